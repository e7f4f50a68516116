"""Job parameters and the fixed values of the candidate rules."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

# Results depend on them.
DEFAULT_SOURCE_CRS = "EPSG:4326"
WORKING_CRS = "EPSG:2272"
TOUCH_TOLERANCE_FT = 1.0
CLOSE_DISTANCE_FT = 500.0
LIVABLE_MIN_SQFT = 3000.0
LIVABLE_MAX_SQFT = 7000.0
ACCOUNTS_PER_BATCH = 200
SOURCE_PATTERN = "properties-*.json"
CACHE_PATTERN = "batch-*.json"

PARCEL_ID_KEYS = ("parcel_id", "parcelid", "objectid")
ACCOUNT_KEYS = ("brt_id", "tencode")

HYPHEN = "hyphen_address"
TOUCHING = "touching_same_owner"
CLOSE = "close_same_owner"
ID_PREFIX = {HYPHEN: "HYPHEN_", TOUCHING: "TOUCH_", CLOSE: "CLOSE_"}
MATCH_REASON = {
    HYPHEN: "address_number_contains_hyphen",
    TOUCHING: "same_owner_touching_or_within_1_ft",
    CLOSE: "same_owner_within_500_ft_excluding_touching",
}


def utc_stamp() -> str:
    """Current UTC time as ISO-8601 text with seconds."""
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


@dataclass(frozen=True)
class JobConfig:
    """Everything one full run needs; paths may be on any file system Spark can reach."""

    source_glob: str
    cache_dir: str
    output_dir: str
    refresh: bool = False
    offline: bool = False
    #: Build also while batches of assessments are missing from the cache.
    allow_missing: bool = False
    source_layout: str = "collection"
    #: CRS of sources that name none (EPSG:4326 if unset).
    source_crs: str | None = None
    touch_tolerance: float = TOUCH_TOLERANCE_FT
    close_distance: float = CLOSE_DISTANCE_FT
    livable_min: float = LIVABLE_MIN_SQFT
    livable_max: float = LIVABLE_MAX_SQFT
    batch_size: int = ACCOUNTS_PER_BATCH
    run_stamp: str = field(default_factory=utc_stamp)
