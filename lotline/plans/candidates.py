"""Purchase candidates: a hyphenated address, or two same-owner parcels that touch or are close.

A candidate row carries its one or two members as structs, taken from the residential parcels when
the pair is found. Membership and shortlist then need neither a second pair search nor a join. The
geometry is not among them where rows are staged: a parcel in very many pairs would be written with each. It
is joined by parcel id then. A search whose rows are not staged may carry it (``SHOWN_GEOMETRY``), or whether there
is one (``LOCATED``), so that no pair is shuffled for it.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline import config
from lotline.functions import text as T
from lotline.operators.overlay import with_union
from lotline.operators.within import BLOCK_EDGES, pairs_within
from lotline.schema import CANDIDATE_COLUMNS

# Width of a cell (feet) where only touching pairs are searched: twice their distance would give
# cells of one or two parcels, each of which costs as much as one of dozens.
TOUCH_CELL = 200.0

# Address and id first: members sort by them.
MEMBER_FIELDS = [
    "street_address",
    "parcel_id",
    "owner_normalized",
    "total_livable_area",
    "zoning",
    "market_value",
    "total_area",
    "category_code_description",
    "building_code_description_new",
]


def _by_type(values: dict[str, str], kind: Column) -> Column:
    choice = None
    for name, value in values.items():
        test, result = kind == name, F.lit(value)
        choice = F.when(test, result) if choice is None else choice.when(test, result)
    return choice


# What membership shows of a member. A search whose rows go no further may carry these alone.
MEMBERSHIP_FIELDS = MEMBER_FIELDS[:3]


# Further fields: the geometry itself, and whether there is one. Only parcels that have one are in pairs.
SHOWN_GEOMETRY, LOCATED = "geom", "located"


def member_fields(rows: DataFrame) -> list[str]:
    """The fields that the members of candidate rows carry."""
    return rows.schema["members"].dataType.elementType.fieldNames()


def _member(fields: Sequence[str]) -> Column:
    own = {LOCATED: F.col("geom").isNotNull()}
    return F.struct(*[own.get(name, F.col(name)).alias(name) for name in fields])


def hyphen_candidates(
    residential: DataFrame, run_stamp: str, fields: Sequence[str] = MEMBER_FIELDS
) -> DataFrame:
    """One candidate per parcel whose address number has a hyphen."""
    return residential.where(F.col("address_number").contains("-")).select(
        T.hashed_key(config.ID_PREFIX[config.HYPHEN], F.col("parcel_id")).alias("candidate_id"),
        F.col("street_address").alias("human_id"),
        F.lit(config.HYPHEN).alias("candidate_type"),
        "owner_normalized",
        F.lit(1).alias("parcel_count"),
        F.lit(config.MATCH_REASON[config.HYPHEN]).alias("match_reason"),
        F.lit(None).cast("double").alias("min_pair_distance"),
        F.lit(run_stamp).alias("created_at"),
        F.array(_member(fields)).alias("members"),
    )


def pair_candidates(
    residential: DataFrame,
    run_stamp: str,
    touch_tolerance: float = config.TOUCH_TOLERANCE_FT,
    close_distance: float = config.CLOSE_DISTANCE_FT,
    block_edges: int = BLOCK_EDGES,
    livable: tuple[float, float] | None = None,
    types: Collection[str] = (config.TOUCHING, config.CLOSE),
    fields: Sequence[str] = MEMBER_FIELDS,
) -> DataFrame:
    """Touching and close same-owner pairs, told apart by one distance.

    Shapes that touch have distance zero, so the tolerance test covers them. ``livable`` bounds the
    combined livable area, as a shortlist does, and ``types`` the wanted kinds: both limit the search itself.
    ``fields`` are those of the members; each is written once per pair and side, so the fewer the better.
    """
    close = config.CLOSE in types
    rows = pairs_within(
        residential,
        close_distance if close else min(touch_tolerance, close_distance),
        cell=None if close else TOUCH_CELL,
        block_edges=block_edges,
        carry=_member([name for name in fields if name not in ("parcel_id", "owner_normalized")]),
        shown=fields,
        total=livable and (F.col("total_livable_area"), *livable),
    )
    touching = F.col("pair_distance") <= F.lit(touch_tolerance)
    kind = F.when(touching, config.TOUCHING).otherwise(config.CLOSE)
    rows = rows.withColumn("candidate_type", kind).where(F.col("candidate_type").isin(list(types)))
    # Members come as they are shown. Structs built here, field by field, make a method that the JVM only interprets.
    a, b = F.col("a"), F.col("b")
    ids = F.md5(F.concat_ws(":", "id_a", "id_b"))
    a_first = (a["street_address"] < b["street_address"]) | (
        (a["street_address"] == b["street_address"]) & (a["parcel_id"] < b["parcel_id"])
    )
    both = [config.TOUCHING, config.CLOSE]
    return rows.select(
        F.concat(
            _by_type({k: config.ID_PREFIX[k] for k in both}, F.col("candidate_type")), ids
        ).alias("candidate_id"),
        T.pair_label(a["street_address"], b["street_address"]).alias("human_id"),
        "candidate_type",
        "owner_normalized",
        F.lit(2).alias("parcel_count"),
        _by_type({k: config.MATCH_REASON[k] for k in both}, F.col("candidate_type")).alias(
            "match_reason"
        ),
        F.col("pair_distance").alias("min_pair_distance"),
        F.lit(run_stamp).alias("created_at"),
        F.array(F.when(a_first, a).otherwise(b), F.when(a_first, b).otherwise(a)).alias("members"),
    )


def candidate_rows(
    residential: DataFrame,
    run_stamp: str,
    types: Collection[str] = tuple(config.ID_PREFIX),
    fields: Sequence[str] = MEMBER_FIELDS,
    **limits,
) -> DataFrame:
    """All candidates of the wanted types with their members; ``fields`` begin with MEMBERSHIP_FIELDS."""
    hyphen = hyphen_candidates(residential, run_stamp, fields)
    pair_types = [kind for kind in (config.TOUCHING, config.CLOSE) if kind in types]
    if not pair_types:
        return hyphen
    pairs = pair_candidates(residential, run_stamp, types=pair_types, fields=fields, **limits)
    return hyphen.unionByName(pairs) if config.HYPHEN in types else pairs


def with_unions(rows: DataFrame, residential: DataFrame) -> DataFrame:
    """The candidate columns, with the union of the members' geometry, and ``union_closed``.

    Geometry that the members do not carry is joined by parcel id.
    """
    if SHOWN_GEOMETRY in member_fields(rows):
        located = rows.withColumns(
            {f"geom_{s}": F.get("members", i)[SHOWN_GEOMETRY] for i, s in enumerate("ab")}
        )
    else:
        located = rows.withColumns(
            {f"id_{s}": F.get("members", i)["parcel_id"] for i, s in enumerate("ab")}
        )
        for s in "ab":
            side = residential.select(F.col("parcel_id").alias(f"id_{s}"), F.col("geom").alias(f"geom_{s}"))
            located = located.join(side, f"id_{s}", "left")
    joined = with_union(located, "min_pair_distance")
    union = F.when(F.size("members") == 1, F.col("geom_a")).otherwise(F.col("geom_union"))
    return joined.withColumn("geom_union", union).select(*CANDIDATE_COLUMNS, "union_closed")


def candidate_table(rows: DataFrame, residential: DataFrame) -> DataFrame:
    """The candidate columns, with the union of the members' geometry."""
    return with_unions(rows, residential).select(*CANDIDATE_COLUMNS)


def membership(rows: DataFrame) -> DataFrame:
    """One row per candidate and member, numbered from 1 by address and id."""
    exploded = rows.select("candidate_id", F.posexplode("members").alias("pos", "member"))
    return exploded.select(
        "candidate_id",
        F.col("member.parcel_id"),
        (F.col("pos") + 1).alias("parcel_order"),
        F.col("member.street_address"),
        F.col("member.owner_normalized"),
    )


def with_totals(rows: DataFrame) -> DataFrame:
    """Add the combined figures of what the members carry; nulls are skipped, all-null stays null."""
    fields = member_fields(rows)

    def both(name: str) -> tuple[Column, Column]:
        return F.get("members", 0)[name], F.get("members", 1)[name]

    def total(name: str) -> Column:
        one, two = both(name)
        return F.coalesce(one + two, one, two)

    figures = {"combined_total_livable_area": total("total_livable_area")}
    if "zoning" in fields:
        figures |= {"min_zoning": F.least(*both("zoning")), "max_zoning": F.greatest(*both("zoning"))}
    for name in ("market_value", "total_area"):
        if name in fields:
            figures[f"combined_{name}"] = total(name)
    return rows.withColumns(figures)


def shortlist(
    rows: DataFrame,
    livable_min: float = config.LIVABLE_MIN_SQFT,
    livable_max: float = config.LIVABLE_MAX_SQFT,
) -> DataFrame:
    """Candidate rows whose combined livable area lies within the bounds, with their totals."""
    return with_totals(rows).where(
        F.col("combined_total_livable_area").between(livable_min, livable_max)
    )


def shortlisted_rows(
    residential: DataFrame,
    run_stamp: str,
    livable_min: float = config.LIVABLE_MIN_SQFT,
    livable_max: float = config.LIVABLE_MAX_SQFT,
    **limits,
) -> DataFrame:
    """The shortlist straight from the parcels: pairs out of the livable bounds are left before their distance."""
    rows = candidate_rows(residential, run_stamp, livable=(livable_min, livable_max), **limits)
    return shortlist(rows, livable_min, livable_max)


def shortlist_view(
    candidates: DataFrame,
    members: DataFrame,
    residential: DataFrame,
    livable_min: float = config.LIVABLE_MIN_SQFT,
    livable_max: float = config.LIVABLE_MAX_SQFT,
) -> DataFrame:
    """The shortlist from the three stored tables.

    Groups by the candidate id alone and joins the other candidate columns afterwards, so the
    union geometry takes part in no grouping.
    """
    figures = residential.select(
        "parcel_id", "total_livable_area", "zoning", "market_value", "total_area"
    )
    totals = (
        members.select("candidate_id", "parcel_id")
        .join(figures, "parcel_id")
        .groupBy("candidate_id")
        .agg(
            F.sum("total_livable_area").alias("combined_total_livable_area"),
            F.min("zoning").alias("min_zoning"),
            F.max("zoning").alias("max_zoning"),
            F.sum("market_value").alias("combined_market_value"),
            F.sum("total_area").alias("combined_total_area"),
        )
    )
    kept = totals.where(F.col("combined_total_livable_area").between(livable_min, livable_max))
    return candidates.join(kept, "candidate_id")
