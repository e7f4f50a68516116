"""Canonical and residential parcels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions import text as T
from lotline.operators.first_per_key import canonical_order, first_per_key


def canonical_parcels(raw: DataFrame) -> DataFrame:
    """One row per parcel id: first file, then first feature id, nulls last."""
    return first_per_key(raw, ["parcel_id"], canonical_order(raw.columns)).drop("feature_pos")


def residential_parcels(canonical: DataFrame, assessments: DataFrame) -> DataFrame:
    """Parcels whose assessment has a residential zoning code, with the assessment's columns."""
    # Very many parcels may lack an account; a blank one has no assessment.
    c = canonical.where(F.col("opa_account_num") != "").alias("c")
    o = assessments.alias("o")
    joined = c.join(o, F.col("c.opa_account_num") == F.col("o.parcel_number"))
    return joined.where(T.residential_zoning(F.col("o.zoning"))).select(
        "c.*",
        "o.zoning",
        F.col("o.address_std").alias("opa_address_std"),
        "o.market_value",
        "o.sale_price",
        "o.total_area",
        "o.total_livable_area",
        "o.category_code_description",
        "o.building_code_description_new",
    )
