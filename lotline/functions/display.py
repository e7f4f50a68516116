"""Display text of the review panel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "—"


def _rounded(value: Column) -> Column:
    # Halves go up, also below zero.
    return F.format_number(F.floor(value + F.lit(0.5)), 0)


def money(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), _rounded(value)), F.lit(MISSING))


def square_feet(value: Column) -> Column:
    return F.coalesce(F.concat(_rounded(value), F.lit(" sf")), F.lit(MISSING))


def label(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(MISSING))
