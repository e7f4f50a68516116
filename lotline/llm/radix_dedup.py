"""Exact duplicates by distributed MSD radix partitioning.

Documents are split by their leading bytes, then each group again by its next bytes, and so on,
until a group has one member or all its members have ended. Equality is decided by the bytes
themselves; no digest is compared. Everything is DataFrame operations:

* Level 0 looks at the first 64 bytes only. Most documents are alone there and done.
* Each later level takes a digit of four times the width, so a group of equal texts of n bytes
  takes about log4(n / 64) levels. A level sees only the documents that still share a group.
* A level counts the members of each (group, digit) with map-side combining, so a group that holds
  a third of all rows sends one row per map task. The members are joined to these counts, never
  collected; AQE splits the join where one group is hot.
* Each level is written to the shared folder and read back, which also ends its lineage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import ascii_lower
from lotline.sources.staging import staged, staging_run

FIRST_BYTES = 64
GROWTH = 4


def radix_groups(docs: DataFrame, carry: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with the group of equal texts that it is in.

    Returns doc_id, keep_id, group_size, kept, text_sha256 and, with ``carry``, the whole input row
    as the struct ``source_row`` (so that clashing column names cannot hurt). Texts are compared
    after lower-casing A-Z; null counts as empty. The row with the largest doc_id stays; a null
    doc_id is below all others. Of repeated rows with that same doc_id exactly one stays. Texts are
    compared whole, however long. An empty table gives an empty result.
    """
    # Carried rows hold the text already; otherwise it travels in normalised form, while needed.
    if carry:
        extra, body = ["source_row"], ascii_lower(F.coalesce("source_row.text", F.lit("")))
        rows = docs.select("doc_id", F.struct("*").alias("source_row"))
        text = F.coalesce(F.col("source_row.text"), F.lit(""))
    else:
        extra, body = [], F.col("body")
        rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("raw"))
        text = F.col("raw")
    # The first 64 characters hold at least the first 64 bytes.
    start = ascii_lower(F.substring(text, 1, FIRST_BYTES)).cast("binary")
    level = rows.select(
        "*",
        F.substring(start, 1, FIRST_BYTES).alias("digit"),
        (F.octet_length(text) <= FIRST_BYTES).alias("ended"),
    )
    shared = (
        level.groupBy("digit", "ended")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digit", "ended", F.lit(True).alias("shared"))
    )
    is_open, lowered = F.col("shared").isNotNull(), ascii_lower(text)
    state = staged(
        level.join(shared, ["digit", "ended"], "left").select(
            "doc_id",
            *extra,
            F.monotonically_increasing_id().alias("row_id"),
            F.sha2(lowered.cast("binary"), 256).alias("text_sha256"),
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            is_open.alias("open"),
            F.when(is_open, F.col("digit")).alias("group"),
            *([] if carry else [F.when(is_open, lowered).alias("body")]),
        ),
        "radix-0",
    )
    levels = [state]
    done, width = FIRST_BYTES, FIRST_BYTES * GROWTH
    while not state.where("open").isEmpty():
        state = staged(_split(state.where("open"), body, done, width, carry), f"radix-{len(levels)}")
        levels.append(state)
        done, width = done + width, width * GROWTH
    settled = [
        x.where("NOT open").select("doc_id", "keep_id", "group_size", "kept", "text_sha256", *extra)
        for x in levels
    ]
    return reduce(DataFrame.unionByName, settled)


def _split(members: DataFrame, body: Column, done: int, width: int, carry: bool) -> DataFrame:
    """Split each group by its next ``width`` bytes."""
    digits = members.drop("keep_id", "group_size", "kept", "open").select(
        "*",
        F.substring(body.cast("binary"), done + 1, width).alias("digit"),
        (F.octet_length(body) <= done + width).alias("ended"),
    )
    keys = ["group", "digit", "ended"]
    counts = (
        digits.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.struct("doc_id", "row_id")).alias("top"),
            F.min("row_id").alias("next_group"),
        )
        .where("n > 1")
    )
    same = F.col("n").isNotNull() & F.col("ended")
    is_open = F.col("n").isNotNull() & ~F.col("ended")
    return digits.join(counts, keys, "left").select(
        "doc_id",
        *(["source_row"] if carry else []),
        "row_id",
        "text_sha256",
        F.when(same, F.col("top.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.when(same, F.col("n")).otherwise(F.lit(1)).cast("long").alias("group_size"),
        (~same | (F.col("top.row_id") == F.col("row_id"))).alias("kept"),
        is_open.alias("open"),
        F.when(is_open, F.col("next_group")).alias("group"),
        *([] if carry else [F.when(is_open, F.col("body")).alias("body")]),
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of equal texts, all columns unchanged."""
    with staging_run(docs.sparkSession):
        kept = radix_groups(docs, carry=True).where("kept").select("source_row")
        return staged(kept, "kept", lasting=True).select("source_row.*")
