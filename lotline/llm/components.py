"""Connected components by alternating large and small stars, as joins and aggregations.

Every step is a minimum per node with map-side combining and one join, written to the shared
folder; the links stay in Spark, and the number of steps grows with the logarithm of their number.
A node with very many links sends one row per map task to the minimum, and AQE splits its join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.sources.staging import staged


def _lowest(pairs: DataFrame) -> DataFrame:
    """The smaller of each node ``u`` and its lowest neighbour ``v``."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    hung = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Is each ``u`` below one ``v`` that is below nothing? Then the ``v`` are the lowest of their components."""
    ends = edges.selectExpr("u AS x", "1 AS below", "0 AS above").union(edges.selectExpr("v", "0", "1"))
    places = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return not places.agg(F.count_if(F.col("below") + F.col("above") > 1)).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of long numbers to (node, label), label the lowest node of its component.

    Only nodes with an edge to another node appear. No edges give no rows.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while not _settled(now):
        now = staged(_small_star(_large_star(now)).where("u <> v").distinct(), "edges")
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = labels.select(F.col("label").alias("node"), "label").distinct()
    return labels.union(roots)
