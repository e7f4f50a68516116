"""Same-key pairs of shapes within a distance, through a multi-level grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lotline.functions import geometry as G
from lotline.operators.block_distance import pairs_of_blocks
from lotline.operators.distance import SLACK
from lotline.sources.staging import staged

# Shapes that lie in one cell and have more edges than this together are cut into blocks of about this
# many. Fewer may be asked for, but a cell makes no more than CELL_BLOCKS of them unless they would exceed it:
# a block travels to every block near it.
BLOCK_EDGES = 32_000
CELL_BLOCKS = 16
# A task is made for every so many pairs of shapes; beyond some tasks a core, only for as many as are much work.
TASK_PAIRS, LARGE_TASK_PAIRS, TASKS_PER_CORE = 250_000, 20_000_000, 6

TILE = ["level", "tx", "ty"]
CELL = ["level", "cx", "cy"]
BOUNDS = ["xmin", "ymin", "xmax", "ymax"]

# Smallest level whose cells are at least as wide as the envelope.
_LEVEL = """CAST(ceil(log2(greatest(
    greatest(xmax - xmin, ymax - ymin) / {cell!r}D, 1D))) AS INT)"""


def _index(edge: str, cell: float) -> str:
    return f"CAST(floor(({edge}) / ({cell!r}D * power(2D, level))) AS BIGINT)"


def _cells(df: DataFrame, cell: float, margin: float) -> DataFrame:
    """One row per cell of ``level`` that the envelope, grown by ``margin``, meets.

    ``x_low`` and ``y_low`` keep the lowest of those cells.
    """
    low = [f"{_index(f'{axis}min - {margin!r}D', cell)} AS {axis}_low" for axis in ("x", "y")]
    cells = df.selectExpr("*", *low)
    for axis in ("x", "y"):
        last = _index(f"{axis}max + {margin!r}D", cell)
        cells = cells.selectExpr("*", f"explode(sequence({axis}_low, {last})) AS c{axis}")
    return cells


def _blocks(shapes: DataFrame, key: str, cell: float, block_edges: int) -> DataFrame:
    """Blocks of the shapes whose lowest corners lie in one cell of their level: one row each, on files.

    A shape is in one block. Cells with many edges are the only ones that are cut; there are fewer of them than
    blocks, so their list is broadcast.
    """
    corners = [f"{_index(f'{axis}min', cell)} AS t{axis}" for axis in ("x", "y")]
    placed = staged(
        shapes.selectExpr("*", f"{_LEVEL.format(cell=cell)} AS level", "size(edges) AS n_edges").selectExpr("*", *corners),
        "shapes",
    )
    tile = [key, *TILE]
    most = f"greatest({CELL_BLOCKS}, ceil(edges / {BLOCK_EDGES}))"
    crowded = placed.groupBy(*tile).agg(F.sum("n_edges").alias("edges")).where(F.col("edges") > block_edges)
    cut = crowded.selectExpr(*tile, f"least(ceil(edges / {block_edges}), {most}) AS blocks")
    dealt = placed.join(F.broadcast(cut), tile, "left").withColumn(
        "block", F.expr("coalesce(pmod(xxhash64(id), blocks), 0)")
    )
    shape = F.struct(*[c for c in placed.columns if c not in (*tile, "n_edges")])
    bounds = [(F.min if c.endswith("min") else F.max)(c).alias(c) for c in BOUNDS]
    found = dealt.groupBy(*tile, "block").agg(F.collect_list(shape).alias("shapes"), *bounds, F.count("*").alias("n"))
    return staged(found.withColumn("block_id", F.monotonically_increasing_id()), "blocks")


def _meeting_blocks(blocks: DataFrame, distance: float, key: str, cell: float) -> DataFrame:
    """The pairs of blocks whose envelopes are within the distance, a block with itself included, on files.

    Each block lies on the level of its shapes. Two meet on the level of the higher one, whose envelope is
    grown by the distance ("near"); the other is listed under its plain envelope on its own level and every
    higher one that its key uses ("home"). They count in the lowest cell they share, so no distinct is needed.
    """
    slim = blocks.select(key, "block_id", "n", *BOUNDS, F.col("level").alias("own_level"))
    used = slim.selectExpr(key, "own_level AS level").distinct()
    near = _cells(slim.selectExpr("*", "own_level AS level"), cell, float(distance * SLACK))
    home = _cells(slim.join(used, key).where("level >= own_level"), cell, 0.0)
    place = [key, *CELL]
    near, home = (
        side.withColumnsRenamed({c: f"{s}_{c}" for c in side.columns if c not in place})
        for side, s in ((near, "near"), (home, "home"))
    )
    gap2 = G.envelope_gap2("near_{}", "home_{}")
    met = near.join(home, place).where(
        f"""(home_own_level < level OR near_block_id < home_block_id OR near_block_id = home_block_id AND near_n > 1)
        AND cx = greatest(near_x_low, home_x_low) AND cy = greatest(near_y_low, home_y_low)
        AND {gap2} <= {float(distance) ** 2 * SLACK!r}D"""
    )
    return staged(met.selectExpr("near_block_id", "home_block_id", "near_n * home_n AS pairs"), "met")


def near_blocks(
    shapes: DataFrame,
    distance: float,
    key: str,
    cell: float | None = None,
    block_edges: int = BLOCK_EDGES,
) -> DataFrame:
    """Pairs of blocks of shapes, in which each unordered same-key pair within ``distance`` counts once.

    ``shapes`` has the key, a unique text ``id``, the shape columns and maybe ``carried`` and ``amount``.
    Each shape lies on the grid level that fits its size, in the cell of its lowest corner, and in one block
    there; blocks meet through their envelopes. Only then do the shapes travel: those of a block to each block
    that it meets, whole, so what is shuffled grows with the pairs of blocks. A block of either side is one row,
    so a join row is bounded as blocks are, and no pair of shapes is a row before its distance is known.
    """
    cell = float(2.0 * distance if cell is None else cell)
    blocks = _blocks(shapes, key, cell, block_edges)
    met = _meeting_blocks(blocks, distance, key, cell)
    size = met.agg(F.sum("pairs").alias("pairs"), F.count("*").alias("rows")).first()
    cores = shapes.sparkSession.sparkContext.defaultParallelism
    pairs, most = size.pairs or 0, cores * TASKS_PER_CORE
    tasks = max(1, min(size.rows, -(-pairs // TASK_PAIRS), max(most, -(-pairs // LARGE_TASK_PAIRS))))
    near = met.drop("pairs").join(
        blocks.select(F.col("block_id").alias("near_block_id"), F.col("shapes").alias("near")), "near_block_id"
    )
    home = blocks.select(F.col("block_id").alias("home_block_id"), key, F.col("shapes").alias("home"))
    # A merge join, as the rows are few but much work: a broadcast would not spread it. The number of tasks is
    # given by that work, as the bytes tell little of it.
    near, home = (side.repartition(tasks, "home_block_id") for side in (near, home))
    return near.join(home.hint("merge"), "home_block_id").withColumn("same", F.expr("near_block_id = home_block_id"))


def pairs_within(
    df: DataFrame,
    distance: float,
    key: str = "owner_normalized",
    id_column: str = "parcel_id",
    geom_column: str = "geom",
    cell: float | None = None,
    block_edges: int = BLOCK_EDGES,
    carry: Column | None = None,
    shown: Sequence[str] | None = None,
    total: tuple[Column, float, float] | None = None,
) -> DataFrame:
    """Same-key pairs within ``distance``: key, id_a < id_b (as text), pair_distance.

    Rows with an empty key or no geometry take no part. ``carry`` is a column of ``df`` that each
    pair shows for both members, as a and b; it travels with the shapes, not with the pairs. With ``shown``, a and b
    are structs of these fields in this order: those of ``carry``, the id and the key by their column names. ``total``
    is a column of doubles and two bounds: only pairs whose sum of it lies within them are found, nulls
    being skipped. It is asked before the distance is taken, so that the others cost no more than that.
    """
    bounds = None if total is None else (float(total[1]), float(total[2]))
    amount = [] if total is None else [total[0].cast("double").alias("amount")]
    carried = [] if carry is None else [carry.alias("carried")]
    shapes = df.where((F.col(key) != "") & F.col(geom_column).isNotNull()).select(
        F.col(key).alias("key"),
        F.col(id_column).alias("id"),
        F.col(geom_column).alias("geom"),
        *carried,
        *amount,
    )
    shapes = G.with_shape(shapes, "geom").drop("geom")
    blocks = near_blocks(shapes, distance, "key", cell, block_edges)
    schema = f"key {shapes.schema['key'].dataType.simpleString()}, id_a string, id_b string, pair_distance double"
    fields = None
    if carried:
        kind = shapes.schema["carried"].dataType
        if shown is not None:
            own = {id_column: "id", key: "key"}
            fields = [(name, own.get(name)) for name in shown]
            inner = [shapes.schema[of].dataType if of else kind[name].dataType for name, of in fields]
            kind = StructType([StructField(name, of_type) for name, of_type in zip(shown, inner)])
        schema += "".join(f", {s} {kind.simpleString()}" for s in "ab")
    found = blocks.select("key", "same", "near", "home").mapInArrow(
        pairs_of_blocks(float(distance), bool(carried), bounds, fields), schema
    )
    return found.withColumnRenamed("key", key)
