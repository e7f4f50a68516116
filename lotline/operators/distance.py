"""Exact distance of paired shapes, as generate + minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions import geometry as G

# Distances that pass the squared pre-filters are compared again exactly after the square root.
SLACK = 1.0 + 1e-9


# For edges a and b: their directions, squared lengths (null when zero) and b's start seen from a's.
_DIRECTIONS = [
    "ax2 - ax1 AS adx", "ay2 - ay1 AS ady", "bx2 - bx1 AS bdx", "by2 - by1 AS bdy",
    "nullif((ax2 - ax1) * (ax2 - ax1) + (ay2 - ay1) * (ay2 - ay1), 0D) AS alen2",
    "nullif((bx2 - bx1) * (bx2 - bx1) + (by2 - by1) * (by2 - by1), 0D) AS blen2",
    "bx1 - ax1 AS wx", "by1 - ay1 AS wy",
]
# Where along each edge the other's start is nearest, and on which side of it that start lies.
_PLACES = [
    "adx", "ady", "bdx", "bdy", "wx", "wy",
    "coalesce(least(greatest((wx * adx + wy * ady) / alen2, 0D), 1D), 0D) AS at_a",
    "coalesce(least(greatest(-(wx * bdx + wy * bdy) / blen2, 0D), 1D), 0D) AS at_b",
    "adx * bdy - ady * bdx AS turn", "adx * wy - ady * wx AS side_a", "bdx * wy - bdy * wx AS side_b",
]
# The ways from there to those starts, and whether the edges cross.
_WAYS = [
    "wx - at_a * adx AS fx", "wy - at_a * ady AS fy", "wx + at_b * bdx AS gx", "wy + at_b * bdy AS gy",
    "side_a * (side_a + turn) < 0 AND side_b * (side_b + turn) < 0 AS cross",
]
_EDGE_GAP2 = "CASE WHEN holds OR cross THEN 0D ELSE least(fx * fx + fy * fy, gx * gx + gy * gy) END"


def _reach2(within: float | None) -> str:
    """Squared bound on the distance of a pair, from the envelopes alone.

    A shape meets all four sides of its envelope. So where the envelopes are apart along one axis,
    the shapes are no farther than that gap and the full spread along the other axis.
    """

    def bound(along: str, across: str) -> str:
        gap = f"greatest({along}min_a - {along}max_b, {along}min_b - {along}max_a)"
        spread = f"greatest({across}max_a - {across}min_b, {across}max_b - {across}min_a)"
        return f"CASE WHEN {gap} > 0 THEN {gap} * {gap} + {spread} * {spread} END"

    limit = "double('infinity')" if within is None else f"{float(within) ** 2!r}D"
    return f"least({bound('x', 'y')}, {bound('y', 'x')}, {limit}) * {SLACK!r}D"


def _gap(axis: str, low: str, high: str) -> str:
    """Gap along an axis of edge a and the span from ``low`` to ``high``."""
    one, two = f"a{axis}1", f"a{axis}2"
    return f"greatest(0D, least({one}, {two}) - {high}, {low} - greatest({one}, {two}))"


def _squared(dx: str, dy: str) -> str:
    return f"{dx} * {dx} + {dy} * {dy}"


def pair_distance(
    pairs: DataFrame, keys: list[str], within: float | None = None, name: str = "pair_distance"
) -> DataFrame:
    """Minimum distance of the shapes a and b for each key, optionally only up to ``within``.

    ``pairs`` has the shape columns of both sides, suffixed _a and _b. Both edge lists are
    exploded, pairs of edges too far apart to matter dropped, and the minimum taken per key. Edges
    that do not cross are nearest at an end of one of them, and each end is the start of an edge of
    its ring, so every edge compares starts only; an open ring ends in an edge of length zero. The
    rows of one pair come one after the other, so the map-side minimum keeps one row per pair.
    Where ``pairs`` is already partitioned on some of the keys, as after the grid join, the minimum
    needs no shuffle at all. A shape that holds a part of the other has distance zero whatever the
    edges say.
    """
    bounds = ["xmin_b", "ymin_b", "xmax_b", "ymax_b"]
    near_b = _squared(_gap("x", "xmin_b", "xmax_b"), _gap("y", "ymin_b", "ymax_b"))
    near_edge = _squared(
        _gap("x", "least(bx1, bx2)", "greatest(bx1, bx2)"),
        _gap("y", "least(by1, by2)", "greatest(by1, by2)"),
    )
    rows = (
        pairs.selectExpr(
            *keys, "edges_a", "edges_b", *bounds,
            f"{G.holds_part('{}_a', '{}_b')} AS holds", f"{_reach2(within)} AS reach2",
        )
        .selectExpr(
            *keys, "holds", "reach2", "edges_b", *bounds,
            "inline(edges_a) AS (ax1, ay1, ax2, ay2)",
        )
        .where(f"holds OR {near_b} <= reach2")
        .selectExpr(
            *keys, "holds", "reach2", "ax1", "ay1", "ax2", "ay2",
            "inline(edges_b) AS (bx1, by1, bx2, by2)",
        )
        .where(f"holds OR {near_edge} <= reach2")
        .selectExpr(*keys, "holds", *_DIRECTIONS)
        .selectExpr(*keys, "holds", *_PLACES)
        .selectExpr(*keys, "holds", *_WAYS)
    )
    nearest = rows.groupBy(*keys).agg(F.expr(f"sqrt(min({_EDGE_GAP2}))").alias(name))
    return nearest if within is None else nearest.where(F.col(name) <= F.lit(float(within)))
