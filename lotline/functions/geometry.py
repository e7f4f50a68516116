"""Polygon geometry as structs of doubles: parsing, envelopes, edges and exact distances.

A geometry is struct<kind, parts>, parts -> rings -> vertices. Everything here is a Column
expression, so it stays in the JVM and inside the surrounding plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def from_geojson(text: Column) -> Column:
    """Polygon or MultiPolygon text to a geometry; null for other types and unusable coordinates."""
    outer = F.from_json(text, "type string, coordinates string")
    kind, coordinates = outer["type"], outer["coordinates"]
    one = F.from_json(coordinates, "array<array<array<double>>>")
    many = F.from_json(coordinates, "array<array<array<array<double>>>>")
    nested = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)

    def vertex(position):
        return F.struct(F.get(position, 0).alias("x"), F.get(position, 1).alias("y"))

    parts = F.transform(
        nested, lambda part: F.transform(part, lambda ring: F.transform(ring, vertex))
    )
    places = F.flatten(F.flatten(nested))
    whole = F.forall(places, lambda p: F.get(p, 0).isNotNull() & F.get(p, 1).isNotNull())
    return F.when(
        (F.size(places) > 0) & whole, F.struct(kind.alias("kind"), parts.alias("parts"))
    )


def is_rejected(text: Column) -> Column:
    """True for geometry text that gives no geometry, unless it is an empty polygon."""
    polygon = F.get_json_object(text, "$.type").isin("Polygon", "MultiPolygon")
    empty = polygon & (F.get_json_object(text, "$.coordinates") == "[]")
    return text.isNotNull() & from_geojson(text).isNull() & ~F.coalesce(empty, F.lit(False))


def to_geojson(geom: Column) -> Column:
    """Geometry to GeoJSON text."""
    coordinates = F.transform(
        geom["parts"],
        lambda part: F.transform(
            part, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
        ),
    )
    single = F.struct(F.lit("Polygon").alias("type"), F.get(coordinates, 0).alias("coordinates"))
    multi = F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))
    return F.when(geom.isNull(), None).otherwise(
        F.when(geom["kind"] == "Polygon", F.to_json(single)).otherwise(F.to_json(multi))
    )


def box(x0: Column, y0: Column, width: Column, height: Column) -> Column:
    """Axis-aligned rectangle, counter-clockwise."""
    corners = [(x0, y0), (x0 + width, y0), (x0 + width, y0 + height), (x0, y0 + height), (x0, y0)]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])
    return F.struct(F.lit("Polygon").alias("kind"), F.array(F.array(ring)).alias("parts"))


def _points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom["parts"]))


def envelope(geom: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax>."""
    xs, ys = _points(geom).getField("x"), _points(geom).getField("y")
    return F.when(
        geom.isNotNull(),
        F.struct(
            F.array_min(xs).alias("xmin"),
            F.array_min(ys).alias("ymin"),
            F.array_max(xs).alias("xmax"),
            F.array_max(ys).alias("ymax"),
        ),
    )


def ring_edges(ring: Column) -> Column:
    """Consecutive vertices as an array of EDGE."""
    xs, ys, n = ring.getField("x"), ring.getField("y"), F.greatest(F.size(ring) - 1, F.lit(0))
    one, two = F.lit(1), F.lit(2)
    zipped = F.arrays_zip(
        F.slice(xs, one, n), F.slice(ys, one, n), F.slice(xs, two, n), F.slice(ys, two, n)
    )
    return zipped.cast(f"array<{EDGE}>")


SHAPE = ["edges", "anchors", "xmin", "ymin", "xmax", "ymax"]

# Consecutive vertices of every ring, as EDGE. A ring that is not closed ends in an edge of length
# zero, so that every vertex is the start of an edge.
_EDGES = f"""flatten(flatten(transform({{geom}}.parts, part -> transform(part, ring ->
  CASE WHEN size(ring) > 1 AND get(ring, 0) = get(ring, size(ring) - 1) THEN CAST(arrays_zip(
    slice(ring.x, 1, size(ring) - 1), slice(ring.y, 1, size(ring) - 1),
    slice(ring.x, 2, size(ring) - 1), slice(ring.y, 2, size(ring) - 1)) AS array<{EDGE}>)
  ELSE CAST(arrays_zip(
    ring.x, ring.y, concat(slice(ring.x, 2, size(ring)), slice(ring.x, -1, 1)),
    concat(slice(ring.y, 2, size(ring)), slice(ring.y, -1, 1))) AS array<{EDGE}>) END))))"""
# One boundary vertex of each part.
_ANCHORS = "array_compact(transform({geom}.parts, part -> get(get(part, 0), 0)))"
_BOUND = "array_{end}(flatten(flatten({geom}.parts)).{axis})"


def with_shape(df: DataFrame, geom: str) -> DataFrame:
    """Add what distance tests need as plain columns: edges, anchors and the four bounds.

    Plain columns, not one struct: Catalyst would copy a struct's expressions to every use.
    """
    bounds = [
        f"{_BOUND.format(end=end, geom=geom, axis=axis)} AS {axis}{end}"
        for axis in ("x", "y")
        for end in ("min", "max")
    ]
    return df.selectExpr(
        "*", f"{_EDGES.format(geom=geom)} AS edges", f"{_ANCHORS.format(geom=geom)} AS anchors",
        *bounds,
    )


def envelope_gap2(a: str, b: str) -> str:
    """Squared gap of two envelopes, zero when they overlap; names as in "a_{}"."""


    def beyond(one: str, two: str, axis: str) -> str:
        return f"{one.format(axis + 'min')} - {two.format(axis + 'max')}"

    gaps = [f"greatest(0D, {beyond(a, b, axis)}, {beyond(b, a, axis)})" for axis in ("x", "y")]
    return " + ".join(f"{gap} * {gap}" for gap in gaps)


def holds_part(a: str, b: str) -> str:
    """Does one shape hold a part of the other? Evaluated only where the envelopes overlap.

    Even-odd test of one vertex of each part over all rings, so holes need nothing extra.
    """

    def within(inner: str, outer: str) -> str:
        crosses = (
            "((e.y1 > p.y) <> (e.y2 > p.y)) AND "
            "(((p.x - e.x1) * (e.y2 - e.y1) < (p.y - e.y1) * (e.x2 - e.x1)) = (e.y2 > e.y1))"
        )
        odd = f"aggregate({outer.format('edges')}, false, (odd, e) -> odd <> ({crosses}))"
        return f"exists({inner.format('anchors')}, p -> {odd})"

    overlap = " AND ".join(
        f"{one.format(axis + 'min')} <= {two.format(axis + 'max')}"
        for axis in ("x", "y")
        for one, two in ((a, b), (b, a))
    )
    return f"CASE WHEN {overlap} THEN {within(a, b)} OR {within(b, a)} ELSE false END"


def ray_crosses(px: Column, py: Column, e: Column) -> Column:
    """Does the ray from the point towards +x cross the edge?"""
    rising = e["y2"] > e["y1"]
    left = (px - e["x1"]) * (e["y2"] - e["y1"]) < (py - e["y1"]) * (e["x2"] - e["x1"])
    return ((e["y1"] > py) != (e["y2"] > py)) & (left == rising)


def inside(px: Column, py: Column, boundary: Column) -> Column:
    """Even-odd test over all rings, so holes need nothing extra."""
    return F.aggregate(
        boundary, F.lit(False), lambda odd, e: odd != ray_crosses(px, py, e)
    )
