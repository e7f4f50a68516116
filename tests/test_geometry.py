import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotline.functions import crs, geometry as G
from lotline.operators.distance import pair_distance

from shapes import GEOM, box, distance, geom, ring, star


def measured(spark, pairs, within=None):
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(pairs)], f"i int, ga {GEOM}, gb {GEOM}"
    )
    for name in ("a", "b"):
        df = G.with_shape(df, f"g{name}").withColumnsRenamed({c: f"{c}_{name}" for c in G.SHAPE})
    return {r.i: r.d for r in pair_distance(df, ["i"], within=within, name="d").collect()}


def test_distance_of_literal_pairs(spark):
    frame = geom([box(0, 0, 100, 100), box(10, 10, 50, 50)])
    cases = [
        (geom([box(0, 0, 50, 50)]), geom([box(50, 0, 50, 50)]), 0.0),
        (geom([box(0, 0, 50, 50)]), geom([box(53, 54, 5, 5)]), 5.0),
        (geom([box(0, 0, 50, 50)]), geom([box(10, 10, 5, 5)]), 0.0),
        (geom([box(10, 10, 5, 5)]), geom([box(0, 0, 50, 50)]), 0.0),
        (frame, geom([box(12, 12, 10, 10)]), 2.0),
        (geom([box(0, 0, 1, 1)], [box(500, 0, 1, 1)]), geom([box(505, 0, 1, 1)]), 4.0),
        (geom([box(0, 0, 9, 9)], [box(500, 0, 1, 1)]), geom([box(490, -9, 30, 30)]), 0.0),
        (geom([box(0, 0, 50, 50)]), geom([box(0, 0, 50, 50)]), 0.0),
        (geom([box(0, 20, 100, 5)]), geom([box(40, 0, 5, 100)]), 0.0),
    ]
    found = measured(spark, [(a, b) for a, b, _ in cases])
    assert found == {i: pytest.approx(c[2]) for i, c in enumerate(cases)}


def test_distance_of_random_polygons(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for _ in range(120):
        a = geom([star(rng, 2.69e6, 2.3e5, 80, rng.integers(3, 9))])
        x, y = rng.uniform(-250, 250, 2)
        b = geom([star(rng, 2.69e6 + x, 2.3e5 + y, 80, rng.integers(3, 9))])
        pairs.append((a, b))
    expected = {i: distance(a, b) for i, (a, b) in enumerate(pairs)}
    assert 0.0 in expected.values()
    assert measured(spark, pairs) == {i: pytest.approx(d, abs=1e-6) for i, d in expected.items()}
    swapped = measured(spark, [(b, a) for a, b in pairs])
    assert swapped == {i: pytest.approx(d, abs=1e-6) for i, d in expected.items()}
    near = measured(spark, pairs, within=100.0)
    assert set(near) == {i for i, d in expected.items() if d <= 100.0}


def test_degenerate_edges_count_as_points(spark):
    flat = geom([[(0.0, 0.0), (0.0, 0.0), (0.0, 0.0)]])
    assert measured(spark, [(flat, geom([box(3, 4, 1, 1)]))]) == {0: pytest.approx(5.0)}


def test_geojson_there_and_back(spark):
    texts = [
        {"type": "Polygon", "coordinates": [[[0.5, 1.0], [2.0, 1.0], [2.0, 3.0], [0.5, 1.0]]]},
        {"type": "MultiPolygon", "coordinates": [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]]},
    ]
    df = spark.createDataFrame([(json.dumps(t),) for t in texts], "t string")
    back = df.select(G.to_geojson(G.from_geojson(F.col("t"))).alias("t")).collect()
    assert [json.loads(r.t) for r in back] == texts


def test_other_geometry_is_null_and_reported(spark):
    texts = ['{"type":"Point","coordinates":[1,2]}', '{"type":"Polygon","coordinates":[]}', None]
    texts += ['{"type":"Polygon","coordinates":[[[0,0],[1,"x"],[1,1]]]}', '{"type":"Polygon","coordinates":[[[0],[1,0],[1,1]]]}']
    texts += ['{"coordinates":[[[0,0],[1,0],[1,1]]]}', '{"type":"Polygon"']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(G.from_geojson(F.col("t")).alias("g"), G.is_rejected(F.col("t")).alias("u"))
    assert [(r.g, r.u) for r in rows.collect()] == [(None, True), (None, False), (None, False)] + [(None, True)] * 4


def test_envelope(spark):
    df = spark.createDataFrame([(geom([box(1, 2, 3, 4)], [box(-5, 0, 1, 1)]),)], f"g {GEOM}")
    assert tuple(df.select(G.envelope(F.col("g")).alias("e")).first().e) == (-5.0, 0.0, 4.0, 6.0)


def test_projection_anchors(spark):
    points = [(-77.75, 39 + 20 / 60, 1968500.0, 0.0), (-75.1635, 39.9526, 2693536.617, 236208.869)]
    df = spark.createDataFrame(points, "lon double, lat double, x double, y double")
    x, y = crs.PENNSYLVANIA_SOUTH_FT.forward(F.col("lon"), F.col("lat"))
    lon, lat = crs.PENNSYLVANIA_SOUTH_FT.inverse(x, y)
    for r in df.select("*", x.alias("px"), y.alias("py"), lon.alias("blon"), lat.alias("blat")).collect():
        assert (r.px, r.py) == (pytest.approx(r.x, abs=1e-3), pytest.approx(r.y, abs=1e-3))
        assert (r.blon, r.blat) == (pytest.approx(r.lon, abs=1e-11), pytest.approx(r.lat, abs=1e-11))


def test_published_projection_example(spark):
    # NAD27 / Texas South Central, US feet: the worked example of the IOGP guidance note 7-2.
    clarke = 6378206.4 / crs.FOOT_M
    cone = crs.Lambert(
        clarke, 294.978698214, 27 + 50 / 60, -99.0, (28 + 23 / 60, 30 + 17 / 60), 2000000.0, 0.0
    )
    x, y = cone.forward(F.lit(-96.0), F.lit(28.5))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert (row.x, row.y) == (pytest.approx(2963503.91, abs=0.01), pytest.approx(254759.80, abs=0.01))


def test_unknown_crs_is_named(spark):
    df = spark.createDataFrame([(geom([box(0, 0, 1, 1)]), "EPSG:9999")], f"g {GEOM}, s string")
    with pytest.raises(Exception, match="EPSG:9999"):
        df.select(crs.to_working(F.col("g"), F.col("s"))).collect()
    assert ring([(0, 0), (1, 0), (1, 1)])[0] == (0.0, 0.0)
