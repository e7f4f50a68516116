import numpy as np
import pytest
from pyspark.sql import functions as F

from lotline.operators.within import pairs_within
from lotline.plans import candidates as C

from shapes import GEOM, box, distance, geom, segments, star


def frame(spark, parcels):
    return spark.createDataFrame(parcels, f"parcel_id string, owner_normalized string, geom {GEOM}")


def found(df):
    return {(r.id_a, r.id_b): r.pair_distance for r in df.collect()}


def brute(parcels, limit):
    result = {}
    for ia, oa, ga in parcels:
        for ib, ob, gb in parcels:
            if oa == ob and oa and ia < ib and ga and gb:
                d = distance(ga, gb)
                if d <= limit:
                    result[ia, ib] = pytest.approx(d, abs=1e-6)
    return result


def mixed_parcels(n, owners, seed):
    """Small, long and very large parcels, so several grid levels are in use."""
    rng = np.random.default_rng(seed)
    parcels = []
    for i in range(n):
        x, y = rng.uniform(-3000, 3000, 2)
        if i % 10 == 0:
            g = geom([box(x, y, rng.uniform(2000, 9000), 30)])
        elif i % 17 == 0:
            g = geom([star(rng, x, y, 4000, 7)])
        else:
            g = geom([star(rng, x, y, 60, 5)])
        parcels.append((str(i), f"O{rng.integers(owners)}", g))
    return parcels


@pytest.mark.parametrize("limit", [50.0, 500.0])
def test_equal_to_brute_force(spark, limit):
    parcels = mixed_parcels(90, 3, seed=3)
    parcels += [("n1", "O1", None), ("e1", "", parcels[0][2]), ("e2", "", parcels[0][2])]
    expected = brute(parcels, limit)
    assert expected
    assert found(pairs_within(frame(spark, parcels), limit)) == expected


def test_one_owner_in_small_blocks(spark):
    parcels = [(i, "ALL", g) for i, _, g in mixed_parcels(80, 1, seed=4)]
    expected = brute(parcels, 300.0)
    df = frame(spark, parcels)
    assert found(pairs_within(df, 300.0, block_edges=12)) == expected
    assert found(pairs_within(df, 300.0, cell=50.0)) == expected
    assert found(pairs_within(df.repartition(7), 300.0, block_edges=40)) == expected


def test_scattered_owners_are_left_out_first(spark):
    """Most owners have lone parcels; few pairs meet, some across grid levels."""
    rng = np.random.default_rng(8)
    parcels = []
    for i in range(120):
        x, y = rng.uniform(0, 200_000, 2)
        parcels.append((f"a{i}", f"S{i // 2}", geom([star(rng, x, y, 60, 5)])))
        if i % 8 == 0:
            near_by = geom([star(rng, x + 300, y, 60, 5)])
            parcels.append((f"b{i}", f"S{i // 2}", near_by))
        if i % 15 == 0:
            long = geom([box(x - 9000, y + 200, 18_000, 20)])
            parcels.append((f"c{i}", f"S{i // 2}", long))
    expected = brute(parcels, 500.0)
    assert len(expected) > 15
    df = frame(spark, parcels)
    for block_edges in (1, 80, 4000):
        assert found(pairs_within(df, 500.0, block_edges=block_edges)) == expected


def test_coincident_parcels(spark):
    parcels = [(str(i), "ALL", geom([box(5, 5, 10, 10)])) for i in range(60)]
    pairs = found(pairs_within(frame(spark, parcels), 500.0, block_edges=28))
    assert len(pairs) == 60 * 59 // 2
    assert set(pairs.values()) == {0.0}
    assert all(a < b for a, b in pairs)


@pytest.mark.parametrize(
    "gap, kind",
    [(0.0, C.config.TOUCHING), (1.0, C.config.TOUCHING), (1.0001, C.config.CLOSE),
     (500.0, C.config.CLOSE), (500.0001, None)],
)
def test_distance_bounds(spark, gap, kind):
    parcels = [("9", "A", geom([box(0, 0, 50, 50)])), ("10", "A", geom([box(50 + gap, 0, 50, 50)]))]
    res = frame(spark, parcels).withColumns(
        {name: F.lit(None).cast("double") for name in ("total_livable_area", "market_value", "total_area")}
    ).withColumns(
        {name: F.lit("x") for name in ("street_address", "zoning", "category_code_description",
                                        "building_code_description_new")}
    )
    rows = C.pair_candidates(res, "now").select("candidate_type", "members.parcel_id").collect()
    assert [r.candidate_type for r in rows] == ([kind] if kind else [])
    if kind:
        assert rows[0].parcel_id == ["10", "9"]


def test_join_keeps_its_partitions_for_the_minimum(spark):
    parcels = mixed_parcels(20, 2, seed=1)
    plan = pairs_within(frame(spark, parcels), 500.0)._jdf.queryExecution().executedPlan().toString()
    above_join = plan[: plan.index("SortMergeJoin")]
    assert "Exchange" not in above_join
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_empty_input(spark):
    assert found(pairs_within(frame(spark, []), 500.0)) == {}


def test_members_travel_with_the_shapes_not_with_the_pairs(spark):
    """Nothing shuffles or joins the pairs, of which there may be far more than parcels."""
    parcels = mixed_parcels(40, 2, seed=5)
    df = frame(spark, parcels)
    pairs = pairs_within(df, 500.0, block_edges=30, carry=F.struct("parcel_id", "owner_normalized"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in above and "Join" not in above and "Aggregate" not in above
    owners = {i: o for i, o, _ in parcels}
    rows = pairs.collect()
    assert found(pairs) == brute(parcels, 500.0) and rows
    for r in rows:
        assert (r.a.parcel_id, r.b.parcel_id) == (r.id_a, r.id_b)
        assert r.a.owner_normalized == r.b.owner_normalized == owners[r.id_a]


def test_distances_do_not_depend_on_how_edges_are_dealt(spark, monkeypatch):
    from lotline.operators import block_distance as B

    parcels = mixed_parcels(40, 1, seed=6)
    expected = brute(parcels, 400.0)
    for name in ("COMPARED", "TAKEN", "EDGE_PAIRS"):
        monkeypatch.setattr(B, name, 3)
    assert found(pairs_within(frame(spark, parcels), 400.0)) == expected


def test_bounds_of_a_total_are_asked_before_the_distance(spark, monkeypatch):
    """Nulls are skipped, NaN lies in no bounds, and pairs out of them get no distance."""
    parcels = mixed_parcels(60, 2, seed=9)
    areas = {p[0]: [None, float("nan"), 2000.0, 3000.0, 4000.0, 9000.0][k % 6] for k, p in enumerate(parcels)}
    df = spark.createDataFrame(
        [(*p, areas[p[0]]) for p in parcels], f"parcel_id string, owner_normalized string, geom {GEOM}, area double"
    )

    def kept(a, b):
        known = [areas[i] for i in (a, b) if areas[i] is not None]
        return bool(known) and 3000 <= sum(known) <= 7000

    every = found(pairs_within(df, 500.0))
    expected = {pair: d for pair, d in every.items() if kept(*pair)}
    assert 0 < len(expected) < len(every)
    for block_edges in (30, 8000):
        limited = pairs_within(df, 500.0, block_edges=block_edges, total=(F.col("area"), 3000.0, 7000.0))
        assert found(limited) == expected


def test_shortlist_and_types_limit_the_search(spark):
    rng = np.random.default_rng(12)
    parcels = [(str(i), "A", geom([box(*(50.0 * rng.integers(0, 9, 2)), 50, 50)]), float(900 * (i % 9))) for i in range(60)]
    parcels = [(*p[:3], None if i % 7 == 0 else p[3], f"{i}-{i + 2}" if i % 5 == 0 else str(i)) for i, p in enumerate(parcels)]
    res = spark.createDataFrame(
        parcels,
        f"parcel_id string, owner_normalized string, geom {GEOM}, total_livable_area double, address_number string",
    ).withColumns(
        {name: F.lit(None).cast("double") for name in ("market_value", "total_area")}
        | {name: F.lit("x") for name in ("street_address", "zoning", "category_code_description", "building_code_description_new")}
    )
    every = C.candidate_rows(res, "now")
    wanted = {tuple(r) for r in C.shortlist(every).drop("members").collect()}
    assert wanted and {tuple(r) for r in C.shortlisted_rows(res, "now").drop("members").collect()} == wanted
    kinds = [C.config.HYPHEN, C.config.TOUCHING, C.config.CLOSE]
    for types in ([kinds[0]], [kinds[1]], [kinds[2]], kinds[:2]):
        wanted = {tuple(r) for r in every.drop("members").where(F.col("candidate_type").isin(types)).collect()}
        assert wanted
        assert {tuple(r) for r in C.candidate_rows(res, "now", types=types).drop("members").collect()} == wanted


def _side(shapes):
    """Shapes as a block holds them."""
    import pyarrow as pa

    from lotline.operators.block_distance import _Side

    rows = []
    for g in shapes:
        edges = [dict(zip(("x1", "y1", "x2", "y2"), s)) for s in segments(g)]
        xs, ys = zip(*[p for part in g[1] for ring in part for p in ring])
        rows.append(
            {"id": "x", "own_level": 0, "x_low": 0, "y_low": 0, "xmin": min(xs), "ymin": min(ys), "xmax": max(xs),
             "ymax": max(ys), "edges": edges, "anchors": [dict(zip("xy", part[0][0])) for part in g[1]]}
        )
    return _Side(pa.array(rows))


def test_few_edges_and_shared_vertices_need_no_lists_of_edges(monkeypatch):
    """Shapes of few edges are compared as tables; those that share a vertex need no edges at all."""
    from lotline.operators import block_distance as B

    def refused(*ends):
        raise AssertionError("pairs of edges are listed")

    rng = np.random.default_rng(21)
    one = [geom([star(rng, 40 * k, 0, 15, 3 + k % 6)]) for k in range(12)]
    two = [geom([star(rng, 40 * k + 5, 35 + 9 * k, 15, 3 + k % 5)]) for k in range(12)]
    many = [(x / 10, 0.0) for x in range(200)] + [(20.0, 20.0), (0.0, 20.0)]
    one.append(geom([many + many[:1]]))
    two.append(geom([[(x, -y) for x, y in many + many[:1]]]))
    i, j = (k.ravel() for k in np.meshgrid(np.arange(12), np.arange(12), indexing="ij"))
    i, j = np.append(i, 12), np.append(j, 12)
    a, b = _side(one), _side(two)
    apart = (a.xmin[i] > b.xmax[j]) | (b.xmin[j] > a.xmax[i]) | (a.ymin[i] > b.ymax[j]) | (b.ymin[j] > a.ymax[i])
    i, j = i[apart | (i == 12)], j[apart | (i == 12)]
    assert len(i) > 100
    monkeypatch.setattr(B, "_edge_gap2", refused)
    for table in (16_384, 50):
        monkeypatch.setattr(B, "TABLE", table, raising=False)
        far = B._distances(a, i, b, j, 1e6)
        assert list(far) == [pytest.approx(distance(one[x], two[y]), abs=1e-9) for x, y in zip(i, j)]
        assert far[-1] == 0


def test_pairs_carry_only_the_member_fields_that_are_shown(spark, monkeypatch):
    """Id and owner are the pair's own; with the fields of a membership, the address alone is carried."""
    rng = np.random.default_rng(15)
    parcels = [(str(i), f"O{i % 2}", geom([star(rng, *rng.uniform(0, 900, 2), 40, 5)]), f"{i % 7} ST") for i in range(40)]
    res = spark.createDataFrame(
        parcels, f"parcel_id string, owner_normalized string, geom {GEOM}, street_address string"
    ).withColumns(
        {name: F.lit(1.0) for name in ("total_livable_area", "market_value", "total_area")}
        | {name: F.lit("x") for name in ("zoning", "category_code_description", "building_code_description_new")}
        | {"address_number": F.expr("CASE WHEN parcel_id % 5 = 0 THEN '1-3' ELSE '1' END")}
    )
    carried = []

    def search(df, *args, **kwargs):
        carried.append(df.select(kwargs["carry"].alias("c")).schema["c"].dataType.fieldNames())
        return pairs_within(df, *args, **kwargs)

    monkeypatch.setattr(C, "pairs_within", search)
    full, slim = C.candidate_rows(res, "now"), C.candidate_rows(res, "now", fields=C.MEMBERSHIP_FIELDS)
    assert "parcel_id" not in carried[0] and carried[1] == ["street_address"]
    wanted = {tuple(r) for r in full.drop("members").collect()}
    assert len(wanted) > 100 and {tuple(r) for r in slim.drop("members").collect()} == wanted
    assert sorted(map(tuple, C.membership(slim).collect())) == sorted(map(tuple, C.membership(full).collect()))


def test_a_crowded_cell_sends_its_shapes_to_few_blocks(spark):
    """However few edges a block is asked to have, the copies of a shape do not grow with those beside it."""
    from lotline.functions import geometry as G
    from lotline.operators.within import CELL_BLOCKS, near_blocks

    n = 64
    parcels = [(f"{i:02}", "ALL", geom([box(5, 5, 10, 10)])) for i in range(n)]
    df = frame(spark, parcels).withColumnsRenamed({"parcel_id": "id", "owner_normalized": "key"})
    blocks = near_blocks(G.with_shape(df, "geom").drop("geom"), 500.0, "key", block_edges=4)
    copies = blocks.agg(F.sum(F.size("near") + F.size("home"))).first()[0]
    assert copies <= n * (CELL_BLOCKS + 1)
    assert len(found(pairs_within(frame(spark, parcels), 500.0, block_edges=4))) == n * (n - 1) // 2


def test_generated_methods_over_pairs_are_small_enough_to_be_compiled(spark):
    """The JVM only interprets methods of more than 8,000 bytes, and each pair passes through these."""
    import re

    import __spark_entry__ as E

    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for query in (E.q_features, E.q_shortlist, E.q_map_extent):
            plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
            assert sizes and max(sizes) <= 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
