"""Registered queries and their DuckDB counterparts.

The spatial queries run on boxes that Spark derives from the whole ``customer`` table, so that
distances, overlaps and unions have closed forms in plain SQL.
"""

from __future__ import annotations

import os
import sys
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lotline import JobConfig  # noqa: E402
from lotline.functions import crs, display, geometry as G, text as T  # noqa: E402
from lotline.functions import jsonfields as J  # noqa: E402
from lotline.operators import batches, quality  # noqa: E402
from lotline.operators.computed import computed_once  # noqa: E402
from lotline.operators.distance import pair_distance  # noqa: E402
from lotline.operators.overlay import with_touches, with_union, with_union_area  # noqa: E402
from lotline.operators.within import pairs_within  # noqa: E402
from lotline.plans import candidates as C, export, job, parcels as P  # noqa: E402
from lotline.sources import assessments as A, geojson, published  # noqa: E402
from lotline.sources.staging import staged, staging_root  # noqa: E402

# The operators for training text are an add-on: without them the other queries still work.
try:
    import corpus_pipeline  # noqa: E402
    from lotline.llm import registry as llm  # noqa: E402
except ImportError as missing:
    if getattr(missing, "name", None) not in {"corpus_pipeline", "lotline.llm", "lotline.llm.registry"}:
        warnings.warn(f"operators for training text are left out: {missing}", stacklevel=1)
    llm = None

STAMP = "2026-01-01T00:00:00+00:00"
SIDE = 50.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- box parcels ---------------------------------------------------------------------------------


def box_customers(spark: SparkSession, sf_dir: str, spacing: float = 50.0) -> DataFrame:
    k = "c_custkey"
    return table(spark, sf_dir, "customer").selectExpr(
        f"{k} AS k",
        f"CAST({k} AS STRING) AS parcel_id",
        "CONCAT('OWNER ', c_nationkey) AS owner_normalized",
        f"""CONCAT(CASE WHEN {k} % 9 = 0 THEN CONCAT(100 + {k} % 900, '-', 102 + {k} % 900)
                   ELSE CAST(100 + {k} % 900 AS STRING) END,
              ' ', UPPER(c_mktsegment), ' ST') AS street_address""",
        f"CASE {k} % 4 WHEN 0 THEN ' rsa5' WHEN 1 THEN 'RM1 ' WHEN 2 THEN 'CMX2' ELSE 'rSD3' END AS zoning",
        "ABS(c_acctbal) AS total_livable_area",
        "c_acctbal * 100 AS market_value",
        f"CASE WHEN {k} % 5 <> 0 THEN CAST({k} % 700 AS DOUBLE) END AS total_area",
        f"CONCAT('CAT ', {k} % 3) AS category_code_description",
        f"CONCAT('BLD ', {k} % 6) AS building_code_description_new",
        f"CAST(({k} * 7919) % 41 AS DOUBLE) * {spacing}D AS x0",
        f"CAST(({k} * 104729) % 43 AS DOUBLE) * {spacing}D AS y0",
    )


def _box() -> F.Column:
    return G.box(F.col("x0"), F.col("y0"), F.lit(SIDE), F.lit(SIDE))


def residential(spark: SparkSession, sf_dir: str, spacing: float = 50.0) -> DataFrame:
    """Residential boxes, staged like the job's table of that name."""
    boxes = box_customers(spark, sf_dir, spacing)
    canonical = boxes.select(
        "parcel_id",
        F.col("parcel_id").alias("opa_account_num"),
        "owner_normalized",
        T.address_number(F.col("street_address")).alias("address_number"),
        "street_address",
        _box().alias("geom"),
    )
    assessed = boxes.select(
        F.col("parcel_id").alias("parcel_number"),
        "zoning",
        F.col("street_address").alias("address_std"),
        "market_value",
        (F.col("market_value") / 2).alias("sale_price"),
        "total_area",
        "total_livable_area",
        "category_code_description",
        "building_code_description_new",
    )
    return staged(P.residential_parcels(canonical, assessed), "residential")


def slim_rows(spark: SparkSession, sf_dir: str, **limits) -> DataFrame:
    """Candidates for queries that show no more of a member than membership does."""
    return C.candidate_rows(residential(spark, sf_dir), STAMP, fields=C.MEMBERSHIP_FIELDS, **limits)


def _six_places(distance: str) -> F.Column:
    """A distance rounded as F.round does it, without a BigDecimal for each row."""
    return (F.floor(F.col(distance) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)).alias(distance)


def _plain(candidates: DataFrame) -> DataFrame:
    return candidates.select(
        "candidate_id",
        "human_id",
        "candidate_type",
        "owner_normalized",
        "parcel_count",
        "match_reason",
        _six_places("min_pair_distance").alias("min_pair_distance"),
        "created_at",
    )


BOX_SQL = """
WITH boxes AS MATERIALIZED (
  SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS parcel_id,
         'OWNER ' || c_nationkey AS owner_normalized,
         CASE WHEN c_custkey % 9 = 0
              THEN (100 + c_custkey % 900) || '-' || (102 + c_custkey % 900)
              ELSE CAST(100 + c_custkey % 900 AS VARCHAR) END AS address_number,
         address_number || ' ' || upper(c_mktsegment) || ' ST' AS street_address,
         CASE c_custkey % 4 WHEN 0 THEN ' rsa5' WHEN 1 THEN 'RM1 ' WHEN 2 THEN 'CMX2'
              ELSE 'rSD3' END AS zoning,
         abs(c_acctbal) AS total_livable_area, c_acctbal * 100 AS market_value,
         CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 700 AS DOUBLE) END AS total_area,
         'CAT ' || (c_custkey % 3) AS category_code_description,
         'BLD ' || (c_custkey % 6) AS building_code_description_new,
         CAST((c_custkey * 7919) % 41 AS DOUBLE) * {spacing} AS x0,
         CAST((c_custkey * 104729) % 43 AS DOUBLE) * {spacing} AS y0
  FROM customer),
res AS MATERIALIZED (SELECT * FROM boxes WHERE upper(trim(zoning)) LIKE 'R%'),
pairs AS MATERIALIZED (
  SELECT * FROM (
    SELECT a.owner_normalized, a.parcel_id AS id_a, b.parcel_id AS id_b,
           a.street_address AS address_a, b.street_address AS address_b,
           a.x0 AS xa, a.y0 AS ya, b.x0 AS xb, b.y0 AS yb,
           sqrt(pow(greatest(0, abs(a.x0 - b.x0) - 50), 2)
                + pow(greatest(0, abs(a.y0 - b.y0) - 50), 2)) AS d
    FROM res a JOIN res b
      ON a.owner_normalized = b.owner_normalized AND a.parcel_id < b.parcel_id)
  WHERE d <= 500),
cand AS MATERIALIZED (
  SELECT 'HYPHEN_' || md5(parcel_id) AS candidate_id, street_address AS human_id,
         'hyphen_address' AS candidate_type, owner_normalized, 1 AS parcel_count,
         'address_number_contains_hyphen' AS match_reason, CAST(NULL AS DOUBLE) AS d,
         parcel_id AS id_a, CAST(NULL AS VARCHAR) AS id_b
  FROM res WHERE address_number LIKE '%-%'
  UNION ALL
  SELECT CASE WHEN d <= 1 THEN 'TOUCH_' ELSE 'CLOSE_' END || md5(id_a || ':' || id_b),
         CASE WHEN address_a <= address_b THEN address_a || ' | ' || address_b
              ELSE address_b || ' | ' || address_a END,
         CASE WHEN d <= 1 THEN 'touching_same_owner' ELSE 'close_same_owner' END,
         owner_normalized, 2,
         CASE WHEN d <= 1 THEN 'same_owner_touching_or_within_1_ft'
              ELSE 'same_owner_within_500_ft_excluding_touching' END,
         d, id_a, id_b
  FROM pairs),
members AS MATERIALIZED (
  SELECT candidate_id, parcel_id, CAST(row_number() OVER (
           PARTITION BY candidate_id ORDER BY street_address, parcel_id) AS INTEGER) AS parcel_order,
         street_address, owner_normalized
  FROM (
    SELECT c.candidate_id, r.parcel_id, r.street_address, r.owner_normalized
    FROM cand c JOIN res r ON r.parcel_id = c.id_a
    UNION ALL
    SELECT c.candidate_id, r.parcel_id, r.street_address, r.owner_normalized
    FROM cand c JOIN res r ON r.parcel_id = c.id_b)),
short AS MATERIALIZED (
  SELECT c.*, t.* EXCLUDE (candidate_id)
  FROM cand c JOIN (
    SELECT m.candidate_id, sum(r.total_livable_area) AS combined_total_livable_area,
           min(r.zoning) AS min_zoning, max(r.zoning) AS max_zoning,
           sum(r.market_value) AS combined_market_value, sum(r.total_area) AS combined_total_area
    FROM members m JOIN res r USING (parcel_id) GROUP BY m.candidate_id
    HAVING sum(r.total_livable_area) BETWEEN 3000 AND 7000) t USING (candidate_id)),
feats AS MATERIALIZED (
  SELECT s.candidate_id, s.human_id, s.candidate_type, s.combined_total_livable_area,
         s.combined_market_value, s.combined_total_area, m.parcel_id, m.parcel_order,
         r.street_address AS address, r.owner_normalized AS owner, r.total_livable_area, r.zoning,
         r.market_value, r.category_code_description, r.building_code_description_new,
         r.x0, r.y0
  FROM short s JOIN members m USING (candidate_id) JOIN res r USING (parcel_id))
"""
BOXES = BOX_SQL.replace("{spacing}", "50.0")
TIGHT_BOXES = BOX_SQL.replace("{spacing}", "25.0")

PLAIN_SQL = (
    "candidate_id, human_id, candidate_type, owner_normalized, parcel_count, match_reason, "
    f"round(d, 6) AS min_pair_distance, '{STAMP}' AS created_at"
)
TOTALS = (
    "combined_total_livable_area, min_zoning, max_zoning, combined_market_value, "
    "combined_total_area"
)


# --- text and JSON -------------------------------------------------------------------------------


def q_clean_address(spark, sf_dir):
    cleaned = T.normalize_spaces(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", cleaned.alias("address"), T.address_number(cleaned).alias("address_number")
    )


def q_clean_owner(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", T.normalize_owner(F.col("text")).alias("owner_normalized")
    )


def q_join_owners(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    first = F.expr("CASE WHEN c_custkey % 3 > 0 THEN CONCAT(' ', REPLACE(c_name, '#', '  ')) END")
    second = F.expr("CASE WHEN c_custkey % 2 > 0 THEN c_mktsegment ELSE '  ' END")
    return c.select("c_custkey", T.join_owners(first, second).alias("owner_name"))


def q_first_present(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    keys = [
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE '' END"),
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END"),
        F.expr("CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS STRING) END"),
    ]
    return o.select("o_orderkey", T.first_present(*keys).alias("value"))


def q_residential_zoning(spark, sf_dir):
    return box_customers(spark, sf_dir).where(T.residential_zoning(F.col("zoning"))).select(
        "parcel_id", "zoning"
    )


def q_pair_key(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    ids = [F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")]
    return line.select(
        "l_orderkey",
        "l_linenumber",
        T.hashed_key("TOUCH_", *ids).alias("candidate_id"),
        T.pair_label(*ids).alias("human_id"),
    )


def q_json_props(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("record", F.parse_json("props"))
    return J.with_fields(events, "record", ["k", "absent"]).select(
        "event_id",
        J.scalar_text("k").alias("k_text"),
        J.number(F.col("record"), "k").alias("k_number"),
        J.scalar_text("absent").alias("absent"),
    )


def q_json_falsy(spark, sf_dir):
    record = F.parse_json(
        F.expr(
            """CASE event_id % 5
                 WHEN 0 THEN '{"z":1,"v":0}' WHEN 1 THEN '{"v":false,"b":2}'
                 WHEN 2 THEN '{"v":true}' WHEN 3 THEN '{"v":""}'
                 ELSE CONCAT('{"v":"', event_type, '","a":1}') END"""
        )
    )
    events = table(spark, sf_dir, "events").withColumn("record", record)
    return J.with_fields(events, "record", ["v"]).select(
        "event_id",
        J.truthy_text("v").alias("truthy"),
        J.scalar_text("v").alias("text"),
        J.sorted_json(F.col("record")).alias("sorted"),
    )


def q_display_format(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    value = F.expr("CASE WHEN c_custkey % 7 > 0 THEN c_acctbal * 10 END")
    name = F.expr("CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment WHEN c_custkey % 8 = 0 THEN '' END")
    return c.select(
        "c_custkey",
        display.money(value).alias("money"),
        display.square_feet(value).alias("area"),
        display.label(name).alias("label"),
    )


SPACE_SQL = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


# --- sources -------------------------------------------------------------------------------------


def customer_features(spark, sf_dir):
    """GeoJSON features as the scan gives them, made from customer rows."""
    made = table(spark, sf_dir, "customer").select(
        F.expr("CONCAT('properties-', c_custkey % 3, '.json')").alias("source_file"),
        F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'EPSG:4326' ELSE 'EPSG:2272' END").alias(
            "source_srid"
        ),
        F.col("c_custkey").cast("int").alias("feature_pos"),
        F.expr("CASE WHEN c_custkey % 10 > 0 THEN CAST(c_custkey AS STRING) END").alias("id"),
        F.expr(
            """CONCAT('{', CASE c_custkey % 4 WHEN 0 THEN '"parcel_id":"",' WHEN 1 THEN ''
                                 ELSE CONCAT('"parcel_id":', c_custkey, ',') END,
                          CASE WHEN c_custkey % 3 > 0 THEN CONCAT('"objectid":"X', c_custkey, '",')
                               ELSE '' END,
                          '"brt_id":null,"tencode":"T', c_custkey % 50, '",',
                          '"address":"  ', CASE WHEN c_custkey % 11 > 0 THEN CAST(c_custkey % 100 AS STRING) ELSE '' END,
                          '  ', CASE WHEN c_custkey % 11 > 0 THEN c_mktsegment ELSE '' END, ' ",',
                          '"owner1":"', REPLACE(c_name, '#', ' . '), '","owner2":',
                          CASE c_custkey % 5 WHEN 0 THEN 'false' WHEN 1 THEN '0' WHEN 2 THEN 'null'
                               ELSE CONCAT('"', c_mktsegment, ', inc."') END, '}')"""
        ).alias("document"),
        F.expr(
            """CASE c_custkey % 6 WHEN 0 THEN '{}' WHEN 1 THEN '{"type":"Point","coordinates":[1,2]}'
               ELSE CONCAT('{"type":"Polygon","coordinates":[[[', c_custkey, ',1],[', c_custkey + 2,
                           ',1],[', c_custkey + 2, ',4],[', c_custkey, ',1]]]}') END"""
        ).alias("geometry"),
    )
    return computed_once(
        made,
        {"properties": F.parse_json("document")},
        keep=["source_file", "source_srid", "feature_pos", "id", "geometry"],
    )


def q_raw_parcels(spark, sf_dir):
    features = customer_features(spark, sf_dir).withColumn("source_srid", F.lit("EPSG:2272"))
    raw = geojson.raw_parcels(features)
    box = G.envelope(F.col("geom"))
    return raw.select(
        "source_file",
        "source_feature_id",
        "parcel_id",
        "opa_account_num",
        "owner_name",
        "owner_normalized",
        "address_number",
        "street_address",
        "full_address",
        "source_srid",
        "working_srid",
        "geometry_raw",
        box["xmax"].alias("xmax"),
        box["ymax"].alias("ymax"),
    )


def q_geometry_rejects(spark, sf_dir):
    raw = geojson.parcel_rows(customer_features(spark, sf_dir))
    return geojson.geometry_rejects(raw)


RAW_SQL = """
WITH f AS (
  SELECT c_custkey AS k,
         'properties-' || (c_custkey % 3) || '.json' AS source_file,
         CASE WHEN k % 10 > 0 THEN CAST(k AS VARCHAR) END AS source_feature_id,
         CASE WHEN k % 4 >= 2 THEN CAST(k AS VARCHAR) WHEN k % 3 > 0 THEN 'X' || k ELSE '' END
           AS parcel_id,
         'T' || (k % 50) AS opa_account_num,
         CASE WHEN k % 11 > 0 THEN (k % 100) || ' ' || c_mktsegment ELSE '' END AS street_address,
         replace(c_name, '#', ' . ') AS owner1,
         CASE WHEN k % 5 >= 3 THEN c_mktsegment || ', inc.' END AS owner2,
         CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '{"type":"Point","coordinates":[1,2]}'
           ELSE '{"type":"Polygon","coordinates":[[[' || k || ',1],[' || (k + 2) || ',1],['
                || (k + 2) || ',4],[' || k || ',1]]]}' END AS geometry_raw
  FROM customer),
kept AS (SELECT *, concat_ws(' | ', owner1, owner2) AS owner_name FROM f
         WHERE parcel_id <> '' AND street_address <> '')
"""


def event_parcels(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source_file"),
        F.expr("CASE WHEN event_id % 7 > 0 THEN CAST(event_id % 100 AS STRING) END").alias(
            "source_feature_id"
        ),
        F.col("user_id").cast("string").alias("parcel_id"),
        F.col("event_id").cast("int").alias("feature_pos"),
        F.lit(None).cast("string").alias("geometry_raw"),
        "value",
    )


def q_canonical_first(spark, sf_dir):
    return P.canonical_parcels(event_parcels(spark, sf_dir)).select(
        "parcel_id", "source_file", "source_feature_id", "value"
    )


def event_records(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    record = F.struct(
        F.expr("CASE WHEN user_id % 10 > 0 THEN user_id END").alias("parcel_number"),
        F.col("event_type").alias("zoning"),
        F.expr("CASE WHEN event_id % 2 = 0 THEN value END").alias("market_value"),
        F.col("value").cast("string").alias("total_livable_area"),
    )
    named = events.select(
        F.concat(F.lit("batch-"), "event_type", F.lit(".json")).alias("file_name"),
        F.col("event_id").cast("int").alias("row_pos"),
        record.alias("fields"),
    )
    return computed_once(
        named, {"record": F.parse_json(F.to_json("fields"))}, keep=["file_name", "row_pos"]
    )


def q_last_wins(spark, sf_dir):
    return A.assessments(event_records(spark, sf_dir)).select(
        "parcel_number", "zoning", "address_std", "market_value", "sale_price", "total_livable_area"
    )


# --- candidates ----------------------------------------------------------------------------------


def q_residential(spark, sf_dir):
    return residential(spark, sf_dir).drop("geom", "opa_account_num")


def q_hyphen_candidates(spark, sf_dir):
    return _plain(C.hyphen_candidates(residential(spark, sf_dir), STAMP))


def q_pairs_within(spark, sf_dir):
    found = pairs_within(residential(spark, sf_dir), 500.0)
    return found.withColumn("pair_distance", _six_places("pair_distance"))


def q_pairs_hot_owner(spark, sf_dir):
    """A third of all parcels under one owner, in cells cut to small blocks."""
    hot = F.when(F.col("parcel_id").cast("bigint") % 3 == 0, F.lit("HOT")).otherwise(
        F.col("owner_normalized")
    )
    parcels = residential(spark, sf_dir).withColumn("owner_normalized", hot)
    found = pairs_within(parcels, 200.0, block_edges=400)
    return found.withColumn("pair_distance", _six_places("pair_distance"))


def q_pairs_blank_and_null(spark, sf_dir):
    """Blank owners and missing geometries take no part."""
    k = F.col("parcel_id").cast("bigint")
    parcels = residential(spark, sf_dir).withColumns(
        {
            "owner_normalized": F.when(k % 7 == 0, "").otherwise(F.col("owner_normalized")),
            "geom": F.when(k % 11 > 0, F.col("geom")),
        }
    )
    found = pairs_within(parcels, 500.0)
    return found.withColumn("pair_distance", _six_places("pair_distance"))


def q_pairs_many_vertices(spark, sf_dir):
    """All parcels under one owner, each side of a box in five edges."""
    steps = "sequence(0, 4)"
    sides = [("x0 + 10 * i", "y0"), ("x0 + 50", "y0 + 10 * i"), ("x0 + 50 - 10 * i", "y0 + 50"), ("x0", "y0 + 50 - 10 * i")]
    points = ", ".join(
        f"transform({steps}, i -> named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE)))" for x, y in sides
    )
    ring = f"concat({points}, array(named_struct('x', x0, 'y', y0)))"
    parcels = box_customers(spark, sf_dir).where("upper(trim(zoning)) LIKE 'R%'").select(
        "parcel_id",
        F.lit("ONE").alias("owner_normalized"),
        F.expr(f"named_struct('kind', 'Polygon', 'parts', array(array({ring})))").alias("geom"),
    )
    found = pairs_within(parcels, 60.0)
    return found.withColumn("pair_distance", _six_places("pair_distance"))


def q_candidates(spark, sf_dir):
    return _plain(slim_rows(spark, sf_dir))


def q_candidates_touching(spark, sf_dir):
    return _plain(slim_rows(spark, sf_dir, types=["touching_same_owner"]))


def q_candidates_close(spark, sf_dir):
    return _plain(slim_rows(spark, sf_dir, types=["close_same_owner"]))


def q_membership(spark, sf_dir):
    return C.membership(slim_rows(spark, sf_dir))


def q_single_candidate(spark, sf_dir):
    """All members of the candidate of parcel 0."""
    chosen = C.hyphen_candidates(residential(spark, sf_dir), STAMP)
    return export.of_candidate(C.membership(chosen), "HYPHEN_cfcd208495d565ef66e7dff9f98764da")


def q_shortlist(spark, sf_dir):
    carried = [*C.MEMBERSHIP_FIELDS, "total_livable_area", "zoning", "market_value", "total_area"]
    chosen = C.shortlisted_rows(residential(spark, sf_dir), STAMP, fields=carried)
    return chosen.select(*_plain(chosen).columns, *TOTALS.split(", ")).withColumn(
        "min_pair_distance", _six_places("min_pair_distance")
    )


def q_shortlist_view(spark, sf_dir):
    parcels = residential(spark, sf_dir)
    found = staged(C.candidate_rows(parcels, STAMP, fields=C.MEMBERSHIP_FIELDS), "candidates")
    view = C.shortlist_view(found.drop("members"), C.membership(found), parcels)
    return view.withColumn("min_pair_distance", _six_places("min_pair_distance"))


def q_candidate_union(spark, sf_dir):
    """All candidates with the area, parts and bounds of their union geometry."""
    parcels = residential(spark, sf_dir)
    carried = [*C.MEMBERSHIP_FIELDS, C.SHOWN_GEOMETRY]
    full = C.candidate_table(C.candidate_rows(parcels, STAMP, fields=carried), parcels)
    part_area = F.transform(
        "geom_union.parts",
        lambda part: F.aggregate(
            G.ring_edges(F.get(part, 0)),
            F.lit(0.0),
            lambda acc, e: acc + (e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2,
        ),
    )
    box = G.envelope(F.col("geom_union"))
    return full.select(
        "candidate_id",
        F.size("geom_union.parts").alias("parts"),
        F.round(F.aggregate(part_area, F.lit(0.0), lambda acc, a: acc + a), 3).alias("area"),
        *[box[name].alias(name) for name in ("xmin", "ymin", "xmax", "ymax")],
    )


# --- geometry ------------------------------------------------------------------------------------


def neighbours(spark, sf_dir):
    """Each box with that of the next customer key, as a pair of geometries."""
    boxes = box_customers(spark, sf_dir, 25.0).select("k", _box().alias("geom"))
    a = boxes.select("k", F.col("geom").alias("geom_a"))
    b = boxes.select((F.col("k") - 1).alias("k"), F.col("geom").alias("geom_b"))
    return a.join(b, "k")


def q_pair_distance(spark, sf_dir):
    pairs = neighbours(spark, sf_dir)
    shaped = G.with_shape(pairs, "geom_a")
    shaped = shaped.withColumnsRenamed({name: f"{name}_a" for name in G.SHAPE})
    shaped = G.with_shape(shaped, "geom_b")
    shaped = shaped.withColumnsRenamed({name: f"{name}_b" for name in G.SHAPE})
    found = pair_distance(shaped, ["k"])
    return found.select("k", _six_places("pair_distance").alias("pair_distance"))


def q_pair_within(spark, sf_dir):
    return q_pair_distance(spark, sf_dir).select("k", (F.col("pair_distance") <= 300).alias("near"))


def meeting(spark, sf_dir, geom: F.Column | None = None):
    """Same-owner pairs of closer boxes with distance zero: touching or overlapping.

    The shapes, or what ``geom`` makes of them, travel in their blocks: there may be far more pairs than parcels,
    and none of the pairs is shuffled.
    """
    parcels = residential(spark, sf_dir, 25.0)
    shown = F.col("geom") if geom is None else geom
    pairs = pairs_within(parcels, 1.0, cell=200.0, carry=shown).where(F.col("pair_distance") == 0)
    return pairs.select("id_a", "id_b", "pair_distance", F.col("a").alias("geom_a"), F.col("b").alias("geom_b"))


def turned(name: str) -> F.Column:
    """A geometry turned by 0.3 radians, so that no edge of a box lies along an axis."""
    return F.expr(
        f"""named_struct('kind', {name}.kind, 'parts', transform({name}.parts, part ->
              transform(part, ring -> transform(ring, p -> named_struct(
                'x', 2.69e6D + p.x * cos(0.3D) - p.y * sin(0.3D),
                'y', 2.3e5D + p.x * sin(0.3D) + p.y * cos(0.3D))))))"""
    )


def rotated(pairs: DataFrame) -> DataFrame:
    """Both geometries turned."""
    return pairs.withColumns({name: turned(name) for name in ("geom_a", "geom_b")})


def q_touches(spark, sf_dir):
    return with_touches(meeting(spark, sf_dir), "pair_distance").select("id_a", "id_b", "touches")


def q_touches_rotated(spark, sf_dir):
    pairs = meeting(spark, sf_dir, turned("geom"))
    return with_touches(pairs, "pair_distance").select("id_a", "id_b", "touches")


def q_union_rotated(spark, sf_dir):
    """Area and parts of the dissolved union of turned boxes."""
    return _turned_union(meeting(spark, sf_dir, turned("geom")))


def _turned_union(pairs: DataFrame) -> DataFrame:
    union = with_union(pairs, "pair_distance")
    part_area = F.transform(
        "geom_union.parts",
        lambda part: F.aggregate(
            G.ring_edges(F.get(part, 0)),
            F.lit(0.0),
            lambda acc, e: acc
            + ((e["x1"] - 2.69e6) * (e["y2"] - 2.3e5) - (e["x2"] - 2.69e6) * (e["y1"] - 2.3e5)) / 2,
        ),
    )
    area = F.aggregate(part_area, F.lit(0.0), lambda acc, a: acc + a)
    return union.select(
        "id_a", "id_b", F.round(area, 1).alias("area"), F.size("geom_union.parts").alias("parts"), "union_closed"
    )


def dense(pairs: DataFrame, steps: int) -> DataFrame:
    """Both boxes with each side cut into ``steps`` edges."""

    def cut(name: str) -> F.Column:
        between = ", ".join(f"'{c}', p.{c} + (ring[k + 1].{c} - p.{c}) * i / {steps}D" for c in ("x", "y"))
        ring = f"""concat(flatten(transform(slice(ring, 1, size(ring) - 1), (p, k) ->
                     transform(sequence(0, {steps - 1}), i -> named_struct({between})))), slice(ring, -1, 1))"""
        return F.expr(
            f"named_struct('kind', {name}.kind, 'parts', transform({name}.parts, part -> transform(part, ring -> {ring})))"
        )

    return pairs.withColumns({name: cut(name) for name in ("geom_a", "geom_b")})


def q_union_many_vertices(spark, sf_dir):
    """Touching and overlapping neighbours of 400 vertices each, turned."""
    return _turned_union(rotated(dense(meeting(spark, sf_dir), 100)))


def q_union_area(spark, sf_dir):
    joined = with_union_area(meeting(spark, sf_dir), "pair_distance")
    return joined.select("id_a", "id_b", F.round("union_area", 3).alias("union_area"))


def q_union_parts(spark, sf_dir):
    joined = with_union(meeting(spark, sf_dir), "pair_distance")
    return joined.select(
        "id_a", "id_b", "geom_union.kind", F.size("geom_union.parts").alias("parts")
    )


def q_envelope(spark, sf_dir):
    box = G.envelope(_box())
    return box_customers(spark, sf_dir).select(
        "k", *[box[name].alias(name) for name in ("xmin", "ymin", "xmax", "ymax")]
    )


def lonlat_boxes(spark, sf_dir):
    lon = F.col("c_custkey") % 1000 * F.lit(0.0003) - F.lit(75.3)
    lat = F.col("c_custkey") % 777 * F.lit(0.0003) + F.lit(39.85)
    shape = G.box(lon, lat, F.lit(0.001), F.lit(0.001))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), shape.alias("geom"), F.lit("EPSG:4326").alias("source_srid")
    )


def q_project_forward(spark, sf_dir):
    moved = lonlat_boxes(spark, sf_dir).withColumn(
        "geom", crs.to_working(F.col("geom"), F.col("source_srid"))
    )
    corner = F.expr("geom.parts[0][0][0]")
    return moved.select(
        "k", F.round(corner["x"], 3).alias("x"), F.round(corner["y"], 3).alias("y")
    )


def q_project_roundtrip(spark, sf_dir):
    there = lonlat_boxes(spark, sf_dir).withColumn(
        "geom", crs.to_working(F.col("geom"), F.col("source_srid"))
    )
    corner = F.expr("back.parts[0][0][2]")
    return there.withColumn("back", crs.to_lonlat(F.col("geom"))).select(
        "k", F.round(corner["x"], 8).alias("lon"), F.round(corner["y"], 8).alias("lat")
    )


LAMBERT_SQL = """
WITH c AS (
  SELECT sqrt(2 / 298.257222101::DOUBLE - pow(1 / 298.257222101::DOUBLE, 2)) AS e,
         6378137.0::DOUBLE * 3937 / 1200 AS a,
         radians(39 + 20 / 60.0::DOUBLE) AS p0, radians(40 + 58 / 60.0::DOUBLE) AS p1,
         radians(39 + 56 / 60.0::DOUBLE) AS p2),
g AS (
  SELECT *, cos(p1) / sqrt(1 - pow(e * sin(p1), 2)) AS m1,
         cos(p2) / sqrt(1 - pow(e * sin(p2), 2)) AS m2,
         tan(pi() / 4 - p0 / 2) / pow((1 - e * sin(p0)) / (1 + e * sin(p0)), e / 2) AS t0,
         tan(pi() / 4 - p1 / 2) / pow((1 - e * sin(p1)) / (1 + e * sin(p1)), e / 2) AS t1,
         tan(pi() / 4 - p2 / 2) / pow((1 - e * sin(p2)) / (1 + e * sin(p2)), e / 2) AS t2
  FROM c),
n AS (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM g),
q AS (SELECT *, m1 / (n * pow(t1, n)) AS big_f FROM n),
pts AS (
  SELECT c_custkey AS k, radians(c_custkey % 1000 * 0.0003::DOUBLE - 75.3::DOUBLE) AS lam,
         radians(c_custkey % 777 * 0.0003::DOUBLE + 39.85::DOUBLE) AS phi
  FROM customer),
r AS (
  SELECT k, a * big_f * pow(t0, n) AS rho0, n * (lam - radians(-77.75)) AS theta,
         a * big_f * pow(tan(pi() / 4 - phi / 2)
           / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2), n) AS rho
  FROM pts, q)
SELECT k, round(1968500 + rho * sin(theta), 3) AS x, round(rho0 - rho * cos(theta), 3) AS y FROM r
"""


def q_geojson_parse(spark, sf_dir):
    text = F.expr(
        """CONCAT('{"type":"', CASE WHEN k % 2 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END,
                  '","coordinates":', CASE WHEN k % 2 = 0 THEN '' ELSE '[' END,
                  '[[[', x0, ',', y0, '],[', x0 + 50, ',', y0, '],[', x0, ',', y0 + 75, '],[',
                  x0, ',', y0, ']]]', CASE WHEN k % 2 = 0 THEN '' ELSE ']' END, '}')"""
    )
    parsed = box_customers(spark, sf_dir).select("k", G.from_geojson(text).alias("geom"))
    box = G.envelope(F.col("geom"))
    return parsed.select(
        "k",
        "geom.kind",
        F.size(F.flatten(F.flatten("geom.parts"))).alias("vertices"),
        *[box[name].alias(name) for name in ("xmin", "ymin", "xmax", "ymax")],
    )


def q_geojson_emit(spark, sf_dir):
    return box_customers(spark, sf_dir).select("k", G.to_geojson(_box()).alias("geojson"))


# --- export, gate, report ------------------------------------------------------------------------


def shortlisted_features(spark, sf_dir, *fields: str, **limits):
    """Features whose members carry these fields beside those of membership and the livable area."""
    parcels = residential(spark, sf_dir)
    carried = [*C.MEMBERSHIP_FIELDS, "total_livable_area", *fields]
    return export.features(C.shortlisted_rows(parcels, STAMP, fields=carried, **limits), parcels)


# All that features show, but for the geometry.
SHOWN = C.MEMBER_FIELDS[len(C.MEMBERSHIP_FIELDS) + 1 :]


def q_features(spark, sf_dir):
    return shortlisted_features(spark, sf_dir, *SHOWN, C.LOCATED).drop("members", "counterparts")


def q_features_members(spark, sf_dir):
    found = shortlisted_features(spark, sf_dir, C.LOCATED)
    ids = [
        F.array_join(F.transform(name, lambda m: m["parcel_id"]), ",").alias(name)
        for name in ("members", "counterparts")
    ]
    return found.select("candidate_id", "parcel_id", *ids)


def q_feature_text(spark, sf_dir):
    """Export features as GeoJSON text, read back."""
    text = export.feature_text(shortlisted_features(spark, sf_dir, *SHOWN, C.SHOWN_GEOMETRY))

    def value(path: str):
        return F.get_json_object("feature", path)

    return text.select(
        "candidate_id",
        "parcel_id",
        value("$.type").alias("type"),
        value("$.geometry.type").alias("geometry_type"),
        value("$.properties.owner").alias("owner"),
        value("$.properties.total_livable_area").cast("double").alias("total_livable_area"),
        value("$.properties.members[0].parcel_id").alias("first_member"),
    )


def q_types_filter(spark, sf_dir):
    chosen = ["hyphen_address", "touching_same_owner"]
    return export.of_types(shortlisted_features(spark, sf_dir, C.LOCATED, types=chosen), chosen).select(
        "candidate_id", "candidate_type", "parcel_id"
    )


def q_map_counts(spark, sf_dir):
    return export.map_counts(shortlisted_features(spark, sf_dir, C.LOCATED))


def q_map_extent(spark, sf_dir):
    return export.map_extent(shortlisted_features(spark, sf_dir, C.SHOWN_GEOMETRY))


def q_map_extent_degrees(spark, sf_dir):
    moved = lonlat_boxes(spark, sf_dir).withColumn(
        "geom", crs.to_working(F.col("geom"), F.col("source_srid"))
    )
    extent = export.map_extent(export.with_lonlat(moved), "lonlat")
    return extent.select(*[F.round(c, 8).alias(c) for c in extent.columns])


def q_summary_by_type(spark, sf_dir):
    return export.summary(slim_rows(spark, sf_dir))


def faulty_tables(spark, sf_dir):
    """Candidates and membership over all customers, with faults of every kind."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    one = customers.selectExpr(
        "CONCAT('C', k) AS candidate_id", "CAST(1 + k % 2 AS INT) AS parcel_count"
    )
    again = customers.where("k % 50 = 0").selectExpr(
        "CONCAT('C', k) AS candidate_id", "2 AS parcel_count"
    )
    member = customers.where("k % 7 > 0").selectExpr("CONCAT('C', k) AS candidate_id")
    second = customers.where("k % 3 = 0").selectExpr("CONCAT('C', k) AS candidate_id")
    orphan = customers.where("k % 40 = 0").selectExpr("CONCAT('X', k % 400) AS candidate_id")
    return one.union(again), member.union(second).union(orphan)


def q_quality_checks(spark, sf_dir):
    return quality.quality_checks(*faulty_tables(spark, sf_dir))


def q_duplicate_keys(spark, sf_dir):
    found = quality.duplicate_keys(faulty_tables(spark, sf_dir)[0], "candidate_id")
    return found.select("candidate_id", F.col("count").alias("rows"))


def q_orphan_rows(spark, sf_dir):
    candidates, members = faulty_tables(spark, sf_dir)
    return quality.orphan_rows(members, candidates)


def q_childless(spark, sf_dir):
    return quality.childless_candidates(*faulty_tables(spark, sf_dir))


def q_count_mismatches(spark, sf_dir):
    return quality.count_mismatches(*faulty_tables(spark, sf_dir))


FAULTY_SQL = """
WITH cand AS (
  SELECT 'C' || c_custkey AS candidate_id, CAST(1 + c_custkey % 2 AS INTEGER) AS parcel_count
  FROM customer
  UNION ALL SELECT 'C' || c_custkey, 2 FROM customer WHERE c_custkey % 50 = 0),
memb AS (
  SELECT 'C' || c_custkey AS candidate_id FROM customer WHERE c_custkey % 7 > 0
  UNION ALL SELECT 'C' || c_custkey FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'X' || (c_custkey % 400) FROM customer WHERE c_custkey % 40 = 0),
actual AS (SELECT candidate_id, count(*) AS actual_count FROM memb GROUP BY candidate_id)
"""


# --- enrichment ----------------------------------------------------------------------------------


def account_plan(spark, sf_dir):
    accounts = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("opa_account_num")
    )
    return batches.batch_plan(accounts)


def q_enrichment_batches(spark, sf_dir):
    return account_plan(spark, sf_dir).select(
        "batch_index",
        F.size("accounts").alias("size"),
        F.array_min("accounts").alias("first"),
        F.array_max("accounts").alias("last"),
        "file_name",
    )


def _half_cached(spark, sf_dir):
    plan = staged(account_plan(spark, sf_dir), "plan")
    return plan, plan.where(F.col("batch_index") % 2 == 0).select("file_name")


def q_enrichment_missing(spark, sf_dir):
    return batches.batches_to_fetch(*_half_cached(spark, sf_dir)).select("batch_index", "file_name")


def q_enrichment_counts(spark, sf_dir):
    return batches.batch_counts(*_half_cached(spark, sf_dir))


PLAN_SQL = """
WITH ids AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders),
placed AS (SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) // 200 + 1 AS INTEGER)
             AS batch_index FROM ids),
plan AS (
  SELECT batch_index, CAST(count(*) AS INTEGER) AS size, min(id) AS first, max(id) AS last,
         printf('batch-%04d-%s.json', batch_index,
                substr(md5(string_agg(id, chr(10) ORDER BY id)), 1, 12)) AS file_name
  FROM placed GROUP BY batch_index)
"""


# --- sources: written to the staging folder and read back -----------------------------------------


def folder(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/lotline/{label}-{uuid.uuid4().hex}"


def feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's box as the text of a GeoJSON feature, some without a type."""
    shape = F.from_json(G.to_geojson(_box()), "type string, coordinates array<array<array<double>>>")
    properties = F.struct(
        "parcel_id",
        F.col("parcel_id").alias("brt_id"),
        F.col("street_address").alias("address"),
        F.col("owner_normalized").alias("owner1"),
    )
    feature = F.struct(
        F.when(F.col("k") % 3 > 0, "Feature").alias("type"),
        F.col("parcel_id").alias("id"),
        properties.alias("properties"),
        shape.alias("geometry"),
    )
    return box_customers(spark, sf_dir).select("k", F.to_json(feature).alias("feature"))


def _scanned(features: DataFrame) -> DataFrame:
    corner = G.from_geojson(F.col("geometry_raw"))
    return geojson.parcel_rows(features).select(
        "source_srid", "feature_pos", "source_feature_id", "opa_account_num", "street_address",
        F.get(F.get(F.get(corner["parts"], 0), 0), 0)["x"].alias("x"),
        F.col("source_file").isNotNull().alias("named"),
    )


def q_scan_features(spark, sf_dir):
    """FeatureCollections of 500 customers each, every second one with a CRS."""
    path = folder(spark, "collections")
    crs_text = F.when(
        F.col("doc") % 2 == 0, '"crs":{"properties":{"name":"EPSG:2272"}},'
    ).otherwise("")
    listed = F.array_sort(F.collect_list(F.struct("k", "feature")))["feature"]
    (
        feature_lines(spark, sf_dir)
        .groupBy(F.expr("k DIV 500").alias("doc"))
        .agg(F.array_join(listed, ",\n").alias("features"))
        .select("doc", F.concat(F.lit("{"), crs_text, F.lit('"features":['), "features", F.lit("]}")).alias("value"))
        .repartition("doc")
        .write.partitionBy("doc")
        .text(path)
    )
    return _scanned(geojson.read_features(spark, f"{path}/*/*.txt"))


def q_scan_lines(spark, sf_dir):
    path = folder(spark, "lines")
    geojson.write_feature_lines(feature_lines(spark, sf_dir), path)
    return _scanned(geojson.read_features(spark, path, "lines", "EPSG:2272")).drop("feature_pos")


def order_responses(spark, sf_dir, value: str) -> DataFrame:
    """Responses of 200 orders each."""
    record = F.struct(
        F.col("o_custkey").alias("parcel_number"), F.expr(value).alias("market_value"), F.col("o_orderstatus").alias("zoning")
    )
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.format_string("batch-%06d.json", F.expr("o_orderkey DIV 200")).alias("file_name"))
        .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", record.alias("record"))))["record"].alias("rows"))
        .select("file_name", F.to_json(F.struct("rows")).alias("response"))
    )


def q_scan_cache(spark, sf_dir):
    path = folder(spark, "cache")
    A.land_responses(order_responses(spark, sf_dir, "o_totalprice"), path)
    found = A.assessments(A.read_cached_records(spark, path))
    return found.select("parcel_number", "market_value", "zoning")


def q_cache_refresh(spark, sf_dir):
    """All batches landed, then those of an even number landed again with other values."""
    path = folder(spark, "cache")
    A.land_responses(order_responses(spark, sf_dir, "o_totalprice"), path)
    again = order_responses(spark, sf_dir, "-o_totalprice")
    A.land_responses(again.where(F.substring("file_name", 7, 6).cast("int") % 2 == 0), path)
    found = A.assessments(A.read_cached_records(spark, path))
    return found.select("parcel_number", "market_value", "zoning")


def _job_over_files(spark, sf_dir) -> JobConfig:
    """Run the whole job over features and assessments read from files."""
    lines, cache = folder(spark, "lines"), folder(spark, "cache")
    geojson.write_feature_lines(feature_lines(spark, sf_dir), lines)
    boxes = box_customers(spark, sf_dir)
    accounts = boxes.select(F.col("parcel_id").alias("opa_account_num"))
    plan = batches.batch_plan(accounts).select("file_name", F.explode("accounts").alias("parcel_id"))
    record = F.struct(
        F.col("parcel_id").alias("parcel_number"), "zoning", "total_livable_area", "market_value", "total_area"
    )
    A.land_responses(
        plan.join(boxes, "parcel_id")
        .groupBy("file_name")
        .agg(F.collect_list(record).alias("rows"))
        .select("file_name", F.to_json(F.struct("rows")).alias("response")),
        cache,
    )
    config = JobConfig(
        lines, cache, folder(spark, "out"), source_layout="lines", source_crs="EPSG:2272", run_stamp=STAMP
    )
    job.run(spark, config)
    return config


def q_full_job(spark, sf_dir):
    """The whole job over features and assessments read from files."""
    config = _job_over_files(spark, sf_dir)
    return _plain(published.read_table(spark, config.output_dir, "candidate_properties"))


JOB_TABLES = [
    "raw_properties", "opa_properties", "canonical_properties", "residential_properties",
    "candidate_properties", "candidate_property_parcels",
]


def q_published_tables(spark, sf_dir):
    """Rows of the six tables that a job publishes."""
    config = _job_over_files(spark, sf_dir)
    counts = None
    for name in JOB_TABLES:
        rows = published.read_table(spark, config.output_dir, name)
        one = rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        counts = one if counts is None else counts.union(one)
    return counts


def q_feature_document(spark, sf_dir):
    """The map's features written as one document and read back in their order."""
    path = f"{folder(spark, 'document')}.geojson"
    found = shortlisted_features(spark, sf_dir, *SHOWN, C.SHOWN_GEOMETRY)
    text = staged(export.feature_text(found), "feature-text")
    geojson.write_feature_collection(text, export.FEATURE_KEY, path)
    found = geojson.read_features(spark, path)
    ids = J.with_fields(found, "properties", ["candidate_id", "parcel_id"])
    return ids.select("feature_pos", *[J.scalar_text(c).alias(c) for c in ("candidate_id", "parcel_id")])


def q_assessments_empty(spark, sf_dir):
    """All customers against the typed table of an empty cache."""
    none = A.assessments(A.read_cached_records(spark, folder(spark, "empty-cache")))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("parcel_number"))
    return customers.join(none, "parcel_number", "left").select("parcel_number", "zoning", "market_value", "raw_opa_json")


def q_run_stamp(spark, sf_dir):
    """Candidates of a run with the default stamp: UTC, ISO-8601, seconds."""
    rows = C.hyphen_candidates(residential(spark, sf_dir), JobConfig("", "", "").run_stamp)
    stamped = F.col("created_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$")
    recent = F.abs(F.unix_timestamp(F.to_timestamp("created_at")) - F.unix_timestamp()) < 3600
    return rows.select("candidate_id", stamped.alias("stamped"), recent.alias("recent"))


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """The livable-area shortlist."""
    return q_shortlist(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        name[2:]: function
        for name, function in globals().items()
        if name.startswith("q_") and callable(function)
    }
    if llm:
        found |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    hot = BOXES.replace("'OWNER ' || c_nationkey AS", "CASE WHEN c_custkey % 3 = 0 THEN 'HOT' ELSE 'OWNER ' || c_nationkey END AS")
    meet = TIGHT_BOXES + ", meet AS (SELECT * FROM pairs WHERE d = 0)"
    rotated_union = meet + """
        SELECT id_a, id_b, round(5000 - greatest(0, 50 - abs(xa - xb))
                 * greatest(0, 50 - abs(ya - yb)), 1) AS area,
               CAST(CASE WHEN abs(xa - xb) = 50 AND abs(ya - yb) = 50 THEN 2 ELSE 1 END AS INTEGER) AS parts,
               true AS union_closed FROM meet"""
    found = llm.ORACLE_SQL if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        found = found | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return found | {
        "clean_address": f"""
            SELECT doc_id, trim(regexp_replace(text, '{SPACE_SQL}', ' ', 'g')) AS address,
                   split_part(address, ' ', 1) AS address_number FROM documents""",
        "clean_owner": f"""
            SELECT doc_id, regexp_replace(regexp_replace(
                     trim(regexp_replace(upper(replace(text, 'ß', 'ss')), '{SPACE_SQL}', ' ', 'g')),
                     '[.,''"]', '', 'g'), ' +', ' ', 'g') AS owner_normalized FROM documents""",
        "join_owners": """
            SELECT c_custkey, concat_ws(' | ',
                     CASE WHEN c_custkey % 3 > 0 THEN replace(c_name, '#', ' ') END,
                     CASE WHEN c_custkey % 2 > 0 THEN c_mktsegment END) AS owner_name
            FROM customer""",
        "first_present": """
            SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus
                     WHEN o_orderkey % 5 = 0 THEN o_orderpriority
                     WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS value
            FROM orders""",
        "residential_zoning": BOXES + "SELECT parcel_id, zoning FROM res",
        "pair_key": """
            SELECT l_orderkey, l_linenumber, 'TOUCH_' || md5(l_partkey || ':' || l_suppkey) AS candidate_id,
                   CASE WHEN CAST(l_partkey AS VARCHAR) <= CAST(l_suppkey AS VARCHAR)
                        THEN l_partkey || ' | ' || l_suppkey
                        ELSE l_suppkey || ' | ' || l_partkey END AS human_id
            FROM lineitem""",
        "json_props": """
            SELECT event_id, json_extract_string(props, '$.k') AS k_text,
                   CAST(json_extract(props, '$.k') AS DOUBLE) AS k_number,
                   json_extract_string(props, '$.absent') AS absent FROM events""",
        "json_falsy": """
            SELECT event_id,
                   CASE event_id % 5 WHEN 2 THEN 'True' WHEN 4 THEN event_type END AS truthy,
                   CASE event_id % 5 WHEN 0 THEN '0' WHEN 1 THEN 'False' WHEN 2 THEN 'True'
                        WHEN 3 THEN '' ELSE event_type END AS text,
                   CASE event_id % 5 WHEN 0 THEN '{"v":0,"z":1}' WHEN 1 THEN '{"b":2,"v":false}'
                        WHEN 2 THEN '{"v":true}' WHEN 3 THEN '{"v":""}'
                        ELSE '{"a":1,"v":"' || event_type || '"}' END AS sorted
            FROM events""",
        "display_format": """
            SELECT c_custkey,
                   CASE WHEN c_custkey % 7 > 0 THEN '$' || format('{:,}', CAST(floor(c_acctbal * 10 + 0.5) AS BIGINT))
                        ELSE '—' END AS money,
                   CASE WHEN c_custkey % 7 > 0 THEN format('{:,}', CAST(floor(c_acctbal * 10 + 0.5) AS BIGINT)) || ' sf'
                        ELSE '—' END AS area,
                   CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment ELSE '—' END AS label
            FROM customer""",
        "raw_parcels": RAW_SQL + """
            SELECT source_file, source_feature_id, parcel_id, opa_account_num,
                   regexp_replace(owner_name, ' +', ' ', 'g') AS owner_name,
                   regexp_replace(regexp_replace(upper(owner_name), '[.,''"]', '', 'g'), ' +', ' ', 'g')
                     AS owner_normalized,
                   split_part(street_address, ' ', 1) AS address_number, street_address,
                   street_address AS full_address, 'EPSG:2272' AS source_srid,
                   'EPSG:2272' AS working_srid, geometry_raw,
                   CASE WHEN k % 6 > 1 THEN CAST(k + 2 AS DOUBLE) END AS xmax,
                   CASE WHEN k % 6 > 1 THEN 4.0::DOUBLE END AS ymax
            FROM kept""",
        "geometry_rejects": RAW_SQL + """
            SELECT source_file, source_feature_id, parcel_id, geometry_raw FROM kept
            WHERE k % 6 = 1""",
        "canonical_first": """
            SELECT parcel_id, source_file, source_feature_id, value FROM (
              SELECT *, row_number() OVER (PARTITION BY parcel_id
                       ORDER BY source_file, source_feature_id NULLS LAST, event_id) AS n
              FROM (SELECT event_type AS source_file, event_id, value,
                           CASE WHEN event_id % 7 > 0 THEN CAST(event_id % 100 AS VARCHAR) END
                             AS source_feature_id,
                           CAST(user_id AS VARCHAR) AS parcel_id FROM events))
            WHERE n = 1""",
        "last_wins": """
            SELECT CAST(user_id AS VARCHAR) AS parcel_number, event_type AS zoning,
                   '' AS address_std, CASE WHEN event_id % 2 = 0 THEN value END AS market_value,
                   CAST(NULL AS DOUBLE) AS sale_price, value AS total_livable_area
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                           ORDER BY 'batch-' || event_type || '.json' DESC, event_id DESC) AS n
                  FROM events WHERE user_id % 10 > 0)
            WHERE n = 1""",
        "residential": BOXES + """
            SELECT parcel_id, owner_normalized, address_number, street_address, zoning,
                   street_address AS opa_address_std, market_value, market_value / 2 AS sale_price,
                   total_area, total_livable_area, category_code_description,
                   building_code_description_new FROM res""",
        "hyphen_candidates": BOXES
        + f"SELECT {PLAIN_SQL} FROM cand WHERE candidate_type = 'hyphen_address'",
        "pairs_within": BOXES
        + "SELECT owner_normalized, id_a, id_b, round(d, 6) AS pair_distance FROM pairs",
        "pairs_hot_owner": hot
        + "SELECT owner_normalized, id_a, id_b, round(d, 6) AS pair_distance FROM pairs WHERE d <= 200",
        "candidates": BOXES + f"SELECT {PLAIN_SQL} FROM cand",
        "candidates_touching": BOXES
        + f"SELECT {PLAIN_SQL} FROM cand WHERE candidate_type = 'touching_same_owner'",
        "candidates_close": BOXES
        + f"SELECT {PLAIN_SQL} FROM cand WHERE candidate_type = 'close_same_owner'",
        "membership": BOXES + "SELECT * FROM members",
        "single_candidate": BOXES
        + "SELECT * FROM members WHERE candidate_id = 'HYPHEN_' || md5('0')",
        "shortlist": BOXES + f"SELECT {PLAIN_SQL}, {TOTALS} FROM short",
        "shortlist_view": BOXES + f"SELECT {PLAIN_SQL}, {TOTALS} FROM short",
        "candidate_union": BOXES + """
            SELECT c.candidate_id,
                   CAST(CASE WHEN c.id_b IS NULL OR c.d = 0 AND least(abs(a.x0 - b.x0), abs(a.y0 - b.y0)) < 50
                             THEN 1 ELSE 2 END AS INTEGER) AS parts,
                   round(CASE WHEN c.id_b IS NULL OR a.x0 = b.x0 AND a.y0 = b.y0 THEN 2500.0
                              ELSE 5000.0 END::DOUBLE, 3) AS area,
                   least(a.x0, b.x0) AS xmin, least(a.y0, b.y0) AS ymin,
                   greatest(a.x0, b.x0) + 50 AS xmax, greatest(a.y0, b.y0) + 50 AS ymax
            FROM cand c JOIN res a ON a.parcel_id = c.id_a
            LEFT JOIN res b ON b.parcel_id = c.id_b""",
        "pair_distance": TIGHT_BOXES + """
            SELECT a.k, round(sqrt(pow(greatest(0, abs(a.x0 - b.x0) - 50), 2)
                        + pow(greatest(0, abs(a.y0 - b.y0) - 50), 2)), 6) AS pair_distance
            FROM boxes a JOIN boxes b ON b.k = a.k + 1""",
        "pair_within": TIGHT_BOXES + """
            SELECT a.k, sqrt(pow(greatest(0, abs(a.x0 - b.x0) - 50), 2)
                        + pow(greatest(0, abs(a.y0 - b.y0) - 50), 2)) <= 300 AS near
            FROM boxes a JOIN boxes b ON b.k = a.k + 1""",
        "touches": meet + """
            SELECT id_a, id_b, NOT (abs(xa - xb) < 50 AND abs(ya - yb) < 50) AS touches FROM meet""",
        "touches_rotated": meet + """
            SELECT id_a, id_b, NOT (abs(xa - xb) < 50 AND abs(ya - yb) < 50) AS touches FROM meet""",
        "union_rotated": rotated_union,
        "union_many_vertices": rotated_union,
        "union_area": meet + """
            SELECT id_a, id_b, round(5000 - greatest(0, 50 - abs(xa - xb))
                     * greatest(0, 50 - abs(ya - yb)), 3) AS union_area FROM meet""",
        "union_parts": meet + """
            SELECT id_a, id_b, CASE WHEN corner THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
                   CASE WHEN corner THEN 2 ELSE 1 END AS parts
            FROM (SELECT *, abs(xa - xb) = 50 AND abs(ya - yb) = 50 AS corner FROM meet)""",
        "envelope": BOXES
        + "SELECT k, x0 AS xmin, y0 AS ymin, x0 + 50 AS xmax, y0 + 50 AS ymax FROM boxes",
        "project_forward": LAMBERT_SQL,
        "project_roundtrip": """
            SELECT c_custkey AS k, round(c_custkey % 1000 * 0.0003::DOUBLE - 75.3::DOUBLE + 0.001::DOUBLE, 8) AS lon,
                   round(c_custkey % 777 * 0.0003::DOUBLE + 39.85::DOUBLE + 0.001::DOUBLE, 8) AS lat
            FROM customer""",
        "geojson_parse": BOXES + """
            SELECT k, CASE WHEN k % 2 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END AS kind,
                   4 AS vertices, x0 AS xmin, y0 AS ymin, x0 + 50 AS xmax, y0 + 75 AS ymax
            FROM boxes""",
        "geojson_emit": BOXES + """
            SELECT k, '{"type":"Polygon","coordinates":[[[' || x0 || ',' || y0 || '],['
                     || (x0 + 50) || ',' || y0 || '],[' || (x0 + 50) || ',' || (y0 + 50) || '],['
                     || x0 || ',' || (y0 + 50) || '],[' || x0 || ',' || y0 || ']]]}' AS geojson
            FROM boxes""",
        "features": BOXES + "SELECT * EXCLUDE (x0, y0) FROM feats",
        "features_members": BOXES + """
            SELECT f.candidate_id, f.parcel_id,
                   (SELECT string_agg(m.parcel_id, ',' ORDER BY m.parcel_order) FROM members m
                    WHERE m.candidate_id = f.candidate_id) AS members,
                   coalesce((SELECT string_agg(m.parcel_id, ',' ORDER BY m.parcel_order) FROM members m
                    WHERE m.candidate_id = f.candidate_id AND m.parcel_id <> f.parcel_id), '')
                     AS counterparts
            FROM feats f""",
        "feature_text": BOXES + """
            SELECT f.candidate_id, f.parcel_id, 'Feature' AS type, 'Polygon' AS geometry_type,
                   f.owner, f.total_livable_area, m.parcel_id AS first_member
            FROM feats f JOIN members m ON m.candidate_id = f.candidate_id AND m.parcel_order = 1""",
        "types_filter": BOXES + """
            SELECT candidate_id, candidate_type, parcel_id FROM feats
            WHERE candidate_type IN ('hyphen_address', 'touching_same_owner')""",
        "map_counts": BOXES
        + "SELECT count(*) AS parcels, count(DISTINCT candidate_id) AS candidates FROM feats",
        "map_extent": BOXES + """
            SELECT min(x0) AS xmin, min(y0) AS ymin, max(x0) + 50 AS xmax, max(y0) + 50 AS ymax
            FROM feats""",
        "map_extent_degrees": """
            SELECT round(min(c_custkey % 1000 * 0.0003::DOUBLE - 75.3::DOUBLE), 8) AS xmin,
                   round(min(c_custkey % 777 * 0.0003::DOUBLE + 39.85::DOUBLE), 8) AS ymin,
                   round(max(c_custkey % 1000 * 0.0003::DOUBLE - 75.3::DOUBLE) + 0.001::DOUBLE, 8) AS xmax,
                   round(max(c_custkey % 777 * 0.0003::DOUBLE + 39.85::DOUBLE) + 0.001::DOUBLE, 8) AS ymax
            FROM customer""",
        "pairs_blank_and_null": BOXES + """
            SELECT owner_normalized, id_a, id_b, round(d, 6) AS pair_distance FROM pairs
            WHERE CAST(id_a AS BIGINT) % 7 > 0 AND CAST(id_b AS BIGINT) % 7 > 0
              AND CAST(id_a AS BIGINT) % 11 > 0 AND CAST(id_b AS BIGINT) % 11 > 0""",
        "pairs_many_vertices": BOXES + """
            SELECT 'ONE' AS owner_normalized, id_a, id_b, round(d, 6) AS pair_distance FROM (
              SELECT a.parcel_id AS id_a, b.parcel_id AS id_b,
                     sqrt(pow(greatest(0, abs(a.x0 - b.x0) - 50), 2)
                          + pow(greatest(0, abs(a.y0 - b.y0) - 50), 2)) AS d
              FROM res a JOIN res b ON a.parcel_id < b.parcel_id
                AND abs(a.x0 - b.x0) <= 110 AND abs(a.y0 - b.y0) <= 110) WHERE d <= 60""",
        "summary_by_type": BOXES
        + "SELECT candidate_type, count(*) AS candidates FROM cand GROUP BY candidate_type",
        "quality_checks": FAULTY_SQL + """
            SELECT 'duplicate candidate_id values' AS "check", (SELECT count(*) FROM (
                     SELECT candidate_id FROM cand GROUP BY 1 HAVING count(*) > 1)) AS violations
            UNION ALL SELECT 'join rows without candidate', (SELECT count(*) FROM memb
                     WHERE candidate_id NOT IN (SELECT candidate_id FROM cand))
            UNION ALL SELECT 'candidate parcel-count mismatches', (SELECT count(*)
                     FROM cand JOIN actual USING (candidate_id) WHERE parcel_count <> actual_count)
            UNION ALL SELECT 'candidates without parcels', (SELECT count(*) FROM cand
                     WHERE candidate_id NOT IN (SELECT candidate_id FROM memb))""",
        "duplicate_keys": FAULTY_SQL
        + "SELECT candidate_id, count(*) AS rows FROM cand GROUP BY 1 HAVING count(*) > 1",
        "orphan_rows": FAULTY_SQL
        + "SELECT * FROM memb WHERE candidate_id NOT IN (SELECT candidate_id FROM cand)",
        "childless": FAULTY_SQL
        + "SELECT * FROM cand WHERE candidate_id NOT IN (SELECT candidate_id FROM memb)",
        "count_mismatches": FAULTY_SQL
        + "SELECT * FROM cand JOIN actual USING (candidate_id) WHERE parcel_count <> actual_count",
        "scan_features": BOXES + """
            SELECT CASE WHEN k // 500 % 2 = 0 THEN 'EPSG:2272' ELSE 'EPSG:4326' END AS source_srid,
                   CAST(row_number() OVER (PARTITION BY k // 500 ORDER BY k) - 1 AS INTEGER) AS feature_pos,
                   parcel_id AS source_feature_id, parcel_id AS opa_account_num, street_address,
                   x0 AS x, true AS named FROM boxes""",
        "scan_lines": BOXES + """
            SELECT 'EPSG:2272' AS source_srid, parcel_id AS source_feature_id,
                   parcel_id AS opa_account_num, street_address, x0 AS x, true AS named FROM boxes""",
        "scan_cache": """
            SELECT CAST(o_custkey AS VARCHAR) AS parcel_number, max_by(o_totalprice, o_orderkey) AS market_value,
                   max_by(o_orderstatus, o_orderkey) AS zoning FROM orders WHERE o_custkey <> 0 GROUP BY o_custkey""",
        "cache_refresh": """
            SELECT CAST(o_custkey AS VARCHAR) AS parcel_number,
                   max_by(CASE WHEN o_orderkey // 200 % 2 = 0 THEN -o_totalprice ELSE o_totalprice END, o_orderkey)
                     AS market_value,
                   max_by(o_orderstatus, o_orderkey) AS zoning FROM orders WHERE o_custkey <> 0 GROUP BY o_custkey""",
        "full_job": BOXES + f"SELECT {PLAIN_SQL} FROM cand",
        "published_tables": BOXES + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
            for name, source in zip(JOB_TABLES, ["boxes", "boxes", "boxes", "res", "cand", "members"])
        ),
        "feature_document": BOXES + """
            SELECT CAST(row_number() OVER (ORDER BY candidate_type, human_id, parcel_order, candidate_id, parcel_id) - 1
                     AS INTEGER) AS feature_pos, candidate_id, parcel_id FROM feats""",
        "assessments_empty": """
            SELECT CAST(c_custkey AS VARCHAR) AS parcel_number, CAST(NULL AS VARCHAR) AS zoning,
                   CAST(NULL AS DOUBLE) AS market_value, CAST(NULL AS VARCHAR) AS raw_opa_json FROM customer""",
        "run_stamp": BOXES
        + "SELECT candidate_id, true AS stamped, true AS recent FROM cand WHERE candidate_type = 'hyphen_address'",
        "enrichment_batches": PLAN_SQL + "SELECT * FROM plan",
        "enrichment_missing": PLAN_SQL
        + "SELECT batch_index, file_name FROM plan WHERE batch_index % 2 > 0",
        "enrichment_counts": PLAN_SQL
        + "SELECT count_if(batch_index % 2 = 0) AS cached, count_if(batch_index % 2 > 0) AS to_fetch FROM plan",
    }
