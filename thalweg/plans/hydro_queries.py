"""Every operator on hydro data as a registered query, each with SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg import adapter as A
from thalweg.adapter import oracle
from thalweg.operators import construct as C
from thalweg.operators import network as N
from thalweg.operators import pourpoints as P
from thalweg.operators import raster as R
from thalweg.operators import relational as Q
from thalweg.operators import sinks as S
from thalweg.operators import spatial as G
from thalweg.plans.registry import query

# ---- scans and predicates

_PATH = "id, from_nexus_id, to_nexus_id, ef_type, ef_subtype, rank, length, rivernameid1, rivernameid2, aoi_id"


@query("src_layer_scan", oracle(f"SELECT {_PATH} FROM flowpaths"))
def _(s, d):
    return A.flowpaths(s, d)


@query("src_bbox_scan", oracle("SELECT id FROM catchments WHERE minx <= 400 AND maxx >= 200 AND miny <= 300 AND maxy >= 100"))
def _(s, d):
    return A.catchments(s, d).filter(Q.bbox_intersects(200, 100, 400, 300)).select("id")


@query("src_attr_scan", oracle("SELECT id, length FROM flowpaths WHERE ef_type = 3"))
def _(s, d):
    return A.flowpaths(s, d).filter("ef_type = 3").select("id", "length")


@query("src_bbox_attr_scan", oracle("SELECT id FROM catchments WHERE minx <= 400 AND maxx >= 200 AND miny <= 300 AND maxy >= 100 AND ec_type = 4"))
def _(s, d):
    return A.catchments(s, d).filter(Q.all_of([Q.bbox_intersects(400, 300, 200, 100), Q.type_in("ec_type", [4])])).select("id")


@query("src_type_filter", oracle("SELECT id, ec_type FROM catchments WHERE ec_type IN (2, 4)"))
def _(s, d):
    return A.catchments(s, d).filter(Q.type_in("ec_type", [2, 4])).select("id", "ec_type")


@query("src_code_table_map", "SELECT l_linenumber AS code, CASE l_linenumber WHEN 4 THEN 'Lake' WHEN 9 THEN 'Pond' WHEN 6 THEN 'River' WHEN 1 THEN 'Canal' ELSE 'Unknown' END AS name, count(*) AS n FROM lineitem GROUP BY ALL")
def _(s, d):
    return A.table(s, d, "lineitem").groupBy(F.col("l_linenumber").alias("code")).agg(F.count("*").alias("n")).select("code", Q.decode(F.col("code"), Q.WATER_DEFINITIONS, "Unknown").alias("name"), "n")


@query("src_terminal_nodes", oracle("SELECT DISTINCT to_nexus_id AS id, 2 AS flow_direction FROM flowpaths WHERE to_nexus_id NOT IN (SELECT from_nexus_id FROM flowpaths)"))
def _(s, d):
    p = A.flowpaths(s, d)
    return p.select(F.col("to_nexus_id").alias("id")).distinct().join(p.select(F.col("from_nexus_id").alias("id")), "id", "left_anti").withColumn("flow_direction", F.lit(2))


@query("flt_predicate", oracle("SELECT id FROM flowpaths WHERE rivernameid1 > 25 AND length < 10000000 AND ef_type <> 2"))
def _(s, d):
    c = F.col
    return A.flowpaths(s, d).filter(Q.all_of([Q.predicate(c("rivernameid1"), "greaterThan", 25), Q.predicate(c("length"), "LESSTHAN", 10_000_000), Q.predicate(c("ef_type"), "notEquals", 2)])).select("id")


@query("flt_predicate_ordinal", oracle("SELECT id FROM flowpaths WHERE rank > 1"))
def _(s, d):
    rank = Q.decode(F.col("rank"), Q.RANKS)
    return A.flowpaths(s, d).filter(Q.predicate(rank, "greaterThan", "primary", Q.ORDINALS["rank"])).select("id")


@query("flt_by_id", oracle("SELECT 'flowpath' AS layer, id FROM flowpaths WHERE id = 100"))
def _(s, d):
    return Q.find_by_id([("flowpath", A.flowpaths(s, d)), ("catchment", A.catchments(s, d))], 100)


@query("flt_by_id_second_layer", oracle("SELECT 'catchment' AS layer, id FROM catchments WHERE id = 3"))
def _(s, d):
    return Q.find_by_id([("flowpath", A.flowpaths(s, d)), ("catchment", A.catchments(s, d))], 3)


@query("flt_contains_point", oracle("SELECT id FROM catchments WHERE 255.5 > minx AND 255.5 < maxx AND 33.25 > miny AND 33.25 < maxy"))
def _(s, d):
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny"))])
    near = A.catchments(s, d).filter(Q.bbox_intersects(255.5, 33.25, 255.5, 33.25))
    return near.filter(G.point_in_ring(F.lit(255.5), F.lit(33.25), ring)).select("id")


@query("flt_ilike", oracle("SELECT name_id FROM names WHERE name_en ILIKE '%re%' OR name_fr ILIKE '%re%'"))
def _(s, d):
    return A.names(s, d).filter(Q.name_matches("Re", "contains")).select("name_id")


@query("flt_ilike_exact", oracle("SELECT name_id FROM names WHERE lower(name_fr) = lower((SELECT min(p_type) FROM part))"))
def _(s, d):
    names = A.names(s, d)
    return names.filter(Q.name_matches(names.agg(F.min("name_fr")).first()[0].swapcase())).select("name_id")


@query("flt_feature_type", oracle("SELECT id FROM catchments WHERE ec_type <> 4"))
def _(s, d):
    return A.catchments(s, d).filter(Q.feature_type_filter("catchment")).select("id")


@query("flt_aoi_names", oracle("SELECT f.id, a.short_name FROM flowpaths f JOIN aois a USING (aoi_id) WHERE a.short_name IN (SELECT n_name FROM nation ORDER BY n_name LIMIT 3)"))
def _(s, d):
    aois = A.aois(s, d)
    wanted = aois.orderBy("short_name").limit(3).select("short_name")
    return A.flowpaths(s, d).join(aois.join(wanted, "short_name", "left_semi"), "aoi_id").select("id", "short_name")


@query("flt_limit_guard", oracle("SELECT count(*) AS n FROM flowpaths WHERE ef_type = 1"))
def _(s, d):
    return Q.guarded(A.flowpaths(s, d).filter("ef_type = 1"), Q.MOST_EXPORTED).agg(F.count("*").alias("n"))


# ---- projections

_LOOKUPS = """, type_names(code, name) AS (VALUES (1, 'Reach'), (2, 'Bank'), (3, 'Skeleton'), (4, 'Infrastructure'))
SELECT f.id, t.name AS type_name, CASE f.rank WHEN 1 THEN 'Primary' WHEN 2 THEN 'Secondary' END AS rank_name, a.name_en AS river1_en, a.name_fr AS river1_fr, b.name_en AS river2_en, b.name_fr AS river2_fr, o.short_name, f.length
FROM flowpaths f LEFT JOIN type_names t ON f.ef_type = t.code LEFT JOIN names a ON f.rivernameid1 = a.name_id LEFT JOIN names b ON f.rivernameid2 = b.name_id LEFT JOIN aois o ON f.aoi_id = o.aoi_id"""


@query("prj_feature_select", oracle(_LOOKUPS + " WHERE f.rank = 1"))
def _(s, d):
    return Q.with_lookups(A.flowpaths(s, d).filter("rank = 1"), A.names(s, d), A.aois(s, d))


@query("join_lookup_left", oracle(_LOOKUPS))
def _(s, d):
    return Q.with_lookups(A.flowpaths(s, d), A.names(s, d), A.aois(s, d))


@query("join_lookup_left7", oracle("""SELECT c.id, CASE c.ec_type WHEN 1 THEN 'Reach' WHEN 2 THEN 'Bank' WHEN 3 THEN 'Empty' WHEN 4 THEN 'Water' END AS type_name, c.area, n.name_en, n.name_fr, m.name_en AS lake_en, m.name_fr AS lake_fr
FROM catchments c LEFT JOIN flowpaths f ON c.id = f.id LEFT JOIN names n ON f.rivernameid1 = n.name_id LEFT JOIN names m ON f.rivernameid2 = m.name_id"""))
def _(s, d):
    names = A.names(s, d)
    own = A.flowpaths(s, d).select("id", "rivernameid1", "rivernameid2")
    out = A.catchments(s, d).join(own, "id", "left").join(names.withColumnRenamed("name_id", "rivernameid1"), "rivernameid1", "left")
    lake = names.select(F.col("name_id").alias("rivernameid2"), F.col("name_en").alias("lake_en"), F.col("name_fr").alias("lake_fr"))
    return out.join(lake, "rivernameid2", "left").select("id", Q.decode(F.col("ec_type"), Q.EC_TYPES).alias("type_name"), "area", "name_en", "name_fr", "lake_en", "lake_fr")


@query("prj_type_case", oracle("SELECT id, CASE WHEN ec_subtype = 1 THEN 'Canal' ELSE 'Unknown' END AS water_type FROM catchments WHERE ec_type = 4"))
def _(s, d):
    return A.catchments(s, d).filter("ec_type = 4").select("id", Q.decode(F.col("ec_subtype"), {1: "Canal", 6: "River", 9: "Pond"}, "Unknown").alias("water_type"))


@query("prj_literal_null_pad", oracle("SELECT id, ef_type AS kind, length, NULL::BIGINT AS area FROM flowpaths UNION ALL SELECT id, ec_type, NULL, area FROM catchments"))
def _(s, d):
    a = A.flowpaths(s, d).select("id", F.col("ef_type").alias("kind"), "length")
    return a.unionByName(A.catchments(s, d).select("id", F.col("ec_type").alias("kind"), "area"), allowMissingColumns=True)


_EDGE = "20037508.342789244"


@query("prj_envelope", f"""WITH t AS (SELECT l_orderkey AS id, 8 AS z, l_partkey % 256 AS x, l_suppkey % 256 AS y FROM lineitem WHERE l_linenumber = 1)
SELECT id, round(x * (2 * {_EDGE}::DOUBLE / 256) - {_EDGE}::DOUBLE, 3) AS minx, round({_EDGE}::DOUBLE - (y + 1) * (2 * {_EDGE}::DOUBLE / 256), 3) AS miny, round((x + 1) * (2 * {_EDGE}::DOUBLE / 256) - {_EDGE}::DOUBLE, 3) AS maxx, round({_EDGE}::DOUBLE - y * (2 * {_EDGE}::DOUBLE / 256), 3) AS maxy FROM t""")
def _(s, d):
    t = A.table(s, d, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("id"), F.lit(8).alias("z"), (F.col("l_partkey") % 256).alias("x"), (F.col("l_suppkey") % 256).alias("y"))
    box = G.tile_envelope(F.col("z"), F.col("x"), F.col("y"))
    return t.select("id", *[F.round(c, 3).alias(n) for c, n in zip(box, ("minx", "miny", "maxx", "maxy"), strict=True)])


@query("prj_tile_key", "SELECT DISTINCT CASE WHEN user_id % 40 < 32 THEN upper(event_type) || '__5_' || (user_id % 40) || '_' || (event_id % 32) END AS key FROM events")
def _(s, d):
    return A.table(s, d, "events").select(G.tile_key(F.col("event_type"), F.lit(5), F.col("user_id") % 40, F.col("event_id") % 32).alias("key")).distinct()


# ---- joins


@query("join_self_aoi", oracle("SELECT DISTINCT b.aoi_id AS src, a.aoi_id AS dst FROM flowpaths a JOIN flowpaths b ON a.from_nexus_id = b.to_nexus_id WHERE a.aoi_id <> b.aoi_id AND a.rank = 1 AND b.rank = 1"))
def _(s, d):
    links = Q.area_links(A.flowpaths(s, d))
    return links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


@query("join_semi_nexus", oracle("SELECT o_orderkey AS id FROM orders WHERE o_orderkey IN (SELECT from_nexus_id FROM flowpaths WHERE ef_type = 3 UNION SELECT to_nexus_id FROM flowpaths WHERE ef_type = 3)"))
def _(s, d):
    return Q.used_nexuses(A.table(s, d, "orders").select(F.col("o_orderkey").alias("id")), A.flowpaths(s, d).filter("ef_type = 3"))


@query("join_semi_names", oracle("SELECT id FROM flowpaths WHERE rivernameid1 IN (SELECT name_id FROM names WHERE name_en ILIKE '%a%') OR rivernameid2 IN (SELECT name_id FROM names WHERE name_en ILIKE '%a%')"))
def _(s, d):
    hits = A.names(s, d).filter(Q.name_matches("a", "contains", ("name_en",))).select("name_id")
    p = A.flowpaths(s, d).select("id", F.explode(F.array("rivernameid1", "rivernameid2")).alias("name_id"))
    return p.join(hits, "name_id", "left_semi").select("id").distinct()


@query("join_point_in_polygon", oracle(", p AS (SELECT id, x + 600 AS x, y + 400 AS y FROM points) SELECT p.id, c.id AS box FROM p JOIN catchments c ON p.x > c.minx AND p.x < c.maxx AND p.y > c.miny AND p.y < c.maxy"))
def _(s, d):
    p = A.points(s, d).select("id", (F.col("x") + 600).alias("x"), (F.col("y") + 400).alias("y"))
    return G.points_in_boxes(p, A.catchments(s, d), 50.0)


@query("join_nearest", oracle(", d AS (SELECT a.id, b.id AS target, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance FROM points a JOIN points b ON a.id <> b.id) SELECT id, target, round(distance, 6) AS distance, row_number() OVER (PARTITION BY id ORDER BY distance, target) AS place FROM d WHERE distance <= 40 QUALIFY place <= 3"))
def _(s, d):
    p = A.points(s, d)
    near = G.nearest(p, p, 4, 40.0).filter("id <> target")
    from pyspark.sql import Window

    w = Window.partitionBy("id").orderBy("distance", "target")
    return near.withColumn("place", F.row_number().over(w)).filter("place <= 3").select("id", "target", F.round("distance", 6).alias("distance"), "place")


@query("join_update_from", "SELECT o_orderkey AS id, CASE WHEN c_custkey IS NOT NULL AND o_orderstatus = 'O' THEN 'FP_PROCESSING' ELSE 'READY' END AS status FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(s, d):
    control = A.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("READY").alias("status"), "o_custkey", "o_orderstatus")
    claimed = control.filter("o_orderstatus = 'O'").join(A.table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("id", F.lit("FP_PROCESSING").alias("status"))
    return S.updated(control.select("id", "status"), claimed, "id", "status")


# ---- name search

_KINDS = "SELECT rivernameid1 AS name_id, 'flowpath' AS kind, least(x1, x2) AS minx, least(y1, y2) AS miny, greatest(x1, x2) AS maxx, greatest(y1, y2) AS maxy FROM lined WHERE rivernameid1 IS NOT NULL"


def _named_features(s, d) -> DataFrame:
    p = A.with_points(A.flowpaths(s, d)).filter("rivernameid1 IS NOT NULL")
    a = p.select(F.col("rivernameid1").alias("name_id"), F.lit("flowpath").alias("kind"), F.least("x1", "x2").alias("minx"), F.least("y1", "y2").alias("miny"), F.greatest("x1", "x2").alias("maxx"), F.greatest("y1", "y2").alias("maxy"))
    c = A.catchments(s, d).filter("ec_type = 4").select((F.col("id") % 60).alias("name_id"), F.lit("waterbody").alias("kind"), "minx", "miny", "maxx", "maxy")
    return a.unionByName(c)


_FEATURES = f", features AS ({_KINDS} UNION ALL SELECT id % 60, 'waterbody', minx, miny, maxx, maxy FROM catchments WHERE ec_type = 4)"


@query("search_all", oracle(""", hits AS (SELECT name_id FROM names WHERE name_en ILIKE '%e%' OR name_fr ILIKE '%e%'),
u AS (SELECT 0 AS place, 'flowpath' AS kind, id FROM flowpaths WHERE rivernameid1 IN (SELECT name_id FROM hits) OR rivernameid2 IN (SELECT name_id FROM hits)
UNION ALL SELECT 1, CASE WHEN ec_type = 4 THEN 'waterbody' ELSE 'catchment' END, id FROM catchments WHERE id % 60 IN (SELECT name_id FROM hits))
SELECT kind, id FROM u ORDER BY place, id LIMIT 5000"""))
def _(s, d):
    return Q.search_all(A.flowpaths(s, d), A.catchments(s, d).withColumn("lakenameid1", F.col("id") % 60), A.names(s, d), "e")


@query("agg_extent", oracle(_FEATURES + " SELECT n.name_id, n.name_en, n.name_fr, count(*) AS n, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM features f JOIN names n USING (name_id) WHERE name_en ILIKE '%o%' OR name_fr ILIKE '%o%' GROUP BY ALL"))
def _(s, d):
    return Q.search_grouped(_named_features(s, d), A.names(s, d), "o")


@query("lim_budget", oracle("SELECT * FROM (SELECT 'flowpath' AS kind, id FROM flowpaths WHERE ef_type = 4 ORDER BY id LIMIT 100) UNION ALL SELECT * FROM (SELECT 'catchment', id FROM catchments ORDER BY id LIMIT greatest(0, 100 - (SELECT count(*) FROM flowpaths WHERE ef_type = 4)))"))
def _(s, d):
    a = A.flowpaths(s, d).filter("ef_type = 4").select(F.lit(0).alias("place"), F.lit("flowpath").alias("kind"), "id")
    return a.unionByName(A.catchments(s, d).select(F.lit(1).alias("place"), F.lit("catchment").alias("kind"), "id")).orderBy("place", "id").limit(100).select("kind", "id")


@query("lim_max_results", oracle("SELECT id, length FROM flowpaths ORDER BY length DESC, id LIMIT 500"))
def _(s, d):
    return A.flowpaths(s, d).orderBy(F.col("length").desc(), "id").limit(500).select("id", "length")


# ---- set operations and windows


@query("set_union_distinct", oracle("SELECT from_nexus_id AS id FROM flowpaths UNION SELECT to_nexus_id FROM flowpaths"))
def _(s, d):
    p = A.flowpaths(s, d)
    return p.select(F.col("from_nexus_id").alias("id")).union(p.select("to_nexus_id")).distinct()


@query("set_distinct", oracle("SELECT DISTINCT name, name_id FROM (SELECT rivernameid1 AS name_id, n.name_en AS name FROM flowpaths JOIN names n ON rivernameid1 = name_id UNION ALL SELECT rivernameid2, n.name_fr FROM flowpaths JOIN names n ON rivernameid2 = name_id) WHERE name <> ''"))
def _(s, d):
    n = A.names(s, d)
    p = A.flowpaths(s, d)
    a = p.join(n, F.col("rivernameid1") == F.col("name_id")).select(F.col("rivernameid1").alias("i"), F.col("name_en").alias("n"))
    b = p.join(n, F.col("rivernameid2") == F.col("name_id")).select(F.col("rivernameid2").alias("i"), F.col("name_fr").alias("n"))
    return Q.name_table([(a, [("i", "n")]), (b, [("i", "n")])])


@query("set_difference", oracle("SELECT id FROM catchments WHERE id NOT IN (SELECT id FROM flowpaths)"))
def _(s, d):
    return A.catchments(s, d).select("id").join(A.flowpaths(s, d), "id", "left_anti")


@query("set_dedup_topological", oracle("SELECT least(from_nexus_id, to_nexus_id) AS a, greatest(from_nexus_id, to_nexus_id) AS b, min(id) AS id, count(*) AS n FROM flowpaths GROUP BY 1, 2"))
def _(s, d):
    return N.without_parallel(A.flowpaths(s, d))


_TILES = "SELECT event_id AS key, ts AS last_accessed, CAST(round(value * 100) AS BIGINT) AS size FROM events"


@query("snk_cache_evict", f"""WITH t AS ({_TILES}), r AS (SELECT *, sum(size) OVER (ORDER BY date_trunc('day', last_accessed), last_accessed, key) AS running, sum(size) OVER () AS total FROM t)
SELECT key, CAST(running AS BIGINT) AS running FROM r WHERE total > 1000000 AND running - size < total - 500000""")
def _(s, d):
    t = A.table(s, d, "events").select(F.col("event_id").alias("key"), F.col("ts").alias("last_accessed"), F.round(F.col("value") * 100).cast("long").alias("size"))
    return Q.cache_evictions(t, 1_000_000, 500_000)


@query("agg_cache_size", f"WITH t AS ({_TILES}) SELECT round(sum(size) / 1e6, 6) AS mb FROM t")
def _(s, d):
    return A.table(s, d, "events").agg(F.round(F.sum(F.round(F.col("value") * 100).cast("long")) / 1e6, 6).alias("mb"))


#: A number from 0 as letters, of up to five: the k-letter names begin behind all shorter ones.
_LETTERS = " ".join(
    f"WHEN n < {sum(26**j for j in range(1, k + 1))} THEN " + " || ".join(f"chr(CAST(65 + ((n - {sum(26**j for j in range(1, k))}) // {26**i}) % 26 AS INT))" for i in reversed(range(k))) for k in range(1, 6)
)


@query("win_partition_letters", oracle(f", r AS (SELECT ec_type, id, area, row_number() OVER (PARTITION BY ec_type ORDER BY area DESC, id) - 1 AS n FROM catchments) SELECT id, CASE {_LETTERS} END AS name FROM r"))
def _(s, d):
    c = A.catchments(s, d).select("id", "ec_type", "area")
    n = Q.places_in_group(c, "ec_type", "area", "id", 1024)
    return n.select("id", Q.letters(F.col("n")).alias("name"))


# ---- aggregates


@query("agg_count_guard", oracle("SELECT count(*) AS n FROM flowpaths WHERE rank = 2"))
def _(s, d):
    return A.flowpaths(s, d).filter("rank = 2").agg(F.count("*").alias("n"))


@query("agg_dup_having", oracle("SELECT to_nexus_id, count(*) AS n FROM flowpaths GROUP BY 1 HAVING count(*) > 1"))
def _(s, d):
    return Q.duplicates(A.flowpaths(s, d), "to_nexus_id")


def _stats_sql(weight: str) -> str:
    means = ", ".join(f"round(sum({c} * area)::DOUBLE / {weight.format(c=c)}, 6) AS {c}" for c in ("elv_mean", "slope_mean", "north_pct", "south_pct", "east_pct", "west_pct", "flat_pct", "d2w2d_mean"))
    return f"sum(area)::BIGINT AS area, min(elv_min) AS elv_min, min(slope_min) AS slope_min, max(elv_max) AS elv_max, max(slope_max) AS slope_max, max(d2w2d_max) AS d2w2d_max, {means}"


@query("agg_drainage_stats", oracle(f"SELECT ec_type, {_stats_sql('sum(area)')} FROM catchments GROUP BY 1"))
def _(s, d):
    return Q.drainage_stats(A.catchments(s, d), ["ec_type"])


@query("agg_drainage_stats_nonnull", oracle("SELECT ec_type, " + _stats_sql("sum(area) FILTER ({c} IS NOT NULL)") + " FROM catchments GROUP BY 1"))
def _(s, d):
    return Q.drainage_stats(A.catchments(s, d), ["ec_type"], nulls_weigh=False)


@query("agg_node_degree", oracle("SELECT id, CAST(sum(i) AS BIGINT) AS n_in, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(b) AS BIGINT) AS n_bank FROM (SELECT from_nexus_id AS id, 0 AS i, 1 AS o, CAST(ef_type = 2 AS INT) AS b FROM flowpaths UNION ALL SELECT to_nexus_id, 1, 0, CAST(ef_type = 2 AS INT) FROM flowpaths) GROUP BY 1"))
def _(s, d):
    return Q.node_degrees(A.flowpaths(s, d))


@query("agg_coord_count", oracle("SELECT x, y, count(*) AS n FROM (SELECT x1 AS x, y1 AS y FROM lined UNION ALL SELECT x2, y2 FROM lined) GROUP BY 1, 2 HAVING count(*) > 2"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d))
    return p.select(F.col("x1").alias("x"), F.col("y1").alias("y")).union(p.select("x2", "y2")).groupBy("x", "y").agg(F.count("*").alias("n")).filter("n > 2")


@query("agg_max_graph_id", oracle("SELECT max(id) AS top FROM flowpaths"))
def _(s, d):
    return A.flowpaths(s, d).agg(F.max("id").alias("top"))


# ---- graph

_ROOT = "CAST(floor(id / pow(2, floor(log2(id)) - 3)) AS BIGINT)"


@query("g_build", oracle(", ends AS (SELECT x1 AS x, y1 AS y FROM lined UNION SELECT x2, y2 FROM lined) SELECT f.id, count(*) AS matched FROM lined f JOIN ends a ON f.x1 = a.x AND f.y1 = a.y JOIN ends b ON f.x2 = b.x AND f.y2 = b.y GROUP BY 1"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d)).select("id", *[G.snapped(F.col(c)).alias(c) for c in ("x1", "y1", "x2", "y2")])
    nodes = p.select(F.col("x1").alias("x"), F.col("y1").alias("y")).union(p.select("x2", "y2")).distinct()
    a, b = nodes.select(F.col("x").alias("x1"), F.col("y").alias("y1")), nodes.select(F.col("x").alias("x2"), F.col("y").alias("y2"))
    return p.join(a, ["x1", "y1"]).join(b, ["x2", "y2"]).groupBy("id").agg(F.count("*").alias("matched"))


@query("g_components", oracle(""", e AS (SELECT from_nexus_id AS a, to_nexus_id AS b FROM flowpaths WHERE rank = 1 UNION ALL SELECT to_nexus_id, from_nexus_id FROM flowpaths WHERE rank = 1)
SELECT id, CAST(floor(id / pow(2, floor(log2(id)) - 3)) AS BIGINT) AS component FROM (SELECT DISTINCT a AS id FROM e)"""))
def _(s, d):
    return N.connected_components(A.flowpaths(s, d).filter("rank = 1"), "from_nexus_id", "to_nexus_id")


@query("agg_component_size", oracle(f", n AS (SELECT from_nexus_id AS id FROM flowpaths WHERE rank = 1 UNION SELECT to_nexus_id FROM flowpaths WHERE rank = 1) SELECT {_ROOT} AS component, count(*) AS n FROM n GROUP BY 1 HAVING count(*) >= 3"))
def _(s, d):
    return N.connected_components(A.flowpaths(s, d).filter("rank = 1"), "from_nexus_id", "to_nexus_id").groupBy("component").agg(F.count("*").alias("n")).filter("n >= 3")


@query("g_visit_order", oracle(", p AS (SELECT * FROM flowpaths WHERE rank = 1 AND ef_type <> 2), r(id, hop) AS (SELECT DISTINCT to_nexus_id, 0 FROM p WHERE to_nexus_id NOT IN (SELECT from_nexus_id FROM p) UNION ALL SELECT p.from_nexus_id, hop + 1 FROM r JOIN p ON p.to_nexus_id = r.id) SELECT id, hop FROM r", recursive=True))
def _(s, d):
    return N.hops_to_outlet(A.flowpaths(s, d))


DEPTHS = 18


def _orders_sql(named: bool, base_hack: str = "1") -> str:
    """Stream orders level by level: nodes 8 * 2^d .. 16 * 2^d - 1 lie d steps above the outlets."""
    best = "e.len_up DESC, e.id" if not named else "coalesce(e.nm = o.nm, false) DESC, (e.nm IS NOT NULL) DESC, e.len_up DESC, e.id"
    parts = [", p AS MATERIALIZED (SELECT id, from_nexus_id AS f, to_nexus_id AS t, length, rivernameid1 AS nm FROM flowpaths WHERE rank = 1 AND ef_type <> 2)"]
    for d in reversed(range(DEPTHS)):
        lo, hi = 8 << d, (16 << d) - 1
        below = f"SELECT p.t AS node, p.id, p.nm, u.s, u.sh, u.up + p.length AS len_up, u.ms FROM p JOIN u{d + 1} u ON p.f = u.node" if d + 1 < DEPTHS else "SELECT 0 AS node, 0 AS id, 0 AS nm, 0 AS s, 0 AS sh, 0 AS len_up, 0 AS ms WHERE false"
        parts.append(
            f"i{d} AS MATERIALIZED ({below}), u{d} AS MATERIALIZED (SELECT n.node, coalesce(max(e.s) + CASE WHEN len(list_filter(list(e.s), lambda x: x = list_max(list(e.s)))) >= 2 THEN 1 ELSE 0 END, 1) AS s, "
            f"coalesce(sum(e.sh), 1)::BIGINT AS sh, coalesce(max(e.len_up), 0) AS up, coalesce(first(e.ms ORDER BY {best}), n.node) AS ms "
            f"FROM (SELECT o_orderkey AS node FROM orders WHERE o_orderkey BETWEEN {lo} AND {hi}) n LEFT JOIN i{d} e ON e.node = n.node LEFT JOIN p o ON o.f = n.node GROUP BY n.node)"
        )
    parts.append(f"w0 AS MATERIALIZED (SELECT node, s, sh, up, ms, {base_hack} AS hack, s AS ho, 0 AS seq FROM u0 u)")
    for d in range(1, DEPTHS):
        same = "w.ms = u.ms"
        parts.append(
            f"w{d} AS MATERIALIZED (SELECT u.node, u.s, u.sh, u.up, u.ms, CASE WHEN w.node IS NULL THEN {base_hack} WHEN {same} THEN w.hack ELSE w.hack + 1 END AS hack, CASE WHEN w.node IS NULL OR NOT {same} THEN u.s ELSE w.ho END AS ho, "
            f"CASE WHEN w.node IS NULL THEN 0 WHEN {same} THEN w.seq + 1 ELSE 1 END AS seq FROM u{d} u LEFT JOIN p ON p.f = u.node LEFT JOIN w{d - 1} w ON w.node = p.t)"
        )
    union = " UNION ALL ".join(f"SELECT * FROM w{d}" for d in range(DEPTHS))
    parts.append(f"w AS ({union})")
    return ", ".join(parts)


_ORDER_ROWS = " SELECT x.id, w.s::BIGINT AS strahler, w.sh AS shreve, w.up::BIGINT AS max_uplength, w.ms::BIGINT AS mainstem, w.hack::BIGINT AS hack, w.ho::BIGINT AS horton, w.seq::BIGINT AS mainstem_seq FROM flowpaths x LEFT JOIN p ON p.id = x.id LEFT JOIN w ON w.node = p.f"


@query("g_orders_by_length", oracle(_orders_sql(False) + _ORDER_ROWS))
def _(s, d):
    return N.stream_orders(A.flowpaths(s, d)).drop("component")


@query("g_orders_by_name", oracle(_orders_sql(True) + _ORDER_ROWS))
def _(s, d):
    return N.stream_orders(A.flowpaths(s, d), name="rivernameid1").drop("component")


@query("g_orders_legacy", oracle(_orders_sql(True, "CASE WHEN u.node IN (8, 10, 12, 14) THEN 1 ELSE 1001 END") + _ORDER_ROWS))
def _(s, d):
    return N.stream_orders(A.flowpaths(s, d), name="rivernameid1", isolated_hack=1001, boundary=[8, 10, 12, 14]).drop("component")


@query("g_strahler", oracle(_orders_sql(False) + " SELECT p.id, w.s::BIGINT AS strahler FROM p JOIN w ON w.node = p.f"))
def _(s, d):
    return N.stream_orders(A.flowpaths(s, d)).filter("strahler IS NOT NULL").select("id", "strahler")


@query("g_shreve", oracle(_orders_sql(False) + " SELECT p.id, w.sh AS shreve FROM p JOIN w ON w.node = p.f"))
def _(s, d):
    return N.stream_orders(A.flowpaths(s, d)).filter("shreve IS NOT NULL").select("id", "shreve")


@query("agg_catchment_orders", oracle(_orders_sql(False) + " SELECT p.t AS ecatchment_id, max(w.s)::BIGINT AS strahler, max(w.ho)::BIGINT AS horton, min(w.hack)::BIGINT AS hack, first(p.nm ORDER BY w.ho DESC, p.id) FILTER (p.nm IS NOT NULL) AS name FROM p JOIN w ON w.node = p.f GROUP BY 1"))
def _(s, d):
    p = A.flowpaths(s, d)
    o = N.stream_orders(p).filter("strahler IS NOT NULL")
    return Q.catchment_orders(p.select("id", F.col("to_nexus_id").alias("ecatchment_id"), F.col("rivernameid1").alias("name")).join(o, "id"))


@query("g_upstream_flowpaths", oracle(", r(id) AS (SELECT 100 UNION SELECT b.id FROM r JOIN flowpaths a ON a.id = r.id JOIN flowpaths b ON b.to_nexus_id = a.from_nexus_id) SELECT id::BIGINT AS id FROM r", recursive=True))
def _(s, d):
    return N.trace(A.flowpaths(s, d), s.createDataFrame([(100,)], "id long"), upstream=True).select("id")


@query("g_downstream_flowpaths", oracle(", r(id) AS (SELECT id FROM flowpaths WHERE id % 997 = 0 AND rank = 1 UNION SELECT b.id FROM r JOIN flowpaths a ON a.id = r.id JOIN flowpaths b ON b.from_nexus_id = a.to_nexus_id) SELECT id FROM r", recursive=True))
def _(s, d):
    p = A.flowpaths(s, d)
    return N.trace(p, p.filter("id % 997 = 0 AND rank = 1").select("id")).select("id")


@query("lim_traversal_cap", oracle(", r(id, hop) AS (SELECT 16, 0 UNION ALL SELECT f.id, hop + 1 FROM r JOIN flowpaths f ON f.to_nexus_id = r.id AND f.rank = 1) SELECT id::BIGINT AS id, hop FROM r ORDER BY hop, id LIMIT 200", recursive=True))
def _(s, d):
    return N.trace(A.flowpaths(s, d).filter("rank = 1"), s.createDataFrame([(16,)], "id long"), upstream=True, most=200)


@query("g_primary_path_down", oracle(", r(id, hop) AS (SELECT id, 0 FROM flowpaths WHERE id = (SELECT max(o_orderkey) FROM orders) UNION ALL SELECT f.id, hop + 1 FROM r JOIN flowpaths f ON f.id = r.id // 2 AND f.rank = 1) SELECT id, hop FROM r", recursive=True))
def _(s, d):
    p = A.flowpaths(s, d).filter("rank = 1")
    return N.trace(p, p.agg(F.max("id").alias("id")))


_CL = ", cl AS (SELECT DISTINCT a.from_nexus_id AS src, b.from_nexus_id AS dst FROM flowpaths a JOIN flowpaths b ON a.to_nexus_id = b.from_nexus_id WHERE a.from_nexus_id <> b.from_nexus_id)"


def _owned(s, d) -> DataFrame:
    return A.flowpaths(s, d).withColumn("ecatchment_id", F.col("from_nexus_id"))


@query("g_upstream_catchments", oracle(_CL + ", r(id) AS (SELECT 40 UNION SELECT src FROM r JOIN cl ON dst = r.id) SELECT c.id, c.ec_type FROM catchments c WHERE c.id IN (SELECT id FROM r)", recursive=True))
def _(s, d):
    return N.drainage(_owned(s, d), A.catchments(s, d), s.createDataFrame([(40,)], "id long")).select("id", "ec_type")


@query("g_downstream_catchments", oracle(_CL + ", r(id) AS (SELECT 1000 UNION SELECT dst FROM r JOIN cl ON src = r.id) SELECT c.id, c.ec_type FROM catchments c WHERE c.id IN (SELECT id FROM r)", recursive=True))
def _(s, d):
    return N.drainage(_owned(s, d), A.catchments(s, d), s.createDataFrame([(1000,)], "id long"), upstream=False).select("id", "ec_type")


@query("g_drainage_area", oracle(_CL + f", r(id) AS (SELECT 20 UNION SELECT src FROM r JOIN cl ON dst = r.id) SELECT {_stats_sql('sum(area)')} FROM catchments c WHERE c.id IN (SELECT id FROM r)", recursive=True))
def _(s, d):
    return Q.drainage_stats(N.drainage(_owned(s, d), A.catchments(s, d), s.createDataFrame([(20,)], "id long")))


@query("g_multidimensional", oracle(_CL + ", r(id) AS (SELECT 20 UNION SELECT src FROM r JOIN cl ON dst = r.id), c AS (SELECT * FROM catchments WHERE id IN (SELECT id FROM r)) SELECT 'waterbody' AS kind, id FROM c WHERE ec_type = 4 UNION ALL SELECT 'flowpath', f.id FROM c JOIN flowpaths f ON f.from_nexus_id = c.id WHERE ec_type <> 4", recursive=True))
def _(s, d):
    p = _owned(s, d)
    c = N.drainage(p, A.catchments(s, d), s.createDataFrame([(20,)], "id long")).select("id", "ec_type")
    lines = c.filter("ec_type <> 4").select(F.col("id").alias("ecatchment_id")).join(p, "ecatchment_id").select(F.lit("flowpath").alias("kind"), "id")
    return c.filter("ec_type = 4").select(F.lit("waterbody").alias("kind"), "id").union(lines)


@query("g_classify_nexus", oracle(""", t AS (SELECT id, sum(i) AS i, sum(o) AS o, sum(b * o) AS bo, sum(s * i) AS ii, sum(s * o) AS io, sum(b + s) AS bi FROM (
SELECT from_nexus_id AS id, 0 AS i, 1 AS o, CAST(ef_type = 2 AS INT) AS b, CAST(ef_type = 3 AS INT) AS s FROM flowpaths UNION ALL SELECT to_nexus_id, 1, 0, CAST(ef_type = 2 AS INT), CAST(ef_type = 3 AS INT) FROM flowpaths) GROUP BY 1)
SELECT id, CASE WHEN i = 0 AND o = 1 AND bo = 1 THEN 'BANK' WHEN i = 0 THEN 'HEADWATER' WHEN o = 0 AND id % 2 = 0 THEN 'TERMINAL_BOUNDARY' WHEN o = 0 THEN 'TERMINAL_ISOLATED' WHEN i = 1 AND o = 1 AND ii = 1 AND io = 1 THEN 'INFERRED' WHEN bi = i + o THEN 'INFERRED' ELSE 'FLOWPATH' END AS nexus_type FROM t"""))
def _(s, d):
    p = A.flowpaths(s, d)
    return N.classify_nexuses(p, p.select(F.col("to_nexus_id").alias("id")).distinct().filter("id % 2 = 0"))


@query("g_cycle_check", oracle("SELECT id, from_nexus_id, to_nexus_id FROM flowpaths WHERE id IN (16, 32, 64) UNION ALL SELECT 0, 8, 64"))
def _(s, d):
    p = A.flowpaths(s, d).filter("rank = 1").select("id", "from_nexus_id", "to_nexus_id")
    return N.peel(p.union(s.createDataFrame([(0, 8, 64)], "id long, a long, b long")))


@query("g_no_cycle", oracle("SELECT id, from_nexus_id, to_nexus_id FROM flowpaths WHERE false"))
def _(s, d):
    return N.peel(A.flowpaths(s, d))


@query("g_invalid_source_sink", oracle(", t AS (SELECT id, count(*) AS n, sum(o) AS o FROM (SELECT from_nexus_id AS id, 1 AS o FROM flowpaths UNION ALL SELECT to_nexus_id, 0 FROM flowpaths) GROUP BY 1) SELECT id, CASE WHEN o = 0 THEN 'sink' ELSE 'source' END AS problem FROM t WHERE n > 1 AND (o = 0 OR o = n) AND id NOT IN (8, 9)"))
def _(s, d):
    return N.invalid_sources_sinks(A.flowpaths(s, d), s.createDataFrame([(8,), (9,)], "id long"))


@query("g_forked_nodes", oracle("SELECT from_nexus_id AS id, count(*) AS n_out FROM flowpaths WHERE rank = 1 AND ef_type <> 2 GROUP BY 1 HAVING count(*) > 1"))
def _(s, d):
    return N.forked_nodes(A.flowpaths(s, d))


@query("g_rank", oracle(f""", forks AS (SELECT from_nexus_id AS n FROM lined GROUP BY 1 HAVING count(*) > 1),
sc AS (SELECT o.from_nexus_id AS n, o.id, round(coalesce(max(CASE WHEN abs(atan2(o.y2 - o.y1, o.x2 - o.x1) - atan2(i.y1 - i.y2, i.x1 - i.x2)) > pi() THEN 2 * pi() - abs(atan2(o.y2 - o.y1, o.x2 - o.x1) - atan2(i.y1 - i.y2, i.x1 - i.x2))
ELSE abs(atan2(o.y2 - o.y1, o.x2 - o.x1) - atan2(i.y1 - i.y2, i.x1 - i.x2)) END), 0) / pi(), 6) AS score FROM lined o JOIN forks f ON o.from_nexus_id = f.n LEFT JOIN lined i ON i.to_nexus_id = o.from_nexus_id GROUP BY 1, 2),
best AS (SELECT n, first(id ORDER BY score DESC, id) AS best FROM sc GROUP BY 1) SELECT l.id, CASE WHEN b.best IS NULL OR b.best = l.id THEN 1 ELSE 2 END AS rank FROM lined l LEFT JOIN best b ON l.from_nexus_id = b.n"""))
def _(s, d):
    return N.rank_by_angle(A.with_points(A.flowpaths(s, d)))


# ---- pourpoints

_POINTS = "point AS (SELECT id AS point, id AS edge FROM flowpaths WHERE rank = 1 AND id IN (20, 41, 83, 90, 100, 200, 401))"


def _pp(s) -> DataFrame:
    return s.createDataFrame([(k, k) for k in (20, 41, 83, 90, 100, 200, 401)], "point long, edge long")


_REACH = f", {_POINTS}, walk(point, node, dist) AS (SELECT point, f.to_nexus_id, 0::BIGINT FROM point JOIN flowpaths f ON f.id = edge UNION ALL SELECT w.point, f.to_nexus_id, w.dist + f.length FROM walk w JOIN flowpaths f ON f.from_nexus_id = w.node)"


@query("pp_reach", oracle(_REACH + " SELECT point, node, min(dist)::BIGINT AS least, max(dist)::BIGINT AS most FROM walk GROUP BY 1, 2", recursive=True))
def _(s, d):
    return P.reach(A.flowpaths(s, d), _pp(s))


_DIST = _REACH + ", dist AS (SELECT w.point AS a, p.point AS b, min(w.dist + f.length)::BIGINT AS least, max(w.dist + f.length)::BIGINT AS most FROM walk w JOIN flowpaths f ON f.from_nexus_id = w.node JOIN point p ON p.edge = f.id WHERE w.point <> p.point GROUP BY 1, 2)"


@query("pp_distance_primary", oracle(_DIST.replace("JOIN flowpaths f ON f.from_nexus_id = w.node)", "JOIN flowpaths f ON f.from_nexus_id = w.node AND f.rank = 1 AND f.ef_type <> 2)") + ' SELECT a AS "from", b AS "to", least FROM dist', recursive=True))
def _(s, d):
    return P.distances(A.flowpaths(s, d), _pp(s), only_primary=True).drop("most")


@query("pp_updown_matrix", oracle(_DIST + ' SELECT a AS "from", b AS "to", 1 AS relation FROM dist UNION ALL SELECT b, a, -1 FROM dist', recursive=True))
def _(s, d):
    return P.relations(A.flowpaths(s, d), _pp(s))


_DRAINED = _CL + f", {_POINTS}, dr(point, catchment) AS (SELECT point, edge FROM point UNION SELECT dr.point, cl.src FROM dr JOIN cl ON cl.dst = dr.catchment), un(point, catchment) AS (SELECT point, edge FROM point UNION SELECT un.point, cl.src FROM un JOIN cl ON cl.dst = un.catchment AND cl.src NOT IN (SELECT edge FROM point))"


@query("pp_catchments", oracle(_DRAINED + " SELECT point, catchment FROM un", recursive=True))
def _(s, d):
    return P.unique_catchments(_owned(s, d), _pp(s))


@query("pp_shared_catchments", oracle(_DRAINED + " SELECT point, catchment FROM dr EXCEPT SELECT point, catchment FROM un", recursive=True))
def _(s, d):
    return P.shared_catchments(_owned(s, d), _pp(s))


@query("pp_containment", oracle(_DRAINED + ', c AS (SELECT p.point AS a, dr.point AS b FROM dr JOIN point p ON p.edge = dr.catchment WHERE p.point <> dr.point) SELECT a AS "from", b AS "to", -1 AS relation FROM c UNION ALL SELECT b, a, 1 FROM c', recursive=True))
def _(s, d):
    return P.containment(_owned(s, d), _pp(s))


@query("pp_unique_check", oracle(f", {_POINTS} SELECT edge, count(*) AS n FROM (SELECT edge FROM point UNION ALL SELECT 100) GROUP BY 1 HAVING count(*) > 1"))
def _(s, d):
    return P.crowded(_pp(s).union(s.createDataFrame([(1, 100)], "point long, edge long")))


# ---- raster

_N9 = ", n9 AS (SELECT a.r, a.c, " + ", ".join(f"max(CASE WHEN b.r - a.r = {dr} AND b.c - a.c = {dc} THEN b.z END) AS n{3 * (dr + 1) + dc + 1}" for dr in (-1, 0, 1) for dc in (-1, 0, 1)) + " FROM grid a JOIN grid b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 WHERE b.z IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 9)"
_SLOPE = _N9 + """, dxy AS (SELECT r, c, (n2 + 2 * n5 + n8) - (n0 + 2 * n3 + n6) AS dx, (n6 + 2 * n7 + n8) - (n0 + 2 * n1 + n2) AS dy FROM n9),
sl AS (SELECT r, c, round(degrees(atan(sqrt((dx / 800) * (dx / 800) + (dy / 800) * (dy / 800)))), 6) AS slope,
round(CASE WHEN dx = 0 AND dy = 0 THEN NULL WHEN degrees(atan2(dy / 8, -dx / 8)) < 0 THEN 90 - degrees(atan2(dy / 8, -dx / 8)) WHEN degrees(atan2(dy / 8, -dx / 8)) > 90 THEN 450 - degrees(atan2(dy / 8, -dx / 8)) ELSE 90 - degrees(atan2(dy / 8, -dx / 8)) END, 6) AS aspect FROM dxy),
ra AS (SELECT g.r, g.c, g.z, sl.slope, sl.aspect FROM grid g LEFT JOIN sl USING (r, c))"""
_CLASS = "CASE WHEN slope IS NULL THEN NULL WHEN slope < 3 OR aspect IS NULL THEN 'flat' WHEN aspect >= 315 OR aspect < 45 THEN 'N' WHEN aspect < 135 THEN 'E' WHEN aspect < 225 THEN 'S' ELSE 'W' END"


@query("ra_slope_aspect", oracle(_SLOPE + " SELECT * FROM ra"))
def _(s, d):
    return R.slope_aspect(A.grid(s, d), 100.0)


@query("ra_aspect_class", oracle(_SLOPE + f" SELECT {_CLASS} AS kind, count(*) AS n FROM ra GROUP BY 1"))
def _(s, d):
    g = R.slope_aspect(A.grid(s, d), 100.0)
    return g.groupBy(R.aspect_class(F.col("slope"), F.col("aspect")).alias("kind")).agg(F.count("*").alias("n"))


@query("ra_tile_grid", oracle("SELECT CAST(floor((c + 0.5) * 100 / 1024) AS BIGINT) AS tx, CAST(floor((r + 0.5) * 100 / 1024) AS BIGINT) AS ty, count(*) AS n FROM grid GROUP BY 1, 2"))
def _(s, d):
    return A.grid(s, d).groupBy(*R.tile_of((F.col("c") + 0.5) * 100, (F.col("r") + 0.5) * 100)).agg(F.count("*").alias("n"))


_ZONES = ", zones AS (SELECT k AS id, (k % 5) * 300.0::DOUBLE AS minx, (k // 5) * 900.0::DOUBLE AS miny, (k % 5) * 300.0::DOUBLE + 400 AS maxx, (k // 5) * 900.0::DOUBLE + 1000 AS maxy FROM range(0, 40) t(k))"


def _zones(s) -> DataFrame:
    x, y = (F.col("id") % 5) * 300.0, F.expr("id div 5") * 900.0
    return s.range(40).select("id", x.alias("minx"), y.alias("miny"), (x + 400).alias("maxx"), (y + 1000).alias("maxy"))


_ZONED = _SLOPE + _ZONES + ", zc AS (SELECT z.id, ra.* FROM zones z JOIN ra ON (c + 0.5) * 100 > minx AND (c + 0.5) * 100 < maxx AND (r + 0.5) * 100 > miny AND (r + 0.5) * 100 < maxy)"


@query("ra_zonal_assign", oracle(_ZONED + " SELECT id, r, c FROM zc"))
def _(s, d):
    return R.zone_cells(A.grid(s, d), _zones(s), 100.0, 500.0).select("id", "r", "c")


_SHARE = ", ".join(f"round(count(*) FILTER ({_CLASS} = '{k}') / nullif(count(slope), 0)::DOUBLE, 6) AS {n}" for k, n in (("N", "north_pct"), ("S", "south_pct"), ("E", "east_pct"), ("W", "west_pct"), ("flat", "flat_pct")))


@query("ra_zonal_stats", oracle(_ZONED + f" SELECT id, min(z) AS elv_min, max(z) AS elv_max, round(avg(z), 6) AS elv_mean, min(slope) AS slope_min, max(slope) AS slope_max, round(avg(slope), 6) AS slope_mean, {_SHARE} FROM zc GROUP BY 1"))
def _(s, d):
    return R.zonal_stats(R.zone_cells(R.slope_aspect(A.grid(s, d), 100.0), _zones(s), 100.0, 500.0))


@query("ra_fill_missing_zone", oracle(""", b AS (SELECT a.id, b.id AS other FROM catchments a JOIN catchments b ON a.id <> b.id AND ((a.maxx = b.minx OR a.minx = b.maxx) AND a.miny = b.miny OR (a.maxy = b.miny OR a.miny = b.maxy) AND a.minx = b.minx)),
st AS (SELECT id, CASE WHEN id % 9 <> 0 THEN elv_min END AS elv_min, CASE WHEN id % 9 <> 0 THEN elv_max END AS elv_max FROM catchments),
lent AS (SELECT b.id, arg_min(o.elv_min, b.other) AS a, arg_min(o.elv_max, b.other) AS z FROM b JOIN st o ON o.id = b.other WHERE o.elv_min IS NOT NULL GROUP BY 1)
SELECT s.id, coalesce(s.elv_min, l.a) AS elv_min, coalesce(s.elv_max, l.z) AS elv_max FROM st s LEFT JOIN lent l USING (id)"""))
def _(s, d):
    c = A.catchments(s, d)
    hide = lambda n: F.when(F.col("id") % 9 != 0, F.col(n)).alias(n)
    return R.fill_missing_zones(c.select("id", hide("elv_min"), hide("elv_max")), G.shared_borders(c))


@query("ra_distance_grid", oracle(_ZONES + " SELECT id, CAST(i AS DOUBLE) * 125 AS x, CAST(j AS DOUBLE) * 125 AS y FROM zones, range(-10, 200) a(i), range(-10, 200) b(j) WHERE i * 125 > minx AND i * 125 < maxx AND j * 125 > miny AND j * 125 < maxy"))
def _(s, d):
    return R.interior_points(_zones(s), 125.0)


_SEG = "greatest(0.0, least(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0)))"


# ---- spatial


@query("sp_bearing", oracle("SELECT id, round(atan2(sin(radians(x2 - x1)) * cos(radians(y2)), cos(radians(y1)) * sin(radians(y2)) - sin(radians(y1)) * cos(radians(y2)) * cos(radians(x2 - x1))), 6) AS bearing FROM lined"))
def _(s, d):
    return A.with_points(A.flowpaths(s, d)).select("id", F.round(G.bearing(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")), 6).alias("bearing"))


_BEAR = "atan2(sin(radians({x2} - {x1})) * cos(radians({y2})), cos(radians({y1})) * sin(radians({y2})) - sin(radians({y1})) * cos(radians({y2})) * cos(radians({x2} - {x1})))"
_BA, _BB = (_BEAR.format(**{k: f"{t}.{k}" for k in ("x1", "x2", "y1", "y2")}) for t in ("a", "b"))


@query("sp_angle", oracle(f"SELECT a.id, b.id AS next, round(CASE WHEN abs({_BA} - {_BB}) > pi() THEN 2 * pi() - abs({_BA} - {_BB}) ELSE abs({_BA} - {_BB}) END, 6) AS angle FROM lined a JOIN lined b ON a.to_nexus_id = b.from_nexus_id"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d)).withColumn("b", G.bearing(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")))
    a = p.select("id", F.col("to_nexus_id").alias("n"), F.col("b").alias("ba"))
    b = p.select(F.col("id").alias("next"), F.col("from_nexus_id").alias("n"), F.col("b").alias("bb"))
    return a.join(b, "n").select("id", "next", F.round(G.angle_between(F.col("ba"), F.col("bb")), 6).alias("angle"))


@query("sp_distance", oracle(f"SELECT l.id, round(sqrt(pow(p.x - (x1 + {_SEG} * (x2 - x1)), 2) + pow(p.y - (y1 + {_SEG} * (y2 - y1)), 2)), 6) AS distance FROM lined l, (SELECT 12.5::DOUBLE AS x, -7.25::DOUBLE AS y) p WHERE x1 <> x2 OR y1 <> y2"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d)).filter("x1 <> x2 OR y1 <> y2")
    return p.select("id", F.round(G.segment_distance(F.lit(12.5), F.lit(-7.25), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")), 6).alias("distance"))


def _ring() -> object:
    return F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny"))])


@query("sp_length", oracle("SELECT id, CAST(40 AS DOUBLE) AS length, CAST(100 AS DOUBLE) AS area FROM catchments"))
def _(s, d):
    return A.catchments(s, d).select("id", G.line_length(_ring()).alias("length"), G.ring_area(_ring()).alias("area"))


@query("sp_reproject", oracle(f"SELECT id, round(x1 * {_EDGE}::DOUBLE / 180, 2) AS x, round(ln(tan(radians(y1) / 2 + pi() / 4)) * {_EDGE}::DOUBLE / pi(), 2) + 0.0::DOUBLE AS y, round(x1, 6) AS lon, round(y1, 6) AS lat FROM lined"))
def _(s, d):
    x, y = G.to_mercator(F.col("x1"), F.col("y1"))
    lon, lat = G.from_mercator(x, y)
    return A.with_points(A.flowpaths(s, d)).select("id", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query("sp_precision", oracle("SELECT id, round(x1 / 7 * 1e8) / 1e8 AS x FROM lined"))
def _(s, d):
    return A.with_points(A.flowpaths(s, d)).select("id", G.snapped(F.col("x1") / 7).alias("x"))


@query("sp_dissolve", oracle(", s AS (SELECT ec_subtype, unnest([{'a': minx, 'b': miny, 'c': maxx, 'd': miny}, {'a': minx, 'b': maxy, 'c': maxx, 'd': maxy}, {'a': minx, 'b': miny, 'c': minx, 'd': maxy}, {'a': maxx, 'b': miny, 'c': maxx, 'd': maxy}]) AS s FROM catchments), o AS (SELECT ec_subtype, s FROM s GROUP BY 1, 2 HAVING count(*) % 2 = 1) SELECT ec_subtype, count(*) AS segments, sum(s.c - s.a + s.d - s.b) AS outline FROM o GROUP BY 1"))
def _(s, d):
    return G.dissolve(A.catchments(s, d), "ec_subtype")


@query("sp_knn_kdtree", oracle(", d AS (SELECT a.id, b.id AS target, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance FROM points a JOIN points b ON a.id % 20 = 0) SELECT id, target, round(distance, 6) AS distance, row_number() OVER (PARTITION BY id ORDER BY distance, target) AS place FROM d WHERE distance < 30 QUALIFY place <= 5"))
def _(s, d):
    p = A.points(s, d)
    return G.nearest(p.filter("id % 20 = 0"), p, 5, 30.0, inclusive=False).select("id", "target", F.round("distance", 6).alias("distance"), "place")


# ---- sinks


@query("snk_flip_edges", oracle("SELECT id, CASE WHEN id % 10 = 0 THEN to_nexus_id ELSE from_nexus_id END AS from_nexus_id, CASE WHEN id % 10 = 0 THEN from_nexus_id ELSE to_nexus_id END AS to_nexus_id, CASE WHEN id % 5 = 0 THEN 1 ELSE -1 END AS direction_known FROM flowpaths"))
def _(s, d):
    p = A.flowpaths(s, d).withColumn("direction_known", F.lit(-1))
    return S.flipped(p, p.filter("id % 10 = 0").select("id"), p.filter("id % 5 = 0").select("id"))


@query("snk_write_ranks", oracle("SELECT id, CASE WHEN id % 6 = 0 THEN 2 ELSE rank END AS rank FROM flowpaths"))
def _(s, d):
    p = A.flowpaths(s, d).select("id", "rank")
    return S.updated(p, p.filter("id % 6 = 0").select("id", F.lit(2).alias("rank")), "id", "rank")


@query("snk_remove_skeletons", oracle("SELECT id FROM flowpaths WHERE ef_type NOT IN (2, 3)"))
def _(s, d):
    return A.flowpaths(s, d).filter(~Q.type_in("ef_type", [2, 3])).select("id")


@query("snk_add_internal_id", oracle("SELECT CASE WHEN id % 3 = 0 THEN sha256(CAST(from_nexus_id AS VARCHAR) || chr(1) || CAST(to_nexus_id AS VARCHAR)) ELSE CAST(id AS VARCHAR) END AS internal_id, from_nexus_id, to_nexus_id FROM flowpaths WHERE rank = 1"))
def _(s, d):
    p = A.flowpaths(s, d).filter("rank = 1").select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("internal_id"), "from_nexus_id", "to_nexus_id")
    return S.with_internal_ids(p, "internal_id", "from_nexus_id", "to_nexus_id")


@query("snk_names_table", oracle("SELECT DISTINCT name_id, name FROM (SELECT name_id, name_en AS name FROM names UNION ALL SELECT name_id, name_fr FROM names) WHERE name IS NOT NULL AND name <> ''"))
def _(s, d):
    return Q.name_table([(A.names(s, d), [("name_id", "name_en"), ("name_id", "name_fr")])])


# ---- construction


@query("agg_tin_area", oracle(", q AS (SELECT a.z AS a, b.z AS b, d.z AS d, e.z AS e FROM grid a JOIN grid b ON b.r = a.r AND b.c = a.c + 1 JOIN grid d ON d.r = a.r + 1 AND d.c = a.c JOIN grid e ON e.r = a.r + 1 AND e.c = a.c + 1 WHERE a.z + b.z + d.z + e.z IS NOT NULL) SELECT sum(10000::DOUBLE) AS flat, round(sum(50 * sqrt(pow(b - a, 2) + pow(d - a, 2) + 10000) + 50 * sqrt(pow(d - e, 2) + pow(b - e, 2) + 10000)), 3) AS surface FROM q"))
def _(s, d):
    return C.surface_area(A.grid(s, d), 100.0)


_SIDES = "unnest([{'x1': minx, 'y1': miny, 'x2': maxx, 'y2': miny}, {'x1': minx, 'y1': maxy, 'x2': maxx, 'y2': maxy}, {'x1': minx, 'y1': miny, 'x2': minx, 'y2': maxy}, {'x1': maxx, 'y1': miny, 'x2': maxx, 'y2': maxy}]) AS s"


@query("sp_segment_crosses", oracle(f""", a AS (SELECT id, x + 600 AS x1, y + 60 AS y1, x + 600.5 + id % 23 AS x2, y + 60.25 + id % 17 AS y2 FROM points),
e AS (SELECT id AS other, s.x1 AS u1, s.y1 AS v1, s.x2 AS u2, s.y2 AS v2 FROM (SELECT id, {_SIDES} FROM catchments)),
t AS (SELECT a.id, e.other, sign((x2 - x1) * (v1 - y1) - (y2 - y1) * (u1 - x1)) * sign((x2 - x1) * (v2 - y1) - (y2 - y1) * (u2 - x1)) AS p, sign((u2 - u1) * (y1 - v1) - (v2 - v1) * (x1 - u1)) * sign((u2 - u1) * (y2 - v1) - (v2 - v1) * (x2 - u1)) AS q
FROM a JOIN e ON least(x1, x2) <= u2 AND greatest(x1, x2) >= u1 AND least(y1, y2) <= v2 AND greatest(y1, y2) >= v1) SELECT id, other, count(*) AS n FROM t WHERE p < 0 AND q < 0 GROUP BY 1, 2"""))
def _(s, d):
    x, y, k = F.col("x") + 600, F.col("y") + 60, F.col("id")
    lines = A.points(s, d).select("id", x.alias("x1"), y.alias("y1"), (x + 0.5 + k % 23).alias("x2"), (y + 0.25 + k % 17).alias("y2"))
    return C.crossings(lines, C.box_sides(A.catchments(s, d)), 20.0).groupBy("id", "other").agg(F.count("*").alias("n"))


_WAY = "sqrt(pow(x - (x1 + coalesce(" + _SEG + ", 0) * (x2 - x1)), 2) + pow(y - (y1 + coalesce(" + _SEG + ", 0) * (y2 - y1)), 2))"
_NEAR = ", l AS (SELECT id AS line, x1, y1, x2, y2 FROM lined WHERE rank = 1), pt AS (SELECT id, x / 3 AS x, y / 3 AS y FROM points), dd AS (SELECT pt.id, l.line, " + _WAY + " AS d FROM pt, l)"


def _near_inputs(s, d) -> tuple[DataFrame, DataFrame]:
    lines = A.with_points(A.flowpaths(s, d)).filter("rank = 1")
    return A.points(s, d).select("id", (F.col("x") / 3).alias("x"), (F.col("y") / 3).alias("y")), lines


@query("sp_proximity_filter", oracle(_NEAR + " SELECT id, x, y FROM pt WHERE id NOT IN (SELECT id FROM dd WHERE d < 2)"))
def _(s, d):
    return C.far_points(*_near_inputs(s, d), 2.0, 10.0)


@query("g_flow_from_point", oracle(""", pt AS (SELECT id, x / 3 AS x, y / 3 AS y FROM points),
ins AS (SELECT pt.id, any_value(x) AS x, any_value(y) AS y, min(c.id) AS box FROM pt LEFT JOIN catchments c ON x > minx AND x < maxx AND y > miny AND y < maxy GROUP BY 1),
own AS (SELECT from_nexus_id AS box, id AS line, x1, y1, x2, y2 FROM lined),
dd AS (SELECT ins.id, line, """ + _WAY + """ AS d, true AS inside FROM ins JOIN own USING (box) UNION ALL SELECT ins.id, l.id, """ + _WAY + """, false FROM ins, lined l WHERE box IS NULL)
SELECT id, arg_min(line, (round(d, 6), line)) AS line, min(round(d, 6)) AS distance FROM dd WHERE inside OR round(d, 6) <= 1 GROUP BY 1"""))
def _(s, d):
    p, _ = _near_inputs(s, d)
    paths, c = A.with_points(_owned(s, d)), A.catchments(s, d)
    banks = c.filter("ec_type = 2").select("id", F.col("id").alias("nexus"))
    return C.flow_from_point(p, c, paths, banks, 10.0, 1.0)


@query("win_angle_order", oracle(", o AS (SELECT from_nexus_id AS node, atan2(y2 - y1, x2 - x1) AS o FROM lined WHERE rank = 1), i AS (SELECT to_nexus_id AS node, id, atan2(y1 - y2, x1 - x2) AS i FROM lined) SELECT node, id, row_number() OVER (PARTITION BY node ORDER BY round(CASE WHEN o - i < 0 THEN o - i + 2 * pi() ELSE o - i END, 9), id)::INT AS place FROM i JOIN o USING (node)"))
def _(s, d):
    return C.inflow_order(A.with_points(A.flowpaths(s, d)))


@query("g_multi_sink_join", oracle("SELECT CAST(5000000000 + n AS BIGINT) AS id, n AS from_nexus_id, -8 - 1 AS to_nexus_id FROM (SELECT DISTINCT to_nexus_id AS n FROM flowpaths WHERE to_nexus_id BETWEEN 8 AND 11)"))
def _(s, d):
    p = A.flowpaths(s, d).filter("rank = 1").select("from_nexus_id", "to_nexus_id")
    tied = p.union(s.createDataFrame([(8, 9), (9, 10), (10, 11)], "a long, b long"))
    return C.joined_sinks(tied, s.range(8, 16), 5_000_000_000)


@query("sp_simplify", oracle("SELECT id, [minx, maxx, maxx, minx, minx] AS xs, [miny, miny, maxy, maxy, miny] AS ys FROM catchments"))
def _(s, d):
    mid = lambda a, b: (F.col(a) + F.col(b)) / 2
    c = A.catchments(s, d).select("id", F.array("minx", mid("minx", "maxx"), "maxx", "maxx", "minx", "minx").alias("xs"), F.array("miny", "miny", "miny", "maxy", "maxy", "miny").alias("ys"))
    return C.simplified(c, 0.5)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way down from the farthest headwater, with type, rank and river names."""
    paths = A.flowpaths(spark, sf_dir)
    way = N.trace(paths.filter("rank = 1"), paths.filter("rank = 1").agg(F.max("id").alias("id")))
    return Q.with_lookups(paths, A.names(spark, sf_dir), A.aois(spark, sf_dir)).join(way, "id").orderBy("hop").limit(Q.MAX_RESULTS)

