"""Registered queries of writers, formats, scalar functions and tabular reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg import adapter as A
from thalweg.adapter import oracle
from thalweg.functions import text as texts
from thalweg.operators import network as N
from thalweg.operators import outputs as O
from thalweg.operators import pourpoints as P
from thalweg.operators import relational as Q
from thalweg.operators import sinks as S
from thalweg.operators import spatial as G
from thalweg.plans.hydro_queries import _DIST, _ORDER_ROWS, _POINTS, _orders_sql, _pp
from thalweg.plans.registry import query
from thalweg.session import stage_table

# ---- writers


@query("snk_prepare_output", oracle(" SELECT 'flowpath' AS layer, id FROM flowpaths UNION ALL SELECT 'catchment', id FROM catchments"))
def _(s, d):
    made = O.prepared({"flowpath": A.flowpaths(s, d), "catchment": A.catchments(s, d)})
    return made["flowpath"].select(F.lit("flowpath").alias("layer"), "id").union(made["catchment"].select(F.lit("catchment"), "id"))


@query("snk_write_names", oracle(" SELECT id, CASE WHEN id % 4 = 0 THEN id % 7 ELSE rivernameid1 END AS rivernameid1, CASE WHEN id % 8 = 0 THEN id % 5 ELSE rivernameid2 END AS rivernameid2 FROM flowpaths"))
def _(s, d):
    p = A.flowpaths(s, d).select("id", "rivernameid1", "rivernameid2")
    named = p.filter("id % 4 = 0").select("id", (F.col("id") % 7).alias("rivernameid1"), F.when(F.col("id") % 8 == 0, F.col("id") % 5).alias("rivernameid2"))
    return S.updated(p, named, "id", "rivernameid1", "rivernameid2")


def _skeletons(s, d) -> DataFrame:
    water = A.catchments(s, d).filter("ec_type = 4")
    return water.select((F.col("id") + 2 * 10**9).alias("id"), F.col("id").alias("from_nexus_id"), F.expr("id div 2").alias("to_nexus_id"), F.lit(3).alias("ef_type"), F.lit("extra").alias("not_there"))


@query("snk_write_skeletons", oracle(" SELECT id, from_nexus_id, to_nexus_id, ef_type, length FROM flowpaths UNION ALL SELECT id + 2000000000, id, id // 2, 3, NULL FROM catchments WHERE ec_type = 4"))
def _(s, d):
    return O.appended(A.flowpaths(s, d).select("id", "from_nexus_id", "to_nexus_id", "ef_type", "length"), _skeletons(s, d))


_CONSTRUCTION = ", cp AS (SELECT l_orderkey AS catchment_id, l_linenumber AS point, CASE WHEN l_returnflag = 'R' THEN 'OUTPUT' ELSE 'INPUT' END AS direction FROM lineitem)"


def _construction(s, d) -> DataFrame:
    direction = F.when(F.col("l_returnflag") == "R", "OUTPUT").otherwise("INPUT")
    return A.table(s, d, "lineitem").select(F.col("l_orderkey").alias("catchment_id"), F.col("l_linenumber").alias("point"), direction.alias("direction"))


@query("snk_write_construction_points", oracle(_CONSTRUCTION + " SELECT * FROM cp WHERE catchment_id % 9 <> 0 UNION ALL SELECT id, 99, 'INPUT' FROM catchments WHERE id % 9 = 0"))
def _(s, d):
    new = A.catchments(s, d).filter("id % 9 = 0").select(F.col("id").alias("catchment_id"), F.lit(99).alias("point"), F.lit("INPUT").alias("direction"))
    return O.replaced(_construction(s, d), new, "catchment_id")


@query("src_construction_points", oracle(_CONSTRUCTION + " SELECT catchment_id, list_sort(list(DISTINCT point) FILTER (direction = 'OUTPUT')) AS outputs, count(*) AS n FROM cp GROUP BY 1"))
def _(s, d):
    p = _construction(s, d)
    out = F.array_sort(F.collect_set(F.when(F.col("direction") == "OUTPUT", F.col("point"))))
    return p.groupBy("catchment_id").agg(F.when(F.size(out) > 0, out).alias("outputs"), F.count("*").alias("n"))


@query("snk_update_polygons", oracle(" SELECT id, CASE WHEN id % 5 = 0 THEN [minx + 1, maxx + 1, maxx + 1, minx + 1, minx + 1] ELSE [minx, maxx, maxx, minx, minx] END AS xs, [miny, miny, maxy, maxy, miny] AS ys FROM catchments"))
def _(s, d):
    c = A.catchments(s, d)
    xs, ys = F.array("minx", "maxx", "maxx", "minx", "minx"), F.array("miny", "miny", "maxy", "maxy", "miny")
    changed = c.filter("id % 5 = 0").select("id", F.transform(xs, lambda x: x + 1).alias("xs"))
    return S.updated(c.select("id", xs.alias("xs"), ys.alias("ys")), changed, "id", "xs")


@query("snk_write_catchments", oracle(" SELECT id, ec_type, area FROM catchments WHERE ec_type NOT IN (1, 2) UNION ALL SELECT from_nexus_id + 3000000000, 1, length FROM flowpaths WHERE rank = 1 AND ef_type = 1"))
def _(s, d):
    new = A.flowpaths(s, d).filter("rank = 1 AND ef_type = 1").select((F.col("from_nexus_id") + 3_000_000_000).alias("id"), F.lit(1).alias("ec_type"), F.col("length").alias("area"))
    return O.new_catchments(A.catchments(s, d).select("id", "ec_type", "area"), new)


@query("snk_write_blocks", oracle(" SELECT CAST(floor(minx / 250) AS BIGINT) AS bx, CAST(floor(miny / 250) AS BIGINT) AS \"by\", count(*) AS n, sum(area)::BIGINT AS area FROM catchments WHERE floor(minx / 250) >= 1 GROUP BY 1, 2"))
def _(s, d):
    made = O.by_block(A.catchments(s, d).select("id", "area", "minx", "miny"), 250.0)
    return made.filter("bx >= 1").groupBy("bx", "by").agg(F.count("*").alias("n"), F.sum("area").alias("area"))


@query("snk_update_block", oracle(", b AS (SELECT CAST(floor(minx / 250) AS BIGINT) AS bx, CAST(floor(miny / 250) AS BIGINT) AS byy, count(*) FILTER (ec_type = 4) AS water FROM catchments GROUP BY 1, 2) SELECT bx || '_' || byy AS block, CASE WHEN bx % 3 = 0 THEN 'READY' WHEN water > 90 THEN 'FAILEDQA' ELSE 'COMPLETE' END AS state, CASE WHEN bx % 3 <> 0 AND water > 90 THEN water || ' waterbodies' END AS message FROM b"))
def _(s, d):
    b = A.catchments(s, d).groupBy(F.floor(F.col("minx") / 250).alias("bx"), F.floor(F.col("miny") / 250).alias("by")).agg(F.count_if(F.col("ec_type") == 4).alias("water"))
    b = b.withColumn("block", F.concat_ws("_", "bx", "by"))
    failed = F.col("water") > 90
    done = b.filter("bx % 3 <> 0").select("block", F.when(failed, "FAILEDQA").otherwise("COMPLETE").alias("state"), F.when(failed, F.concat("water", F.lit(" waterbodies"))).alias("message"))
    return O.block_states(b.select("block", F.lit("READY").alias("state"), F.lit(None).cast("string").alias("message")), done)


@query("snk_order_table", oracle(_orders_sql(False) + _ORDER_ROWS))
def _(s, d):
    return stage_table(N.stream_orders(A.flowpaths(s, d)).drop("component"), "order-table")


@query("snk_stats_writer", oracle(" SELECT c.id, c.area, s.n AS elv_max, s.n % 7 AS slope_max FROM catchments c LEFT JOIN (SELECT to_nexus_id AS id, count(*) AS n FROM flowpaths GROUP BY 1) s USING (id)"))
def _(s, d):
    stats = A.flowpaths(s, d).groupBy(F.col("to_nexus_id").alias("id")).agg(F.count("*").alias("elv_max")).withColumn("slope_max", F.col("elv_max") % 7)
    return O.with_stats(A.catchments(s, d).select("id", "area", "elv_max", "slope_max"), stats, ["elv_max", "slope_max"])


@query("snk_error_log", oracle(", t AS (SELECT id, count(*) AS n, sum(o) AS o, any_value(x) AS x, any_value(y) AS y FROM (SELECT from_nexus_id AS id, 1 AS o, x1 AS x, y1 AS y FROM lined UNION ALL SELECT to_nexus_id, 0, x2, y2 FROM lined) GROUP BY 1) SELECT 'DIRECTION' AS process, 'ERROR' AS type, 'node ' || id || ': all flows arrive' AS message, x, y FROM t WHERE n > 1 AND o = 0 UNION ALL SELECT 'DIRECTION', 'WARNING', 'node ' || id || ': ' || o || ' flows leave', x, y FROM t WHERE o > 1"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d))
    end = lambda c, o, i: p.select(F.col(c).alias("id"), F.lit(o).alias("o"), F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y"))
    t = end("from_nexus_id", 1, 1).union(end("to_nexus_id", 0, 2)).groupBy("id").agg(F.count("*").alias("n"), F.sum("o").alias("o"), F.any_value("x").alias("x"), F.any_value("y").alias("y"))
    node = F.concat(F.lit("node "), F.col("id").cast("string"))
    return O.error_log("DIRECTION", [
        ("ERROR", t, F.concat(node, F.lit(": all flows arrive")), (F.col("n") > 1) & (F.col("o") == 0)),
        ("WARNING", t, F.concat(node, F.lit(": "), F.col("o").cast("string"), F.lit(" flows leave")), F.col("o") > 1),
    ])


_CACHE = "c AS (SELECT event_id AS key, event_type AS tile, ts AS last_accessed FROM events)"
_NOW = "TIMESTAMP '2030-01-01 00:00:00'"


@query("snk_tile_cache", f"WITH {_CACHE} SELECT key, CASE WHEN key % 5 = 0 THEN 'new' ELSE tile END AS tile, CASE WHEN key % 5 = 0 OR key % 3 = 0 THEN {_NOW} ELSE last_accessed END AS last_accessed FROM c WHERE key % 7 <> 0 UNION ALL SELECT -1, 'new', {_NOW}")
def _(s, d):
    cache = A.table(s, d, "events").select(F.col("event_id").alias("key"), F.col("event_type").alias("tile"), F.col("ts").alias("last_accessed"))
    now = F.expr(_NOW).cast(dict(cache.dtypes)["last_accessed"])
    touched = O.tiles_touched(cache, cache.filter("key % 3 = 0").select("key"), now)
    new = cache.filter("key % 5 = 0").select("key").union(s.createDataFrame([(-1,)], "key long")).withColumn("tile", F.lit("new"))
    return O.tiles_removed(O.tiles_set(touched, new, now), cache.filter("key % 7 = 0"))


@query("snk_tile_cache_get", f"WITH {_CACHE}, k AS (SELECT DISTINCT user_id AS key FROM events) SELECT k.key, c.key IS NOT NULL AS found, c.tile FROM k LEFT JOIN c USING (key)")
def _(s, d):
    e = A.table(s, d, "events")
    return O.tiles_found(e.select(F.col("event_id").alias("key"), F.col("event_type").alias("tile")), e.select(F.col("user_id").alias("key")))


# ---- formats

_FIELDS = """ '{"id":' || id || ',"type":"' || CASE ef_type WHEN 1 THEN 'Reach' WHEN 2 THEN 'Bank' WHEN 3 THEN 'Skeleton' ELSE 'Infrastructure' END || '","length":' || length || CASE WHEN rivernameid1 IS NULL THEN '' ELSE ',"name":' || rivernameid1 END || '}'"""


def _fields() -> dict:
    return {"id": F.col("id"), "type": Q.decode(F.col("ef_type"), Q.EF_TYPES), "length": F.col("length"), "name": F.col("rivernameid1")}


@query("snk_old_formats", oracle(f" SELECT id, {_FIELDS} AS json, 'show(' || {_FIELDS} || ');' AS jsonp, '<table><caption>Flowpath &lt;' || id || '&gt;</caption><tr><td>type</td><td>' || CASE ef_type WHEN 1 THEN 'Reach' WHEN 2 THEN 'Bank' WHEN 3 THEN 'Skeleton' ELSE 'Infrastructure' END || '</td></tr><tr><td>name</td><td>' || coalesce(rivernameid1 || '', '') || '</td></tr></table>' AS html FROM flowpaths"))
def _(s, d):
    json, f = O.json_text(_fields()), _fields()
    html = O.html_rows(F.concat(F.lit("Flowpath <"), F.col("id").cast("string"), F.lit(">")), {"type": f["type"], "name": f["name"]})
    return A.flowpaths(s, d).select("id", json.alias("json"), O.jsonp_text("show", json).alias("jsonp"), html.alias("html"))


_SEVEN = (20, 41, 83, 90, 100, 200, 401)


@query("snk_pourpoint_formats", oracle(_DIST + ", m AS (SELECT a, b, 1 AS r FROM dist UNION ALL SELECT b, a, -1 FROM dist) SELECT p.point, '[" + ",".join(map(str, _SEVEN)) + "]' AS headers, '[' || " + " || ',' || ".join(f"coalesce(max(CASE WHEN m.b = {k} THEN m.r END) || '', 'null')" for k in _SEVEN) + " || ']' AS row FROM point p LEFT JOIN m ON m.a = p.point GROUP BY 1", recursive=True))
def _(s, d):
    return O.matrix_rows(P.relations(A.flowpaths(s, d), _pp(s)), list(_SEVEN), "relation")


_COORD = "CASE WHEN {c} = 0 THEN '0.0' ELSE CAST({c} AS VARCHAR) END"


@query("snk_geojson", oracle(" SELECT id, 'Feature' AS type, CAST(id AS VARCHAR) AS fid, [[x1, y1], [x2, y2]] AS coordinates, 'flowpath' AS feature_type, rank, length, rivernameid1 FROM lined"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d))
    line = S.line_geometry(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    text = S.geojson_feature(F.lit("flowpath"), F.col("id"), {"rank": F.col("rank"), "length": F.col("length"), "rivernameid1": F.col("rivernameid1")}, line)
    schema = "type string, id string, geometry struct<type string, coordinates array<array<double>>>, properties struct<feature_type string, rank int, length long, rivernameid1 long>"
    f = p.select("id", F.from_json(text, schema).alias("f")).filter("f.geometry.type = 'LineString'")
    return f.select("id", "f.type", F.col("f.id").alias("fid"), "f.geometry.coordinates", "f.properties.feature_type", "f.properties.rank", "f.properties.length", "f.properties.rivernameid1")


# ---- scalar functions


@query("fn_text", "SELECT p_partkey AS id, replace(replace(replace(p_name, '\\', '\\\\'), '%', '\\%'), '_', '\\_') AS escaped, upper(p_brand) AS area, trim(p_name) = '' OR p_name IS NULL AS blank, replace('a;' || p_type, ';', chr(10)) AS lines FROM part")
def _(s, d):
    escaped = F.col("p_name")
    for mark in ("\\", "%", "_"):
        escaped = F.replace(escaped, F.lit(mark), F.lit("\\" + mark))
    blank = F.coalesce(F.trim("p_name") == "", F.lit(True))
    return A.table(s, d, "part").select(F.col("p_partkey").alias("id"), escaped.alias("escaped"), F.upper("p_brand").alias("area"), blank.alias("blank"), F.replace(F.concat(F.lit("a;"), "p_type"), F.lit(";"), F.lit("\n")).alias("lines"))


@query("fn_points", "SELECT p_partkey AS id, 'P' || p_partkey AS point, CAST(p_size AS DOUBLE) / 2 AS x, CAST(-p_size AS DOUBLE) AS y, CAST(p_size % 10 AS INT) AS c FROM part UNION ALL SELECT p_partkey, 'Q', 1.5, 2.0, -1 FROM part")
def _(s, d):
    half = F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit(", "), (F.col("p_size") / 2).cast("string"), F.lit(","), (-F.col("p_size")).cast("string"), F.lit(","), (F.col("p_size") % 10).cast("string"), F.lit(",Q,1.5,2,-1"))
    return A.table(s, d, "part").select(F.col("p_partkey").alias("id"), F.explode(texts.parsed_points(half)).alias("p")).select("id", F.col("p.id").alias("point"), "p.x", "p.y", "p.c")


_MD5 = "md5(CAST(o_orderkey AS VARCHAR))"
_DASHED = " || '-' || ".join(f"substr({_MD5}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


@query("fn_uuid", f"SELECT o_orderkey AS id, {_DASHED} AS parsed, o_orderkey % 2 = 0 AS proper FROM orders")
def _(s, d):
    bare = F.md5(F.col("o_orderkey").cast("string").cast("binary"))
    dashed = texts.parsed_uuid(bare)
    text = F.when(F.col("o_orderkey") % 2 == 0, F.upper(dashed)).otherwise(bare)
    return A.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), texts.parsed_uuid(text).alias("parsed"), texts.is_uuid(text).alias("proper"))


@query("fn_date", "SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, date_trunc('day', ts)::TIMESTAMP AS day FROM events")
def _(s, d):
    ts = F.col("ts").cast("timestamp_ntz")
    return A.table(s, d, "events").select(F.col("event_id").alias("id"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.date_trunc("day", ts).cast("timestamp_ntz").alias("day"))


@query("fn_map", oracle(" SELECT id, elv_min AS low, elv_max - elv_min AS span, CAST(CASE WHEN elv_min IS NULL THEN 0 ELSE 3 END AS INT) AS n FROM catchments"))
def _(s, d):
    keys = ("elv_min", "elv_max", "slope_min")
    stats = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*[F.col(k) for k in keys])), lambda _, v: v.isNotNull())
    m = A.catchments(s, d).select("id", stats.alias("m"))
    at = lambda k: F.try_element_at("m", F.lit(k))
    return m.select("id", at("elv_min").alias("low"), (at("elv_max") - at("elv_min")).alias("span"), F.size("m").alias("n"))


@query("fn_json", oracle(" SELECT id, rank, length FROM flowpaths WHERE rivernameid1 IS NOT NULL"))
def _(s, d):
    text = A.flowpaths(s, d).select("id", O.json_text({"rank": F.col("rank"), "length": F.col("length"), "name": F.col("rivernameid1")}).alias("j"))
    return text.select("id", F.from_json("j", "rank int, length long, name long").alias("v")).filter("v.name IS NOT NULL").select("id", "v.rank", "v.length")


# ---- sources and guards


@query("src_schema_probe", oracle(" SELECT id, length AS \"Length\", NULL::VARCHAR AS nid FROM flowpaths"))
def _(s, d):
    p = A.flowpaths(s, d).withColumnRenamed("id", "ID")
    return texts.resolved(p, ["id", "Length", "nid"], ["nid"])


@query("flt_bbox_param", oracle(" SELECT id FROM lined WHERE least(x1, x2) <= 20.5 AND greatest(x1, x2) >= -20 AND least(y1, y2) <= 10 AND greatest(y1, y2) >= -10.25"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d)).select("id", F.least("x1", "x2").alias("minx"), F.least("y1", "y2").alias("miny"), F.greatest("x1", "x2").alias("maxx"), F.greatest("y1", "y2").alias("maxy"))
    return p.filter(Q.bbox_intersects(*texts.parsed_bounds("20.5, 10, -20,-10.25"))).select("id")


_VIEW = "f.id, f.ef_type, f.ef_subtype, f.rank, f.length, f.rivernameid1, f.rivernameid2, f.aoi_id, f.from_nexus_id, f.to_nexus_id"


@query("prj_order_view", oracle(_orders_sql(False) + f" SELECT {_VIEW}, 'N' || f.id AS nid, f.from_nexus_id AS ecatchment_id, w.ms::BIGINT AS mainstem_id, w.seq::BIGINT AS mainstem_seq, w.up::BIGINT AS max_uplength, w.s::BIGINT AS strahler_order, w.hack::BIGINT AS hack_order, w.ho::BIGINT AS horton_order, w.sh AS shreve_order, [[f.x1, f.y1], [f.x2, f.y2]] AS geometry FROM lined f LEFT JOIN p ON p.id = f.id LEFT JOIN w ON w.node = p.f"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d))
    geometry = F.array(F.array("x1", "y1"), F.array("x2", "y2"))
    kept = [c.strip()[2:] for c in _VIEW.split(",")]
    shaped = p.select(*kept, F.concat(F.lit("N"), F.col("id").cast("string")).alias("nid"), F.col("from_nexus_id").alias("ecatchment_id"), geometry.alias("geometry"))
    o = N.stream_orders(p).select("id", F.col("mainstem").alias("mainstem_id"), "mainstem_seq", "max_uplength", F.col("strahler").alias("strahler_order"), F.col("hack").alias("hack_order"), F.col("horton").alias("horton_order"), F.col("shreve").alias("shreve_order"))
    return Q.order_view(shaped, o)


# ---- aggregates and orders


@query("agg_max_order_per_waterbody", oracle(_orders_sql(False) + " SELECT c.id, max(w.s)::BIGINT AS strahler FROM catchments c LEFT JOIN flowpaths x ON x.from_nexus_id = c.id LEFT JOIN p ON p.id = x.id LEFT JOIN w ON w.node = p.f WHERE c.ec_type = 4 GROUP BY 1"))
def _(s, d):
    p = A.flowpaths(s, d)
    o = p.select("id", F.col("from_nexus_id").alias("ecatchment_id")).join(N.stream_orders(p), "id")
    return Q.most_order(A.catchments(s, d).filter("ec_type = 4"), o)


@query("agg_best_rank", oracle(" SELECT c.id, min(CASE WHEN f.id % 3 = 0 THEN NULL ELSE f.rank END) AS rank FROM catchments c LEFT JOIN flowpaths f ON f.from_nexus_id = c.id GROUP BY 1"))
def _(s, d):
    p = A.flowpaths(s, d).select(F.col("from_nexus_id").alias("ecatchment_id"), F.when(F.col("id") % 3 == 0, "UNKNOWN").otherwise(F.upper(Q.decode(F.col("rank"), Q.RANKS))).alias("rank"))
    return Q.best_rank(A.catchments(s, d), p)


@query("srt_by_id", oracle(" SELECT id, row_number() OVER (ORDER BY id DESC) AS place FROM (SELECT id FROM flowpaths ORDER BY id DESC LIMIT 5000)"))
def _(s, d):
    return Q.first_places(A.flowpaths(s, d).select("id"), [F.col("id").desc()], 5000)


@query("srt_by_area", oracle(" SELECT id, area, row_number() OVER (ORDER BY area DESC, id) AS place FROM (SELECT id, area FROM catchments ORDER BY area DESC, id LIMIT 5000)"))
def _(s, d):
    return Q.first_places(A.catchments(s, d).select("id", "area"), [F.col("area").desc(), F.col("id")], 5000)


@query("srt_by_pathdistance", oracle(", r(id, distance) AS (SELECT o_orderkey, 0::BIGINT FROM orders WHERE o_orderkey BETWEEN 8 AND 15 UNION ALL SELECT f.from_nexus_id, r.distance + f.length FROM r JOIN flowpaths f ON f.to_nexus_id = r.id AND f.rank = 1) SELECT id, distance, row_number() OVER (ORDER BY distance, id) AS place FROM (SELECT id, distance FROM r ORDER BY distance, id LIMIT 5000)", recursive=True))
def _(s, d):
    links = A.flowpaths(s, d).filter("rank = 1").select(F.col("from_nexus_id").alias("src"), F.col("to_nexus_id").alias("dst"), "length")
    return Q.first_places(N.shortest_distances(links, s.range(8, 16)), [F.col("distance"), F.col("id")], 5000)


_SETS = ", a AS (SELECT to_nexus_id AS id, list_sort(list(DISTINCT ef_type)) AS s FROM flowpaths GROUP BY 1), b AS (SELECT from_nexus_id AS id, list_sort(list(DISTINCT ef_type)) AS s FROM flowpaths GROUP BY 1)"


@query("set_equal", oracle(_SETS + " SELECT id, coalesce(a.s = b.s, false) AS equal FROM a FULL JOIN b USING (id)"))
def _(s, d):
    p = A.flowpaths(s, d)
    a, b = (p.select(F.col(c).alias("id"), F.col("ef_type").alias("member")) for c in ("to_nexus_id", "from_nexus_id"))
    return Q.equal_sets(a, b, "id", "member")


_SEGMENTS = ", seg AS (SELECT x1, y1, x2, y2 FROM lined UNION ALL SELECT x2, y2, x1, y1 FROM lined WHERE id % 4 = 0 UNION ALL SELECT minx, miny, maxx, miny FROM catchments UNION ALL SELECT maxx, maxy, minx, maxy FROM catchments)"


@query("set_dup_segments", oracle(_SEGMENTS + ", n AS (SELECT CASE WHEN (x1, y1) <= (x2, y2) THEN [x1, y1, x2, y2] ELSE [x2, y2, x1, y1] END AS s FROM seg) SELECT s[1] AS x1, s[2] AS y1, s[3] AS x2, s[4] AS y2, count(*) AS n FROM n GROUP BY s HAVING count(*) > 1"))
def _(s, d):
    p, c = A.with_points(A.flowpaths(s, d)), A.catchments(s, d)
    ends = ("x1", "y1", "x2", "y2")
    turned = p.filter("id % 4 = 0").select("x2", "y2", "x1", "y1")
    segments = p.select(*ends).union(turned).union(c.select("minx", "miny", "maxx", "miny")).union(c.select("maxx", "maxy", "minx", "maxy"))
    return G.repeated_segments(segments.toDF(*ends))
