"""Registered queries of polygon and line algebra. Lines are short segments set on points, polygons the square catchments, moved or not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg import adapter as A
from thalweg.adapter import oracle
from thalweg.operators import geometry as X
from thalweg.operators import network as N
from thalweg.operators import pourpoints as P
from thalweg.operators import raster as R
from thalweg.operators import relational as Q
from thalweg.operators import spatial as G
from thalweg.operators import tiles as T
from thalweg.plans.hydro_queries import _CL, _DRAINED, _FEATURES, _named_features, _owned, _pp
from thalweg.plans.registry import query
from thalweg.session import stage_table

_SHORT = ", a AS (SELECT id, x + 600.05 AS x1, y + 60.05 AS y1, x + 600.75 + id % 23 AS x2, y + 60.35 + id % 17 AS y2 FROM points)"


def _short(s, d) -> DataFrame:
    x, y, k = F.col("x") + 600.05, F.col("y") + 60.05, F.col("id")
    return A.points(s, d).select("id", x.alias("x1"), y.alias("y1"), (F.col("x") + 600.75 + k % 23).alias("x2"), (F.col("y") + 60.35 + k % 17).alias("y2"))


def _lines(s, d) -> DataFrame:
    return _short(s, d).select("id", F.array(F.array("x1", "y1"), F.array("x2", "y2")).alias("g"), F.col("x1").alias("minx"), F.col("y1").alias("miny"), F.col("x2").alias("maxx"), F.col("y2").alias("maxy"))


def _boxes(s, d, dx: float = 0.0, dy: float = 0.0) -> DataFrame:
    c = A.catchments(s, d).select("id", "ec_type", "ec_subtype", "area", *[(F.col(n) + k).alias(n) for n, k in (("minx", dx), ("miny", dy), ("maxx", dx), ("maxy", dy))])
    return c.withColumn("g", X.box_polygon())


# segments run up and right, so that a box cuts them between these shares
_CUT = _SHORT + """, t AS (SELECT a.id, c.id AS other, x1, y1, x2, y2, greatest(0, (minx - x1) / (x2 - x1), (miny - y1) / (y2 - y1)) AS lo, least(1, (maxx - x1) / (x2 - x1), (maxy - y1) / (y2 - y1)) AS hi
FROM a JOIN catchments c ON x1 <= maxx AND x2 >= minx AND y1 <= maxy AND y2 >= miny), w AS (SELECT * FROM t WHERE hi - lo > 1e-9)"""
_MOVED = ", m AS (SELECT id, minx + 3 AS minx, miny + 4 AS miny, maxx + 3 AS maxx, maxy + 4 AS maxy FROM catchments), o AS (SELECT c.id, m.id AS other, least(c.maxx, m.maxx) - greatest(c.minx, m.minx) AS w, least(c.maxy, m.maxy) - greatest(c.miny, m.miny) AS h FROM catchments c JOIN m ON c.maxx > m.minx AND c.minx < m.maxx AND c.maxy > m.miny AND c.miny < m.maxy)"

# ---- relations and joins


@query("flt_relate", oracle(_MOVED + " SELECT id, other, '212101212' AS matrix FROM o"))
def _(s, d):
    return X.related(_boxes(s, d), _boxes(s, d, 3.0, 4.0), 40.0, "2********")


@query("flt_relate_boundary", oracle(" SELECT a.id, b.id AS other FROM catchments a JOIN catchments b ON a.id <> b.id AND ((a.maxx = b.minx OR a.minx = b.maxx) AND a.miny = b.miny OR (a.maxy = b.miny OR a.miny = b.maxy) AND a.minx = b.minx)"))
def _(s, d):
    return X.related(_boxes(s, d), _boxes(s, d), 40.0, "F***1****").select("id", "other")


@query("flt_relate_line", oracle(_CUT + " SELECT id, other FROM w"))
def _(s, d):
    return X.related(_lines(s, d), _boxes(s, d), 40.0, "T********", lines=True).select("id", "other")


_IN = ", i AS (SELECT a.id, min(c.id) AS polygon, count(c.id) AS containing FROM a LEFT JOIN catchments c ON x1 >= minx AND x2 <= maxx AND y1 >= miny AND y2 <= maxy GROUP BY 1), e AS (SELECT a.id, min(c.id) AS at_end FROM a JOIN catchments c ON x2 >= minx AND x2 <= maxx AND y2 >= miny AND y2 <= maxy GROUP BY 1)"


@query("join_line_in_polygon", oracle(_SHORT + _IN + " SELECT id, coalesce(polygon, CASE WHEN id % 3 = 0 THEN at_end END) AS polygon, containing FROM i LEFT JOIN e USING (id)"))
def _(s, d):
    return X.line_in_polygon(_lines(s, d).withColumn("bank", F.col("id") % 3 == 0), _boxes(s, d), 40.0)


@query("join_touch_nexus", oracle(", n AS (SELECT id, CAST(id % 97 AS DOUBLE) * 10 AS x, CAST(id % 11 AS DOUBLE) * 10 AS y FROM catchments) SELECT c.id AS catchment, n.id AS nexus FROM catchments c JOIN n ON (x = minx OR x = maxx) AND y >= miny AND y <= maxy OR (y = miny OR y = maxy) AND x >= minx AND x <= maxx"))
def _(s, d):
    k = F.col("id")
    n = A.catchments(s, d).select("id", ((k % 97) * 10.0).alias("x"), ((k % 11) * 10.0).alias("y"))
    return G.touched(n, X.ring_edges(_boxes(s, d)), 10.0)


@query("join_spatial_intersects", oracle(", b AS (SELECT id, x1, y1, x2, y2, CASE WHEN x1 = x2 THEN CASE WHEN x1 BETWEEN -20 AND 20 THEN 0 ELSE 2 END ELSE least((-20 - x1) / (x2 - x1), (20 - x1) / (x2 - x1)) END AS xl, CASE WHEN x1 = x2 THEN 1 ELSE greatest((-20 - x1) / (x2 - x1), (20 - x1) / (x2 - x1)) END AS xh, CASE WHEN y1 = y2 THEN CASE WHEN y1 BETWEEN -10 AND 10 THEN 0 ELSE 2 END ELSE least((-10 - y1) / (y2 - y1), (10 - y1) / (y2 - y1)) END AS yl, CASE WHEN y1 = y2 THEN 1 ELSE greatest((-10 - y1) / (y2 - y1), (10 - y1) / (y2 - y1)) END AS yh FROM lined) SELECT id FROM b WHERE greatest(0, xl, yl) <= least(1, xh, yh)"))
def _(s, d):
    # the envelope first, which scans push down, then the exact test
    p = A.with_points(A.flowpaths(s, d)).withColumns({"minx": F.least("x1", "x2"), "miny": F.least("y1", "y2"), "maxx": F.greatest("x1", "x2"), "maxy": F.greatest("y1", "y2")})
    low, high = X.clip_shares(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], *[F.lit(v) for v in (-20.0, -10.0, 20.0, 10.0)])
    return p.filter(Q.bbox_intersects(-20, -10, 20, 10)).filter(low <= high).select("id")


@query("join_cross_bounds", "WITH bounds AS (SELECT 3 AS z, 100 AS least_value) SELECT event_id AS id, z FROM events, bounds WHERE value >= least_value")
def _(s, d):
    bounds = s.createDataFrame([(3, 100)], "z int, least_value int")
    return Q.with_bounds(A.table(s, d, "events").select(F.col("event_id").alias("id"), "value"), bounds).filter("value >= least_value").select("id", "z")


_UNEVEN = ", u AS (SELECT id, (id % 128) * 10.0::DOUBLE + (id // 128 % 3) * 4 AS minx, (id // 128) * 10.0::DOUBLE AS miny FROM catchments), sh AS (SELECT a.id, b.id AS other, CASE WHEN a.miny = b.miny THEN 10.0 ELSE 10 - abs(a.minx - b.minx) END::DOUBLE AS shared FROM u a JOIN u b ON a.id <> b.id AND (a.miny = b.miny AND abs(a.minx - b.minx) = 10 OR abs(a.miny - b.miny) = 10 AND abs(a.minx - b.minx) < 10))"


def _uneven(s, d) -> DataFrame:
    """Rows of squares that are set off against each other."""
    k = F.col("id")
    x, y = (k % 128) * 10.0 + F.expr("id div 128 % 3") * 4, F.expr("id div 128") * 10.0
    c = A.catchments(s, d).select("id", "area", x.alias("minx"), y.alias("miny"))
    return c.withColumns({"maxx": F.col("minx") + 10, "maxy": F.col("miny") + 10}).withColumn("g", X.box_polygon())


@query("join_longest_shared_edge", oracle(_UNEVEN + " SELECT id, arg_max(other, (shared, -other)) AS other, max(shared) AS shared FROM sh WHERE other % 3 <> 0 GROUP BY 1"))
def _(s, d):
    c = _uneven(s, d)
    return X.longest_neighbour(X.shared_lengths(c), c.filter("id % 3 <> 0")).select("id", "other", F.round("shared", 6).alias("shared"))


@query("join_shared_lengths", oracle(_UNEVEN + " SELECT * FROM sh"))
def _(s, d):
    return X.shared_lengths(_uneven(s, d)).withColumn("shared", F.round("shared", 6))


# ---- overlay


@query("sp_overlap_polygons", oracle(" SELECT id FROM catchments WHERE minx < 777.5 AND maxx > 123.25 AND miny < 888.5 AND maxy > 15.5"))
def _(s, d):
    lake = s.createDataFrame([(1, 123.25, 15.5, 777.5, 888.5)], "id long, minx double, miny double, maxx double, maxy double").withColumn("g", X.box_polygon())
    return X.related(_boxes(s, d), lake, 40.0, "2********").select("id")


def _pairs(s, d) -> DataFrame:
    return X.candidates(_boxes(s, d), _boxes(s, d, 3.0, 4.0), 40.0)


def _area(parts: str):
    return F.round(F.aggregate(F.transform(parts, X.area_of), F.lit(0.0), lambda t, a: t + a), 6)


@query("sp_intersection", oracle(_MOVED + " SELECT id, other, 1 AS parts, round(w * h, 6) AS area FROM o"))
def _(s, d):
    return X.overlaid(_pairs(s, d), "intersection").filter(F.size("parts") > 0).select("id", "other", F.size("parts").alias("parts"), _area("parts").alias("area"))


@query("sp_difference", oracle(_MOVED + " SELECT id, other, 1 AS parts, round(100 - w * h, 6) AS area FROM o"))
def _(s, d):
    f = X.overlaid(_pairs(s, d), "difference").select("id", "other", F.size("parts").alias("parts"), _area("parts").alias("area"))
    return f.filter("area < 100")


@query("sp_union", oracle(_MOVED + " SELECT id, other, 1 AS parts, round(200 - w * h, 6) AS area FROM o"))
def _(s, d):
    f = X.overlaid(_pairs(s, d), "union").select("id", "other", F.size("parts").alias("parts"), _area("parts").alias("area"))
    return f.filter("area < 200")


_OUTLINE = ", sg AS (SELECT k, unnest([{'a': minx, 'b': miny, 'c': maxx, 'd': miny}, {'a': minx, 'b': maxy, 'c': maxx, 'd': maxy}, {'a': minx, 'b': miny, 'c': minx, 'd': maxy}, {'a': maxx, 'b': miny, 'c': maxx, 'd': maxy}]) AS s FROM {t}), ol AS (SELECT k, sum(s.c - s.a + s.d - s.b) AS outline FROM (SELECT k, s FROM sg GROUP BY 1, 2 HAVING count(*) = 1) GROUP BY 1)"


def _outline(parts: str):
    rings = F.flatten(parts)
    length = lambda r: F.aggregate(F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: F.abs(a[0] - b[0]) + F.abs(a[1] - b[1])), F.lit(0.0), lambda t, v: t + v)
    return F.round(F.aggregate(F.transform(rings, length), F.lit(0.0), lambda t, v: t + v), 6)


@query("sp_dissolve_polygons", oracle(", c AS (SELECT ec_subtype * 10 + ec_type AS k, minx, miny, maxx, maxy FROM catchments)" + _OUTLINE.replace("{t}", "c") + " SELECT k, (SELECT count(*) * 100.0::DOUBLE FROM c WHERE c.k = ol.k) AS area, outline FROM ol"))
def _(s, d):
    c = _boxes(s, d).withColumn("k", (F.col("ec_subtype") * 10 + F.col("ec_type")).cast("int"))
    return X.dissolved(c, "k").select("k", _area("parts").alias("area"), _outline("parts").alias("outline"))


@query("agg_union_by_name", oracle(_FEATURES + ", h AS (SELECT * FROM features f JOIN names n USING (name_id) WHERE name_en ILIKE '%e%' OR name_fr ILIKE '%e%'), c AS (SELECT name_id AS k, minx, miny, maxx, maxy FROM h WHERE kind = 'waterbody')" + _OUTLINE.replace("{t}", "c") + " SELECT name_id, kind, count(*) AS n, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, CASE WHEN kind = 'waterbody' THEN count(*) * 100.0::DOUBLE END AS area, any_value(CASE WHEN kind = 'waterbody' THEN outline END) AS outline, CASE WHEN kind = 'flowpath' THEN count(*) END AS lines FROM h LEFT JOIN ol ON ol.k = h.name_id GROUP BY 1, 2"))
def _(s, d):
    hits = A.names(s, d).filter(Q.name_matches("e", "contains"))
    found = _named_features(s, d).join(hits, "name_id", "left_semi")
    lines = A.with_points(A.flowpaths(s, d)).filter("rivernameid1 IS NOT NULL").select(F.col("rivernameid1").alias("name_id"), F.array(F.array("x1", "y1"), F.array("x2", "y2")).alias("line"))
    lines = lines.join(hits, "name_id", "left_semi").groupBy("name_id").agg(F.array_sort(F.collect_list("line")).alias("lines")).select("name_id", F.lit("flowpath").alias("kind"), F.size("lines").cast("long").alias("lines"))
    water = X.dissolved(found.filter("kind = 'waterbody'").withColumn("g", X.box_polygon()), "name_id").select("name_id", F.lit("waterbody").alias("kind"), "parts")
    boxes = found.groupBy("name_id", "kind").agg(F.count("*").alias("n"), F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))
    both = boxes.join(water, ["name_id", "kind"], "left").join(lines, ["name_id", "kind"], "left")
    return both.select("name_id", "kind", "n", "minx", "miny", "maxx", "maxy", _area("parts").alias("area"), _outline("parts").alias("outline"), "lines")


def _drained(s, d, start: int) -> DataFrame:
    return N.drainage(_owned(s, d), _boxes(s, d), s.createDataFrame([(start,)], "id long")).withColumn("k", F.lit(start))


@query("agg_drainage_area", oracle(_CL + ", r(id) AS (SELECT 20 UNION SELECT src FROM r JOIN cl ON dst = r.id), c AS (SELECT 20 AS k, * FROM catchments WHERE id IN (SELECT id FROM r))" + _OUTLINE.replace("{t}", "c") + " SELECT 20 AS k, (SELECT count(*) * 100.0::DOUBLE FROM c) AS area, outline, (SELECT sum(area)::BIGINT FROM c) AS stated FROM ol", recursive=True))
def _(s, d):
    c = stage_table(_drained(s, d, 20), "drained")
    stated = c.groupBy("k").agg(F.sum("area").alias("stated"))
    return X.dissolved(c, "k").join(stated, "k").select("k", _area("parts").alias("area"), _outline("parts").alias("outline"), "stated")


@query("g_remove_holes", oracle(_CL + """, r(id) AS (SELECT 20 UNION SELECT src FROM r JOIN cl ON dst = r.id), own AS (SELECT id, id % 128 AS x, id // 128 AS y FROM catchments WHERE id IN (SELECT id FROM r)),
free AS (SELECT x, y FROM (SELECT unnest(range(-1, 129)) AS x), (SELECT unnest(range(-1, (SELECT max(o_orderkey) // 128 + 2 FROM orders))) AS y) WHERE (x, y) NOT IN (SELECT x, y FROM own)),
sea(x, y) AS (SELECT -1, -1 UNION SELECT f.x, f.y FROM sea s JOIN free f ON abs(f.x - s.x) <= 1 AND abs(f.y - s.y) <= 1)
SELECT 20 AS k, coalesce(count(c.id), 0) AS filled, sum(c.area)::BIGINT AS area FROM (SELECT 1) LEFT JOIN catchments c ON (c.id % 128, c.id // 128) IN (SELECT x, y FROM free EXCEPT SELECT x, y FROM sea)""", recursive=True))
def _(s, d):
    # grid cells that meet at a corner alone leave no hole: the outline's rings touch there
    whole = X.without_holes(X.dissolved(_drained(s, d, 20), "k").withColumnRenamed("k", "key"), _boxes(s, d), 40.0, ["area"])
    return whole.select(F.col("key").alias("k"), F.coalesce(F.size("filled"), F.lit(0)).cast("long").alias("filled"), "area")


@query("pp_interior_holes", oracle(_DRAINED + """, own AS (SELECT DISTINCT catchment % 128 AS x, catchment // 128 AS y FROM dr),
free AS (SELECT x, y FROM (SELECT unnest(range(-1, 129)) AS x), (SELECT unnest(range(-1, (SELECT max(o_orderkey) // 128 + 2 FROM orders))) AS y) WHERE (x, y) NOT IN (SELECT x, y FROM own)),
sea(x, y) AS (SELECT -1, -1 UNION SELECT f.x, f.y FROM sea s JOIN free f ON abs(f.x - s.x) <= 1 AND abs(f.y - s.y) <= 1)
SELECT c.id FROM catchments c WHERE (c.id % 128, c.id // 128) IN (SELECT x, y FROM free EXCEPT SELECT x, y FROM sea)""", recursive=True))
def _(s, d):
    # catchments in the holes of what all points drain together; none of them is claimed
    return X.interior_holes(P.drained(_owned(s, d), _pp(s)).select(F.col("catchment").alias("id")).distinct(), _boxes(s, d), 40.0)


# ---- lines


@query("sp_clip", oracle(_CUT + " SELECT id, other, round(x1 + lo * (x2 - x1), 6) AS ax, round(y1 + lo * (y2 - y1), 6) AS ay, round(x1 + hi * (x2 - x1), 6) AS bx, round(y1 + hi * (y2 - y1), 6) AS byy FROM w"))
def _(s, d):
    f = X.clipped(_lines(s, d), _boxes(s, d), 40.0)
    return f.select("id", "other", *[F.round(F.element_at("line", k)[i], 6).alias(n) for n, k, i in (("ax", 1, 0), ("ay", 1, 1), ("bx", -1, 0), ("byy", -1, 1))])


@query("sp_trim", oracle(_SHORT + " SELECT a.id, c.id AS other FROM a JOIN catchments c ON x1 >= minx AND x2 <= maxx AND y1 >= miny AND y2 <= maxy"))
def _(s, d):
    return X.clipped(_lines(s, d), _boxes(s, d), 40.0, whole_segments=True).select("id", "other")


@query("sp_linemerge", oracle(_SHORT + " SELECT CASE WHEN id % 2 = 0 THEN 4 ELSE 2 END::INT AS n, round(x1 + id * 1000, 6) AS x1, round(y1, 6) AS y1, round(x2 + id * 1000 + CASE WHEN id % 2 = 0 THEN 2 ELSE 0 END, 6) AS x2, round(y2 + CASE WHEN id % 2 = 0 THEN 1 ELSE 0 END, 6) AS y2 FROM a"))
def _(s, d):
    # the lines of even ids come in three, the middle one turned; no two of different ids meet
    a = _short(s, d).withColumns({c: F.col(c) + F.col("id") * 1000 for c in ("x1", "x2")})
    p = lambda x, y: F.array(F.round(x, 6), F.round(y, 6))
    start, end, more, last = p("x1", "y1"), p("x2", "y2"), p(F.col("x2") + 1, "y2"), p(F.col("x2") + 2, F.col("y2") + 1)
    parts = F.when(F.col("id") % 2 == 0, F.array(F.array(start, end), F.array(more, end), F.array(more, last))).otherwise(F.array(F.array(start, end)))
    lines = a.select("id", F.posexplode(parts).alias("k", "line")).select((F.col("id") * 3 + F.col("k")).alias("id"), "line")
    both = F.array_sort(F.array(F.element_at("line", 1), F.element_at("line", -1)))
    m = X.merged_lines(lines).select(F.size("line").alias("n"), both.alias("e"))
    return m.select("n", F.col("e")[0][0].alias("x1"), F.col("e")[0][1].alias("y1"), F.col("e")[1][0].alias("x2"), F.col("e")[1][1].alias("y2"))


@query("sp_polygonize", oracle(" SELECT id, 2 AS polygons, 100.0::DOUBLE AS area, 1 AS dangles, 0 AS cuts FROM catchments"))
def _(s, d):
    # four sides and a diagonal, and a line that leads away from a corner
    c = A.catchments(s, d)
    p = lambda x, y: F.array(x, y)
    a, b, e, f = p("minx", "miny"), p("maxx", "miny"), p("maxx", "maxy"), p("minx", "maxy")
    lines = F.array(F.array(a, b), F.array(b, e), F.array(e, f), F.array(f, a), F.array(a, e), F.array(e, p(F.col("maxx") + 3, F.col("maxy") + 1)))
    return X.polygonized(c.select("id", F.explode(lines).alias("line")), "id").select("id", F.size("polygons").alias("polygons"), _area("polygons").alias("area"), "dangles", "cuts")


_BENT = _SHORT + ", b AS (SELECT id, x1, y1, x2, y2, x2 - x1 AS w, y2 - y1 AS h FROM a)"


def _bent(s, d) -> DataFrame:
    """Lines that run right, then up."""
    return _short(s, d).select("id", F.array(F.array("x1", "y1"), F.array("x2", "y1"), F.array("x2", "y2")).alias("line"))


@query("sp_midpoint", oracle(_BENT + ", m AS (SELECT *, CASE WHEN w >= h THEN x1 + (w + h) / 2 ELSE x2 END AS mx, CASE WHEN w >= h THEN y1 ELSE y1 + (h - w) / 2 END AS my FROM b) SELECT id, round(mx, 6) AS x, round(my, 6) AS y, round(CASE WHEN abs(w - h) <= 2 THEN x2 ELSE mx END, 6) AS snap_x, round(CASE WHEN abs(w - h) <= 2 THEN y1 ELSE my END, 6) AS snap_y FROM m WHERE abs(abs(w - h) - 2) > 1e-6 AND w + h > 4.5"))
def _(s, d):
    n = G.line_length(F.transform("line", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    odd = F.abs(F.abs((F.col("line")[1][0] - F.col("line")[0][0]) - (F.col("line")[2][1] - F.col("line")[1][1])) - 2) > 1e-6
    m, t = X.point_along(F.col("line"), F.lit(0.5)), X.middle_of(F.col("line"), 1.0)
    return _bent(s, d).filter(odd & (n > 4.5)).select("id", *[F.round(c[i], 6).alias(name) for name, c, i in (("x", m, 0), ("y", m, 1), ("snap_x", t, 0), ("snap_y", t, 1))])


@query("sp_nearest_points", oracle(_SHORT + ", t AS (SELECT *, greatest(0, least(1, ((610.5 - x1) * (x2 - x1) + (55.25 - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t FROM a) SELECT id, round(x1 + t * (x2 - x1), 6) AS x, round(y1 + t * (y2 - y1), 6) AS y FROM t"))
def _(s, d):
    x, y = X.nearest_on_segment(F.lit(610.5), F.lit(55.25), *[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    return _short(s, d).select("id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("sp_ring_side", oracle(" SELECT id, CASE WHEN id % 2 = 0 THEN -1 ELSE 1 END::INT AS bottom, CASE WHEN id % 2 = 0 THEN 1 ELSE -1 END::INT AS bottom_turned, 0 AS diagonal FROM catchments"))
def _(s, d):
    left = X.box_polygon()[0]
    a, b, e = F.array("minx", "miny"), F.array("maxx", "miny"), F.array("maxx", "maxy")
    # the rings of even ids turn left, of odd ids right, and always have their edges the way they run
    ring = F.when(F.col("id") % 2 == 0, left).otherwise(F.reverse(left))
    side = lambda p, q: X.ring_side(ring, p, q)
    return A.catchments(s, d).select("id", F.when(F.col("id") % 2 == 0, side(a, b)).otherwise(side(b, a)).alias("bottom"), F.when(F.col("id") % 2 == 0, side(b, a)).otherwise(side(a, b)).alias("bottom_turned"), side(a, e).alias("diagonal"))


def _axis(i: int, places: int):
    return F.transform("line", lambda p: F.round(p[i], places))


_SMOOTH = {
    "centroid": ("[x1, (2 * x2 + x1) / 3, x2]", "[y1, (2 * y1 + y2) / 3, y2]"),
    "slide": ("[x1, (5 * x2 + x1) / 6, x2]", "[y1, (5 * y1 + y2) / 6, y2]"),
    "midpoint": ("[x1, (x1 + x2) / 2, x2, x2]", "[y1, y1, (y1 + y2) / 2, y2]"),
    "progressive": ("[x1, (x1 + x2 + (2 * x2 + x1) / 3) / 3, x2]", "[y1, (y1 + y2 + (2 * y1 + y2) / 3) / 3, y2]"),
    "corners": ("[x1, x2 - least(w / 2, h), x2, x2]", "[y1, y1, y1 + least(h / 2, w), y2]"),
}


def _smooth(how: str) -> None:
    xs, ys = _SMOOTH[how]
    # both arms of a corner are cut alike where they are equally long; there is then no shorter one
    @query(f"sp_smooth_{how}", oracle(_BENT + f" SELECT id, list_transform({xs}, lambda v: round(v, 6)) AS xs, list_transform({ys}, lambda v: round(v, 6)) AS ys FROM b"))
    def _(s, d):
        f = X.smoothed(_bent(s, d), how)
        return f.select("id", _axis(0, 6).alias("xs"), _axis(1, 6).alias("ys"))


for _how in _SMOOTH:
    _smooth(_how)


@query("prj_simplify_by_zoom", oracle(", z AS (SELECT z FROM range(0, 20) t(z)), b AS (SELECT id, (id % 100) / 1000.0::DOUBLE AS off FROM points) SELECT id, z::INT AS z, CASE WHEN off > CASE WHEN z <= 3 THEN 0.05 WHEN z <= 7 THEN 0.01 WHEN z <= 9 THEN 0.001 ELSE -1 END THEN 3 ELSE 2 END::INT AS n FROM b, z"))
def _(s, d):
    lines = A.points(s, d).select("id", F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(5.0), ((F.col("id") % 100) / 1000).cast("double")), F.array(F.lit(10.0), F.lit(0.0))).alias("line"))
    return T.simplified_by_zoom(lines, list(range(20))).select("id", "z", F.size("line").alias("n"))


# ---- reports around a point or box


@query("sp_near", oracle(", d AS (SELECT id, sqrt((x - 5) * (x - 5) + (y + 7) * (y + 7)) AS distance FROM points WHERE id % 2 = 0) SELECT id, round(distance, 6) AS distance FROM d WHERE distance <= 60 ORDER BY d.distance, id LIMIT 25"))
def _(s, d):
    return G.near(A.points(s, d).filter("id % 2 = 0"), 5.0, -7.0, 60.0, 25).select("id", F.round("distance", 6).alias("distance"))


@query("sp_within", oracle(" SELECT id FROM points WHERE x BETWEEN -40 AND 30 AND y BETWEEN -20 AND 55"))
def _(s, d):
    return G.within(A.points(s, d), -40.0, -20.0, 30.0, 55.0).select("id")


@query("sp_containing", oracle(" SELECT id FROM catchments WHERE 255.5 > minx AND 255.5 < maxx AND 33.25 > miny AND 33.25 < maxy"))
def _(s, d):
    p = s.createDataFrame([(1, 255.5, 33.25)], "id long, x double, y double")
    return G.points_in_boxes(p, A.catchments(s, d), 50.0).select(F.col("box").alias("id"))


# ---- functions

_N = "sqrt(nx * nx + ny * ny + nz * nz)"


@query("sp_vector_math", oracle(", v AS (SELECT id, elv_min AS a, elv_max AS b, slope_min AS c, slope_max AS e FROM catchments WHERE elv_min IS NOT NULL), n AS (SELECT id, a, b, c, e, 0.0::DOUBLE * (c - a) - (b - a)::DOUBLE * e AS nx, (b - a)::DOUBLE * 0 - 10.0::DOUBLE * (c - a) AS ny, 10.0::DOUBLE * e - 0 AS nz FROM v) SELECT id, round(nx / " + _N + ", 9) AS nx, round(ny / " + _N + ", 9) AS ny, round(nz / " + _N + ", 9) AS nz, (10.0::DOUBLE * a * e) AS det FROM n"))
def _(s, d):
    c = A.catchments(s, d).filter("elv_min IS NOT NULL")
    z = lambda n: F.col(n).cast("double")
    p, q, r = X.vector(F.lit(0.0), F.lit(0.0), z("elv_min")), X.vector(F.lit(10.0), F.lit(0.0), z("elv_max")), X.vector(F.lit(0.0), z("slope_max"), z("slope_min"))
    n = X.triangle_normal(p, q, r)
    value = X.det(X.vector(F.lit(10.0), F.lit(0.0), F.lit(0.0)), X.vector(F.lit(0.0), z("elv_min"), F.lit(0.0)), X.vector(F.lit(0.0), F.lit(0.0), z("slope_max")))
    return c.select("id", F.round(n["x"], 9).alias("nx"), F.round(n["y"], 9).alias("ny"), F.round(n["z"], 9).alias("nz"), value.alias("det"))


@query("sp_flip_axes", oracle(" SELECT id, y1 AS x, x1 AS y FROM lined"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d)).select("id", F.array(F.array("x1", "y1")).alias("g"))
    return p.select("id", G.flipped_axes(F.col("g"))[0].alias("p")).select("id", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


_LCC = "pow(tan(pi() / 4 - radians({p}) / 2) / pow((1 - sqrt(0.006694380022900787) * sin(radians({p}))) / (1 + sqrt(0.006694380022900787) * sin(radians({p}))), sqrt(0.006694380022900787) / 2), 1)"
_M = "(cos(radians({p})) / sqrt(1 - 0.006694380022900787 * pow(sin(radians({p})), 2)))"


@query("sp_reproject_conic", oracle(f""", k AS (SELECT ln({_M.format(p=49)} / {_M.format(p=77)}) / ln({_LCC.format(p=49)} / {_LCC.format(p=77)}) AS n, {_M.format(p=49)} AS m1, {_LCC.format(p=49)} AS t1, {_LCC.format(p='63.390675')} AS t0),
c AS (SELECT n, m1 / (n * pow(t1, n)) AS f, t0 FROM k), q AS (SELECT id, x1, y1, 6378137.0 * f * pow({_LCC.format(p='y1')}, n) AS rho, 6378137.0 * f * pow(t0, n) AS rho0, n * radians(x1 + 91.866666666666667) AS theta FROM lined, c WHERE y1 BETWEEN 40 AND 79 AND x1 BETWEEN -180 AND -20)
SELECT id, round(6200000 + rho * sin(theta), 1) AS x, round(3000000 + rho0 - rho * cos(theta), 1) AS y, round(x1, 6) AS lon, round(y1, 6) AS lat FROM q"""))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d)).filter("y1 BETWEEN 40 AND 79 AND x1 BETWEEN -180 AND -20")
    x, y = G.to_conic(F.col("x1"), F.col("y1"))
    lon, lat = G.from_conic(F.col("cx"), F.col("cy"))
    back = p.select("id", x.alias("cx"), y.alias("cy")).withColumns({"lon": lon, "lat": lat})
    return back.select("id", F.round("cx", 1).alias("x"), F.round("cy", 1).alias("y"), F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("sp_convex_hull", oracle(", h AS (SELECT label, id, x, y FROM points JOIN (SELECT vec_id AS id, label FROM embeddings) USING (id)) SELECT label, min(x) AS minx, max(x) AS maxx, min(y) AS miny, max(y) AS maxy, count(*) AS n FROM h GROUP BY 1 HAVING count(DISTINCT (x, y)) > 2"))
def _(s, d):
    p = A.points(s, d).join(A.table(s, d, "embeddings").select(F.col("vec_id").alias("id"), "label"), "id")
    h = X.hulls(p, "label").filter("hull IS NOT NULL")
    end = lambda f, k: f(F.transform("hull", lambda v: v[k]))
    # every point of a label lies in the hull
    outside = p.join(h, "label").filter(F.exists(F.arrays_zip(F.slice("hull", 1, F.size("hull") - 1).alias("a"), F.slice("hull", 2, F.size("hull") - 1).alias("b")), lambda e: (e["b"][0] - e["a"][0]) * (F.col("y") - e["a"][1]) - (e["b"][1] - e["a"][1]) * (F.col("x") - e["a"][0]) < -1e-6))
    counts = p.groupBy("label").agg(F.count("*").alias("n")).join(outside.select("label").distinct(), "label", "left_anti")
    return h.select("label", end(F.array_min, 0).alias("minx"), end(F.array_max, 0).alias("maxx"), end(F.array_min, 1).alias("miny"), end(F.array_max, 1).alias("maxy")).join(counts, "label")


@query("sp_hull_inset", None)
def _(s, d):
    p = A.points(s, d).join(A.table(s, d, "embeddings").select(F.col("vec_id").alias("id"), "label"), "id")
    return X.hulls(p, "label", inset=5.0)


@query("src_geom_unwrap", oracle(" SELECT id, x1, y1 FROM lined"))
def _(s, d):
    from thalweg.operators.construct import unwrapped

    p = A.with_points(A.flowpaths(s, d)).select("id", F.array(F.struct("x1", "y1")).alias("parts"))
    return p.select("id", unwrapped(F.col("parts")).alias("g")).select("id", "g.x1", "g.y1")


@query("sp_wkb", oracle(_BENT + " SELECT id, 'LineString' AS kind, list_transform([x1, x2, x2], lambda v: round(v, 9)) AS xs, list_transform([y1, y1, y2], lambda v: round(v, 9)) AS ys FROM b"))
def _(s, d):
    read = T.parsed_wkb(_bent(s, d).select("id", T.line_wkb(F.col("line")).alias("wkb")))
    return read.select("id", "kind", _axis(0, 9).alias("xs"), _axis(1, 9).alias("ys"))


# ---- tiles


@query("sp_mvt_geometry", oracle(", t AS (SELECT id, least(greatest(floor((x1 + 180) / 360 * 32), 0), 31)::INT AS tx, x1, y1, ln(tan(radians(y1) / 2 + pi() / 4)) / pi() * 180 AS my FROM lined) SELECT id, tx, least(greatest(floor((180 - my) / 360 * 32), 0), 31)::INT AS ty, round(((x1 + 180) / 360 * 32 - tx) * 4096)::INT AS px, round(((180 - my) / 360 * 32 - least(greatest(floor((180 - my) / 360 * 32), 0), 31)::INT) * 4096)::INT AS py FROM t"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d))
    return T.placed_in_tiles(p.select("id", "x1", "y1"), "x1", "y1", 5).select("id", "tx", "ty", "px", "py")


@query("sp_asmvt", oracle(", t AS (SELECT id, least(greatest(floor((x1 + 180) / 360 * 8), 0), 7)::INT AS tx, least(greatest(floor((180 - ln(tan(radians(y1) / 2 + pi() / 4)) / pi() * 180) / 360 * 8), 0), 7)::INT AS ty FROM lined) SELECT 'FLOWPATH__3_' || tx || '_' || ty AS key, count(*) AS features FROM t GROUP BY 1"))
def _(s, d):
    p = T.placed_in_tiles(A.with_points(A.flowpaths(s, d)).select("id", "length", "x1", "y1"), "x1", "y1", 3)
    tiles = T.encoded_tiles(p, "FLOWPATH", 3, ["id", "length"])
    return tiles.select("key", T.features_in(F.col("tile")).alias("features"))


# ---- raster


@query("ra_distance_to_water", oracle(""", z AS (SELECT id, minx, miny FROM catchments WHERE ec_type <> 3), pts AS (SELECT id, minx + i * 2.5 AS x, miny + j * 2.5 AS y FROM z, range(1, 4) a(i), range(1, 4) b(j)),
seg AS (SELECT id, minx + 1 AS x1, miny AS y1, minx + id % 9 AS x2, miny + 10 AS y2 FROM catchments WHERE ec_type = 1 AND id % 4 <> 0 UNION ALL SELECT id, minx, miny + id % 7, minx + 10, miny + id % 5 FROM catchments WHERE ec_type = 1 AND id % 3 = 0),
dd AS (SELECT p.id, p.x, p.y, min(sqrt(pow(x - (x1 + t * (x2 - x1)), 2) + pow(y - (y1 + t * (y2 - y1)), 2))) AS d FROM (SELECT p.id, x, y, x1, y1, x2, y2, greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t FROM pts p JOIN seg USING (id)) p GROUP BY 1, 2, 3)
SELECT z.id, CASE WHEN c.ec_type = 4 THEN 0 ELSE round(avg(d), 6) END AS d2w2d_mean, CASE WHEN c.ec_type = 4 THEN 0 ELSE round(max(d), 6) END AS d2w2d_max FROM z JOIN catchments c USING (id) LEFT JOIN dd USING (id) GROUP BY z.id, c.ec_type"""))
def _(s, d):
    c = A.catchments(s, d)
    zones = c.filter("ec_type <> 3")
    k = F.col("id")
    one = c.filter("ec_type = 1 AND id % 4 <> 0").select("id", (F.col("minx") + 1).alias("x1"), F.col("miny").alias("y1"), (F.col("minx") + k % 9).alias("x2"), (F.col("miny") + 10).alias("y2"))
    two = c.filter("ec_type = 1 AND id % 3 = 0").select("id", "minx", (F.col("miny") + k % 7), (F.col("minx") + 10), (F.col("miny") + k % 5))
    return R.distance_to_water(R.interior_points(zones, 2.5), one.union(two), zones.select("id"), c.filter("ec_type = 4").select("id"))
