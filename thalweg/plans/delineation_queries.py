"""Registered queries of delineation. Blocks of 100 x 100 hold two rivers, at x = 10 and x = 90 of the block, and a ridge at x = 50 between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg import adapter as A
from thalweg.adapter import oracle
from thalweg.operators import construct as C
from thalweg.operators import delineate as Z
from thalweg.operators import geometry as X
from thalweg.operators import spatial as G
from thalweg.plans.geometry_queries import _SHORT, _short
from thalweg.plans.registry import query

SIDE = 100.0


def _points(s, d) -> DataFrame:
    """Elevation points (id, block, x, y, z), forty to a block, somewhat spread; rivers lie below the ground beside them."""
    t = A.table(s, d, "orders").select(F.col("o_orderkey").alias("id"))
    k = F.expr("id div 40")
    u, v = (F.col("id") * 37) % 79 + 10.5, (F.col("id") * 61) % 97 + 1.25
    return t.select("id", k.alias("block"), (k * SIDE + u).alias("x"), v.alias("y"), (100 - F.abs(u - 50) + v / 1000).alias("z"))


def _rivers(s, d) -> DataFrame:
    """Edges (block, x1, y1, x2, y2, drainage)."""
    b = _points(s, d).select("block").distinct()
    x = F.explode(F.array(F.lit(10.0), F.lit(90.0))).alias("u")
    b = b.select("block", x)
    at = F.col("block") * SIDE + F.col("u")
    return b.select("block", at.alias("x1"), F.lit(1.0).alias("y1"), at.alias("x2"), F.lit(99.0).alias("y2"), F.concat(F.lit("R"), F.col("block").cast("string"), F.lit("_"), F.col("u").cast("int").cast("string")).alias("drainage"))


def _made(s, d) -> DataFrame:
    return Z.block_boundaries(_points(s, d).select("x", "y", "z"), _rivers(s, d), SIDE, 8.0, buffer=0.0)


_BLOCKS = " SELECT o_orderkey // 40 AS block, count(*) AS n FROM orders GROUP BY 1"


@query("cd_hydro_edges", oracle(_SHORT + """, w AS (SELECT * FROM catchments WHERE ec_type = 4), s AS (SELECT minx AS x1, miny AS y1, maxx AS x2, miny AS y2, 'LEFT' AS side FROM w UNION ALL SELECT maxx, miny, maxx, maxy, 'LEFT' FROM w UNION ALL SELECT minx, maxy, maxx, maxy, 'RIGHT' FROM w UNION ALL SELECT minx, miny, minx, maxy, 'RIGHT' FROM w)
SELECT x1, y1, x2, y2, 'SHORE' AS kind, CASE WHEN count(*) > 1 THEN 'BOTH' ELSE min(side) END AS side FROM s GROUP BY 1, 2, 3, 4 UNION ALL SELECT round(x1, 6), round(y1, 6), round(x2, 6), round(y2, 6), 'FLOW', NULL FROM a"""))
def _(s, d):
    water = A.catchments(s, d).filter("ec_type = 4").select("id", X.box_polygon().alias("g"))
    return Z.hydro_edges(_short(s, d), water).select("x1", "y1", "x2", "y2", "kind", "side")


@query("cd_blocks", oracle(""", c AS (SELECT x AS bx, y AS byy, x1, y1, x2, y2 FROM lined, range(-5, 5) a(x), range(-3, 3) b(y) WHERE x BETWEEN floor(least(x1, x2) / 60) AND floor(greatest(x1, x2) / 60) AND y BETWEEN floor(least(y1, y2) / 60) AND floor(greatest(y1, y2) / 60)),
t AS (SELECT bx, byy, CASE WHEN x1 = x2 THEN 0 ELSE least((bx * 60 - x1) / (x2 - x1), (bx * 60 + 60 - x1) / (x2 - x1)) END AS xl, CASE WHEN x1 = x2 THEN 1 ELSE greatest((bx * 60 - x1) / (x2 - x1), (bx * 60 + 60 - x1) / (x2 - x1)) END AS xh, CASE WHEN y1 = y2 THEN 0 ELSE least((byy * 60 - y1) / (y2 - y1), (byy * 60 + 60 - y1) / (y2 - y1)) END AS yl, CASE WHEN y1 = y2 THEN 1 ELSE greatest((byy * 60 - y1) / (y2 - y1), (byy * 60 + 60 - y1) / (y2 - y1)) END AS yh FROM c)
SELECT bx, byy AS "by", count(*) AS n, (bx - 0.5) * 60::DOUBLE AS minx, (byy - 0.5) * 60::DOUBLE AS miny, (bx + 1.5) * 60::DOUBLE AS maxx, (byy + 1.5) * 60::DOUBLE AS maxy FROM t WHERE greatest(0, xl, yl) <= least(1, xh, yh) GROUP BY 1, 2"""))
def _(s, d):
    return C.blocks(A.with_points(A.flowpaths(s, d)), 60.0)


@query("cd_prepare", oracle(_SHORT + ", e AS (SELECT * FROM a WHERE id % 4 = 0), p AS (SELECT id, x + 603.5 AS x, y + 64.5 AS y FROM points), t AS (SELECT p.id, x, y, x1, y1, x2, y2, greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t FROM p, e) SELECT 'point' AS kind, count(*) AS n FROM p WHERE id NOT IN (SELECT id FROM t WHERE sqrt(pow(x - x1 - t * (x2 - x1), 2) + pow(y - y1 - t * (y2 - y1), 2)) < 5) UNION ALL SELECT 'vertex', count(*) FROM (SELECT x1, y1 FROM e UNION SELECT x2, y2 FROM e)"))
def _(s, d):
    edges = _short(s, d).filter("id % 4 = 0").withColumn("drainage", F.col("id"))
    points = A.points(s, d).select("id", (F.col("x") + 603.5).alias("x"), (F.col("y") + 64.5).alias("y")).withColumn("z", F.lit(1.0))
    kept, vertices = Z.prepared(points, edges, 5.0, 20.0)
    count = lambda df, n: df.agg(F.count("*").alias("n")).select(F.lit(n).alias("kind"), "n")
    return count(kept, "point").union(count(vertices, "vertex"))


@query("cd_closest_vertex", oracle(", v AS (SELECT id, minx + 0.25 AS x, miny + id % 7 AS y FROM catchments), p AS (SELECT id, x + 600 AS x, y + 60 AS y FROM points), t AS (SELECT p.id, v.id AS vertex, sqrt((p.x - v.x) * (p.x - v.x) + (p.y - v.y) * (p.y - v.y)) AS distance FROM p JOIN v ON abs(p.x - v.x) <= 25 AND abs(p.y - v.y) <= 25) SELECT id, arg_min(vertex, (distance, vertex)) AS vertex, round(min(distance), 6) AS distance FROM t WHERE distance <= 25 GROUP BY 1"))
def _(s, d):
    v = A.catchments(s, d).select("id", (F.col("minx") + 0.25).alias("x"), (F.col("miny") + F.col("id") % 7).alias("y"))
    p = A.points(s, d).select("id", (F.col("x") + 600).alias("x"), (F.col("y") + 60).alias("y"))
    return Z.closest_vertices(p, v, 25.0).select("id", "vertex", F.round("distance", 6).alias("distance"))


@query("cd_block_process", oracle(", b AS (" + _BLOCKS + ") SELECT block || '_0' AS block, CASE WHEN block % 4 = 3 THEN 'DISABLED' WHEN block % 5 = 0 THEN 'FAILEDQA' ELSE 'COMPLETE' END AS state, CASE WHEN block % 4 = 3 THEN 'no elevation points' WHEN block % 5 = 0 THEN '1 segments repeat' END AS message FROM b"))
def _(s, d):
    # some blocks have no points, some have a river twice
    rivers = _rivers(s, d)
    again = rivers.filter("block % 5 = 0 AND drainage LIKE '%_90'").select("block", "x2", "y2", "x1", "y1", "drainage")
    made = Z.block_boundaries(_points(s, d).filter("block % 4 <> 3").select("x", "y", "z"), rivers.union(again), SIDE, 8.0, buffer=0.0)
    return made.filter("state IS NOT NULL").select("block", "state", "message")


@query("cd_build", oracle(", b AS (" + _BLOCKS + ") SELECT block || '_0' AS block, 'R' || block || '_10' AS one, 'R' || block || '_90' AS other, true AS on_ridge FROM b WHERE n >= 30"))
def _(s, d):
    # the two rivers' areas meet along the ridge, as closely as forty points tell
    made = _made(s, d).filter("line IS NOT NULL")
    full = _points(s, d).groupBy("block").agg(F.count("*").alias("n")).filter("n >= 30").select(F.concat(F.col("block").cast("string"), F.lit("_0")).alias("block"))
    x = F.transform("line", lambda p: p[0] - F.floor(p[0] / SIDE) * SIDE)
    near = F.aggregate(x, F.lit(0.0), lambda t, v: t + v) / F.size("line")
    pair = made.select("block", F.least("left_id", "right_id").alias("one"), F.greatest("left_id", "right_id").alias("other"), F.size("line").alias("n"), near.alias("x"))
    whole = pair.groupBy("block", "one", "other").agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("x"))
    return whole.join(full, "block", "left_semi").select("block", "one", "other", F.col("x").between(25, 75).alias("on_ridge"))


def _meshes(s, d, what) -> DataFrame:
    """(block, kind, triangles) of each block's mesh by a kernel of mesh that gives every triangle's kind."""
    import numpy as np
    import pandas as pd

    rows = _points(s, d).select("block", "x", "y", "z", F.lit(None).cast("double").alias("x2"), F.lit(None).cast("double").alias("y2"), F.lit(None).cast("string").alias("drainage"))
    rows = rows.union(_rivers(s, d).select("block", "x1", "y1", F.lit(None).cast("double"), "x2", "y2", "drainage"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["x", "y"])
        e, p = frame[frame["drainage"].notna()], frame[frame["drainage"].isna()]
        mesh = Z.Mesh(p[["x", "y", "z"]].to_numpy(float), e[["x", "y", "x2", "y2"]].to_numpy(float), e["drainage"].tolist(), 8.0)
        kinds = pd.Series(what(mesh)).value_counts()
        area = float(np.abs([X.signed_area(np.vstack([mesh.xy[t], mesh.xy[t[:1]]])) for t in mesh.triangles]).sum())
        return pd.DataFrame({"block": frame["block"].iloc[0], "kind": kinds.index.astype(str), "triangles": kinds.to_numpy(), "area": area})

    return rows.groupBy("block").applyInPandas(run, "block long, kind string, triangles long, area double")


@query("cd_trickle", None)
def _(s, d):
    return _meshes(s, d, lambda mesh: [e[0] if isinstance(e, tuple) else "river" for e in Z.trickled(mesh)])


@query("cd_merge", oracle(", b AS (" + _BLOCKS + ") SELECT block, 'R' || block || '_' || u AS kind FROM b, (VALUES (10), (90)) t(u)"))
def _(s, d):
    # every triangle belongs to one of the two rivers afterwards
    return _meshes(s, d, lambda mesh: Z.connected_areas(mesh, Z.merged(mesh, Z.trickled(mesh)))).select("block", "kind")


@query("cd_extract", None)
def _(s, d):
    return _made(s, d).filter("line IS NOT NULL").select("block", "left_id", "right_id", F.size("line").alias("points"))


@query("cd_medial", oracle(", b AS (" + _BLOCKS + ") SELECT block || '_0' AS block, 'R' || block || '_10' AS one, 'R' || block || '_90' AS other, block * 100 + 50.0::DOUBLE AS x FROM b"))
def _(s, d):
    m = Z.block_medial(_rivers(s, d), SIDE, 8.0)
    own = m.filter(F.substring_index("one", "_", 1) == F.substring_index("other", "_", 1))
    return own.select("block", "one", "other", F.explode("line").alias("p")).select("block", "one", "other", F.round(F.col("p")[0], 6).alias("x")).distinct()


def _sides(s, d) -> DataFrame:
    """Every catchment's four sides with the catchment on their left."""
    ring = X.box_polygon()[0]
    n = F.size(ring) - 1
    line = F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda a, b: F.array(a, b))
    return A.catchments(s, d).select("id", "maxx", "maxy", F.explode(line).alias("line"))


@query("cd_merge_blocks", oracle(" SELECT CAST(id AS VARCHAR) AS drainage, 100.0::DOUBLE AS area, CASE WHEN id % 3 = 0 THEN 2 ELSE 1 END::INT AS kind FROM catchments WHERE ec_type <> 4"))
def _(s, d):
    # lines come from both of the blocks that they lie in; what is bounded inside water is no catchment
    sides = _sides(s, d).select(F.col("id").cast("string").alias("left_id"), F.lit(None).cast("string").alias("right_id"), "line", (F.col("id") % 3 == 0).alias("hydro"))
    again = sides.select("left_id", "right_id", F.reverse("line").alias("line"), "hydro")
    water = A.catchments(s, d).filter("ec_type = 4").select(F.col("id").cast("string").alias("drainage"), X.box_polygon().alias("polygon"))
    return Z.joined_blocks(sides.union(again), water).select("drainage", F.round(X.area_of(F.col("polygon")), 6).alias("area"), "kind")


@query("cd_qa", oracle(" SELECT maxx + 3 AS x, maxy + 1 AS y, 'a boundary ends alone' AS problem FROM catchments WHERE id % 10 = 0 UNION ALL SELECT maxx, maxy, 'a boundary meets a hydro edge''s loose end' FROM catchments WHERE id % 50 = 0"))
def _(s, d):
    lines = _sides(s, d)
    loose = A.catchments(s, d).filter("id % 10 = 0").select(F.array(F.array("maxx", "maxy"), F.array(F.col("maxx") + 3, F.col("maxy") + 1)).alias("line"))
    hydro = A.catchments(s, d).filter("id % 50 = 0").select(F.col("maxx").alias("x1"), F.col("maxy").alias("y1"), (F.col("maxx") + 0.5).alias("x2"), (F.col("maxy") - 0.5 - F.col("id") / 1e6).alias("y2"))
    return Z.checked(lines.select("line").union(loose), hydro)


@query("cd_reproject", oracle(" SELECT id, round(round(x1 * 20037508.342789244::DOUBLE / 180 * 100) / 100, 2) AS x, round(round(ln(tan(radians(y1) / 2 + pi() / 4)) * 20037508.342789244::DOUBLE / pi() * 100) / 100, 2) + 0.0::DOUBLE AS y FROM lined"))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d)).select("id", F.array(F.array("x1", "y1"), F.array("x2", "y2")).alias("line"))
    return C.reprojected(p, G.to_mercator, 100.0).select("id", F.round(F.col("line")[0][0], 2).alias("x"), (F.round(F.col("line")[0][1], 2) + 0.0).alias("y"))


@query("sp_delaunay", None)
def _(s, d):
    # a block is a square of 100 x 100
    block = F.floor(F.col("x") / 100) * 100_000 + F.floor(F.col("y") / 100)
    return C.triangulated(A.points(s, d).withColumn("block", block), "block")


@query("sp_voronoi", None)
def _(s, d):
    block = F.floor(F.col("x") / 100) * 100_000 + F.floor(F.col("y") / 100)
    return C.voronoi(A.points(s, d).withColumn("block", block), "block")
