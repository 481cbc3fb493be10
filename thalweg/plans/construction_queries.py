"""Registered queries of flowpath construction. Waterbodies are the square catchments of type 4; by their id a flow leads in on the left, out on the right, both or neither."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg import adapter as A
from thalweg.adapter import oracle
from thalweg.operators import flowpaths as W
from thalweg.operators import geometry as X
from thalweg.plans.registry import query


def _water(s, d) -> DataFrame:
    return A.catchments(s, d).filter("ec_type = 4").select("id", X.box_polygon().alias("g"), "minx", "miny", "maxx", "maxy", (1000 + F.col("id") % 5).alias("name"))


def _flows(s, d) -> DataFrame:
    w = _water(s, d)
    line = lambda x1, y1, x2, y2: F.array(F.array(x1, y1), F.array(x2, y2))
    minx, miny, maxx = F.col("minx"), F.col("miny"), F.col("maxx")
    into = w.filter("id % 4 IN (0, 1)").select((F.col("id") * 2).alias("id"), line(minx - 3, miny + 4, minx, miny + 4).alias("line"))
    out = w.filter("id % 4 IN (0, 2)").select((F.col("id") * 2 + 1).alias("id"), line(maxx, miny + 3, maxx + 3, miny + 2.5).alias("line"))
    return into.union(out)


_W = ", w AS (SELECT * FROM catchments WHERE ec_type = 4)"
_ENDS = _W + """, p AS (SELECT id AS water, minx AS x1, CASE WHEN id % 4 IN (0, 1) THEN miny + 4 WHEN id % 4 = 2 THEN maxy ELSE miny END AS y1,
maxx AS x2, CASE WHEN id % 4 IN (0, 2) THEN miny + 3 ELSE maxy END AS y2, CASE WHEN id % 4 IN (0, 1) THEN 'INPUT' ELSE 'HEADWATER' END AS k1, CASE WHEN id % 4 IN (0, 2) THEN 'OUTPUT' ELSE 'TERMINAL' END AS k2 FROM w)"""


@query("fc_points", oracle(_ENDS + " SELECT water, x1 AS x, y1 AS y, k1 AS kind, 1 AS n FROM p UNION ALL SELECT water, x2, y2, k2, 1 FROM p UNION ALL SELECT water, NULL, NULL, 'BANK', 2 FROM p"))
def _(s, d):
    w = _water(s, d)
    p = W.with_points(w, W.known_points(w, _flows(s, d), 40.0))
    bank = F.col("kind") == "BANK"
    place = lambda c: F.when(~bank, F.col(c)).alias(c)
    return p.select("water", place("x"), place("y"), "kind").groupBy("water", "x", "y", "kind").agg(F.count("*").cast("int").alias("n"))


def _made(s, d) -> DataFrame:
    w = _water(s, d)
    return W.skeletons(w, W.with_points(w, W.known_points(w, _flows(s, d), 40.0)), 2.0)


@query("fc_skeleton", oracle(_ENDS + " SELECT water, x1, y1, x2, y2 FROM p"))
def _(s, d):
    # one way leads from the one end to the other, in pieces where banks join it
    m = _made(s, d).filter("kind = 'SKELETON'")
    a, b = F.element_at("line", 1), F.element_at("line", -1)
    ends = m.select("water", F.explode(F.array(F.struct(F.round(a[0], 6).alias("x"), F.round(a[1], 6).alias("y"), F.lit(1).alias("out")), F.struct(F.round(b[0], 6).alias("x"), F.round(b[1], 6).alias("y"), F.lit(-1).alias("out")))).alias("e"))
    net = ends.groupBy("water", "e.x", "e.y").agg(F.sum("e.out").alias("out")).filter("out <> 0")
    at = lambda out, c: F.max(F.when(F.col("out") == out, F.col(c)))
    return net.groupBy("water").agg(at(1, "x").alias("x1"), at(1, "y").alias("y1"), at(-1, "x").alias("x2"), at(-1, "y").alias("y2"))


@query("fc_bank", oracle(_W + " SELECT id AS water, 2 AS banks, true AS at_shore FROM w"))
def _(s, d):
    # every bank line begins on the shore
    m = _made(s, d).filter("kind = 'BANK'").join(_water(s, d).withColumnRenamed("id", "water"), "water")
    x, y = F.round(F.element_at("line", 1)[0], 6), F.round(F.element_at("line", 1)[1], 6)
    shore = (x == F.col("minx")) | (x == F.col("maxx")) | (y == F.col("miny")) | (y == F.col("maxy"))
    return m.groupBy("water").agg(F.count_if(shore).cast("int").alias("banks"), F.bool_or(shore).alias("at_shore"))


@query("fc_boundary", oracle(_W + ", b AS (SELECT id, CASE WHEN minx = 0 THEN [[minx, miny], [minx, maxy]] END AS l, miny = 0 AS low FROM w WHERE minx = 0 OR miny = 0) SELECT 1 AS area, id AS water, CASE WHEN low AND l IS NOT NULL THEN 20 ELSE 10 END::DOUBLE AS length, CASE WHEN low AND id % 2 = 0 THEN 'OUT' END AS direction FROM b"))
def _(s, d):
    # the area's lower and left sides run along the catchments', its others far away
    w = _water(s, d)
    area = s.createDataFrame([(1, 0.0, 0.0, 5e6, 5e6)], "id long, minx double, miny double, maxx double, maxy double").withColumn("g", X.box_polygon())
    nodes = w.filter("miny = 0 AND id % 2 = 0").select((F.col("minx") + 5).alias("x"), F.lit(-0.003).alias("y"), F.lit("OUT").alias("direction"))
    runs = W.boundary_edges(area, w, nodes, 20_000.0)
    n = F.size("line") - 1
    size = F.aggregate(F.zip_with(F.slice("line", 1, n), F.slice("line", 2, n), lambda a, b: F.sqrt((b[0] - a[0]) * (b[0] - a[0]) + (b[1] - a[1]) * (b[1] - a[1]))), F.lit(0.0), lambda t, v: t + v)
    return runs.select("area", "water", F.round(size, 6).alias("length"), "direction")


@query("fc_pipeline", oracle(_W + " SELECT id AS water, 1 + CAST(id % 4 IN (0, 1) AS INT) + CAST(id % 4 IN (0, 2) AS INT) AS named_ways, 2 AS banks, true AS one_way, 1000 + id % 5 AS name FROM w"))
def _(s, d):
    # in every waterbody the banks join one way, which has the water's name and goes on in the flows
    w = _water(s, d)
    flows = _flows(s, d)
    names = flows.select("id", (1000 + F.expr("id div 2") % 5).alias("name"))
    made = W.constructed(w.select("id", "g", "name"), flows, 40.0, 2.0, names)
    e = made.withColumn("owner", F.coalesce("water", F.expr("id div 2")))
    flow = e.groupBy("owner").agg(
        F.count_if(F.col("ef_type") == 1).alias("flows"), F.count_if(F.col("ef_type") == 2).alias("bank_edges"), F.min("name").alias("name"), F.min(F.when(F.col("ef_type") == 3, F.coalesce("name", F.lit(-1)))).alias("least"),
        F.count_distinct("from_nexus_id").alias("starts"), F.count("*").alias("edges"),
    )
    shore = e.filter("ef_type = 2").select("owner", F.col("from_nexus_id").alias("n")).join(e.select("owner", F.col("to_nexus_id").alias("n")), ["owner", "n"], "left_anti").groupBy("owner").agg(F.count("*").cast("int").alias("banks"))
    both = flow.join(shore, "owner")
    return both.select(F.col("owner").alias("water"), (1 + F.col("flows")).cast("int").alias("named_ways"), "banks", (F.col("starts") == F.col("edges")).alias("one_way"), F.when(F.col("least") == F.col("name"), F.col("name")).alias("name"))


_TREE = " SELECT id, from_nexus_id, to_nexus_id, 1 AS rank, NULL::BIGINT AS name FROM flowpaths WHERE rank = 1"


@query("fc_dir_rank_name", oracle(_TREE))
def _(s, d):
    # edges that exist come with half of them turned; in a forest none is secondary
    p = A.with_points(A.flowpaths(s, d)).filter("rank = 1")
    back = F.col("id") % 2 == 0
    swap = lambda a, b: F.when(back, F.col(b)).otherwise(F.col(a)).alias(a)
    turned = p.select("id", swap("from_nexus_id", "to_nexus_id"), swap("to_nexus_id", "from_nexus_id"), "length", F.lit(1).alias("ef_type"), swap("x1", "x2"), swap("y1", "y2"), swap("x2", "x1"), swap("y2", "y1"), (~back).alias("known"))
    return W.direct_rank_name(turned, s.range(8, 16)).select("id", "from_nexus_id", "to_nexus_id", "rank", "name")
