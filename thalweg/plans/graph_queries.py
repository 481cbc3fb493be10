"""Registered queries of directions, ranks, pieces and pourpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg import adapter as A
from thalweg.adapter import oracle
from thalweg.operators import construct as C
from thalweg.operators import directions as D
from thalweg.operators import network as N
from thalweg.operators import pourpoints as P
from thalweg.plans.hydro_queries import _DIST, _DRAINED, _POINTS, _ROOT, _owned, _pp
from thalweg.plans.registry import query

# ---- loops: secondary flowpaths close loops in the trees they stay in

_NET = ", own AS (SELECT id, from_nexus_id AS a, to_nexus_id AS b, length FROM flowpaths WHERE rank = 2), ends AS (SELECT id, a, b, " + _ROOT.replace("id", "a") + " AS ra, " + _ROOT.replace("id", "b") + " AS rb FROM own), same AS (SELECT id, a, b FROM ends WHERE ra = rb), up(id, side, node) AS (SELECT id, 0, a FROM same UNION ALL SELECT id, 1, b FROM same UNION ALL SELECT id, side, node // 2 FROM up WHERE node >= 16), cov AS (SELECT DISTINCT node FROM (SELECT id, node FROM up WHERE node >= 16 GROUP BY 1, 2 HAVING count(*) = 1))"


def _net(s, d) -> DataFrame:
    """The primary trees and the secondary flowpaths that stay in one of them."""
    p = A.with_points(A.flowpaths(s, d))
    at = lambda c: F.expr(f"shiftright({c}, CAST(floor(log2({c})) AS INT) - 3)")
    return p.filter((F.col("rank") == 1) | (at("from_nexus_id") == at("to_nexus_id")))


@query("g_bridges", oracle(_NET + " SELECT f.id FROM flowpaths f WHERE rank = 1 AND from_nexus_id NOT IN (SELECT node FROM cov)", recursive=True))
def _(s, d):
    return N.bridges(_net(s, d))


@query("g_two_edge_partition", oracle(_NET + ", n AS (SELECT from_nexus_id AS id FROM flowpaths WHERE rank = 1 UNION SELECT to_nexus_id FROM flowpaths WHERE rank = 1), climb(id, top) AS (SELECT id, id FROM n UNION ALL SELECT id, top // 2 FROM climb WHERE top IN (SELECT node FROM cov)) SELECT id, min(top)::BIGINT AS component FROM climb GROUP BY 1", recursive=True))
def _(s, d):
    return N.loop_groups(_net(s, d))


def _unknown(df: DataFrame, known: str = "false") -> DataFrame:
    return df.withColumn("known", F.expr(known))


@query("g_tree_direction", oracle(" SELECT id, CASE WHEN id % 2 = 0 AND id % 5 = 0 THEN to_nexus_id ELSE from_nexus_id END AS from_nexus_id, CASE WHEN id % 2 = 0 AND id % 5 = 0 THEN from_nexus_id ELSE to_nexus_id END AS to_nexus_id FROM flowpaths WHERE rank = 1"))
def _(s, d):
    # those of even ids come turned; where that is said to be known they stay so
    p = A.flowpaths(s, d).filter("rank = 1")
    even = F.col("id") % 2 == 0
    turned = p.select("id", F.when(even, F.col("to_nexus_id")).otherwise(F.col("from_nexus_id")).alias("from_nexus_id"), F.when(even, F.col("from_nexus_id")).otherwise(F.col("to_nexus_id")).alias("to_nexus_id"))
    return D.trees_directed(_unknown(turned, "id % 5 = 0"), s.range(8, 16))


@query("g_loop_direction", oracle(_NET + " SELECT count(*) AS edges, 0 AS left_after_peeling, count(*) AS known_kept FROM (SELECT id FROM same UNION ALL SELECT from_nexus_id FROM flowpaths WHERE rank = 1 AND from_nexus_id IN (SELECT node FROM cov))", recursive=True))
def _(s, d):
    # all edges of loops get a direction, no cycle comes up, and what is known stays
    net = _unknown(_net(s, d), "id % 3 = 0")
    got = D.loops_directed(net, s.range(8, 16))
    stays = got.join(net.filter("known").select("id", F.col("from_nexus_id").alias("was")), "id", "left").agg(F.count("*").alias("edges"), F.count_if(F.col("was").isNull() | (F.col("was") == F.col("from_nexus_id"))).alias("known_kept"))
    return stays.select("edges", F.lit(N.peel(got).count()).cast("int").alias("left_after_peeling"), "known_kept")


@query("fc_direction", oracle(" SELECT id, from_nexus_id, to_nexus_id FROM flowpaths WHERE rank = 1 AND id % 8 < 4"))
def _(s, d):
    # a forest of which half of the edges come turned; pieces cut off from the outlets find a sink of their own
    p = _unknown(A.with_points(A.flowpaths(s, d)).filter("rank = 1"), "id % 8 < 4")
    return D.directed(p, s.range(8, 16)).filter("id % 8 < 4")


@query("g_dijkstra", oracle(", r(id, distance, edge, next) AS (SELECT o_orderkey, 0::BIGINT, NULL::BIGINT, NULL::BIGINT FROM orders WHERE o_orderkey BETWEEN 8 AND 15 UNION ALL SELECT f.from_nexus_id, r.distance + f.length, f.id, r.id FROM r JOIN flowpaths f ON f.to_nexus_id = r.id AND f.rank = 1 AND f.id % 50 <> 0) SELECT id, distance, edge, next FROM r", recursive=True))
def _(s, d):
    # known edges with ids divisible by 50 run upstream, so no way leads down them
    p = A.flowpaths(s, d).filter("rank = 1")
    up = F.col("id") % 50 == 0
    turned = p.select("id", "length", F.when(up, F.col("to_nexus_id")).otherwise(F.col("from_nexus_id")).alias("from_nexus_id"), F.when(up, F.col("from_nexus_id")).otherwise(F.col("to_nexus_id")).alias("to_nexus_id"))
    return D.shortest_ways(_unknown(turned, "id % 50 = 0 OR id % 2 = 0"), s.range(8, 16))


@query("g_dijkstra_path", oracle(", r(start, step, id) AS (SELECT o_orderkey, 0, o_orderkey FROM orders WHERE o_orderkey % 20 = 0 AND o_orderkey >= 16 UNION ALL SELECT start, step + 1, id // 2 FROM r WHERE id >= 16) SELECT start, step, id, CASE WHEN id >= 16 THEN id END AS edge FROM r", recursive=True))
def _(s, d):
    p = A.flowpaths(s, d).filter("rank = 1")
    starts = p.filter("id % 20 = 0").select(F.col("from_nexus_id").alias("id"))
    return D.way_from(D.shortest_ways(_unknown(p), s.range(8, 16)), starts)


_STRAIGHT = """, t AS (SELECT a.id, b.id AS next, round(CASE WHEN abs(atan2(a.y2 - a.y1, a.x2 - a.x1) - atan2(b.y2 - b.y1, b.x2 - b.x1)) > pi() THEN 2 * pi() - abs(atan2(a.y2 - a.y1, a.x2 - a.x1) - atan2(b.y2 - b.y1, b.x2 - b.x1)) ELSE abs(atan2(a.y2 - a.y1, a.x2 - a.x1) - atan2(b.y2 - b.y1, b.x2 - b.x1)) END, 6) AS turn FROM lined a JOIN lined b ON a.to_nexus_id = b.from_nexus_id), nx AS (SELECT id, first(next ORDER BY turn, next) AS next FROM t GROUP BY 1)"""


@query("g_straightest_path", oracle(_STRAIGHT + ", r(start, step, id) AS (SELECT id, 0, id FROM flowpaths WHERE id % 20 = 0 UNION ALL SELECT start, step + 1, next FROM r JOIN nx USING (id)) SELECT start, step, id FROM r", recursive=True))
def _(s, d):
    p = A.with_points(A.flowpaths(s, d))
    return D.straightest_ways(p, p.filter("id % 20 = 0").select("id"))


@query("g_no_sink", oracle(f""", e AS (SELECT from_nexus_id AS id, 0 AS down, CAST(ef_type = 3 AS INT) AS sk FROM flowpaths WHERE rank = 1 UNION ALL SELECT to_nexus_id, CAST(id % 500 = 20 AS INT), CAST(ef_type = 3 AS INT) FROM flowpaths WHERE rank = 1),
n AS (SELECT id, count(*) AS d, max(down) AS down, max(sk) AS sk, {_ROOT} AS c FROM e GROUP BY 1), w AS (SELECT c, id, CASE WHEN d = 1 AND down = 1 THEN 1 WHEN d = 1 AND sk = 1 THEN 2 WHEN d = 1 THEN 3 ELSE 4 END AS why FROM n WHERE c NOT IN (9, 12)) SELECT c AS component, arg_min(id, (why, id)) AS id, min(why)::INT AS why FROM w GROUP BY 1"""))
def _(s, d):
    p = _unknown(A.flowpaths(s, d).filter("rank = 1"), "id % 500 = 20")
    return D.chosen_sinks(p, s.createDataFrame([(9,), (12,)], "id long"))


@query("g_sink_points", oracle(", p AS (SELECT *, id % 4 <> 0 AS known FROM flowpaths WHERE ef_type <> 2), e AS (SELECT from_nexus_id AS id, 1 AS bad FROM p UNION ALL SELECT to_nexus_id, CAST(NOT known AS INT) FROM p), t AS (SELECT id, sum(bad) AS bad, count(*) AS d FROM e GROUP BY 1) SELECT id FROM t WHERE bad = 0 OR id IN (8, 9, 10) OR id % 37 = 0 OR d = 1 AND id % 41 = 0"))
def _(s, d):
    p = A.flowpaths(s, d).withColumn("direction_known", F.when(F.col("id") % 4 != 0, 1).otherwise(-1))
    nodes = A.table(s, d, "orders").select(F.col("o_orderkey").alias("id"))
    return N.sink_points(p, s.createDataFrame([(8,), (9,), (10,)], "id long"), nodes.filter("id % 37 = 0"), nodes.filter("id % 41 = 0"))


@query("g_short_edge_flip", oracle(""", e AS (SELECT id, from_nexus_id AS a, to_nexus_id AS b, length, atan2(y2 - y1, x2 - x1) AS t FROM lined WHERE rank = 1), dg AS (SELECT n FROM (SELECT a AS n FROM e UNION ALL SELECT b FROM e) GROUP BY 1 HAVING count(*) >= 3),
sh AS (SELECT * FROM e WHERE id % 7 <> 0 AND length < 8000000 AND a IN (SELECT n FROM dg) AND b IN (SELECT n FROM dg)),
ar AS (SELECT a AS n, id, t FROM e UNION ALL SELECT b, id, t FROM e), nb AS (SELECT sh.id, sh.t, cos(o.t) AS cx, sin(o.t) AS cy FROM sh JOIN ar o ON o.n = sh.a AND o.id <> sh.id UNION ALL SELECT sh.id, sh.t, cos(o.t), sin(o.t) FROM sh JOIN ar o ON o.n = sh.b AND o.id <> sh.id)
SELECT id FROM nb GROUP BY id, t HAVING round(sum(cx) * cos(t) + sum(cy) * sin(t), 9) < 0"""))
def _(s, d):
    # no flip closes a cycle in a forest
    return D.short_flips(_unknown(A.with_points(A.flowpaths(s, d)).filter("rank = 1"), "id % 7 = 0"), 8_000_000)


@query("g_rank_width", oracle(""", f AS (SELECT from_nexus_id AS n FROM lined GROUP BY 1 HAVING count(*) > 1), w AS (SELECT *, CASE WHEN from_nexus_id % 2 = 0 THEN id % 9 + 1 END AS width FROM lined),
sc AS (SELECT o.from_nexus_id AS n, o.id, o.width, round(coalesce(max(CASE WHEN abs(atan2(o.y2 - o.y1, o.x2 - o.x1) - atan2(i.y1 - i.y2, i.x1 - i.x2)) > pi() THEN 2 * pi() - abs(atan2(o.y2 - o.y1, o.x2 - o.x1) - atan2(i.y1 - i.y2, i.x1 - i.x2)) ELSE abs(atan2(o.y2 - o.y1, o.x2 - o.x1) - atan2(i.y1 - i.y2, i.x1 - i.x2)) END), 0) / pi(), 6) AS score FROM w o JOIN f ON o.from_nexus_id = f.n LEFT JOIN lined i ON i.to_nexus_id = o.from_nexus_id GROUP BY 1, 2, 3),
s2 AS (SELECT n, id, round(CASE WHEN width IS NULL THEN score ELSE 0.7::DOUBLE * width / sum(width) OVER (PARTITION BY n) + 0.3::DOUBLE * score END, 6) AS score FROM sc), best AS (SELECT n, first(id ORDER BY score DESC, id) AS best FROM s2 GROUP BY 1),
m0 AS (SELECT l.id FROM lined l JOIN best b ON l.from_nexus_id = b.n WHERE b.best <> l.id)
SELECT id, CASE WHEN id IN (SELECT id FROM m0) THEN 2 ELSE 1 END AS rank FROM lined WHERE id IN (SELECT id FROM lined WHERE from_nexus_id IN (SELECT n FROM f))"""))
def _(s, d):
    # the flowpaths out of forks; how marks go on from there is for the tests
    p = A.with_points(A.flowpaths(s, d)).withColumn("width", F.when(F.col("from_nexus_id") % 2 == 0, F.col("id") % 9 + 1))
    forks = p.groupBy("from_nexus_id").agg(F.count("*").alias("n")).filter("n > 1")
    return D.ranked(p).join(p.join(forks, "from_nexus_id", "left_semi").select("id"), "id", "left_semi")


@query("g_classify_catchment", oracle(""", nt AS (SELECT id, CASE WHEN i = 0 AND o = 1 AND bo = 1 THEN 'BANK' ELSE 'OTHER' END AS t FROM (SELECT id, sum(i) AS i, sum(o) AS o, sum(b * o) AS bo FROM (SELECT from_nexus_id AS id, 0 AS i, 1 AS o, CAST(ef_type = 2 AS INT) AS b FROM flowpaths UNION ALL SELECT to_nexus_id, 1, 0, CAST(ef_type = 2 AS INT) FROM flowpaths) GROUP BY 1)),
fl AS (SELECT from_nexus_id AS id, count(*) AS n FROM flowpaths WHERE id % 3 <> 0 GROUP BY 1), tc AS (SELECT from_nexus_id AS id, from_nexus_id AS nexus FROM flowpaths WHERE id % 11 <> 0 UNION SELECT to_nexus_id, from_nexus_id FROM flowpaths WHERE id % 13 = 0),
tt AS (SELECT tc.id, count(*) AS n, count(*) FILTER (t = 'BANK') AS banks, min(nexus) FILTER (t = 'BANK') AS nexus FROM tc LEFT JOIN nt ON nt.id = nexus GROUP BY 1), k AS (SELECT c.id, CASE WHEN fl.n IS NOT NULL THEN CASE WHEN ec_type = 1 THEN 'REACH' ELSE CAST(ec_type AS VARCHAR) END WHEN tt.n IS NULL THEN 'EMPTY' WHEN banks = 1 THEN 'BANK' ELSE 'UNKNOWN' END AS kind, tt.nexus FROM catchments c LEFT JOIN fl USING (id) LEFT JOIN tt USING (id))
SELECT id, kind, CASE WHEN kind = 'BANK' THEN nexus END AS nexus FROM k"""))
def _(s, d):
    p = A.flowpaths(s, d)
    c = A.catchments(s, d).select("id", F.when(F.col("ec_type") != 1, F.col("ec_type")).alias("ec_type"))
    flows = p.filter("id % 3 <> 0").select(F.col("from_nexus_id").alias("catchment"))
    touches = p.filter("id % 11 <> 0").select(F.col("from_nexus_id").alias("catchment"), F.col("from_nexus_id").alias("nexus")).union(p.filter("id % 13 = 0").select("to_nexus_id", "from_nexus_id")).distinct()
    return D.classified_catchments(c, flows, touches, N.classify_nexuses(p, s.createDataFrame([], "id long")))


@query("g_subgraph", oracle(f" SELECT id FROM flowpaths WHERE rank = 1 AND {_ROOT.replace('id', 'from_nexus_id')} = 11"))
def _(s, d):
    p = A.flowpaths(s, d).filter("rank = 1")
    return D.subgraph(p, p.agg(F.max(F.when(F.expr("shiftright(from_nexus_id, CAST(floor(log2(from_nexus_id)) AS INT) - 3)") == 11, F.col("from_nexus_id"))).alias("id"))).select("id")


@query("g_longest_primary", oracle(f", r(id, distance) AS (SELECT o_orderkey, 0::BIGINT FROM orders WHERE o_orderkey BETWEEN 8 AND 15 UNION ALL SELECT f.from_nexus_id, r.distance + f.length FROM r JOIN flowpaths f ON f.to_nexus_id = r.id AND f.rank = 1) SELECT {_ROOT} AS component, arg_max(id, (distance, -id)) AS id, max(distance) AS distance FROM r GROUP BY 1", recursive=True))
def _(s, d):
    p = A.flowpaths(s, d).filter("rank = 1")
    links = p.select(F.col("from_nexus_id").alias("src"), F.col("to_nexus_id").alias("dst"), "length")
    return D.longest_way(N.shortest_distances(links, s.range(8, 16)), N.connected_components(p, "from_nexus_id", "to_nexus_id"))


@query("g_collapse_short", oracle(""", dg AS (SELECT n FROM (SELECT from_nexus_id AS n FROM flowpaths WHERE rank = 1 UNION ALL SELECT to_nexus_id FROM flowpaths WHERE rank = 1) GROUP BY 1 HAVING count(*) > 2),
k AS (SELECT id FROM flowpaths WHERE rank = 1 AND id BETWEEN 64 AND 127 AND id % 5 <> 0 AND from_nexus_id IN (SELECT n FROM dg) AND to_nexus_id IN (SELECT n FROM dg))
SELECT f.id, f.from_nexus_id, CASE WHEN f.to_nexus_id IN (SELECT id FROM k) THEN f.to_nexus_id // 2 ELSE f.to_nexus_id END AS to_nexus_id, f.length FROM flowpaths f WHERE rank = 1 AND id NOT IN (SELECT id FROM k)"""))
def _(s, d):
    # one layer of the trees is short; every fifth of it is known
    p = A.flowpaths(s, d).filter("rank = 1")
    marked = p.withColumn("length", F.when(F.col("id").between(64, 127), -1).otherwise(F.col("length")))
    out = D.contracted(_unknown(marked, "id % 5 = 0"), 0)
    return out.join(p.select("id", F.col("length").alias("was")), "id").select("id", "from_nexus_id", "to_nexus_id", F.col("was").alias("length"))


@query("g_aoi_groups", oracle(""", links AS (SELECT DISTINCT a.aoi_id AS x, b.aoi_id AS y FROM flowpaths a JOIN flowpaths b ON a.to_nexus_id = b.from_nexus_id WHERE a.rank = 1 AND b.rank = 1 AND a.aoi_id <> b.aoi_id),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links), r(x, y) AS (SELECT aoi_id, aoi_id FROM aois UNION SELECT r.x, b.y FROM r JOIN both_ways b ON r.y = b.x)
SELECT x AS aoi_id, min(y) AS component FROM r GROUP BY 1""", recursive=True))
def _(s, d):
    from thalweg.operators import relational as Q

    comp = N.connected_components(Q.area_links(A.flowpaths(s, d))).withColumnRenamed("id", "aoi_id")
    return A.aois(s, d).join(comp, "aoi_id", "left").select("aoi_id", F.coalesce("component", "aoi_id").alias("component"))


@query("g_trim", oracle(", keep AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 100 = 17 AND o_orderkey >= 16), up(id) AS (SELECT id FROM keep UNION SELECT id // 2 FROM up WHERE id >= 16), outlets AS (SELECT 8 AS id UNION SELECT 11) SELECT f.id, from_nexus_id, to_nexus_id FROM flowpaths f WHERE rank = 1 AND " + _ROOT.replace("id", "from_nexus_id") + " IN (8, 11) AND from_nexus_id IN (SELECT id FROM up)", recursive=True))
def _(s, d):
    # of two trees the ways from kept nodes to the kept outlets stay
    p = A.flowpaths(s, d).filter("rank = 1").filter(F.expr("shiftright(from_nexus_id, CAST(floor(log2(from_nexus_id)) AS INT) - 3)").isin(8, 11))
    keep = A.table(s, d, "orders").filter("o_orderkey % 100 = 17 AND o_orderkey >= 16").select(F.col("o_orderkey").alias("id"))
    return N.trim(p, keep.union(s.createDataFrame([(8,), (11,)], "id long")))


@query("g_degree2_merge", oracle(" SELECT from_nexus_id AS first, to_nexus_id AS last, CASE WHEN id % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS n, length FROM flowpaths"))
def _(s, d):
    # the flowpaths of every third id come in two halves
    return N.merge_chains(A.halved(A.flowpaths(s, d), "id % 3 = 0"))


@query("g_name_skeleton", oracle(", w AS (SELECT id FROM catchments WHERE ec_type = 4) SELECT id * 10 + k AS id, 1000 + id % 5 AS name FROM w, range(0, 3) t(k) WHERE id % 3 = 0 AND k < 2 OR id % 3 = 1 AND k IN (0, 1) OR id % 3 = 2 AND k IN (0, 2)"))
def _(s, d):
    # in every waterbody one way leads in and forks to two ways out; which are named depends on the id
    w = A.catchments(s, d).filter("ec_type = 4").select(F.col("id").alias("water"))
    edge = lambda k, a, b, n, rank: F.struct((F.col("water") * 10 + k).alias("id"), F.lit(a).cast("long").alias("from_nexus_id"), F.lit(b).cast("long").alias("to_nexus_id"), F.lit(n).cast("long").alias("length"), F.lit(rank).alias("rank"))
    edges = w.select("water", F.explode(F.array(edge(0, 1, 2, 5, 1), edge(1, 2, 3, 7, 1), edge(2, 2, 4, 9, 2))).alias("e")).select("water", "e.*")
    name = (1000 + F.col("water") % 5).alias("name")
    end = lambda node, way: F.struct(F.lit(node).cast("long").alias("node"), F.lit(way).alias("way"))
    third = F.col("water") % 3
    ends = w.select("water", name, F.explode(F.when(third == 1, F.array(end(1, "in"))).when(third == 2, F.array(end(4, "out"), end(1, "in"))).otherwise(F.array().cast("array<struct<node:bigint,way:string>>"))).alias("e"))
    return D.named_skeletons(edges, ends.select("water", "e.node", "name", "e.way"), w.select("water", name))


# ---- pourpoints


@query("pp_distance_min", oracle(_DIST + ' SELECT a AS "from", b AS "to", least FROM dist UNION ALL SELECT b, a, -least FROM dist', recursive=True))
def _(s, d):
    return P.signed(P.distances(A.flowpaths(s, d), _pp(s)), "least")


@query("pp_distance_max", oracle(_DIST + ' SELECT a AS "from", b AS "to", most FROM dist UNION ALL SELECT b, a, -most FROM dist', recursive=True))
def _(s, d):
    return P.signed(P.distances(A.flowpaths(s, d), _pp(s)), "most")


@query("pp_relationship_tree", oracle(f", {_POINTS}, pw(point, edge) AS (SELECT point, edge FROM point UNION ALL SELECT point, f.id FROM pw JOIN flowpaths e ON e.id = edge JOIN flowpaths f ON f.from_nexus_id = e.to_nexus_id AND f.rank = 1 AND f.ef_type <> 2), st AS (SELECT edge, list_sort(list(point)) AS members, min(point) FILTER (point = edge) AS own FROM pw GROUP BY 1) SELECT members, max(own) AS own FROM st GROUP BY 1", recursive=True))
def _(s, d):
    # the sets of points whose water flows together; the text that they make is for the tests
    p = A.flowpaths(s, d)
    return P.point_sets(p, _pp(s), N.stream_orders(p).select("id", "horton")).select("members", "own")


_PIECE_SETS = _DRAINED + ", marks AS (SELECT catchment, list_sort(list(point)) AS m FROM dr GROUP BY 1), ow AS (SELECT catchment, min(point) AS point FROM un GROUP BY 1)"


@query("pp_partition", oracle(_PIECE_SETS + """, fl AS (SELECT DISTINCT a.from_nexus_id AS up, b.from_nexus_id AS down FROM flowpaths a JOIN flowpaths b ON a.to_nexus_id = b.from_nexus_id WHERE a.from_nexus_id <> b.from_nexus_id),
lk AS (SELECT up, down, mu.m <> md.m AS change FROM fl JOIN marks mu ON mu.catchment = up JOIN marks md ON md.catchment = down), st AS (SELECT DISTINCT down FROM lk WHERE change),
sm AS (SELECT up AS x, down AS y FROM lk JOIN ow a ON a.catchment = up JOIN ow b ON b.catchment = down WHERE a.point = b.point AND down NOT IN (SELECT down FROM st)
  UNION SELECT a.up, b.up FROM lk a JOIN lk b ON a.down = b.down JOIN ow p ON p.catchment = a.up JOIN ow q ON q.catchment = b.up WHERE p.point = q.point AND a.up <> b.up AND a.down IN (SELECT down FROM st)),
bw AS (SELECT x, y FROM sm UNION SELECT y, x FROM sm), top(x, y) AS (SELECT catchment, catchment FROM ow UNION SELECT t.x, bw.y FROM top t JOIN bw ON t.y = bw.x)
SELECT ow.point, c.piece, ow.catchment FROM ow JOIN (SELECT x AS catchment, min(y) AS piece FROM top GROUP BY 1) c USING (catchment)""", recursive=True))
def _(s, d):
    return P.partition(_owned(s, d), _pp(s), _pp(s).select("point", F.col("point").alias("place")))


@query("pp_partition_relation", oracle(", pc AS (SELECT id, id % 6 AS piece FROM (SELECT DISTINCT from_nexus_id AS id FROM flowpaths) WHERE id < 400), lk AS (SELECT DISTINCT a.piece AS x, b.piece AS y FROM flowpaths f JOIN pc a ON a.id = f.from_nexus_id JOIN flowpaths g ON g.from_nexus_id = f.to_nexus_id JOIN pc b ON b.id = g.from_nexus_id WHERE a.piece <> b.piece), r(x, y) AS (SELECT x, y FROM lk UNION SELECT r.x, lk.y FROM r JOIN lk ON r.y = lk.x) SELECT DISTINCT x AS \"from\", y AS \"to\", 1 AS relation FROM r WHERE x <> y UNION ALL SELECT DISTINCT y, x, -1 FROM r WHERE x <> y", recursive=True))
def _(s, d):
    p = _owned(s, d)
    pieces = p.select(F.col("ecatchment_id").alias("catchment")).distinct().filter("catchment < 400").withColumn("piece", F.col("catchment") % 6)
    return P.piece_relations(p, pieces)


@query("pp_project", oracle(""", n AS (SELECT DISTINCT from_nexus_id AS id, x1 AS x, y1 AS y FROM lined UNION SELECT to_nexus_id, x2, y2 FROM lined), pt AS (SELECT id AS point, x, y, CAST(id % 13 - 2 AS INT) AS c FROM points),
ty AS (SELECT id, CASE WHEN i = 0 AND o = 1 AND bo = 1 THEN 'BANK' ELSE 'OTHER' END AS t FROM (SELECT id, sum(i) AS i, sum(o) AS o, sum(b * o) AS bo FROM (SELECT from_nexus_id AS id, 0 AS i, 1 AS o, CAST(ef_type = 2 AS INT) AS b FROM flowpaths UNION ALL SELECT to_nexus_id, 1, 0, CAST(ef_type = 2 AS INT) FROM flowpaths) GROUP BY 1)),
nd AS (SELECT point, first(n.id ORDER BY sqrt((n.x - pt.x) * (n.x - pt.x) + (n.y - pt.y) * (n.y - pt.y)), n.id) AS node FROM pt JOIN n ON true JOIN ty ON ty.id = n.id AND t <> 'BANK' WHERE c BETWEEN 0 AND 9 AND sqrt((n.x - pt.x) * (n.x - pt.x) + (n.y - pt.y) * (n.y - pt.y)) <= 60 GROUP BY 1),
fl AS (SELECT to_nexus_id AS node, id AS edge, ef_type FROM flowpaths WHERE ef_type <> 2), cn AS (SELECT node, count(*) AS flows FROM fl GROUP BY 1)
SELECT pt.point, count(*) AS rows, count(*) FILTER (CASE WHEN c < 0 OR c > 9 THEN true WHEN nd.node IS NULL THEN true WHEN c = 0 THEN fl.edge IS NULL ELSE coalesce(cn.flows, 0) < c END) AS problems FROM pt LEFT JOIN nd USING (point) LEFT JOIN cn USING (node) LEFT JOIN fl ON fl.node = nd.node AND pt.c = 0 WHERE c <> -2 AND NOT coalesce(c > 0 AND c <= 9 AND nd.node < 16, false) GROUP BY 1"""))
def _(s, d):
    paths = A.with_points(_owned(s, d))
    nodes = paths.select(F.col("from_nexus_id").alias("id"), F.col("x1").alias("x"), F.col("y1").alias("y")).union(paths.select("to_nexus_id", "x2", "y2")).distinct()
    points = A.points(s, d).select(F.col("id").alias("point"), "x", "y", (F.col("id") % 13 - 2).cast("int").alias("c"))
    inside = s.createDataFrame([], "id long, line long")
    types = N.classify_nexuses(paths, s.createDataFrame([], "id long"))
    found = P.project(points, paths, inside, nodes, C.inflow_order(paths), types, 60.0)
    # outlets have no outflow to count from
    from thalweg.operators.spatial import nearest

    usable = nodes.join(types.filter("nexus_type <> 'BANK'").select("id"), "id", "left_semi")
    low = nearest(points.filter("c > 0 AND c <= 9").select(F.col("point").alias("id"), "x", "y"), usable, 1, 60.0).filter("target < 16").select(F.col("id").alias("point"))
    kept = found.join(points.filter("c <> -2").select("point"), "point", "left_semi").join(low, "point", "left_anti")
    return kept.groupBy("point").agg(F.count("*").alias("rows"), F.count_if(F.col("problem").isNotNull()).alias("problems"))


@query("pp_outputs", oracle(_DRAINED + " SELECT 'c' AS output, count(*) AS n FROM un UNION ALL SELECT 'sc', count(*) FROM (SELECT * FROM dr EXCEPT SELECT * FROM un)", recursive=True))
def _(s, d):
    made = P.outputs(_owned(s, d), _pp(s), _pp(s).select("point", F.col("point").alias("place")), {"c", "sc"})
    count = lambda n: made[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("output"), "n")
    return count("c").union(count("sc"))
