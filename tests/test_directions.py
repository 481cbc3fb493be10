"""Directions, ranks, names and pourpoints on small networks with known answers."""

import math
import random

import pandas as pd
import pytest

from thalweg.operators import directions as D
from thalweg.operators import network as N
from thalweg.operators import pourpoints as P

EDGE = "id long, from_nexus_id long, to_nexus_id long, length long, known boolean, ef_type int, x1 double, y1 double, x2 double, y2 double"


def net(spark, rows, at=None):
    """Edges (id, a, b, length, known[, ef_type]) between nodes at places; by default on a circle."""
    at = at or {n: (math.cos(n), math.sin(n)) for r in rows for n in r[1:3]}
    full = [(r[0], r[1], r[2], r[3], r[4], r[5] if len(r) > 5 else 1, *map(float, at[r[1]]), *map(float, at[r[2]])) for r in rows]
    return spark.createDataFrame(full, EDGE)


def acyclic(edges):
    left = list(edges)
    while left:
        fed = {b for _, _, b in left}
        keep = [e for e in left if e[1] in fed]
        if len(keep) == len(left):
            return False
        left = keep
    return True


@pytest.mark.parametrize("seed", range(5))
def test_random_networks_get_directions_without_cycles(spark, seed):
    r = random.Random(seed)
    nodes = list(range(1, 26))
    pairs = [(n, r.randrange(1, n)) for n in nodes[1:]] + [(r.choice(nodes), r.choice(nodes)) for _ in range(12)]
    order = {n: r.random() for n in nodes}
    rows = []
    for i, (a, b) in enumerate(p for p in pairs if p[0] != p[1]):
        known = r.random() < 0.25
        if known and order[a] < order[b]:
            a, b = b, a  # known edges follow one order, so they make no cycle
        rows.append((i, a, b, r.randint(1, 9), known))
    edges = net(spark, rows)
    sinks = spark.createDataFrame([(1,)], "id long")
    got = [tuple(x) for x in D.directed(edges, sinks).collect()]
    assert sorted(g[0] for g in got) == [x[0] for x in rows]
    both = {x[0]: {x[1], x[2]} for x in rows}
    assert all({a, b} == both[i] for i, a, b in got)
    assert all((a, b) == (x[1], x[2]) for x in rows if x[4] for i, a, b in got if i == x[0])
    groups = {x.id: x.component for x in N.loop_groups(edges).collect()}
    # what is known may force a cycle over several groups' bridges only if it is one itself; inside groups none comes up
    assert acyclic([g for g in got if groups[g[1]] == groups[g[2]]])


def test_without_known_edges_everything_drains_to_the_sink(spark):
    rows = [(1, 1, 2, 1, False), (2, 2, 3, 1, False), (3, 3, 1, 1, False), (4, 3, 4, 1, False), (5, 4, 5, 1, False), (6, 5, 6, 1, False), (7, 6, 4, 5, False), (8, 5, 7, 1, False), (9, 20, 21, 1, False), (10, 21, 22, 1, False, 3)]
    got = {i: (a, b) for i, a, b in D.directed(net(spark, rows), spark.createDataFrame([(7,)], "id long")).collect()}
    assert got[8] == (5, 7) and got[4] == (3, 4) and got[5] == (4, 5) and got[6] == (6, 5)
    assert acyclic([(i, a, b) for i, (a, b) in got.items()])
    out = {a for a, _ in got.values()}
    assert {n for e in got.values() for n in e} - out == {7, 22}  # the piece without a sink drains to the dead end of its skeleton


def test_known_edges_that_make_a_cycle_are_refused():
    rows = pd.DataFrame([(1, 1, 2, 1, True, 0, 0, 1, 0), (2, 2, 3, 1, True, 1, 0, 1, 1), (3, 3, 1, 1, True, 1, 1, 0, 0)], columns=["id", "a", "b", "length", "known", "x1", "y1", "x2", "y2"])
    with pytest.raises(ValueError, match="cycle"):
        D.direct_group(rows, {1}, 1.0)


def test_nodes_of_loops_are_fed_from_where_water_comes_in():
    # from 1 the way to 9 is short by 2; 4, the farthest from 9, would be a source of its own
    at = {1: (0, 0), 2: (1, 0), 3: (1, 2), 4: (2, 3), 5: (3, 2), 9: (3, 0)}
    pairs = [(1, 2, 1), (2, 9, 1), (2, 3, 5), (3, 4, 9), (4, 5, 9), (5, 9, 5), (1, 3, 6)]
    rows = pd.DataFrame([(k, a, b, n, False, *at[a], *at[b]) for k, (a, b, n) in enumerate(pairs)], columns=["id", "a", "b", "length", "known", "x1", "y1", "x2", "y2"])
    for fed in (None, {1}, {4}, {5}, {1, 5}):
        flip = D.direct_group(rows, {9}, math.inf, fed).set_index("id")["flip"]
        got = [(k, *((b, a) if flip[k] else (a, b))) for k, (a, b, _) in enumerate(pairs)]
        out, into = {a for _, a, _ in got}, {b for *_, b in got}
        assert acyclic(got) and into - out == {9} and (fed is None or out - into <= fed), (fed, got)
        assert fed is not None or out - into == {4}


def test_short_edges_turn_with_their_neighbours_but_close_no_cycle(spark):
    at = {1: (0, 0), 2: (1, 0), 3: (1.1, 0), 4: (2, 0), 5: (1, 1), 6: (1.1, -1)}
    rows = [(1, 1, 2, 10, True), (2, 3, 2, 1, False), (3, 3, 4, 10, True), (4, 5, 2, 10, True), (5, 3, 6, 10, True)]
    assert [x.id for x in D.short_flips(net(spark, rows, at), 2).collect()] == [2]
    assert D.short_flips(net(spark, [*rows[:1], (2, 3, 2, 1, True), *rows[2:]], at), 2).count() == 0
    assert D.short_flips(net(spark, [*rows, (6, 4, 5, 10, True)], at), 2).count() == 0  # 2-3-4-5-2 would be a cycle


def test_straightest_ways_that_meet_themselves_have_no_row(spark):
    rows = [(1, 1, 2, 1, True), (2, 2, 3, 1, True), (3, 3, 1, 1, True), (4, 9, 8, 1, True), (5, 8, 7, 1, True)]
    got = sorted(tuple(x) for x in D.straightest_ways(net(spark, rows), spark.createDataFrame([(1,), (4,)], "id long")).collect())
    assert got == [(4, 0, 4), (4, 1, 5)]


def test_secondary_marks_go_on_downstream(spark):
    at = {1: (0, 0), 2: (1, 0), 3: (2, 0), 4: (2, 1), 5: (3, 1), 6: (4, 0), 7: (5, 0), 8: (3, 2), 9: (5, 1)}
    rows = [(1, 1, 2, 1, True), (2, 2, 3, 1, True), (3, 2, 4, 1, True), (4, 4, 5, 1, True), (5, 5, 6, 1, True), (6, 3, 6, 1, True), (7, 6, 7, 1, True), (8, 8, 5, 1, True, 2)]
    p = net(spark, rows, at)
    width = lambda wide: p.selectExpr("*", f"CAST(CASE id WHEN 2 THEN 1 WHEN 3 THEN {wide} END AS DOUBLE) AS width")
    rank = lambda df: {x.id for x in D.ranked(df).collect() if x.rank == 2}
    # the bend is secondary, and so is what it alone feeds, but for a bank flow; after the meeting of both it ends
    assert rank(p.selectExpr("*", "CAST(NULL AS DOUBLE) AS width")) == {3, 4, 5}
    assert rank(width(50)) == {2, 6} and rank(width(1)) == {3, 4, 5}


def test_names_follow_the_counts_of_flows():
    edges = pd.DataFrame([(1, 1, 2, 5, 1), (2, 2, 3, 5, 1), (3, 2, 4, 50, 2), (4, 9, 2, 1, 1)], columns=["id", "a", "b", "length", "rank"])
    ends = lambda *rows: pd.DataFrame(rows, columns=["node", "name", "way"])
    name = lambda e, own=(): sorted(i for i, _ in D.name_waterbody(edges, e, list(own)))
    assert name(ends(), [7]) == [1, 2]  # the longest primary way
    assert name(ends((9, 7, "in")), [7]) == [2, 4] and name(ends((9, 7, "in"))) == []
    assert name(ends((4, 7, "out")), [7]) == [1, 3]  # the longest of the shortest ways to it
    assert name(ends((1, 7, "in"), (4, 7, "out"))) == [1, 3] and name(ends((9, 7, "in"), (3, 7, "out"))) == [2, 4]
    assert name(ends((1, 7, "in"), (9, 7, "in"), (3, 7, "out"), (4, 7, "out"))) == [1, 2]
    assert name(ends((1, 7, "in"), (9, 7, "in")), [7]) == []


# ---- pourpoints: the tree of texts



def test_sets_of_points_read_as_nested_text(spark):
    sets = lambda *rows: spark.createDataFrame([(list(m), o, h) for m, o, h in rows], "members array<long>, own long, horton long")
    text = lambda *rows: P.relation_tree(sets(*rows))
    assert text(((1,), 1, 1)) == "1"
    # three points: one below a confluence of two
    assert text(((1, 2, 3), 1, 3), ((2,), 2, 2), ((3,), 3, 1)) == "1(x1(3,2))"
    assert text(((7, 4, 6, 1), 1, 4), ((7, 4, 6), 6, 4), ((7, 4), 4, 2), ((7,), 7, 1)) == "1(6(4(7)))"
    assert text(((1, 2, 3, 4), 1, 4), ((2, 3), None, 1), ((4,), 4, 3), ((2,), 2, 2), ((3,), 3, 1)) == "1(x1(x2(3,2),4))"
    assert text(((2, 3, 4, 7), None, 4), ((2, 3), None, 1), ((4, 7), 4, 3), ((7,), 7, 1), ((2,), 2, 2), ((3,), 3, 1)) == "x1(x2(3,2),4(7))"
    assert text(((1, 2, 3, 4, 5, 6, 7), 1, 4), ((5,), 5, 1), ((2, 3, 4, 6, 7), 6, 4), ((2, 3), None, 1), ((4, 7), 4, 2), ((2,), 2, 2), ((3,), 3, 1), ((7,), 7, 1)) == "1(x1(5,6(x2(x3(3,2),4(7)))))"
    assert text(((5,), 5, 1), ((2,), 2, 1)) == "2;5"


def test_point_sets_come_from_the_flow(spark):
    paths = spark.createDataFrame([(i, a, b, 1, None, 1, 1) for i, a, b in ((1, 1, 5), (2, 2, 5), (3, 5, 6), (4, 3, 6), (5, 6, 7), (6, 8, 9))], "id long, from_nexus_id long, to_nexus_id long, length long, name long, rank int, ef_type int")
    points = spark.createDataFrame([(10, 1), (20, 2), (30, 5), (40, 6)], "point long, edge long")
    sets = P.point_sets(paths, points, N.stream_orders(paths).select("id", "horton"))
    got = {(tuple(r.members), r.own) for r in sets.collect()}
    assert got == {((10,), 10), ((20,), 20), ((10, 20), None), ((10, 20, 30), 30), ((40,), 40)}
    assert P.relation_tree(sets) == "30(x1(20,10));40" or P.relation_tree(sets) == "30(x1(10,20));40"


def test_points_slide_down_inside_a_catchment(spark):
    paths = spark.createDataFrame([(1, 1, 2, 100, 1), (2, 2, 3, 100, 1), (3, 3, 4, 100, 1), (4, 4, 5, 200, 1), (5, 9, 5, 200, 1), (6, 5, 6, 200, 1)], "id long, from_nexus_id long, to_nexus_id long, ecatchment_id long, ef_type int")
    types = spark.createDataFrame([(n, "FLOWPATH" if n != 3 else "INFERRED") for n in range(1, 10)], "id long, nexus_type string")
    assert {r.id: r.end for r in P.slide_ends(paths, types).collect()} == {1: 2, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}


def test_points_are_placed_by_their_code(spark):
    cols = "id long, from_nexus_id long, to_nexus_id long, ecatchment_id long, ef_type int"
    paths = spark.createDataFrame([(1, 1, 4, 1, 1), (2, 2, 4, 2, 1), (3, 3, 4, 3, 2), (4, 4, 5, 4, 1)], cols)
    nodes = spark.createDataFrame([(4, 0.0, 0.0), (5, 10.0, 0.0), (1, -9.0, 9.0)], "id long, x double, y double")
    types = spark.createDataFrame([(4, "FLOWPATH"), (5, "TERMINAL_BOUNDARY"), (1, "HEADWATER")], "id long, nexus_type string")
    inflows = spark.createDataFrame([(4, 3, 1), (4, 2, 2), (4, 1, 3)], "node long, id long, place int")
    inside = spark.createDataFrame([(50, 2)], "id long, line long")
    rows = [(10, 1.0, 1.0, 0), (11, 1.0, 1.0, 1), (12, 1.0, 1.0, 2), (13, 1.0, 1.0, 3), (14, 99.0, 99.0, 1), (15, 1.0, 1.0, -1), (16, 1.0, 1.0, 12), (50, 0.0, 0.0, -2), (51, 0.0, 0.0, -2), (17, 10.0, 0.0, 1)]
    got = sorted((r.point, r.edge, r.problem) for r in P.project(spark.createDataFrame(rows, "point long, x double, y double, c int"), paths, inside, nodes, inflows, types, 5.0).collect())
    assert got == sorted([(10, 1, None), (10, 2, None), (11, 2, None), (12, 1, None), (13, None, "no flows"), (14, None, "no node near"), (15, None, "code -1"), (16, None, "code 12"), (50, 2, None), (51, None, "in no catchment"), (17, 4, None)], key=lambda x: (x[0], x[1] or 0))


def test_unknown_outputs_are_refused(spark):
    with pytest.raises(ValueError):
        P.outputs(None, None, None, {"nothing"})
