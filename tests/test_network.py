import numpy as np
import pandas as pd
import pytest

from thalweg.operators import network as N
from thalweg.operators import pourpoints as P
from thalweg.operators.components import connected_components

#: id: (from, to, length, name); a network of 17 flowpaths whose orders are known.
EDGES = {
    1: (3, 11, 2, None), 2: (4, 11, 3, 1), 3: (11, 12, 9, 1), 4: (1, 10, 5, None), 5: (2, 10, 6, None), 6: (10, 12, 8, None), 7: (12, 16, 1, 1), 8: (5, 16, 6, None), 9: (16, 17, 2, None),
    10: (6, 13, 8, None), 11: (7, 13, 7, 2), 12: (13, 15, 5, 2), 13: (8, 14, 1, None), 14: (9, 14, 2, None), 15: (14, 15, 2, None), 16: (15, 17, 3, 2), 17: (17, 18, 3, 2),
}
SAME = {
    "strahler": [1, 1, 2, 1, 1, 2, 3, 1, 3, 1, 1, 2, 1, 1, 2, 3, 4],
    "shreve": [1, 1, 2, 1, 1, 2, 4, 1, 5, 1, 1, 2, 1, 1, 2, 4, 9],
    "max_uplength": [0, 0, 3, 0, 0, 6, 14, 0, 15, 0, 0, 8, 0, 0, 2, 13, 17],
}
BY_LENGTH = {"mainstem_seq": [1, 2, 1, 1, 5, 4, 3, 1, 2, 3, 1, 2, 1, 2, 1, 1, 1], "hack": [3, 2, 2, 2, 1, 1, 1, 2, 1, 2, 3, 2, 4, 3, 3, 2, 1], "horton": [1, 2, 2, 1, 4, 4, 4, 1, 4, 3, 1, 3, 1, 2, 2, 3, 4]}
BY_NAME = {"mainstem_seq": [1, 4, 3, 1, 2, 1, 2, 1, 1, 1, 4, 3, 1, 2, 1, 2, 1], "hack": [3, 2, 2, 4, 3, 3, 2, 3, 2, 2, 1, 1, 3, 2, 2, 1, 1], "horton": [1, 3, 3, 1, 2, 2, 3, 1, 3, 1, 4, 4, 1, 2, 2, 4, 4]}
PATHS = "id long, from_nexus_id long, to_nexus_id long, length long, name long, rank int, ef_type int"


def paths(spark, extra=()):
    return spark.createDataFrame([(i, a, b, n, m, 1, 1) for i, (a, b, n, m) in EDGES.items()] + list(extra), PATHS)


@pytest.mark.parametrize(("name", "own"), [(None, BY_LENGTH), ("name", BY_NAME)])
def test_orders_of_the_known_network(spark, name, own):
    got = {r.id: r for r in N.stream_orders(paths(spark), name).collect()}
    for column, values in (SAME | own).items():
        assert [got[i][column] for i in EDGES] == values, column
    stems = [{17, 9, 7, 6, 5}, {16, 12, 10}, {15, 14}] if name is None else [{17, 16, 12, 11}, {15, 14}, {9, 7, 3, 2}, {6, 5}]
    for stem in stems:
        assert len({got[i].mainstem for i in stem}) == 1


@pytest.mark.parametrize("name", [None, "name"])
def test_large_components_are_folded_alike(spark, name):
    rows = [(k, k, k // 2, (k * 7919) % 50, k % 3 if k % 4 else None, 1, 1) for k in range(2, 26)] + [(500, 900, 901, 3, None, 1, 1)]
    p = spark.createDataFrame(rows, PATHS)
    small = sorted(map(tuple, N.stream_orders(p, name, isolated_hack=1001, boundary=[1]).collect()))
    assert small == sorted(map(tuple, N.stream_orders(p, name, isolated_hack=1001, boundary=[1], most=5).collect()))


def test_orders_of_odd_networks(spark):
    extra = [(100, 200, 201, 7, None, 1, 1), (101, 300, 18, 1, None, 2, 1), (102, 301, 18, 1, None, 1, 2), (103, 400, 401, 1, None, 1, 1), (104, 401, 400, 1, None, 1, 1)]
    got = {r.id: r for r in N.stream_orders(paths(spark, extra)).collect()}
    assert (got[100].strahler, got[100].max_uplength, got[100].mainstem_seq, got[100].component) == (1, 0, 1, 200)
    assert got[101].strahler is None and got[102].hack is None and got[103].strahler == got[104].hack == 1 and got[17].strahler == 4  # two nodes, whatever lies between
    assert N.stream_orders(paths(spark).limit(0)).count() == 0
    legacy = {r.id: r.hack for r in N.stream_orders(paths(spark), "name", isolated_hack=1001).collect()}
    assert legacy[17] == 1001 and legacy[15] == 1002


def test_traversals(spark):
    p = paths(spark)
    start = spark.createDataFrame([(7,)], "id long")
    assert {r.id for r in N.trace(p, start).collect()} == {7, 9, 17}
    assert {r.id for r in N.trace(p, start, upstream=True).collect()} == {1, 2, 3, 4, 5, 6, 7}
    assert [r.id for r in N.trace(p, start, upstream=True, most=3).collect()] == [7, 3, 6]
    loop = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    assert {(r.id, r.hop) for r in N.reachable(loop, spark.createDataFrame([(1,), (7,)], "id long"), at_once=0).collect()} == {(1, 0), (2, 1), (3, 2), (7, 0)}
    assert {(r.id, r.hop) for r in N.reachable(loop, spark.createDataFrame([(1,), (7,)], "id long"), within=1).collect()} == {(1, 0), (2, 1), (7, 0)}
    assert {(r.id, r.hop) for r in N.reachable(loop, spark.createDataFrame([(1,)], "id long")).collect()} == {(1, 0), (2, 1), (3, 2)}


def test_cycles_and_checks(spark):
    assert not N.has_cycle(paths(spark))
    back = [(99, 18, 16, 1, None, 1, 1)]
    assert N.has_cycle(paths(spark, back))
    assert {r.id for r in N.peel(paths(spark, back)).collect()} == {9, 17, 99}
    none = spark.createDataFrame([], "id long")
    assert N.invalid_sources_sinks(paths(spark), none).count() == 0
    two = paths(spark, [(50, 16, 900, 1, None, 1, 1), (51, 13, 900, 1, None, 1, 1)])
    assert [tuple(r) for r in N.invalid_sources_sinks(two, none).collect()] == [(900, "sink")]
    assert {r.id for r in N.forked_nodes(two).collect()} == {16, 13}
    with pytest.raises(ValueError, match="itself"):
        N.without_parallel(paths(spark, [(60, 5, 5, 1, None, 1, 1)]))


def test_bridges_groups_and_trimming(spark):
    ring = [(50, 18, 20, 1, None, 1, 1), (51, 20, 21, 1, None, 1, 1), (52, 21, 18, 1, None, 1, 1), (53, 3, 11, 1, None, 1, 1)]
    p = paths(spark, ring)
    assert {r.id for r in N.bridges(p).collect()} == set(EDGES) - {1}
    groups = {r.id: r.component for r in N.loop_groups(p).collect()}
    assert groups[18] == groups[20] == groups[21] == 18 and groups[3] == groups[11] == 3 and groups[17] == 17
    assert {r.id for r in N.trim(p, spark.createDataFrame([], "id long")).collect()} == {1, 50, 51, 52, 53} | {3, 7, 9, 17}
    chains = {(r.first, r.last, r.n, r.length) for r in N.merge_chains(spark.createDataFrame([(1, 1, 2, 5), (2, 2, 3, 6), (3, 4, 3, 1), (4, 3, 5, 1)], "id long, from_nexus_id long, to_nexus_id long, length long")).collect()}
    assert chains == {(1, 3, 2, 11), (4, 3, 1, 1), (3, 5, 1, 1)}


def test_shortest_distances(spark):
    links = spark.createDataFrame([(1, 2, 5), (2, 3, 5), (1, 3, 20), (4, 1, 1), (3, 1, 1)], "src long, dst long, length long")
    got = {r.id: r.distance for r in N.shortest_distances(links, spark.createDataFrame([(3,)], "id long")).collect()}
    assert got == {3: 0, 2: 5, 1: 10, 4: 11}


def test_pourpoints_of_the_known_network(spark):
    p = paths(spark).selectExpr("*", "id AS ecatchment_id")
    pts = spark.createDataFrame([(1, 9), (2, 3), (3, 16), (4, 17)], "point long, edge long")
    d = {(r["from"], r["to"]): (r.least, r.most) for r in P.distances(p, pts).collect()}
    assert d == {(2, 1): (3, 3), (2, 4): (6, 6), (1, 4): (3, 3), (3, 4): (3, 3)}
    unique = {}
    for r in P.unique_catchments(p, pts).collect():
        unique.setdefault(r.point, set()).add(r.catchment)
    assert unique == {1: {9, 7, 8, 6, 4, 5}, 2: {3, 1, 2}, 3: {16, 12, 10, 11, 15, 13, 14}, 4: {17}}
    assert {r.catchment for r in P.shared_catchments(p, pts).filter("point = 1").collect()} == {1, 2, 3}
    assert {(r["from"], r["to"]) for r in P.containment(p, pts).filter("relation = -1").collect()} == set(d)


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 5), (9, 8), (None, 1), (7, None), *[(k, k + 1) for k in range(100, 160)]], "src long, dst long")
    got = {r.id: r.component for r in connected_components(e).collect()}
    assert got == {r.id: r.component for r in connected_components(e, at_once=0).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 8: 8, 9: 8} | {k: 100 for k in range(100, 161)}
    assert connected_components(e.limit(0)).count() == 0


def test_ties_go_to_the_lowest_id():
    frame = pd.DataFrame([(5, 1, 3, 4, None), (4, 2, 3, 4, None), (6, 3, 9, 1, None)], columns=["id", "from", "to", "length", "name"])
    got = N.fold_component(frame).set_index("id")
    assert got.loc[6, "mainstem"] == 2 and got.loc[6, "strahler"] == 2


ODD = [  # id, from, to, length, name, rank, ef_type: forks at 2 and 5, a cycle 7-8-9 with a way in, a pair of its own, a bank pair
    (30, 1, 2, 4, None, 1, 1), (31, 2, 3, 5, 1, 1, 1), (32, 2, 4, 9, 2, 1, 1), (33, 3, 5, 1, 1, 1, 1), (34, 4, 5, 2, None, 1, 1), (35, 5, 6, 3, 1, 1, 1), (36, 5, 10, 3, 2, 1, 1), (37, 10, 6, 7, None, 1, 1),
    (40, 11, 7, 1, None, 1, 1), (41, 7, 8, 1, None, 1, 1), (42, 8, 9, 1, None, 1, 1), (43, 9, 7, 1, None, 1, 1), (50, 20, 21, 8, None, 1, 2), (51, 22, 23, 8, None, 2, 1), (52, 24, 25, 8, None, 1, 1), (53, 26, 27, 1, None, 1, 1), (54, 27, 28, 1, None, 1, 2),
]
COLUMNS = ("strahler", "shreve", "max_uplength", "mainstem", "hack", "horton", "mainstem_seq", "component")


def odd_orders(df):
    return {r.id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("name", [None, "name"])
def test_both_ways_give_the_same_orders_on_forks_cycles_and_pairs(spark, name):
    odd = spark.createDataFrame(ODD, PATHS)
    one = odd_orders(N.stream_orders(odd, name, isolated_hack=1001, boundary=[6]))
    assert one == odd_orders(N.stream_orders(odd, name, isolated_hack=1001, boundary=[6], most=0))
    assert one[31][:4] == (1, 1, 4, 1) and one[32][:4] == (1, 1, 4, 1)  # both flowpaths out of a fork have its orders
    assert one[33][:3] == (1, 1, 9) and one[34][:4] == (1, 1, 0, 4)  # but only that of lowest id brings them down
    assert all(one[i][:7] == (None,) * 7 for i in (40, 41, 42, 43, 54))
    # the orders of pairs take no notice of rank and type
    assert all(one[i][:3] + one[i][4:7] == (1, 1, 0, 1, 1, 1) for i in (50, 51, 52)) and one[53][4] == 1001 and one[35][4] == 1


def test_both_ways_reach_the_same_nodes_for_ids_of_any_type(spark):
    links = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("d", None), (None, "e")]
    for kind, cast in (("string", str), ("long", ord)):
        df = spark.createDataFrame([tuple(cast(x) if x else None for x in r) for r in links], f"src {kind}, dst {kind}")
        starts = spark.createDataFrame([(cast("a"),), (None,), (cast("z"),)], f"id {kind}")
        for within in (None, 0, 2):
            got = sorted(map(tuple, N.reachable(df, starts, within).collect()))
            assert got == sorted(map(tuple, N.reachable(df, starts, within, at_once=0).collect()))
            assert got == sorted((cast(n), h) for n, h in (("a", 0), ("b", 1), ("c", 2), ("d", 3), ("z", 0)) if within is None or h <= within)


def test_ids_beyond_the_whole_numbers_of_floats_stay_apart(spark):
    big = 2**60
    df = spark.createDataFrame([(big + k, big + k + 1) for k in range(5)], "src long, dst long")
    got = sorted(map(tuple, N.reachable(df, spark.createDataFrame([(big + 1,)], "id long")).collect()))
    assert got == [(big + 1 + k, k) for k in range(5)] == sorted(map(tuple, N.reachable(df, spark.createDataFrame([(big + 1,)], "id long"), at_once=0).collect()))


def test_string_ids_have_orders_too(spark):
    rows = [(i, f"N{a}", f"N{b}", n, m, 1, 1) for i, (a, b, n, m) in EDGES.items()]
    got = {r.id: r for r in N.stream_orders(spark.createDataFrame(rows, PATHS.replace("nexus_id long", "nexus_id string"))).collect()}
    assert [got[i].strahler for i in EDGES] == SAME["strahler"] and got[17].mainstem == "N2"


def test_a_way_of_50000_flowpaths(spark):
    n = 50_000
    deep = spark.range(1, n + 1).selectExpr("id", "id AS from_nexus_id", "id + 1 AS to_nexus_id", "CAST(2 AS LONG) AS length", "CAST(NULL AS LONG) AS name", "1 AS rank", "1 AS ef_type")
    got = {r.id: r for r in N.stream_orders(deep).filter(f"id IN (1, 777, {n})").collect()}
    assert [(got[k].strahler, got[k].max_uplength, got[k].mainstem, got[k].mainstem_seq) for k in (1, 777, n)] == [(1, 0, 1, n), (1, 2 * 776, 1, n - 776), (1, 2 * (n - 1), 1, 1)]
    assert N.trace(deep, spark.createDataFrame([(1,)], "id long")).count() == n


def test_graphs_of_a_million_edges_go_to_one_task():
    from thalweg.operators.components import AT_ONCE, label

    n = 1_000_000
    assert n < AT_ONCE
    k = np.arange(16, n)
    nodes, low = label(k, k // 2)
    assert (low == nodes >> (np.floor(np.log2(nodes)).astype(np.int64) - 3)).all()


@pytest.mark.parametrize(("kind", "at_once"), [("long", 40), ("string", 1)])
def test_components_of_graphs_too_large_for_one_task(spark, kind, at_once):
    from thalweg.operators.components import label

    r = np.random.default_rng(11)
    edges = [*r.integers(1000, 1400, (260, 2)).tolist(), *r.integers(2000, 2020, (60, 2)).tolist(), *[[3000 + k, 3000 + (k + 1) % 4] for k in range(4)], *[[4000, 4001 + k] for k in range(30)], *[[5000 + k, 5030] for k in range(30)], [6000, 6000], [6001, 6001], [6001, 6002]]
    e = spark.createDataFrame([(str(a), str(b)) for a, b in edges], "src string, dst string").selectExpr(f"CAST(src AS {kind}) AS src", f"CAST(dst AS {kind}) AS dst")
    want = [x.tolist() for x in label(*np.array(edges).T)]
    assert sorted((int(k), int(c)) for k, c in connected_components(e, at_once=at_once).collect()) == list(zip(*want, strict=True))


def test_large_trees_need_no_rounds(spark, monkeypatch):
    from thalweg.operators import components

    monkeypatch.setattr(components, "MAX_ROUNDS", 0)
    e = spark.range(16, 4096).selectExpr("id AS src", "id DIV 2 AS dst")
    got = connected_components(e, at_once=300).collect()
    assert len(got) == 4088 and all(c == k >> (k.bit_length() - 4) for k, c in got)


def test_bridges_of_a_component_take_little_memory():
    import tracemalloc

    n = 30_000
    k = np.arange(1, n)
    edges = pd.DataFrame({"id": np.arange(n + 1), "a": [*k, 0, n - 1], "b": [*k // 2, 0, n - 5]})
    tracemalloc.start()
    got = set(N.component_bridges(edges)["id"])
    assert tracemalloc.get_traced_memory()[1] < 250 * n
    tracemalloc.stop()
    up = lambda x: {x >> i for i in range(x.bit_length())}
    assert got == set(range(n - 1)) - {x - 1 for x in up(n - 1) ^ up(n - 5)}


def test_orders_of_a_component_take_little_memory():
    import tracemalloc

    n = 30_000
    k = np.arange(16, n)
    edges = pd.DataFrame({"id": k, "from": k, "to": k // 2, "length": k % 1000, "name": pd.Series([None] * len(k), dtype=object), "component": 8})
    tracemalloc.start()
    got = N.fold_component(edges).set_index("id")
    assert tracemalloc.get_traced_memory()[1] < 400 * n
    tracemalloc.stop()
    assert got["shreve"].sum() == sum(leaf >> j >= 16 for leaf in range(n // 2, n) for j in range(12))
    assert (got.loc[n // 2 :, "strahler"] == 1).all() and got["strahler"].max() == 11


def test_small_groups_go_to_a_kernel_many_at_once_and_each_whole():
    keys = [k for k in range(300) for _ in range(1 + k % 5)] + ["x"] * 40 + [None] * 3
    rows = pd.DataFrame({"key": pd.Series(keys, dtype=object), "place": range(len(keys))})
    for batch, least in ((7, 20), (1, 1), (64, 10_000), (50, 8)):
        got = list(N.whole_groups((rows.iloc[k : k + batch] for k in range(0, len(rows), batch)), "key", least))
        assert pd.concat(got)["place"].tolist() == list(range(len(rows)))
        seen = [set(map(str, frame["key"])) for frame in got]
        assert sum(map(len, seen)) == len(set().union(*seen)) == 302
        assert len(got) <= len(rows) / least + 1
    assert list(N.whole_groups(iter([rows.iloc[:0]]), "key")) == []


def test_bridges_of_many_small_components_take_few_kernel_calls(spark):
    rows = [(4 * k + i, 4 * k + a, 4 * k + b) for k in range(500) for i, (a, b) in enumerate(((0, 1), (1, 2), (2, 0), (2, 3)))]
    paths = spark.createDataFrame(rows, "id long, from_nexus_id long, to_nexus_id long")
    calls, kernel = spark.sparkContext.accumulator(0), N.component_bridges

    def counted(edges):
        calls.add(1)
        return kernel(edges)

    N.component_bridges = counted
    try:
        assert sorted(r.id for r in N.bridges(paths).collect()) == [4 * k + 3 for k in range(500)]
    finally:
        N.component_bridges = kernel
    assert calls.value <= 4
