"""Registered queries against brute force over all of their input."""

from collections import Counter

import numpy as np

import __spark_entry__ as entry
from thalweg import adapter as A
from thalweg.operators import construct as C

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_every_catchment_gets_letters(spark):
    def generate_id(i):
        return "" if i < 0 else generate_id(i // 26 - 1) + chr(65 + i % 26)

    kinds = {}
    for key, kind, area in rows(A.catchments(spark, SF).select("id", "ec_type", "area")):
        kinds.setdefault(kind, []).append((-area, key))
    want = {key: generate_id(i) for group in kinds.values() for i, (_, key) in enumerate(sorted(group))}
    assert max(map(len, kinds.values())) > 702
    assert dict(rows(entry.queries()["win_partition_letters"](spark, SF))) == want


def test_letters_have_any_length(spark):
    from thalweg.operators import relational as Q

    got = spark.createDataFrame([(701,), (702,), (18277,), (18278,), (475254,)], "n long")
    assert [r.name for r in got.select(Q.letters(got.n).alias("name")).collect()] == ["ZZ", "AAA", "ZZZ", "AAAA", "AAAAA"]


def test_all_primary_flowpaths_are_compared_for_crossings(spark):
    lines = rows(A.with_points(A.flowpaths(spark, SF)).filter("rank = 1").select("id", "x1", "y1", "x2", "y2"))
    ids, p = np.array([r[0] for r in lines]), np.array([r[1:] for r in lines])
    x1, y1, x2, y2 = p.T[:, :, None]

    def side(x, y):
        return np.sign((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1))

    parts = side(x1.T, y1.T) * side(x2.T, y2.T) < 0
    a, b = np.nonzero(parts & parts.T)
    p = A.with_points(A.flowpaths(spark, SF)).filter("rank = 1")
    got = C.crossings(p, p, 40.0).toPandas()
    assert len(ids) == 1484 and len(got) == len(a)
    assert set(zip(got["id"], got["other"], strict=True)) == set(zip(ids[a].tolist(), ids[b].tolist(), strict=True))


def distances(p, lines):
    x, y = np.array(p).T[:, :, None]
    x1, y1, x2, y2 = np.array(lines, float).T
    dx, dy = x2 - x1, y2 - y1
    size = dx * dx + dy * dy
    t = np.clip(((x - x1) * dx + (y - y1) * dy) / np.where(size, size, 1), 0, 1) * (size > 0)
    return np.hypot(x - x1 - t * dx, y - y1 - t * dy)


def test_points_near_any_primary_flowpath_are_not_far(spark):
    points = rows(A.points(spark, SF))
    lines = rows(A.with_points(A.flowpaths(spark, SF)).filter("rank = 1").select("x1", "y1", "x2", "y2"))
    d = distances([(x / 3, y / 3) for _, x, y in points], lines).min(1)
    got = {r[0] for r in rows(entry.queries()["sp_proximity_filter"](spark, SF))}
    assert got == {p[0] for p, far in zip(points, d >= 2, strict=True) if far}


def test_points_flow_by_their_catchment_first(spark):
    paths = rows(A.with_points(A.flowpaths(spark, SF)).select("id", "from_nexus_id", "x1", "y1", "x2", "y2"))
    boxes = rows(A.catchments(spark, SF).select("id", "minx", "miny", "maxx", "maxy"))
    ids, owner, ends = np.array([p[0] for p in paths]), np.array([p[1] for p in paths]), [p[2:] for p in paths]
    want, ways = {}, set()
    points = [(i, x / 3, y / 3) for i, x, y in rows(A.points(spark, SF))]
    for (i, x, y), d in zip(points, distances([p[1:] for p in points], ends).round(6), strict=True):
        box = [b[0] for b in boxes if b[1] < x < b[3] and b[2] < y < b[4]]
        near = owner == box[0] if box else d <= 1
        ways.add((bool(box), min(int(near.sum()), 2)))
        if near.any():
            want[i] = min((a, b) for a, b in zip(d[near].tolist(), ids[near].tolist(), strict=True))
    got = {r.id: (r.distance, r.line) for r in entry.queries()["g_flow_from_point"](spark, SF).collect()}
    assert {(True, 1), (False, 2)} <= ways
    assert got.keys() == want.keys() and all(got[i][1] == want[i][1] and abs(got[i][0] - want[i][0]) < 2e-6 for i in want)


def test_banks_and_catchments_without_flowpaths(spark):
    points = spark.createDataFrame([(k, x, 5.0) for k, x in ((1, 2.0), (2, 12.0), (3, 22.0), (4, 32.0), (5, 41.5), (6, 40.5), (7, 8.0))], "id long, x double, y double")
    boxes = spark.createDataFrame([(k, 10.0 * k, 0.0, 10.0 * k + 10, 10.0) for k in range(4)], "id long, minx double, miny double, maxx double, maxy double")
    lines = [(50, 0, 7, 0, 0, 10, 0), (51, 0, 8, 9, 0, 9, 10), (52, 9, 9, 40, 5, 40, 9), (53, 9, 9, 0, 5, 60, 5.5)]
    paths = spark.createDataFrame([(*r[:3], *map(float, r[3:])) for r in lines], "id long, ecatchment_id long, from_nexus_id long, x1 double, y1 double, x2 double, y2 double")
    banks = spark.createDataFrame([(1, 9), (2, 9), (2, 8), (0, 9)], "id long, nexus long")
    got = {r.id: r.line for r in C.flow_from_point(points, boxes, paths, banks, 8.0, 1.0).collect()}
    assert got == {1: 50, 2: 52, 5: 53, 6: 53, 7: 51}


def test_every_flowpath_is_in_one_chain(spark):
    paths = rows(A.flowpaths(spark, SF).select("from_nexus_id", "to_nexus_id", "id", "length"))
    into, out = Counter(p[1] for p in paths), Counter(p[0] for p in paths)
    assert not any(into[k] == 1 and out[k] == 1 for k in out)  # so the halves are all there is to merge
    want = [(a, b, 2 if key % 3 == 0 else 1, length) for a, b, key, length in paths]
    assert sorted(rows(entry.queries()["g_degree2_merge"](spark, SF))) == sorted(want)
