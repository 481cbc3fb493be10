"""Delineation on surfaces whose catchments are known."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.operators import construct as C
from thalweg.operators import delineate as Z
from thalweg.operators import geometry as X


def test_triangles_have_empty_circles():
    p = np.random.default_rng(2).random((60, 2)) * 100
    tri = C.delaunay(p)
    assert len(tri) > 60 and sorted(set(tri.ravel().tolist())) == list(range(60))
    for t in tri:
        a, b, c = p[t]
        m = np.linalg.solve(2 * np.array([b - a, c - a]), [b @ b - a @ a, c @ c - a @ a])
        assert (np.hypot(*(p - m).T) >= np.hypot(*(a - m)) - 1e-7).all()
    area = sum(abs((p[b][0] - p[a][0]) * (p[c][1] - p[a][1]) - (p[b][1] - p[a][1]) * (p[c][0] - p[a][0])) / 2 for a, b, c in tri)
    from thalweg.operators.spatial import convex_hull

    hull = convex_hull(p)
    assert abs(area - abs(X.signed_area(np.vstack([hull, hull[:1]])))) < 1e-6


def grid(n, height, step=1.0):
    x, y = np.meshgrid(np.arange(n) * step, np.arange(n) * step)
    r = np.random.default_rng(5)
    x, y = x + r.normal(0, 0.05, x.shape), y + r.normal(0, 0.05, y.shape)
    return np.stack([x.ravel(), y.ravel(), height(x, y).ravel()], 1)


def two_rivers(n=21):
    """Valleys along x = 2 and x = 18, a ridge between them at x = 10, all falling a little towards y = 0."""
    points = grid(n, lambda x, y: -np.abs(x - 10) + 0.01 * y)
    points = points[(np.abs(points[:, 0] - 2) > 0.5) & (np.abs(points[:, 0] - 18) > 0.5)]
    return points, np.array([[2.0, 0, 2, 20], [18.0, 0, 18, 20]]), ["A", "B"]


def test_a_ridge_parts_two_rivers():
    mesh, labels = Z.delineate(*two_rivers(), 1.0)
    middle = mesh.xy[mesh.triangles].mean(1)
    assert all(label == ("A" if x < 10 else "B") for (x, _), label in zip(middle, labels, strict=True) if abs(x - 10) > 1.5)
    lines = Z.boundaries(mesh, labels)
    assert lines and all({a, b} == {"A", "B"} for a, b, _ in lines) and all(abs(p[0] - 10) < 1.6 for _, _, line in lines for p in line)
    # the ridge runs over the whole block, up from the smaller end, with A on its left
    longest = max(lines, key=lambda v: len(v[2]))
    assert longest[2][:, 1].max() - longest[2][:, 1].min() > 18 and longest[2][0].tolist() <= longest[2][-1].tolist()
    up = longest[2][-1][1] > longest[2][0][1]
    assert longest[:2] == (("A", "B") if up else ("B", "A"))


def test_pits_join_over_their_lowest_side():
    points, edges, names = two_rivers()
    points[:, 2] -= 3 * np.exp(-((points[:, 0] - 6) ** 2 + (points[:, 1] - 10) ** 2) / 2)  # a hollow on the side of A
    mesh = Z.Mesh(points, edges, names, 1.0)
    ends = Z.trickled(mesh)
    assert any(isinstance(e, tuple) and e[0] == "pit" for e in ends)
    labels = Z.connected_areas(mesh, Z.merged(mesh, ends))
    middle = mesh.xy[mesh.triangles].mean(1)
    assert all(label == "A" for (x, y), label in zip(middle, labels, strict=True) if math.hypot(x - 6, y - 10) < 2)
    assert set(labels) == {"A", "B"}


def test_the_medial_axis_lies_between_constraints():
    _, edges, names = two_rivers()
    mesh = Z.Mesh(np.empty((0, 3)), edges, names, 1.0)
    axis = Z.medial_axis(mesh)
    assert axis and all((a, b) == ("A", "B") and np.abs(line[:, 0] - 10).max() < 1e-6 for a, b, line in axis)


def test_blocks_give_their_outcomes_and_agree(spark):
    points, edges, names = two_rivers(41)
    points, edges = points[points[:, 0] < 20.5], edges.copy()
    edges[:, 3] = 40
    p = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(points)], "id long, x double, y double, z double")
    e = spark.createDataFrame([(*map(float, r), n) for r, n in zip(edges, names, strict=True)], "x1 double, y1 double, x2 double, y2 double, drainage string")
    made = Z.block_boundaries(p, e, 20.0, 1.0).collect()
    states = {r.block: r.state for r in made if r.state}
    assert set(states) == {"0_0", "0_1", "0_2"} and states["0_0"] == states["0_1"] == "COMPLETE"
    assert all(abs(x - 10) < 1.7 for r in made if r.line and r.block != "0_2" for x, y in r.line if 2 < y < 38)
    # the ridge comes from both blocks, and they agree on what they share
    ridge = {b: {tuple(p) for r in made if r.line and r.block == b for p in r.line} for b in ("0_0", "0_1")}
    assert min(y for _, y in ridge["0_0"]) < 1.5 and max(y for _, y in ridge["0_1"]) > 38.5 and ridge["0_0"] & ridge["0_1"]
    twice = Z.block_boundaries(p, e.union(e.select("x2", "y2", "x1", "y1", "drainage")), 20.0, 1.0).filter("block = '0_0'").collect()
    assert [(r.state, r.message) for r in twice] == [("FAILEDQA", "2 segments repeat")]
    assert {r.state for r in Z.block_boundaries(p.limit(0), e, 20.0, 1.0).collect()} == {"DISABLED"}
    assert {r.state for r in Z.block_boundaries(p.limit(2), e, 20.0, 50.0).filter("block = '0_0'").collect()} <= {"ERROR", "COMPLETE", "DISABLED"}


def test_lines_of_all_blocks_make_catchments(spark):
    ring = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]
    rows = [("A", "B", [[5.0, 0.0], [5.0, 10.0]], False), ("A", "B", [[5.0, 10.0], [5.0, 0.0]], False), ("A", None, [[5.0, 0.0], [0.0, 0.0], [0.0, 10.0], [5.0, 10.0]], True), ("B", None, [[5.0, 0.0], [10.0, 0.0], [10.0, 10.0], [5.0, 10.0]], False), ("C", None, ring[:3], False)]
    lines = spark.createDataFrame(rows, f"left_id string, right_id string, line {X.LINE}, hydro boolean")
    got = {r.drainage: (X.polygon_area(r.polygon), r.kind) for r in Z.joined_blocks(lines).collect()}
    assert got == {"A": (50, 2), "B": (50, 1)}
    wet = spark.createDataFrame([("A", [[[-1.0, -1.0], [6.0, -1.0], [6.0, 11.0], [-1.0, 11.0], [-1.0, -1.0]]])], f"drainage string, polygon {X.POLYGON}")
    assert {r.drainage for r in Z.joined_blocks(lines, wet).collect()} == {"B"}
    hydro = spark.createDataFrame([(5.0, 0.0, 5.0, -9.0), (5.0, 0.0, 7.0, -9.0), (5.0, 10.0, 5.0, 19.0)], "x1 double, y1 double, x2 double, y2 double")
    got = {(r.x, r.y, r.problem.split()[-1]) for r in Z.checked(spark.createDataFrame([([[5.0, 0.0], [5.0, 4.0], [5.0, 10.0]],), ([[5.0, 4.0], [8.0, 4.0]],)], f"line {X.LINE}"), hydro).collect()}
    assert got == {(5.0, 10.0, "end"), (5.0, 4.0, "alone"), (8.0, 4.0, "alone")}


def test_shores_have_sides_and_chains(spark):
    square = lambda x, y: [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]
    lakes = spark.createDataFrame([(1, square(0.0, 0.0)), (2, square(1.0, 0.0))], f"id long, g {X.POLYGON}")
    flows = spark.createDataFrame([(7, -1.0, 0.0, 0.0, 0.0)], "id long, x1 double, y1 double, x2 double, y2 double")
    got = {(r.x1, r.y1, r.x2, r.y2): r for r in Z.hydro_edges(flows, lakes).collect()}
    assert len(got) == 8 and got[1.0, 0.0, 1.0, 1.0].side == "BOTH" and got[-1.0, 0.0, 0.0, 0.0].drainage == "F7"
    assert got[0.0, 0.0, 1.0, 0.0].side == "LEFT" and got[0.0, 1.0, 1.0, 1.0].side == "RIGHT"
    # the flow's end and the two ends of the common side are nodes: four chains and the flow
    chains = {}
    for r in got.values():
        chains.setdefault(r.chain, 0)
        chains[r.chain] += 1
    assert sorted(chains.values()) == [1, 1, 1, 2, 3]


def test_blocks_are_dealt_over_tasks(spark):
    # a few bytes a block, so that adaptive execution would put all of them in one task
    p = spark.range(200).selectExpr("(id % 20) * 20 + 3 + id % 13 AS x", "1 + (id * 7) % 18 + 0.5 AS y", "1.0 * id AS z").selectExpr("double(x) x", "double(y) y", "double(z) z")
    e = spark.range(20).selectExpr("double(id * 20 + 2) x1", "1.0D y1", "double(id * 20 + 2) x2", "19.0D y2", "id AS drainage")
    made = Z.block_boundaries(p, e, 20.0, 4.0, buffer=0.0).filter("state = 'COMPLETE'").select("block", F.spark_partition_id().alias("task")).collect()
    assert len({r.block for r in made}) == 20 and len({r.task for r in made}) > 1
    boxes = spark.range(20).selectExpr("string(id) AS left_id", "string(null) AS right_id", "double(id) AS x").withColumn("hydro", F.lit(False))
    ring = F.array(*[F.array(F.col("x") + u, F.lit(v)) for u, v in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0))])
    areas = Z.joined_blocks(boxes.withColumn("line", ring)).select("drainage", "kind", F.spark_partition_id().alias("task")).collect()
    assert {(r.drainage, r.kind) for r in areas} == {(str(k), 1) for k in range(20)} and len({r.task for r in areas}) > 1
