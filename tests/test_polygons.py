"""Polygon and line kernels against sampling and simple shapes."""

import math

import numpy as np
import pyarrow as pa
import pytest

from thalweg.operators import geometry as X

SQUARE = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]
HOLED = [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]], [[3, 3], [3, 7], [7, 7], [7, 3], [3, 3]]]


def star(r, n, cx, cy, size):
    t = np.sort(r.random(n)) * 2 * math.pi
    d = size * (0.4 + 0.6 * r.random(n))
    ring = np.stack([cx + d * np.cos(t), cy + d * np.sin(t)], 1)
    return [np.vstack([ring, ring[:1]]).tolist()]


@pytest.mark.parametrize("seed", range(12))
def test_overlays_are_those_of_sampled_points(seed):
    r = np.random.default_rng(seed)
    a, b = star(r, 11, 0, 0, 5), star(r, 9, *r.normal(size=2) * 2, 5)
    if seed % 3 == 0:
        a = [a[0], *[[[0.5, 0.5], [0.5, -0.5], [-0.5, -0.5], [-0.5, 0.5], [0.5, 0.5]]]]
    points = r.uniform(-9, 9, (4000, 2))
    in_a, in_b = (X.locate(points, X.rings_of(g)) == X.INSIDE for g in (a, b))
    for how, want in (("intersection", in_a & in_b), ("union", in_a | in_b), ("difference", in_a & ~in_b)):
        parts = X.overlay(a, b, how)
        got = np.zeros(len(points), bool)
        for p in parts:
            got |= X.locate(points, X.rings_of(p)) == X.INSIDE
        assert (got == want).all(), how
        edges = X.edge_area(*X.overlay_edges(X.rings_of(a), X.rings_of(b), how))
        assert abs(edges - sum(X.polygon_area(p) for p in parts)) < 1e-6
    assert abs(X.overlap_area(a, b) + X.edge_area(*X.overlay_edges(X.rings_of(a), X.rings_of(b), "difference")) - X.polygon_area(a)) < 1e-6


def test_squares_relate_as_known():
    move = lambda dx, dy=0.0, s=1.0: [[[x * s + dx, y * s + dy] for x, y in SQUARE[0]]]
    cases = {(2, 1, 1): "212101212", (4, 0, 1): "FF2F11212", (4, 4, 1): "FF2F01212", (9, 9, 1): "FF2FF1212", (0, 0, 1): "2FFF1FFF2", (1, 1, 0.5): "212FF1FF2", (0, 0, 2): "2FF11F212"}
    for (dx, dy, s), want in cases.items():
        assert X.relate_polygons(SQUARE, move(dx, dy, s)) == want, (dx, dy, s)
    assert X.relate_polygons(HOLED, [[[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]])[0] == "F"
    assert X.matches("212101212", "2********") and X.matches("FF2F11212", "****1****") and not X.matches("FF2F01212", "****1****")
    with pytest.raises(ValueError):
        X.matches("212101212", "2*")


def test_many_pairs_relate_as_one_by_one(monkeypatch):
    r = np.random.default_rng(3)
    box = lambda x, y, w, h: [[[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]]
    kinds = [
        lambda: box(*map(float, r.integers(0, 4, 4) + [0, 0, 1, 1])), lambda: [box(*map(float, r.integers(0, 4, 4) + [0, 0, 1, 1]))[0][::-1]], lambda: star(r, int(r.integers(3, 9)), *r.normal(size=2), 4),
        lambda: star(r, 5, *r.normal(size=2) * 1e5, 3e5),
    ]
    draw = lambda n, among: [kinds[k]() for k in r.integers(0, among, n)]
    a, b = draw(600, 4), draw(600, 4)
    a[100:200], b[100:200] = draw(100, 2), draw(100, 2)
    a[:3], b[5:8] = [None, HOLED, [[[0, 0], [0, 0], [4, 0], [4, 4], [0, 0]]]], [None, HOLED, a[7]]
    kind = pa.list_(pa.list_(pa.list_(pa.float64())))
    one, two = pa.array(a, kind), pa.array(b, kind)
    want = [None if x is None or y is None else X.relate_polygons(x, y) for x, y in zip(a, b, strict=True)]
    assert len(set(want)) > 12
    assert X.relate_many(one, two).to_pylist() == want
    assert X.relate_many(one.slice(2, 500), two.slice(2, 500)).to_pylist() == want[2:502]
    assert X.relate_many(one[:0], two[:0]).to_pylist() == []
    # single rings are not looked at one by one
    monkeypatch.setattr(X, "relate_polygons", None)
    assert X.relate_many(one.slice(100), two.slice(100)).to_pylist() == want[100:]


def test_outlines_of_many_holes_look_at_few_shells(monkeypatch):
    ring = lambda x, y, w: np.array([[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]], float)
    n, asked = 60, []
    rings = [r for k in range(n) for r in (ring(10 * k, 0, 9), ring(10 * k + 3, 3, 2)[::-1])]
    rings.append(ring(1, 1, 1)[::-1])  # the first has a second hole
    locate = X.locate
    monkeypatch.setattr(X, "locate", lambda *a: asked.append(1) or locate(*a))
    got = X.polygons_of(X.chain_rings(np.concatenate([r[:-1] for r in rings]), np.concatenate([r[1:] for r in rings])))
    assert [len(p) for p in got] == [3] + [2] * (n - 1) and [p[0][0, 0] for p in got] == [10.0 * k for k in range(n)]
    assert len(asked) == n + 1


def test_lines_relate_as_known():
    cases = [
        ([[1, 1], [2, 2]], "1FF0FF212"), ([[-1, 2], [6, 2]], "101FF0212"), ([[0, 0], [4, 0]], "F1FF0F212"), ([[-2, -2], [0, 0]], "FF1F00212"),
        ([[0, 1], [2, 1]], "1FF00F212"), ([[5, 5], [6, 6]], "FF1FF0212"), ([[-1, 0], [2, 0], [2, 3]], "1110F0212"),
    ]
    for line, want in cases:
        assert X.relate_line(line, SQUARE) == want, line


def test_clipping_and_trimming():
    line = [[-2, 1], [2, 1], [2, 2], [6, 2], [6, 3], [1, 3]]
    assert [x.tolist() for x in X.clip_line(line, SQUARE)] == [[[0, 1], [2, 1], [2, 2], [4, 2]], [[4, 3], [1, 3]]]
    assert [x.tolist() for x in X.trim_line(line, SQUARE)] == [[[2, 1], [2, 2]]]
    through = X.clip_line([[-1, 5], [11, 5]], HOLED)
    assert [x.tolist() for x in through] == [[[0, 5], [3, 5]], [[7, 5], [10, 5]]]


def test_lines_merge_and_bound_polygons():
    lines = [np.array(x, float) for x in ([[0, 0], [1, 0]], [[2, 0], [1, 0]], [[2, 0], [2, 2]], [[2, 0], [3, 0]], [[5, 5], [6, 5], [6, 6]], [[6, 6], [5, 5]])]
    merged = sorted((len(x), x[0].tolist()) for x in X.merge_lines(lines))
    assert [m[0] for m in merged] == [2, 2, 3, 4]
    # a square with a diagonal, an inner ring, a dangle and a line that only joins two rings
    ring = lambda x, y, n: [[x, y], [x + n, y], [x + n, y + n], [x, y + n], [x, y]]
    corners = ring(0, 0, 10)
    noded = [np.array([a, b], float) for a, b in zip(corners, corners[1:], strict=False)] + [np.array([[0, 0], [10, 10]], float), np.array(ring(6, 2, 2), float), np.array([[10, 10], [12, 12]], float), np.array([[10, 0], [20, 0]], float), np.array(ring(20, 0, 1), float)]
    found, dangles, cuts = X.polygonize(noded)
    assert sorted(round(X.polygon_area(p), 9) for p in found) == [1, 4, 46, 50] and dangles == [6] and cuts == [7]
    assert sum(len(p) - 1 for p in found) == 1


def test_smoothers_have_their_known_values():
    line = np.array([[0, 0], [4, 0], [4, 2]], float)
    assert X.smooth_centroid(line).tolist() == [[0, 0], [8 / 3, 2 / 3], [4, 2]]
    assert X.smooth_slide(line).tolist() == [[0, 0], [(8 / 3 + 4) / 2, 1 / 3], [4, 2]]
    assert X.smooth_midpoint(line).tolist() == [[0, 0], [2, 0], [4, 1], [4, 2]] and X.smooth_midpoint(line[:2]).tolist() == [[0, 0], [2, 0], [4, 0]]
    assert X.smooth_corners(line).tolist() == [[0, 0], [2, 0], [4, 1], [4, 2]]
    assert X.smooth_corners(np.array([[0, 0], [9, 0], [9, 2]], float)).tolist() == [[0, 0], [7, 0], [9, 1], [9, 2]]
    assert X.smooth_corners(line, most_angle=1.0).tolist() == line.tolist() and X.smooth_corners(line, most_clip=0.5).tolist() == [[0, 0], [3.5, 0], [4, 0.5], [4, 2]]
    ring = np.array([[0, 0], [3, 0], [0, 3], [0, 0]], float)
    assert X.smooth_centroid(ring, ring=True).tolist() == [[1, 1], [1, 1], [1, 1], [1, 1]] and X.smooth_centroid(ring).tolist()[0] == [0, 0]
    assert X.smooth_progressive(line).tolist() == X.smooth_centroid(X.smooth_centroid(line)).tolist()


def test_hulls_move_inwards():
    assert sorted(X.hull_inset(np.array([[0, 0], [4, 0], [4, 4], [0, 4]], float), 1).tolist()) == [[1, 1], [1, 3], [3, 1], [3, 3]]
    assert not len(X.hull_inset(np.array([[0, 0], [4, 0], [0, 4]], float), 2))


def test_dissolving_keeps_holes(spark):
    boxes = [(k, 10 * (k % 3), 10 * (k // 3)) for k in range(9) if k != 4] + [(20, 100, 0)]
    rows = [(1, [[[x, y], [x, y + 10], [x + 10, y + 10], [x + 10, y], [x, y]]]) for _, x, y in ((k, float(x), float(y)) for k, x, y in boxes)]
    (got,) = X.dissolved(spark.createDataFrame(rows, f"id long, g {X.POLYGON}"), "id").collect()
    assert sorted((round(X.polygon_area(p)), len(p)) for p in got.parts) == [(100, 1), (800, 2)]
    holes = spark.createDataFrame([(1, got.parts)], f"key long, parts array<{X.POLYGON}>").select(X.holes_of("parts").alias("h")).first().h
    assert [X.polygon_area(h) for h in holes] == [100]


def test_catchments_in_holes_are_found(spark):
    boxes = [(k, 10.0 * (k % 5), 10.0 * (k // 5)) for k in range(25)]
    rows = [(k, [[[x, y], [x + 10, y], [x + 10, y + 10], [x, y + 10], [x, y]]], x, y, x + 10, y + 10) for k, x, y in boxes]
    catchments = spark.createDataFrame(rows, f"id long, g {X.POLYGON}, minx double, miny double, maxx double, maxy double")
    ring = [k for k in range(25) if k // 5 in (0, 4) or k % 5 in (0, 4)]
    holes = lambda ids: sorted(r.id for r in X.interior_holes(spark.createDataFrame([(k,) for k in ids], "id long"), catchments, 20.0).collect())
    assert holes(ring) == [6, 7, 8, 11, 12, 13, 16, 17, 18]
    assert holes([*ring, 12]) == [6, 7, 8, 11, 13, 16, 17, 18] and holes(ring[1:]) != holes(ring) and holes([1, 2]) == []
