"""Pieces of flowpath construction and catchment delineation that DataFrames express, and their geometry kernels.

Kernels work on one block or component each, as numpy in a grouped function; everything between them is joins and aggregates.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.operators.components import connected_components
from thalweg.operators.geometry import clip_shares
from thalweg.operators.spatial import boxes_to_cells, points_in_boxes, segment_distance, simplify


def line_boxes(lines: DataFrame) -> DataFrame:
    """Add the envelope of each line (x1, y1, x2, y2)."""
    return lines.select("*", F.least("x1", "x2").alias("minx"), F.least("y1", "y2").alias("miny"), F.greatest("x1", "x2").alias("maxx"), F.greatest("y1", "y2").alias("maxy"))


def blocks(lines: DataFrame, size: float, buffer: float = 0.5) -> DataFrame:
    """(bx, by, n, minx, miny, maxx, maxy) of square blocks that a line touches, widened on each side by a share of their size."""
    at = lambda c, k=0: (F.col(c) + k) * size
    low, high = clip_shares(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], at("bx"), at("by"), at("bx", 1), at("by", 1))
    cells = boxes_to_cells(line_boxes(lines), size).filter(low <= high).groupBy("bx", "by").agg(F.count("*").alias("n"))
    edge = lambda c, k: (F.col(c) + k) * size
    return cells.select("bx", "by", "n", edge("bx", -buffer).alias("minx"), edge("by", -buffer).alias("miny"), edge("bx", 1 + buffer).alias("maxx"), edge("by", 1 + buffer).alias("maxy"))


def surface_area(grid: DataFrame, cell: float) -> DataFrame:
    """(flat, surface) area of the two triangles of each square of four neighbouring cells with data."""
    at = lambda dr, dc, n: grid.filter("z IS NOT NULL").select((F.col("r") - dr).alias("r"), (F.col("c") - dc).alias("c"), F.col("z").alias(n))
    q = at(0, 0, "a").join(at(0, 1, "b"), ["r", "c"]).join(at(1, 0, "d"), ["r", "c"]).join(at(1, 1, "e"), ["r", "c"])

    def triangle(u: Column, v: Column) -> Column:
        return F.sqrt(u * u + v * v + cell * cell) * cell / 2

    surface = triangle(F.col("b") - F.col("a"), F.col("d") - F.col("a")) + triangle(F.col("d") - F.col("e"), F.col("b") - F.col("e"))
    return q.agg(F.sum(F.lit(cell * cell)).alias("flat"), F.round(F.sum(surface), 3).alias("surface"))


def box_sides(boxes: DataFrame) -> DataFrame:
    """(id, x1, y1, x2, y2): the four sides of each rectangle."""
    side = lambda a, b, c, d: F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2"))
    corners = (("minx", "miny", "maxx", "miny"), ("minx", "maxy", "maxx", "maxy"), ("minx", "miny", "minx", "maxy"), ("maxx", "miny", "maxx", "maxy"))
    return boxes.select("id", F.explode(F.array(*[side(*c) for c in corners])).alias("s")).select("id", "s.*")


def crossings(lines: DataFrame, others: DataFrame, size: float) -> DataFrame:
    """(id, other) of segments (one a row and id) that properly cross, by buckets and orientation.

    A pair is compared only in the first bucket that both envelopes touch, so each comes once and the pairs aren't shuffled.
    """
    first = lambda c: F.floor(F.col(c) / size)
    cells = lambda t: boxes_to_cells(line_boxes(t).withColumns({"fx": first("minx"), "fy": first("miny")}), size)
    kept = ("x1", "y1", "x2", "y2", "fx", "fy")
    a = cells(lines).select("bx", "by", "id", *[F.col(c).alias(f"a_{c}") for c in kept])
    b = cells(others).select("bx", "by", F.col("id").alias("other"), *[F.col(c).alias(f"b_{c}") for c in kept])

    def turn(p: str, q: str, r: str, pk: str, qk: str, rk: str) -> Column:
        x = lambda s, k: F.col(f"{s}_x{k}")
        y = lambda s, k: F.col(f"{s}_y{k}")
        return F.signum((x(q, qk) - x(p, pk)) * (y(r, rk) - y(p, pk)) - (y(q, qk) - y(p, pk)) * (x(r, rk) - x(p, pk)))

    cross = (turn("a", "a", "b", "1", "2", "1") * turn("a", "a", "b", "1", "2", "2") < 0) & (turn("b", "b", "a", "1", "2", "1") * turn("b", "b", "a", "1", "2", "2") < 0)
    once = (F.col("bx") == F.greatest("a_fx", "b_fx")) & (F.col("by") == F.greatest("a_fy", "b_fy"))
    return a.join(b, ["bx", "by"]).filter(once & cross).select("id", "other")


def _cells_near(lines: DataFrame, reach: float, size: float) -> DataFrame:
    """Each line once for each bucket that it comes within ``reach`` of (and a few more); all columns are kept."""
    dealt = lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # else a small table spreads in one task
    wide = line_boxes(dealt).withColumns({c: F.col(c) + k * reach for c, k in (("minx", -1), ("miny", -1), ("maxx", 1), ("maxy", 1))})
    cells = boxes_to_cells(wide, size).drop("minx", "miny", "maxx", "maxy")
    middle = [(F.col(c) + 0.5) * size for c in ("bx", "by")]
    return cells.filter(segment_distance(*middle, *[F.col(c) for c in ("x1", "y1", "x2", "y2")]) <= (size * math.sqrt(0.5) + reach) * (1 + 1e-9))


def _placed(points: DataFrame, size: float) -> DataFrame:
    return points.select("id", "x", "y", F.floor(F.col("x") / size).alias("bx"), F.floor(F.col("y") / size).alias("by"))


def far_points(points: DataFrame, lines: DataFrame, distance: float, size: float) -> DataFrame:
    """Points (id, x, y) at least ``distance`` from every line."""
    spread = _cells_near(lines.select("x1", "y1", "x2", "y2"), distance, size)
    near = _placed(points, size).join(spread, ["bx", "by"]).filter(segment_distance(*[F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]) < distance).select("id")
    return points.join(near, "id", "left_anti")


def _closest(pairs: DataFrame) -> DataFrame:
    """(id, line, distance) of the closest line (lowest id of equals) of each point among pairs (id, x, y, line, x1, y1, x2, y2)."""
    d = F.round(segment_distance(*[F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]), 6)
    return pairs.groupBy("id").agg(F.min(F.struct(d.alias("distance"), "line")).alias("b")).select("id", "b.line", "b.distance")


def nearest_line(points: DataFrame, lines: DataFrame, radius: float, size: float) -> DataFrame:
    """(id, line, distance) of the nearest line (lowest id of equals) within ``radius`` of each point; no row where none is."""
    spread = _cells_near(lines.select(F.col("id").alias("line"), "x1", "y1", "x2", "y2"), radius, size)
    return _closest(_placed(points, size).join(spread, ["bx", "by"])).filter(F.col("distance") <= radius)


def flow_from_point(points: DataFrame, catchments: DataFrame, paths: DataFrame, banks: DataFrame, size: float, radius: float) -> DataFrame:
    """(id, line, distance): the flowpath that each point (id, x, y) drains to; no row where none is.

    A point inside a catchment (id, minx, miny, maxx, maxy; the lowest id of several) has its only or closest flowpath
    (id, ecatchment_id, from_nexus_id, x1, y1, x2, y2). Where the catchment has none but is of ``banks`` (id, nexus) with one nexus, it is the
    first flowpath (lowest id) out of that nexus. A point in no catchment has the nearest flowpath within ``radius``.
    """
    inside = points_in_boxes(points, catchments, size).groupBy("id").agg(F.min("box").alias("box"))
    placed = points.select("id", "x", "y").join(inside, "id", "left")
    lines = paths.select("ecatchment_id", "from_nexus_id", F.col("id").alias("line"), "x1", "y1", "x2", "y2")
    ends = ["line", "x1", "y1", "x2", "y2"]
    own = lines.select(F.col("ecatchment_id").alias("box"), *ends)
    one = banks.distinct().groupBy(F.col("id").alias("box")).agg(F.min("nexus").alias("nexus"), F.count("*").alias("n")).filter("n = 1")
    first = lines.groupBy(F.col("from_nexus_id").alias("nexus")).agg(F.min(F.struct(*ends)).alias("f")).select("nexus", "f.*")
    bank = one.join(own, "box", "left_anti").join(first, "nexus").select("box", *ends)
    within = _closest(placed.join(own.union(bank), "box"))
    return within.union(nearest_line(placed.filter("box IS NULL"), paths, radius, size))


def inflow_order(paths: DataFrame) -> DataFrame:
    """(node, id, place): inflows of each node with one primary out-edge, clockwise from it, counted from 1."""
    turn = lambda dy, dx: F.atan2(dy, dx)
    out = paths.filter("rank = 1").select(F.col("from_nexus_id").alias("node"), turn(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("o"))
    into = paths.select(F.col("to_nexus_id").alias("node"), "id", turn(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2")).alias("i"))
    clockwise = F.round(F.pmod(F.col("o") - F.col("i"), F.lit(2 * math.pi)), 9)
    w = Window.partitionBy("node").orderBy("angle", "id")
    return into.join(out, "node").withColumn("angle", clockwise).withColumn("place", F.row_number().over(w)).select("node", "id", "place")


def joined_sinks(paths: DataFrame, sinks: DataFrame, first_id: int) -> DataFrame:
    """Rows (id, from_nexus_id, to_nexus_id) that tie the sinks of every network of several sinks to one virtual node, ``-component - 1``; ids run from ``first_id`` by sink."""
    comp = connected_components(paths, "from_nexus_id", "to_nexus_id")
    placed = sinks.select("id").distinct().join(comp, "id")
    many = placed.groupBy("component").agg(F.count("*").alias("n")).filter("n > 1").select("component")
    return placed.join(many, "component").select((F.lit(first_id) + F.col("id")).alias("id"), F.col("id").alias("from_nexus_id"), (-F.col("component") - 1).alias("to_nexus_id"))


def unwrapped(parts: Column) -> Column:
    """The only part of a geometry; null of none, an error of more."""
    return F.when(F.size(parts) == 1, parts[0]).when(F.size(parts) > 1, F.raise_error(F.lit("a geometry of several parts")).cast("void"))


def simplified(lines: DataFrame, tolerance: float) -> DataFrame:
    """(id, xs, ys) of lines (id, xs, ys) by Douglas-Peucker, whole batches of lines at a time."""

    def run(batches):
        for frame in batches:
            rows = [simplify(np.stack([np.asarray(x, float), np.asarray(y, float)], 1), tolerance) for x, y in zip(frame["xs"], frame["ys"], strict=True)]
            yield pd.DataFrame({"id": frame["id"], "xs": [r[:, 0] for r in rows], "ys": [r[:, 1] for r in rows]})

    return lines.select("id", "xs", "ys").mapInPandas(run, "id long, xs array<double>, ys array<double>")


#: Up to so many points plain loops are faster than arrays.
FEW_POINTS = 100


def _delaunay_few(p: list[list[float]]) -> list[tuple[int, int, int]]:
    """The triangles of ``delaunay``, in its order and by its arithmetic, of scaled points of which the last three are the corners around them."""
    n = len(p) - 3

    def circled(a: int, b: int, c: int) -> tuple:
        """A triangle with its circle's centre and squared radius."""
        (ax, ay), (bx, by), (cx, cy) = p[a], p[b], p[c]
        bx, by, cx, cy = bx - ax, by - ay, cx - ax, cy - ay
        d = 2 * (bx * cy - by * cx) or 1e-300
        bb, cc = bx * bx + by * by, cx * cx + cy * cy
        ux, uy = (cy * bb - by * cc) / d, (bx * cc - cx * bb) / d
        return a, b, c, ux + ax, uy + ay, (ux * ux + uy * uy) * (1 + 1e-12)

    tri = [circled(n, n + 1, n + 2)]
    for k in range(n):
        x, y = p[k]
        kept, rim = [], {}
        for t in tri:
            dx, dy = t[3] - x, t[4] - y
            if dx * dx + dy * dy < t[5]:
                a, b, c = t[:3]
                for u, v in ((a, b), (b, c), (c, a)):  # sides of two such triangles lie inside; no third one has them
                    key = (u, v) if u < v else (v, u)
                    rim[key] = None if key in rim else (u, v)
            else:
                kept.append(t)
        for key in sorted(rim):
            if rim[key]:
                u, v = rim[key]
                (ax, ay), (bx, by) = p[u], p[v]
                if (bx - ax) * (y - ay) != (by - ay) * (x - ax):
                    kept.append(circled(u, v, k))
        tri = kept
    return [t[:3] for t in tri if t[0] < n and t[1] < n and t[2] < n]


def delaunay(points: np.ndarray) -> np.ndarray:
    """Triangles (rows of three point numbers) of a Delaunay triangulation, by adding one point after another.

    Coordinates are shifted and scaled to the unit square first. Equal points count once, at their first place; fewer than three points or
    points on one line give no triangle.
    """
    if len(points) <= FEW_POINTS:
        first = {}
        for k, v in enumerate(map(tuple, points.tolist())):
            first.setdefault(v, k)
        order = np.array(list(first.values()), np.int64)
    else:
        order = np.sort(np.unique(points, axis=0, return_index=True)[1])
    if len(order) < 3:
        return np.empty((0, 3), np.int64)
    p = points[order] - points[order].min(0)
    p = p / (p.max() or 1.0)
    n = len(p)
    p = np.vstack([p, [[-50.0, -50.0], [52.0, -50.0], [0.5, 90.0]]])
    if n <= FEW_POINTS:
        return order[np.array(_delaunay_few(p.tolist()), np.int64).reshape(-1, 3)]
    tri = np.array([[n, n + 1, n + 2]])

    def circles(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, c = p[t[:, 0]], p[t[:, 1]], p[t[:, 2]]
        b, c = b - a, c - a
        d = 2 * (b[:, 0] * c[:, 1] - b[:, 1] * c[:, 0])
        bb, cc = (b * b).sum(1), (c * c).sum(1)
        u = np.stack([c[:, 1] * bb - b[:, 1] * cc, b[:, 0] * cc - c[:, 0] * bb], 1) / np.where(d == 0, 1e-300, d)[:, None]
        return u + a, (u * u).sum(1)

    center, radius = circles(tri)
    for k in range(n):
        bad = ((center - p[k]) ** 2).sum(1) < radius * (1 + 1e-12)
        sides = np.concatenate([tri[bad][:, [0, 1]], tri[bad][:, [1, 2]], tri[bad][:, [2, 0]]])
        key = sides.min(1) * (n + 3) + sides.max(1)  # in the order of the sorted pairs
        _, at, count = np.unique(key, return_index=True, return_counts=True)
        rim = sides[at[count == 1]]
        new = np.column_stack([rim, np.full(len(rim), k)])
        a, b, c = p[new[:, 0]], p[new[:, 1]], p[new[:, 2]]
        new = new[(b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) != (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])]
        nc, nr = circles(new)
        tri, center, radius = np.concatenate([tri[~bad], new]), np.concatenate([center[~bad], nc]), np.concatenate([radius[~bad], nr])
    return order[tri[(tri < n).all(1)]]


def triangulated(points: DataFrame, key: str) -> DataFrame:
    """(key, a, b, c): point ids of the Delaunay triangles of each group of points (key, id, x, y). A group is one block's points."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        ids = frame["id"].to_numpy()
        t = np.sort(ids[delaunay(frame[["x", "y"]].to_numpy(float))], 1)
        return pd.DataFrame({key: np.full(len(t), frame[key].iloc[0]), "a": t[:, 0], "b": t[:, 1], "c": t[:, 2]})

    return points.select(key, "id", "x", "y").groupBy(key).applyInPandas(run, f"{key} long, a long, b long, c long")


def voronoi(points: DataFrame, key: str) -> DataFrame:
    """(key, a, b, x1, y1, x2, y2): the sides between the cells of neighbouring points of each group (key, id, x, y), a < b; sides that run to infinity are left out."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        ids, p = frame["id"].to_numpy(), frame[["x", "y"]].to_numpy(float)
        tri = delaunay(p)
        q = p[tri] - p[tri][:, :1]
        b, c = q[:, 1], q[:, 2]
        d = 2 * (b[:, 0] * c[:, 1] - b[:, 1] * c[:, 0])
        bb, cc = (b * b).sum(1), (c * c).sum(1)
        middle = p[tri][:, 0] + np.stack([c[:, 1] * bb - b[:, 1] * cc, b[:, 0] * cc - c[:, 0] * bb], 1) / d[:, None] if len(tri) else np.empty((0, 2))
        sides: dict[tuple[int, int], list[int]] = {}
        for t, corners in enumerate(tri.tolist()):
            for k in range(3):
                sides.setdefault(tuple(sorted((corners[k], corners[k - 1]))), []).append(t)
        both = [(key, own) for key, own in sides.items() if len(own) == 2]
        ends = [sorted((int(ids[u]), int(ids[v]))) for (u, v), _ in both]
        return pd.DataFrame({key: frame[key].iloc[0], "a": [e[0] for e in ends], "b": [e[1] for e in ends], **{n: [middle[own[i]][j] for _, own in both] for n, i, j in (("x1", 0, 0), ("y1", 0, 1), ("x2", 1, 0), ("y2", 1, 1))}})

    return points.select(key, "id", "x", "y").groupBy(key).applyInPandas(run, f"{key} long, a long, b long, x1 double, y1 double, x2 double, y2 double")


def reprojected(lines: DataFrame, project, scale: float) -> DataFrame:
    """(id, line) of lines (id, line) through ``project``, a function of two coordinate columns, on the grid of a precision."""

    def point(p: Column) -> Column:
        x, y = project(p[0], p[1])
        return F.array(F.round(x * scale) / scale, F.round(y * scale) / scale)

    return lines.select("id", F.transform("line", point).alias("line"))
