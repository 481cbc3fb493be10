"""Catchment delineation on triangles, block by block: prepare, triangulate, trickle, merge, extract, join blocks, check; and the medial axis.

A block's work is one task's: its elevation points and the hydro edges (constraints, each with a drainage id) in it and in a margin around it. Every
triangle passes its water on across the side that the steepest way down from its middle meets, until a constraint, the hull or a pit is
reached. Pits join the area over their lowest side. Sides between areas of different drainage are the boundaries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.operators.components import connected_components
from thalweg.operators.construct import delaunay, far_points
from thalweg.operators.geometry import LINE, POLYGON, as_line, locate, merge_lines, polygon_area, polygonize, ring_edges, rings_of
from thalweg.operators.spatial import boxes_to_cells, nearest
from thalweg.session import dealt, stage_table

HULL = -1


# ---- hydro edges


def hydro_edges(flows: DataFrame, polygons: DataFrame, places: int = 6) -> DataFrame:
    """(x1, y1, x2, y2, kind, side, drainage, chain): segments of flowpaths (id, x1, y1, x2, y2) and of waterbodies' rings (id, g), each once.

    A flowpath's drainage id is its own. A ring's segment has the water on its left or right, as it is written, or on BOTH sides if two rings share
    it; its drainage id is its chain's. A chain is a run of ring segments between nodes, points where not just two of all segments meet, and named by
    its smallest segment.
    """
    up = F.struct("x1", "y1") <= F.struct(F.col("x2").alias("x1"), F.col("y2").alias("y1"))
    pick = lambda a, b, n: F.round(F.when(up, F.col(a)).otherwise(F.col(b)), places).alias(n)
    ends = (pick("x1", "x2", "x1"), pick("y1", "y2", "y1"), pick("x2", "x1", "x2"), pick("y2", "y1", "y2"))
    sides = ring_edges(polygons).select(*ends, F.when(up, "LEFT").otherwise("RIGHT").alias("side"))
    # rings turn left, so the water is on the left of their edges as they run
    shore = sides.groupBy("x1", "y1", "x2", "y2").agg(F.count("*").alias("n"), F.min("side").alias("side"))
    shore = shore.select("x1", "y1", "x2", "y2", F.lit("SHORE").alias("kind"), F.when(F.col("n") > 1, "BOTH").otherwise(F.col("side")).alias("side"), F.lit(None).cast("string").alias("drainage"))
    own = flows.select(*ends, F.lit("FLOW").alias("kind"), F.lit(None).cast("string").alias("side"), F.concat(F.lit("F"), F.col("id").cast("string")).alias("drainage"))
    number = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("x1", "y1", "x2", "y2")])
    edges = stage_table(shore.union(own).withColumn("segment", number), "hydro-edges")
    node = lambda a, b: F.concat_ws(" ", F.col(a).cast("string"), F.col(b).cast("string"))
    at = edges.select("segment", "kind", F.explode(F.array(node("x1", "y1"), node("x2", "y2"))).alias("node"))
    plain = at.groupBy("node").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "FLOW").alias("flows"), F.min("segment").alias("a"), F.max("segment").alias("b")).filter("n = 2 AND flows = 0")
    comp = connected_components(plain, "a", "b").withColumnRenamed("id", "segment")
    joined = edges.join(comp, "segment", "left").withColumn("chain", F.coalesce("component", "segment"))
    return joined.select("x1", "y1", "x2", "y2", "kind", "side", F.coalesce("drainage", F.concat(F.lit("S"), F.col("chain"))).alias("drainage"), "chain")


def prepared(points: DataFrame, edges: DataFrame, near: float, bucket: float) -> tuple[DataFrame, DataFrame]:
    """Elevation points (id, x, y, z) that keep ``near`` from every hydro edge, and the constraint vertices (x, y, drainage) with the least drainage of each place."""
    far = far_points(points.select("id", "x", "y"), edges, near, bucket).select("id")
    vertices = edges.select(F.col("x1").alias("x"), F.col("y1").alias("y"), "drainage").union(edges.select("x2", "y2", "drainage"))
    return points.join(far, "id", "left_semi"), vertices.groupBy("x", "y").agg(F.min("drainage").alias("drainage"))


def closest_vertices(points: DataFrame, vertices: DataFrame, radius: float) -> DataFrame:
    """(id, vertex, distance): the constraint vertex (id, x, y) nearest to each point (id, x, y) within ``radius``, lowest id of equals."""
    return nearest(points, vertices, 1, radius).select("id", F.col("target").alias("vertex"), "distance")


# ---- one block


def adjacency(triangles: np.ndarray) -> dict[tuple[int, int], list[int]]:
    """The triangles on either side of each edge (of two point numbers, the lower first)."""
    out: dict[tuple[int, int], list[int]] = {}
    for t, (a, b, c) in enumerate(triangles.tolist()):
        for u, v in ((a, b), (b, c), (c, a)):
            out.setdefault((min(u, v), max(u, v)), []).append(t)
    return out


def split_edges(edges: np.ndarray, most: float) -> list[np.ndarray]:
    """Each edge (x1, y1, x2, y2) as points at most ``most`` apart, ends included."""
    out = []
    for x1, y1, x2, y2 in edges:
        n = max(1, math.ceil(math.hypot(x2 - x1, y2 - y1) / most - 1e-9))
        t = np.arange(n + 1)[:, None] / n
        out.append(np.array([[x1, y1]]) * (1 - t) + np.array([[x2, y2]]) * t)
    return out


class Mesh:
    """Triangles over elevation points and constraints, with neighbours and the drainage of constraint sides."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, drainage: list, spacing: float):
        runs = split_edges(edges, spacing)
        places = np.round(np.concatenate([*runs, points[:, :2]]) if len(runs) else points[:, :2], 9)
        self.xy, first, inverse = np.unique(places, axis=0, return_index=True, return_inverse=True)
        inverse = inverse.ravel()
        count = sum(map(len, runs))
        self.z = np.full(len(self.xy), np.nan)
        self.z[inverse[count:]] = points[:, 2]
        # constraint vertices lie as high as the nearest point, less a little, so that water reaches them
        missing = np.flatnonzero(np.isnan(self.z))
        for k in missing:
            d = ((points[:, :2] - self.xy[k]) ** 2).sum(1)
            self.z[k] = points[d.argmin(), 2] - 1e-3 if len(points) else 0.0
        self.label: dict[tuple[int, int], object] = {}
        self.owner: dict[int, object] = {}
        at = 0
        for run, own in zip(runs, drainage, strict=True):
            numbers = inverse[at : at + len(run)].tolist()
            at += len(run)
            for u, v in zip(numbers, numbers[1:], strict=False):
                key = (min(u, v), max(u, v))
                self.label[key] = min(self.label.get(key, own), own)
            for u in numbers:
                self.owner[u] = min(self.owner.get(u, own), own)
        self.triangles = delaunay(self.xy)
        self.sides = adjacency(self.triangles)

    def across(self, t: int, edge: tuple[int, int]) -> int:
        """The triangle on the other side of an edge, or HULL."""
        both = self.sides[edge]
        return both[0] if len(both) == 2 and both[1] == t else both[1] if len(both) == 2 else HULL

    def edges(self, t: int) -> list[tuple[int, int]]:
        a, b, c = self.triangles[t].tolist()
        return [(min(u, v), max(u, v)) for u, v in ((a, b), (b, c), (c, a))]

    def exit_side(self, t: int) -> tuple[int, int]:
        """The side that the steepest way down from a triangle's middle meets; of a flat triangle the one with the lowest triangle behind it."""
        p, z = self.xy[self.triangles[t]], self.z[self.triangles[t]]
        u, v = p[1] - p[0], p[2] - p[0]
        det = u[0] * v[1] - u[1] * v[0]
        du, dv = z[1] - z[0], z[2] - z[0]
        down = -np.array([du * v[1] - dv * u[1], dv * u[0] - du * v[0]]) / det
        if not np.abs(down).max() > 1e-12:
            return min(self.edges(t), key=lambda e: (self._behind(t, e), e))
        middle, best, side = p.mean(0), math.inf, None
        for k, j in ((0, 1), (1, 2), (2, 0)):
            d = p[j] - p[k]
            cross = down[0] * d[1] - down[1] * d[0]
            if cross == 0:
                continue
            s = ((p[k][0] - middle[0]) * d[1] - (p[k][1] - middle[1]) * d[0]) / cross
            if 1e-12 < s < best:
                a, b = int(self.triangles[t][k]), int(self.triangles[t][j])
                best, side = s, (min(a, b), max(a, b))
        return side

    def _behind(self, t: int, edge: tuple[int, int]) -> float:
        n = self.across(t, edge)
        return math.inf if n == HULL else float(self.z[self.triangles[n]].mean())


def trickled(mesh: Mesh) -> list:
    """What each triangle's water reaches: a drainage id, ``("hull", edge)`` or ``("pit", least triangle of the cycle)``.

    Where two triangles drain towards their common side it is a channel: the water goes on in the lowest triangle around the side's lower end, other
    than those that it came through.
    """
    around: dict[int, list[int]] = {}
    for t, corners in enumerate(mesh.triangles.tolist()):
        for c in corners:
            around.setdefault(c, []).append(t)
    n = len(mesh.triangles)
    sides = [mesh.exit_side(t) for t in range(n)]
    ends: list = [None] * n
    follow = [-1] * n
    for t in range(n):
        if sides[t] in mesh.label:
            ends[t] = mesh.label[sides[t]]
            continue
        other = mesh.across(t, sides[t])
        if other == HULL:
            ends[t] = ("hull", sides[t])
        elif sides[other] != sides[t]:
            follow[t] = other
        else:
            low = min(sides[t], key=lambda v: (mesh.z[v], v))
            if low in mesh.owner:
                ends[t] = mesh.owner[low]
                continue
            lowest = min((k for k in around[low] if k not in (t, other)), key=lambda k: (float(mesh.z[mesh.triangles[k]].mean()), k), default=-1)
            if lowest >= 0 and mesh.z[mesh.triangles[lowest]].mean() < mesh.z[mesh.triangles[t]].mean():
                follow[t] = lowest
            else:
                ends[t] = ("pit", min(t, other))
    for start in range(n):
        way = []
        t = start
        on = set()
        while ends[t] is None and t not in on:
            on.add(t)
            way.append(t)
            t = follow[t]
        found = ends[t] if ends[t] is not None else ("pit", min(way[way.index(t) :]))
        for k in way:
            ends[k] = found
    return ends


def merged(mesh: Mesh, ends: list) -> list:
    """Drainage ids of all triangles: pits and what runs off the hull join the area behind their lowest side, then smallest triangle, until every area has an id.

    An area that touches no area with an id keeps None.
    """
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    named = lambda x: not isinstance(x, tuple)
    while True:
        best: dict = {}
        for edge, both in mesh.sides.items():
            if len(both) < 2 or edge in mesh.label:
                continue
            a, b = find(ends[both[0]]), find(ends[both[1]])
            if a == b:
                continue
            height = (float(min(mesh.z[edge[0]], mesh.z[edge[1]])), edge)
            for own, other in ((a, b), (b, a)):
                if not named(own) and (own not in best or height < best[own][0]):
                    best[own] = height, other
        if not best:
            break
        moved = False
        for own, (_, other) in sorted(best.items(), key=lambda x: x[1][0]):
            a, b = find(own), find(other)
            if a != b and not named(a):
                root[a] = b
                moved = True
        if not moved:
            break
    found = [find(e) for e in ends]
    return [e if named(e) else None for e in found]


def connected_areas(mesh: Mesh, labels: list) -> list:
    """Labels when every area keeps only its largest connected part; cut-off parts go to the neighbour over their lowest side."""
    part = [-1] * len(labels)
    groups: list[list[int]] = []
    for t in range(len(labels)):
        if part[t] >= 0:
            continue
        part[t], stack = len(groups), [t]
        groups.append([])
        while stack:
            k = stack.pop()
            groups[-1].append(k)
            for e in mesh.edges(k):
                m = mesh.across(k, e)
                if m != HULL and part[m] < 0 and labels[m] == labels[t]:
                    part[m] = part[t]
                    stack.append(m)
    # parts along a constraint of their own drainage are areas too, on its other side
    rooted = {part[t] for (u, v), label in mesh.label.items() for t in mesh.sides.get((u, v), ()) if labels[t] == label}
    out = list(labels)
    for g, own in enumerate(groups):
        if g in rooted:
            continue
        options = [((float(min(mesh.z[e[0]], mesh.z[e[1]])), e), labels[m]) for k in own for e in mesh.edges(k) if (m := mesh.across(k, e)) != HULL and part[m] in rooted]
        if options:
            label = min(options, key=lambda o: o[0])[1]
            for k in own:
                out[k] = label
    return out


def boundaries(mesh: Mesh, labels: list) -> list[tuple[object, object, np.ndarray]]:
    """(left, right, line): runs of sides between areas of different drainage, in a direction that does not depend on the block: from the smaller end, with
    what lies on either side. Constraint sides are no boundaries, nor are sides of areas without an id."""
    pairs: dict[tuple, list[np.ndarray]] = {}
    for (u, v), both in mesh.sides.items():
        if len(both) < 2 or (u, v) in mesh.label:
            continue
        a, b = labels[both[0]], labels[both[1]]
        if a is None or b is None or a == b:
            continue
        p, q = mesh.xy[u], mesh.xy[v]
        middle = mesh.xy[mesh.triangles[both[0]]].mean(0)
        if (q[0] - p[0]) * (middle[1] - p[1]) - (q[1] - p[1]) * (middle[0] - p[0]) < 0:
            a, b = b, a
        # one pair of areas, in one order, whichever way a side runs
        pairs.setdefault((a, b) if a < b else (b, a), []).append(np.array([p, q]) if a < b else np.array([q, p]))
    out = []
    for (a, b), sides in sorted(pairs.items()):
        for line in merge_lines(sides):
            # merging may turn lines: the first side tells which area is on the left
            own = next((s for s in sides if (s[0] == line[0]).all() and (s[1] == line[1]).all()), None)
            left, right = (a, b) if own is not None else (b, a)
            if line[0].tolist() > line[-1].tolist():
                line, left, right = line[::-1], right, left
            out.append((left, right, line))
    return out


def medial_axis(mesh: Mesh) -> list[tuple[object, object, np.ndarray]]:
    """(one, other, segment): the segments, between the middles of neighbouring triangles' circles, that lie as far from constraints of one drainage as of another."""
    p = mesh.xy[mesh.triangles]
    b, c = p[:, 1] - p[:, 0], p[:, 2] - p[:, 0]
    d = 2 * (b[:, 0] * c[:, 1] - b[:, 1] * c[:, 0])
    bb, cc = (b * b).sum(1), (c * c).sum(1)
    middle = p[:, 0] + np.stack([c[:, 1] * bb - b[:, 1] * cc, b[:, 0] * cc - c[:, 0] * bb], 1) / d[:, None]
    out = []
    for (u, v), both in sorted(mesh.sides.items()):
        if len(both) == 2 and u in mesh.owner and v in mesh.owner and mesh.owner[u] != mesh.owner[v] and (u, v) not in mesh.label:
            out.append((*sorted((mesh.owner[u], mesh.owner[v])), middle[both]))
    return out


def delineate(points: np.ndarray, edges: np.ndarray, drainage: list, spacing: float) -> tuple[Mesh, list]:
    """The mesh of a block and the drainage id of each triangle."""
    mesh = Mesh(points, edges, drainage, spacing)
    return mesh, connected_areas(mesh, merged(mesh, trickled(mesh)))


# ---- blocks


_STATES = "block string, state string, message string"
_BOUNDARIES = f"block string, left_id string, right_id string, line {LINE}, state string, message string"


def block_boundaries(points: DataFrame, edges: DataFrame, size: float, spacing: float, buffer: float = 0.5) -> DataFrame:
    """(block, left_id, right_id, line, state, message): the boundaries of each square block that a hydro edge touches, and its outcome, once a block without a line.

    Points (x, y, z) and edges (x1, y1, x2, y2, drainage) go to all blocks whose square, widened by ``buffer`` of its side, they meet. A block without points
    is DISABLED, one with a hydro edge twice FAILEDQA, one whose kernel fails ERROR, others COMPLETE. Only the runs of a
    boundary that meet the square itself are kept.
    """
    cells = edges.withColumns({"minx": F.least("x1", "x2"), "miny": F.least("y1", "y2"), "maxx": F.greatest("x1", "x2"), "maxy": F.greatest("y1", "y2")})
    wide = {c: F.col(c) + k * buffer * size for c, k in (("minx", -1), ("miny", -1), ("maxx", 1), ("maxy", 1))}
    own = boxes_to_cells(cells, size).select("bx", "by").distinct()
    near = boxes_to_cells(cells.withColumns(wide), size).select("bx", "by", "x1", "y1", "x2", "y2", F.col("drainage").cast("string").alias("drainage")).join(own, ["bx", "by"], "left_semi")
    dots = points.select("x", "y", "z", F.col("x").alias("minx"), F.col("y").alias("miny"), F.col("x").alias("maxx"), F.col("y").alias("maxy")).withColumns(wide)
    spread = boxes_to_cells(dots, size).select("bx", "by", "x", "y", "z").join(own, ["bx", "by"], "left_semi")
    none = lambda *names: [F.lit(None).cast("double").alias(n) for n in names]
    rows = near.select("bx", "by", "x1", "y1", "x2", "y2", "drainage", *none("z")).union(spread.select("bx", "by", "x", "y", *none("x2", "y2"), F.lit(None).cast("string"), "z"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bx, by = int(key[0]), int(key[1])
        name = f"{bx}_{by}"
        is_edge = frame["drainage"].notna()
        e = frame[is_edge].sort_values(["x1", "y1", "x2", "y2", "drainage"])
        p = frame[~is_edge].sort_values(["x1", "y1"])[["x1", "y1", "z"]].dropna().drop_duplicates(["x1", "y1"])

        def outcome(state: str, message: str | None = None) -> pd.DataFrame:
            return pd.DataFrame([(name, None, None, None, state, message)], columns=[c.split()[0] for c in _BOUNDARIES.split(", ")])

        if p.empty:
            return outcome("DISABLED", "no elevation points")
        ends = e[["x1", "y1", "x2", "y2"]].to_numpy(float)
        normal = np.where((ends[:, :2] > ends[:, 2:]).any(1)[:, None], ends[:, [2, 3, 0, 1]], ends)
        if len(np.unique(normal, axis=0)) < len(normal):
            return outcome("FAILEDQA", f"{len(normal) - len(np.unique(normal, axis=0))} segments repeat")
        try:
            mesh, labels = delineate(p.to_numpy(float), ends, e["drainage"].tolist(), spacing)
            found = boundaries(mesh, labels)
        except Exception as problem:  # noqa: BLE001  a block that fails must not end the others
            return outcome("ERROR", f"{type(problem).__name__}: {problem}")
        low, high = np.array([bx, by]) * size, np.array([bx + 1, by + 1]) * size
        kept = []
        for a, b, line in found:
            inside = ((line >= low) & (line <= high)).all(1)
            meets = inside[:-1] | inside[1:]
            edge = np.flatnonzero(np.diff(meets.astype(int), prepend=0, append=0))
            kept += [(name, a, b, line[i : j + 1].tolist(), None, None) for i, j in zip(edge[::2], edge[1::2], strict=True)]
        return pd.concat([outcome("COMPLETE"), pd.DataFrame(kept, columns=[c.split()[0] for c in _BOUNDARIES.split(", ")])]) if kept else outcome("COMPLETE")

    return dealt(rows, "bx", "by").groupBy("bx", "by").applyInPandas(run, _BOUNDARIES)


def block_medial(edges: DataFrame, size: float, spacing: float) -> DataFrame:
    """(block, one, other, line): the medial axis of each block's hydro edges (x1, y1, x2, y2, drainage), as far as its middle lies in the block."""
    cells = edges.withColumns({"minx": F.least("x1", "x2") - size / 2, "miny": F.least("y1", "y2") - size / 2, "maxx": F.greatest("x1", "x2") + size / 2, "maxy": F.greatest("y1", "y2") + size / 2})
    near = boxes_to_cells(cells, size).select("bx", "by", "x1", "y1", "x2", "y2", F.col("drainage").cast("string").alias("drainage"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bx, by = int(key[0]), int(key[1])
        frame = frame.sort_values(["x1", "y1", "x2", "y2", "drainage"])
        mesh = Mesh(np.empty((0, 3)), frame[["x1", "y1", "x2", "y2"]].to_numpy(float), frame["drainage"].tolist(), spacing)
        rows = []
        for a, b, line in medial_axis(mesh) if len(mesh.triangles) else []:
            m = line.mean(0)
            if math.floor(m[0] / size) == bx and math.floor(m[1] / size) == by:
                rows.append((f"{bx}_{by}", a, b, line.tolist()))
        return pd.DataFrame(rows, columns=["block", "one", "other", "line"])

    return near.groupBy("bx", "by").applyInPandas(run, f"block string, one string, other string, line {LINE}")


def joined_blocks(lines: DataFrame, water: DataFrame | None = None) -> DataFrame:
    """(drainage, polygon, kind): each drainage id's catchment from boundaries (left_id, right_id, line) of all blocks and other lines that bound it.

    Lines that several blocks give count once. What a drainage's lines bound is made of polygons; those inside ``water`` (drainage, polygon) are
    passed over and the largest of the rest is kept. ``kind`` is 2 if a hydro edge (``hydro`` true) bounds it, else 1. A drainage whose lines
    bound nothing has no row.
    """
    one = F.when(F.element_at("line", 1)[0] * 1e6 + F.element_at("line", 1)[1] <= F.element_at("line", -1)[0] * 1e6 + F.element_at("line", -1)[1], F.col("line")).otherwise(F.reverse("line"))
    sides = lines.select(F.explode(F.array("left_id", "right_id")).alias("drainage"), one.alias("line"), "hydro").filter("drainage IS NOT NULL").distinct()
    own = sides.groupBy("drainage").agg(F.collect_list("line").alias("lines"), F.bool_or(F.coalesce("hydro", F.lit(False))).alias("hydro"))
    if water is not None:
        own = own.join(water.groupBy("drainage").agg(F.collect_list("polygon").alias("water")), "drainage", "left")
    else:
        own = own.withColumn("water", F.lit(None).cast(f"array<{POLYGON}>"))

    def bounds(lines, wet) -> list[list[list[float]]] | None:
        runs = [as_line(line).tolist() for line in lines]
        segments = sorted({tuple(sorted((tuple(a), tuple(b)))) for run in runs for a, b in zip(run, run[1:], strict=False)})
        found, _, _ = polygonize([np.array(s) for s in segments])
        if wet is not None:
            inner = [rings_of([as_line(r) for r in p]) for p in wet]
            found = [p for p in found if not any((locate((p[0][:-1] + p[0][1:]) / 2, w) >= 0).all() for w in inner)]
        return [r.tolist() for r in max(found, key=polygon_area)] if found else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [bounds(lines, wet) for lines, wet in zip(frame["lines"], frame["water"], strict=True)]
            out = pd.DataFrame({"drainage": frame["drainage"], "polygon": pd.Series(made, dtype=object, index=frame.index), "kind": np.where(frame["hydro"], 2, 1).astype("int32")})
            yield out[out["polygon"].notna()]

    return dealt(own.select("drainage", "lines", "water", "hydro")).mapInPandas(run, f"drainage string, polygon {POLYGON}, kind int")


def checked(lines: DataFrame, hydro: DataFrame, places: int = 6) -> DataFrame:
    """(x, y, problem): where boundaries (line) and hydro edges (x1, y1, x2, y2) don't fit: a boundary that ends alone, and one that meets a hydro edge elsewhere
    than at its ends' nodes of two segments or more."""
    node = lambda p: F.struct(F.round(p[0], places).alias("x"), F.round(p[1], places).alias("y"))
    ends = lines.select(F.explode(F.array(node(F.element_at("line", 1)), node(F.element_at("line", -1)))).alias("n"))
    degree = ends.groupBy("n").agg(F.count("*").alias("ends"))
    at = hydro.select(F.explode(F.array(F.struct(F.round("x1", places).alias("x"), F.round("y1", places).alias("y")), F.struct(F.round("x2", places).alias("x"), F.round("y2", places).alias("y")))).alias("n")).groupBy("n").agg(F.count("*").alias("hydro"))
    inner = lines.select(F.explode(F.slice("line", 2, F.greatest(F.size("line") - 2, F.lit(0)))).alias("p")).select(node(F.col("p")).alias("n")).distinct()
    alone = degree.join(at, "n", "left").filter("ends = 1 AND hydro IS NULL").select("n.x", "n.y", F.lit("a boundary ends alone").alias("problem"))
    loose = degree.join(at, "n").filter("hydro < 2").select("n.x", "n.y", F.lit("a boundary meets a hydro edge's loose end").alias("problem"))
    through = inner.join(at, "n").select("n.x", "n.y", F.lit("a boundary passes a hydro node").alias("problem"))
    return alone.union(loose).union(through)


def delineated(points: DataFrame, edges: DataFrame, size: float, spacing: float, near: float) -> tuple[DataFrame, DataFrame]:
    """Catchments (drainage, polygon, kind) and block outcomes (block, state, message): all steps from prepared points to joined blocks."""
    kept, _ = prepared(points, edges, near, size)
    made = stage_table(block_boundaries(kept, edges, size, spacing), "block-boundaries")
    own = made.filter("line IS NOT NULL").select("left_id", "right_id", "line", F.lit(False).alias("hydro"))
    hydro = edges.select(F.col("drainage").cast("string").alias("left_id"), F.lit(None).cast("string").alias("right_id"), F.array(F.array("x1", "y1"), F.array("x2", "y2")).alias("line"), F.lit(True).alias("hydro"))
    return joined_blocks(own.union(hydro)), made.filter("state IS NOT NULL").select("block", "state", "message")
