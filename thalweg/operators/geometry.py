"""Polygon and line algebra: kernels on numpy arrays, and operators that apply them to pairs that a bucket join has found.

A line is a list of [x, y]; a polygon is a list of closed rings, the outer one first. Kernels cut the edges of one geometry at those of the other
and sort the pieces by where their midpoints lie: inside, on the boundary or outside. All else follows from these pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.operators.components import connected_components
from thalweg.operators.spatial import boxes_to_cells

LINE = "array<array<double>>"
POLYGON = "array<array<array<double>>>"
#: Coordinates are equal if they differ by less than this share of the geometry's extent.
NEAR = 1e-10
INSIDE, BOUNDARY, OUTSIDE = 1, 0, -1


# ---- kernels: pieces


def as_line(points) -> np.ndarray:
    return np.array([list(p)[:2] for p in points], float).reshape(-1, 2)


def signed_area(ring: np.ndarray) -> float:
    """Positive if the closed ring turns left."""
    x, y = (ring - ring[:1]).T if len(ring) else ring.T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def rings_of(polygon) -> list[np.ndarray]:
    """Rings as arrays with the interior on their left: the outer one turns left, holes turn right."""
    rings = [as_line(r) for r in polygon]
    return [r if (signed_area(r) >= 0) == (k == 0) else r[::-1] for k, r in enumerate(rings)]


def edges_of(rings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end points of all edges, without those of no length."""
    a = np.concatenate([r[:-1] for r in rings] or [np.empty((0, 2))])
    b = np.concatenate([r[1:] for r in rings] or [np.empty((0, 2))])
    some = (a != b).any(1)
    return a[some], b[some]


def _scale(*parts: np.ndarray) -> float:
    return max((float(np.abs(p).max()) for p in parts if len(p)), default=1.0) or 1.0


#: Up to so many pairs of edges plain loops are faster than arrays.
FEW = 400


def _locate_few(points: np.ndarray, a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    edges = list(zip(a.tolist(), b.tolist(), strict=True))
    out = []
    for x, y in points.tolist():
        odd, on = False, False
        for (x1, y1), (x2, y2) in edges:
            dx, dy, wx, wy = x2 - x1, y2 - y1, x - x1, y - y1
            t = (wx * dx + wy * dy) / (dx * dx + dy * dy)
            t = 0.0 if t < 0 else 1.0 if t > 1 else t
            ex, ey = wx - t * dx, wy - t * dy
            if ex * ex + ey * ey <= eps * eps:
                on = True
                break
            if (y1 > y) != (y2 > y) and x < dx * wy / dy + x1:
                odd = not odd
        out.append(BOUNDARY if on else INSIDE if odd else OUTSIDE)
    return np.array(out, np.int8)


def locate(points: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Where points lie in a polygon: inside, on the boundary or outside."""
    a, b = edges_of(rings)
    eps = NEAR * _scale(a, points)
    if len(points) * len(a) <= FEW:
        return _locate_few(points, a, b, eps)
    out = np.empty(len(points), np.int8)
    for at in range(0, len(points), 512):
        p = points[at : at + 512, None, :]
        d, w = b - a, p - a
        size = (d * d).sum(-1)
        t = np.clip((w * d).sum(-1) / size, 0, 1)
        off = w - t[..., None] * d
        on = ((off * off).sum(-1) <= eps * eps).any(1)
        y = p[..., 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = ((a[:, 1] > y) != (b[:, 1] > y)) & (p[..., 0] < d[:, 0] * (y - a[:, 1]) / d[:, 1] + a[:, 0])
        out[at : at + 512] = np.where(on, BOUNDARY, np.where(hit.sum(1) % 2 == 1, INSIDE, OUTSIDE))
    return out


def _cut_few(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    others = list(zip(c.tolist(), d.tolist(), strict=True))
    starts, ends, owner = [], [], []
    for k, ((px, py), (qx, qy)) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        ux, uy = qx - px, qy - py
        size = ux * ux + uy * uy
        length = math.sqrt(size)
        margin = eps / length
        places = []
        for (cx, cy), (dx, dy) in others:
            vx, vy, wx, wy = dx - cx, dy - cy, cx - px, cy - py
            cross = ux * vy - uy * vx
            vlen = math.sqrt(vx * vx + vy * vy)
            if abs(cross) > NEAR * length * vlen:
                slack = eps / vlen
                if -slack <= (wx * uy - wy * ux) / cross <= 1 + slack:
                    places.append((wx * vy - wy * vx) / cross)
            for rx, ry in ((wx, wy), (dx - px, dy - py)):  # ends of others on this edge
                if abs(ux * ry - uy * rx) <= eps * length:
                    places.append((rx * ux + ry * uy) / size)
        last, points = -1.0, [(px, py)]
        for t in sorted(places):
            if margin < t < 1 - margin and t - last > margin:
                points.append((px + t * ux, py + t * uy))
                last = t
        points.append((qx, qy))
        starts += points[:-1]
        ends += points[1:]
        owner += [k] * (len(points) - 1)
    return np.array(starts, float).reshape(-1, 2), np.array(ends, float).reshape(-1, 2), np.array(owner, np.int64)


def cut(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The edges a-b cut where edges c-d cross or touch them: start and end points of the pieces, in order, and the edge that each is of."""
    eps = NEAR * _scale(a, c)
    if 0 < len(a) * len(c) <= FEW:
        return _cut_few(a, b, c, d, eps)
    starts, ends, owner = [], [], []
    for k in range(len(a)):
        u, p = b[k] - a[k], a[k]
        size = float(u @ u)
        v, w = d - c, c - p
        cross = u[0] * v[:, 1] - u[1] * v[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (w[:, 0] * v[:, 1] - w[:, 1] * v[:, 0]) / cross
            s = (w[:, 0] * u[1] - w[:, 1] * u[0]) / cross
        vlen = np.hypot(v[:, 0], v[:, 1])
        proper = np.abs(cross) > NEAR * math.sqrt(size) * vlen
        slack = eps / np.maximum(vlen, 1e-300)
        places = [t[proper & (s >= -slack) & (s <= 1 + slack)]]
        for q in (c, d):  # ends of others on this edge
            r = q - p
            off = np.abs(u[0] * r[:, 1] - u[1] * r[:, 0]) / math.sqrt(size)
            places.append(((r @ u) / size)[off <= eps])
        margin = eps / math.sqrt(size)
        t = np.unique(np.concatenate(places))
        t = t[(t > margin) & (t < 1 - margin)]
        t = t[np.diff(t, prepend=-1) > margin]
        points = np.vstack([p, p + t[:, None] * u, b[k]])
        starts.append(points[:-1])
        ends.append(points[1:])
        owner.append(np.full(len(points) - 1, k))
    if not starts:
        return np.empty((0, 2)), np.empty((0, 2)), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(owner)


def pieces(a: np.ndarray, b: np.ndarray, rings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of the edges a-b cut at a polygon's rings, and where each lies."""
    c, d = edges_of(rings)
    p, q, _ = cut(a, b, c, d)
    return p, q, locate((p + q) / 2, rings) if len(p) else np.empty(0, np.int8)


def _along(p: np.ndarray, q: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """For pieces on a polygon's boundary: whether the boundary runs the same way."""
    c, d = edges_of(rings)
    out = np.empty(len(p), bool)
    for k, (m, u) in enumerate(zip((p + q) / 2, q - p, strict=True)):
        v, w = d - c, m - c
        t = np.clip((w * v).sum(1) / (v * v).sum(1), 0, 1)
        near = ((w - t[:, None] * v) ** 2).sum(1).argmin()
        out[k] = v[near] @ u > 0
    return out


def line_length(line: np.ndarray) -> float:
    return float(np.hypot(*np.diff(line, axis=0).T).sum())


# ---- kernels: overlay


def chain_rings(p: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Closed rings from directed edges with the interior on their left, each edge used once; at a node the sharpest left turn is taken."""
    if not len(p):
        return []
    places = int(round(-math.log10(NEAR * _scale(p))))
    _, node = np.unique(np.round(np.concatenate([p, q]), places) + 0.0, axis=0, return_inverse=True)
    node = node.ravel().tolist()
    begin, end, way = node[: len(p)], node[len(p) :], (q - p).tolist()
    out: dict[int, list[int]] = {}
    for k, n in enumerate(begin):
        out.setdefault(n, []).append(k)
    used, rings = [False] * len(p), []
    for first in range(len(p)):
        if used[first]:
            continue
        k, ring = first, []
        while not used[k]:
            used[k] = True
            ring.append(k)
            free = [e for e in out.get(end[k], ()) if not used[e]]
            if not free:
                break
            bx, by = -way[k][0], -way[k][1]

            def turn(e: int) -> float:  # clockwise from the way back
                ux, uy = way[e]
                angle = math.atan2(bx * uy - by * ux, bx * ux + by * uy)
                return -angle % (2 * math.pi) or 2 * math.pi

            k = free[0] if len(free) == 1 else min(free, key=turn)
        if len(ring) > 2 and end[ring[-1]] == begin[first]:
            rings.append(np.concatenate([p[first][None], q[ring]]))
    return rings


def _tidy(ring: np.ndarray) -> np.ndarray:
    """A closed ring without points on straight edges, beginning at its smallest corner."""
    r = ring[:-1]
    eps = NEAR * _scale(r)
    u, v = r - np.roll(r, 1, axis=0), np.roll(r, -1, axis=0) - r
    r = r[(np.abs(u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]) > eps * (np.hypot(*u.T) + np.hypot(*v.T))) | ((u * v).sum(1) < 0)]
    if len(r) < 3:
        return np.empty((0, 2))
    k = np.lexsort((r[:, 1], r[:, 0]))[0]
    r = np.roll(r, -k, axis=0)
    return np.vstack([r, r[:1]])


def polygons_of(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Rings with the interior on their left as polygons: every right-turning one is a hole of the smallest ring around it."""
    rings = [r for r in map(_tidy, rings) if len(r)]
    shells = sorted((r for r in rings if signed_area(r) > 0), key=lambda r: (signed_area(r), r.tolist()))
    out = [[s] for s in shells]
    low, high = (np.array([f(s, axis=0) for s in shells]).reshape(-1, 2) for f in (np.min, np.max))
    for hole in (r for r in rings if signed_area(r) < 0):
        middle = (hole[:-1] + hole[1:]) / 2
        slack = NEAR * _scale(low, high, hole)
        for own in [out[k] for k in np.flatnonzero(((low <= middle.min(0) + slack) & (high >= middle.max(0) - slack)).all(1))]:
            where = locate(middle, own[:1])
            if (where != OUTSIDE).all() and signed_area(own[0]) > -signed_area(hole):
                own.append(hole)
                break
    return [[own[0], *sorted(own[1:], key=lambda r: r.tolist())] for own in sorted(out, key=lambda o: o[0].tolist())]


def overlay_edges(one: list[np.ndarray], two: list[np.ndarray], how: str, cuts: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The boundary of the intersection, union or difference of two polygons, interior on the left; ``cuts`` are their pieces if these are known already."""
    p, q, where, r, s, there = cuts or (*pieces(*edges_of(one), two), *pieces(*edges_of(two), one))
    shared = where == BOUNDARY
    same = np.zeros(len(p), bool)
    same[shared] = _along(p[shared], q[shared], two)
    if how == "intersection":
        keep, other, turned = (where == INSIDE) | shared & same, there == INSIDE, False
    elif how == "union":
        keep, other, turned = (where == OUTSIDE) | shared & same, there == OUTSIDE, False
    elif how == "difference":
        keep, other, turned = (where == OUTSIDE) | shared & ~same, there == INSIDE, True
    else:
        raise ValueError(f"unknown overlay {how}")
    r, s = r[other], s[other]
    return np.concatenate([p[keep], s if turned else r]), np.concatenate([q[keep], r if turned else s])


def overlay(one, two, how: str) -> list[list[np.ndarray]]:
    """Polygons of the intersection, union or difference."""
    return polygons_of(chain_rings(*overlay_edges(rings_of(one), rings_of(two), how)))


def edge_area(p: np.ndarray, q: np.ndarray) -> float:
    """The area that directed edges bound."""
    if not len(p):
        return 0.0
    o = p[0]
    a, b = p - o, q - o
    return float((a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]).sum() / 2)


def overlap_area(one, two) -> float:
    return edge_area(*overlay_edges(rings_of(one), rings_of(two), "intersection"))


def polygon_area(polygon) -> float:
    return sum(signed_area(r) for r in rings_of(polygon))


# ---- kernels: relations


def relate_polygons(one, two) -> str:
    """The nine dimensions of how two polygons' interiors, boundaries and exteriors meet, in rows; F where they don't."""
    one, two = rings_of(one), rings_of(two)
    p, q, where = pieces(*edges_of(one), two)
    r, s, there = pieces(*edges_of(two), one)
    eps = NEAR * _scale(p, r) ** 2 * 10
    areas = [sum(map(signed_area, x)) for x in (one, two)]
    both = edge_area(*overlay_edges(one, two, "intersection", (p, q, where, r, s, there)))
    has = lambda w, k: "1" if (w == k).any() else "F"
    touch = "1" if (where == BOUNDARY).any() else "0" if (locate(p, two) == BOUNDARY).any() or (locate(r, one) == BOUNDARY).any() else "F"
    area = lambda x: "2" if x > eps else "F"
    return area(both) + has(there, INSIDE) + area(areas[0] - both) + has(where, INSIDE) + touch + has(where, OUTSIDE) + area(areas[1] - both) + has(there, OUTSIDE) + "2"


def relate_line(line, polygon) -> str:
    """The same for a line, whose boundary are its ends (none if it is closed), and a polygon."""
    line, rings = as_line(line), rings_of(polygon)
    p, q, where = pieces(line[:-1], line[1:], rings)
    closed = (line[0] == line[-1]).all()
    ends = np.empty(0, np.int8) if closed else locate(line[[0, -1]], rings)
    inner = locate(np.concatenate([p[1:], q[:-1]]), rings) if len(p) > 1 else np.empty(0, np.int8)
    has = lambda k: "1" if (where == k).any() else "F"
    end = lambda k: "0" if (ends == k).any() else "F"
    on = "1" if (where == BOUNDARY).any() else "0" if (inner == BOUNDARY).any() else "F"
    # the boundary is covered only by a line that runs along all of it
    c, d = edges_of(rings)
    covered = float(np.hypot(*(q - p)[where == BOUNDARY].T).sum()) >= float(np.hypot(*(d - c).T).sum()) * (1 - 1e-9)
    return has(INSIDE) + on + has(OUTSIDE) + end(INSIDE) + end(BOUNDARY) + end(OUTSIDE) + "2" + ("F" if covered else "1") + "2"


def matches(matrix: str, mask: str) -> bool:
    """Whether a matrix fits a mask of T (any dimension), F, *, 0, 1 and 2."""
    if len(mask) != 9 or set(mask) - set("TF*012"):
        raise ValueError(f"not a mask: {mask}")
    return all(m == "*" or (c != "F" if m == "T" else c == m) for c, m in zip(matrix, mask, strict=True))


# ---- kernels: relations of many pairs at once


def _cut_many(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, eps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``cut`` for pairs in the first dimension: start and end points of the pieces of each edge, and which of these places hold one."""
    u, v, eps = b - a, d - c, eps[:, None, None]
    size, vlen = (u * u).sum(-1)[..., None], np.sqrt((v * v).sum(-1))[:, None]
    length = np.sqrt(size)
    ux, uy, vx, vy = u[..., 0, None], u[..., 1, None], v[:, None, :, 0], v[:, None, :, 1]
    wx, wy = c[:, None, :, 0] - a[..., 0, None], c[:, None, :, 1] - a[..., 1, None]
    turn = ux * vy - uy * vx
    slack, margin = eps / vlen, eps / length
    with np.errstate(divide="ignore", invalid="ignore"):
        along = (wx * uy - wy * ux) / turn
        places = [np.where((np.abs(turn) > NEAR * length * vlen) & (along >= -slack) & (along <= 1 + slack), (wx * vy - wy * vx) / turn, np.inf)]
    for rx, ry in ((wx, wy), (d[:, None, :, 0] - a[..., 0, None], d[:, None, :, 1] - a[..., 1, None])):  # ends of others on this edge
        places.append(np.where(np.abs(ux * ry - uy * rx) <= eps * length, (rx * ux + ry * uy) / size, np.inf))
    t = np.concatenate(places, 2)
    t = np.sort(np.where((t > margin) & (t < 1 - margin), t, np.inf), 2)[..., : int(np.isfinite(t).sum(2).max())]
    last = np.full(t.shape[:2], -1.0)
    for k in range(t.shape[2]):
        keep = t[..., k] - last > margin[..., 0]
        last = np.where(keep & np.isfinite(t[..., k]), t[..., k], last)
        t[..., k] = np.where(keep, t[..., k], np.inf)
    t = np.sort(t, 2)
    t = t[..., : int(np.isfinite(t).sum(2).max()) if t.size else 0]
    some = np.isfinite(t)
    inner = np.where(some[..., None], a[:, :, None] + np.where(some, t, 0)[..., None] * u[:, :, None], b[:, :, None])
    flat = lambda x: x.reshape(len(a), -1, *x.shape[3:])
    first = np.ones((*t.shape[:2], 1), bool)
    return flat(np.concatenate([a[:, :, None], inner], 2)), flat(np.concatenate([inner, b[:, :, None]], 2)), flat(np.concatenate([first, some], 2))


def _extent(*parts: np.ndarray) -> np.ndarray:
    """``_scale`` of each pair."""
    most = np.max([np.abs(p).max((1, 2)) for p in parts], 0)
    return np.where(most == 0, 1.0, most)


def _on_edges(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of points from edges, by pair."""
    dx, dy = (b - a)[:, None, :, 0], (b - a)[:, None, :, 1]
    wx, wy = points[..., 0, None] - a[:, None, :, 0], points[..., 1, None] - a[:, None, :, 1]
    t = np.clip((wx * dx + wy * dy) / (dx * dx + dy * dy), 0, 1)
    ex, ey = wx - t * dx, wy - t * dy
    return ex * ex + ey * ey


def _locate_many(points: np.ndarray, some: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``locate`` for pairs in the first dimension, and the squared distances from the edges."""
    eps = NEAR * _extent(a, np.where(some[..., None], points, 0))
    off = _on_edges(points, a, b)
    x, y, x1, y1, x2, y2 = points[..., 0, None], points[..., 1, None], *(p[:, None, :, k] for p in (a, b) for k in (0, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        hit = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return np.where((off <= (eps * eps)[:, None, None]).any(2), BOUNDARY, np.where(hit.sum(2) % 2 == 1, INSIDE, OUTSIDE)), off


def _relate_rings(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """``relate_polygons`` for pairs of single rings of as many points each, without edges of no length: letters as bytes, nine a pair."""

    def left(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.moveaxis(r - r[:, :1], 2, 0)
        area = (x[:, :-1] * y[:, 1:] - x[:, 1:] * y[:, :-1]).sum(1) / 2
        return np.where((area >= 0)[:, None, None], r, r[:, ::-1]), np.abs(area)

    (one, size), (two, other) = left(one), left(two)
    a, b, c, d = one[:, :-1], one[:, 1:], two[:, :-1], two[:, 1:]
    near = NEAR * _extent(a, c)
    p, q, some = _cut_many(a, b, c, d, near)
    r, s, more = _cut_many(c, d, a, b, near)
    where, off = _locate_many((p + q) / 2, some, c, d)
    there, _ = _locate_many((r + s) / 2, more, a, b)
    v = np.take_along_axis(d - c, off.argmin(2)[..., None], 1)
    keep = some & ((where == INSIDE) | (where == BOUNDARY) & ((v * (q - p)).sum(2) > 0))
    begin, end, kept = np.concatenate([p, r], 1), np.concatenate([q, s], 1), np.concatenate([keep, more & (there == INSIDE)], 1)
    o = np.take_along_axis(begin, kept.argmax(1)[:, None, None], 1)
    e, f = begin - o, end - o
    both = np.where(kept, e[..., 0] * f[..., 1] - e[..., 1] * f[..., 0], 0).sum(1) / 2
    least = NEAR * _extent(np.where(some[..., None], p, 0), np.where(more[..., None], r, 0)) ** 2 * 10
    has = lambda w, m, k: np.where((m & (w == k)).any(1), ord("1"), ord("F"))
    meet = (some & (_locate_many(p, some, c, d)[0] == BOUNDARY)).any(1) | (more & (_locate_many(r, more, a, b)[0] == BOUNDARY)).any(1)
    touch = np.where((some & (where == BOUNDARY)).any(1), ord("1"), np.where(meet, ord("0"), ord("F")))
    area = lambda x: np.where(x > least, ord("2"), ord("F"))
    letters = [area(both), has(there, more, INSIDE), area(size - both), has(where, some, INSIDE), touch, has(where, some, OUTSIDE), area(other - both), has(there, more, OUTSIDE), np.full(len(a), ord("2"))]
    return np.stack(letters, 1).astype(np.uint8)


def _single_rings(polygons: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All points of an Arrow column of polygons, with the first point and the number of points of each row; 0 points where a row isn't one ring of finite points without repeats."""
    rings = polygons.flatten()
    points = rings.flatten()
    none = np.zeros(len(polygons), np.int64)
    width = points.value_lengths().to_numpy(zero_copy_only=False)
    if rings.null_count or points.null_count or not len(points) or (width != width[0]).any() or width[0] < 2 or points.flatten().null_count:
        return np.empty((0, 2)), none, none
    xy = points.flatten().to_numpy(zero_copy_only=False).reshape(-1, int(width[0]))[:, :2]
    each = rings.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    count = polygons.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    bad = np.zeros(len(xy) + 1, np.int64)
    np.cumsum(~np.isfinite(xy).all(1) | np.append((xy[1:] == xy[:-1]).all(1), False), out=bad[1:])
    start = np.cumsum(each) - each
    alone = count == 1
    ring = (np.cumsum(count) - count)[alone]
    first, size = none.copy(), none.copy()
    first[alone], size[alone] = start[ring], each[ring]
    # a repeat counts at the first of the two points; the last point's neighbour is of the next ring
    wrong = bad[np.maximum(first + size - 1, first)] - bad[first] > 0
    last = xy[np.maximum(first + size - 1, 0)]
    size[wrong | (size < 2) | ~np.isfinite(last).all(1)] = 0
    return xy, first, size


def relate_many(one: pa.Array, two: pa.Array) -> pa.Array:
    """``relate_polygons`` of two Arrow columns of polygons, null if either is. Small single rings go by arrays, all pairs of equal size together; others one by one."""
    (xy, first, n), (uv, start, m) = _single_rings(one), _single_rings(two)
    out = np.zeros((len(one), 9), np.uint8)
    fast = (n > 0) & (m > 0) & ((n - 1) * (m - 1) <= FEW)
    shape = np.where(fast, n * (2 * FEW) + m, 0)
    for kind in np.unique(shape[fast]).tolist():
        rows = np.flatnonzero(shape == kind)
        i, j = divmod(kind, 2 * FEW)
        step = max(1, 40_000 // (i * j))
        for at in range(0, len(rows), step):
            k = rows[at : at + step]
            out[k] = _relate_rings(xy[first[k, None] + np.arange(i)], uv[start[k, None] + np.arange(j)])
    found = out.view("S9").ravel().astype(str).astype(object)
    rest = np.flatnonzero(~fast)
    for k, a, b in zip(rest.tolist(), one.take(pa.array(rest)).to_pylist(), two.take(pa.array(rest)).to_pylist(), strict=True):
        found[k] = None if a is None or b is None else relate_polygons(a, b)
    return pa.array(found, pa.string())


# ---- kernels: lines


def clip_line(line, polygon, keep: tuple[int, ...] = (INSIDE,)) -> list[np.ndarray]:
    """The parts of a line inside a polygon (or elsewhere), joined where they follow each other."""
    line = as_line(line)
    p, q, where = pieces(line[:-1], line[1:], rings_of(polygon))
    out: list[list] = []
    open_ = False
    for a, b, w in zip(p, q, where, strict=True):
        if w not in keep:
            open_ = False
        elif open_:
            out[-1].append(b)
        else:
            out.append([a, b])
            open_ = True
    return [np.array(x) for x in out]


def trim_line(line, polygon) -> list[np.ndarray]:
    """The runs of whole segments of a line that a polygon covers."""
    line, rings = as_line(line), rings_of(polygon)
    out: list[list] = []
    open_ = False
    for a, b in zip(line[:-1], line[1:], strict=True):
        _, _, where = pieces(a[None], b[None], rings)
        if len(where) and (where != OUTSIDE).all():
            if open_:
                out[-1].append(b)
            else:
                out.append([a, b])
            open_ = True
        else:
            open_ = False
    return [np.array(x) for x in out]


def merge_lines(lines: list[np.ndarray]) -> list[np.ndarray]:
    """Lines joined wherever exactly two ends meet; loops that no other line touches close."""
    key = lambda x: tuple(x.tolist())
    ends: dict[tuple, list[tuple[int, bool]]] = {}
    for k, line in enumerate(lines):
        ends.setdefault(key(line[0]), []).append((k, True))
        ends.setdefault(key(line[-1]), []).append((k, False))
    used, out = [False] * len(lines), []

    def follow(k: int, forward: bool) -> list[np.ndarray]:
        parts = []
        while not used[k]:
            used[k] = True
            own = lines[k] if forward else lines[k][::-1]
            parts.append(own if not parts else own[1:])
            here = ends[key(own[-1])]
            if len(here) != 2:
                break
            # the other of the two ends; a line whose own ends meet here is a loop
            k, forward = next((e for e in here if e != (k, not forward)), (k, forward))
        return parts

    for k, line in enumerate(lines):
        for forward, end in ((True, line[0]), (False, line[-1])):
            if not used[k] and len(ends[key(end)]) != 2:
                out.append(np.concatenate(follow(k, forward)))
    for k in range(len(lines)):
        if not used[k]:
            out.append(np.concatenate(follow(k, True)))
    return out


def polygonize(lines: list[np.ndarray]) -> tuple[list[list[np.ndarray]], list[int], list[int]]:
    """Polygons that noded lines bound, and the numbers of dangles (lines that end somewhere alone) and of cut lines (with one face on both sides)."""
    key = lambda x: tuple(np.round(x, 9).tolist())
    alive = set(range(len(lines)))
    dangles: list[int] = []
    while True:
        count: dict[tuple, int] = {}
        for k in alive:
            for e in (lines[k][0], lines[k][-1]):
                count[key(e)] = count.get(key(e), 0) + 1
        loose = [k for k in alive if count[key(lines[k][0])] == 1 or count[key(lines[k][-1])] == 1]
        if not loose:
            break
        dangles += loose
        alive -= set(loose)
    half = [(k, f) for k in sorted(alive) for f in (True, False)]
    points = {h: lines[h[0]] if h[1] else lines[h[0]][::-1] for h in half}
    out: dict[tuple, list[tuple]] = {}
    for h in half:
        u = points[h][1] - points[h][0]
        out.setdefault(key(points[h][0]), []).append((math.atan2(u[1], u[0]), h))
    for own in out.values():
        own.sort()
    follow = {}
    for h in half:  # the next edge clockwise from the way back
        own = out[key(points[h][-1])]
        at = next(i for i, (_, g) in enumerate(own) if g == (h[0], not h[1]))
        follow[h] = own[at - 1][1]
    face: dict[tuple, int] = {}
    rings = []
    for h in half:
        if h in face:
            continue
        walk, k = [], h
        while k not in face:
            face[k] = len(rings)
            walk.append(k)
            k = follow[k]
        rings.append(np.concatenate([points[walk[0]], *[points[g][1:] for g in walk[1:]]]))
    cuts = sorted({k for k, f in half if f and face[k, True] == face[k, False]})
    if cuts:
        kept = [k for k in sorted(alive) if k not in cuts]
        found, more_dangles, more_cuts = polygonize([lines[k] for k in kept])
        return found, sorted([*dangles, *(kept[k] for k in more_dangles)]), sorted([*cuts, *(kept[k] for k in more_cuts)])
    shells, holes = [r for r in rings if signed_area(r) > 0], [r for r in rings if signed_area(r) < 0]
    out_polygons = [[_tidy(s)] for s in sorted(shells, key=signed_area)]
    for hole in holes:
        tidy = _tidy(hole)
        for own in out_polygons:  # the smallest face around it, other than the faces that it bounds itself
            if signed_area(own[0]) > -signed_area(tidy) + 1e-12 and (locate((tidy[:-1] + tidy[1:]) / 2, own[:1]) == INSIDE).all():
                own.append(tidy)
                break
    return sorted(out_polygons, key=lambda o: o[0].tolist()), sorted(dangles), []


def hull_inset(hull: np.ndarray, distance: float) -> np.ndarray:
    """A convex ring (turning left) with every side moved inwards; empty if nothing remains."""
    ring = np.vstack([hull, hull[:1]])
    low, high = ring.min(0) - 1, ring.max(0) + 1
    out = np.array([[low[0], low[1]], [high[0], low[1]], [high[0], high[1]], [low[0], high[1]]])
    for a, b in zip(ring[:-1], ring[1:], strict=True):
        u = (b - a) / np.hypot(*(b - a))
        normal = np.array([-u[1], u[0]])
        side = (out - a) @ normal - distance
        new = []
        for k in range(len(out)):
            j = (k + 1) % len(out)
            if side[k] >= 0:
                new.append(out[k])
            if (side[k] >= 0) != (side[j] >= 0):
                new.append(out[k] + (out[j] - out[k]) * side[k] / (side[k] - side[j]))
        out = np.array(new).reshape(-1, 2)
        if len(out) < 3:
            return np.empty((0, 2))
    return out


# ---- kernels: smoothing


def corner_angle(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> float:
    """The angle at b, from 0 to pi."""
    u, v = a - b, c - b
    return abs(math.atan2(u[0] * v[1] - u[1] * v[0], float(u @ v)))


def smooth_centroid(line: np.ndarray, most_angle: float = math.inf, ring: bool = False) -> np.ndarray:
    """Every corner of at most ``most_angle`` moves to the middle of itself and its neighbours; ends stay, but for a closed ring's if asked."""
    out = line.copy()
    n = len(line)
    closed = ring and n > 2 and (line[0] == line[-1]).all()
    for i in range(0 if closed else 1, n - 1):
        a, b, c = line[i - 1] if i else line[-2], line[i], line[i + 1]
        if corner_angle(a, b, c) <= most_angle:
            out[i] = (a + b + c) / 3
    if closed:
        out[-1] = out[0]
    return out


def smooth_progressive(line: np.ndarray, levels: int = 2, most_angle: float = math.inf) -> np.ndarray:
    """Centroid smoothing of the inner points, again and again."""
    for _ in range(levels):
        line = smooth_centroid(line, most_angle)
    return line


def smooth_midpoint(line: np.ndarray) -> np.ndarray:
    """Ends stay; every segment gives its midpoint."""
    return np.vstack([line[:1], (line[:-1] + line[1:]) / 2, line[-1:]]) if len(line) > 1 else line


def smooth_slide(line: np.ndarray, window: int = 3) -> np.ndarray:
    """Inner points move halfway to the mean of the window around them; points nearer to an end than half a window stay."""
    if window < 3 or window % 2 != 1:
        raise ValueError("a window has an odd number of points, three at least")
    out, half = line.copy(), window // 2
    for i in range(half, len(line) - half):
        out[i] = (line[i - half : i + half + 1].mean(0) + line[i]) / 2
    return out


def smooth_corners(line: np.ndarray, most_angle: float = math.inf, most_clip: float = math.inf, least_segment: float = 0.0) -> np.ndarray:
    """Corners of at most ``most_angle`` are cut off: half of the shorter arm, and of the longer one up to twice that; equal points in a row count once."""
    out = [line[0]]

    def add(p: np.ndarray, check: bool) -> None:
        if (p != out[-1]).any() and (not check or np.hypot(*(p - out[-1])) > least_segment):
            out.append(p)

    for a, b, c in zip(line[:-2], line[1:-1], line[2:], strict=True):
        if corner_angle(a, b, c) > most_angle:
            add(b, False)
            continue
        arms = [float(np.hypot(*(a - b))), float(np.hypot(*(c - b)))]
        short = 0 if arms[0] < arms[1] else 1
        clip = [0.0, 0.0]
        clip[short] = min(arms[short] / 2, most_clip)
        clip[1 - short] = min(arms[1 - short] / 2, clip[short] * 2, most_clip)
        for end, arm, n in ((a, arms[0], clip[0]), (c, arms[1], clip[1])):
            add(b + (end - b) * (n / arm), True)
    add(line[-1], False)
    return np.array(out)


SMOOTHERS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "centroid": smooth_centroid,
    "corners": smooth_corners,
    "midpoint": smooth_midpoint,
    "slide": smooth_slide,
    "progressive": smooth_progressive,
}


# ---- columns


def box_polygon(minx="minx", miny="miny", maxx="maxx", maxy="maxy") -> Column:
    """A rectangle as a polygon, turning left."""
    return F.array(F.array(*[F.array(x, y) for x, y in ((minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny))]))


def bounded(df: DataFrame, geometry: str, polygon: bool) -> DataFrame:
    """Add the envelope of a line or polygon column."""
    points = F.flatten(geometry) if polygon else F.col(geometry)
    low = lambda k, f: f(F.transform(points, lambda p: p[k]))
    return df.withColumns({"minx": low(0, F.array_min), "miny": low(1, F.array_min), "maxx": low(0, F.array_max), "maxy": low(1, F.array_max)})


def candidates(left: DataFrame, right: DataFrame, size: float, along: bool = False) -> DataFrame:
    """Pairs (id, other, a, b) of rows (id, g, minx, miny, maxx, maxy) whose envelopes meet, each once: in the first bucket that both touch.

    With ``along`` those whose envelopes meet in more than a point, as those of geometries that share a boundary must.
    """
    first = lambda c: F.floor(F.col(c) / size)
    box = ("minx", "miny", "maxx", "maxy")

    def cells(df: DataFrame, name: str, geometry: str, mark: str) -> DataFrame:
        spread = boxes_to_cells(df.withColumns({"fx": first("minx"), "fy": first("miny")}), size)
        return spread.select("bx", "by", F.col("id").alias(name), F.col("g").alias(geometry), *[F.col(c).alias(f"{mark}{c}") for c in (*box, "fx", "fy")])

    pairs = cells(left, "id", "a", "l_").join(cells(right, "other", "b", "r_"), ["bx", "by"])
    once = (F.col("bx") == F.greatest("l_fx", "r_fx")) & (F.col("by") == F.greatest("l_fy", "r_fy"))
    meet = (F.col("l_minx") <= F.col("r_maxx")) & (F.col("l_maxx") >= F.col("r_minx")) & (F.col("l_miny") <= F.col("r_maxy")) & (F.col("l_maxy") >= F.col("r_miny"))
    if along:
        meet &= (F.col("l_minx") < F.col("r_maxx")) & (F.col("l_maxx") > F.col("r_minx")) | (F.col("l_miny") < F.col("r_maxy")) & (F.col("l_maxy") > F.col("r_miny"))
    return pairs.filter(once & meet).select("id", "other", "a", "b")


def paired(f: Callable, kind: str):
    """A kernel of two geometries as a function of columns; null if either is."""

    @F.arrow_udf(kind)
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = [None if x is None or y is None else f(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]
        return pa.array(out, _ARROW[kind])

    return run


def _relate():
    @F.arrow_udf("string")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return relate_many(a, b)

    return run


_ARROW = {"string": pa.string(), "double": pa.float64(), LINE: pa.list_(pa.list_(pa.float64())), POLYGON: pa.list_(pa.list_(pa.list_(pa.float64()))), f"array<{POLYGON}>": pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))}


def related(left: DataFrame, right: DataFrame, size: float, mask: str, lines: bool = False) -> DataFrame:
    """(id, other, matrix) of pairs that fit a mask; ``left`` holds lines if so said, else polygons, ``right`` polygons."""
    matches("F" * 9, mask)
    matrix = paired(relate_line, "string") if lines else _relate()
    found = candidates(left, right, size, along=not lines and mask[4] in "12").select("id", "other", matrix("a", "b").alias("matrix"))
    fits = [F.lit(True)]
    for k, m in enumerate(mask):
        c = F.substring("matrix", k + 1, 1)
        if m != "*":
            fits.append(c != "F" if m == "T" else c == m)
    condition = fits[0]
    for f in fits[1:]:
        condition = condition & f
    return found.filter(condition)


def overlaid(pairs: DataFrame, how: str) -> DataFrame:
    """Pairs (id, other, a, b) with ``parts``: the polygons of the intersection, union or difference."""
    f = paired(lambda a, b: [[r.tolist() for r in p] for p in overlay(a, b, how)], f"array<{POLYGON}>")
    return pairs.select("id", "other", f("a", "b").alias("parts"))


def area_of(polygon: Column) -> Column:
    """Area of a polygon: the outer ring's less that of the holes."""
    ring = lambda r: F.abs(F.aggregate(F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: (a[0] - r[0][0]) * (b[1] - r[0][1]) - (b[0] - r[0][0]) * (a[1] - r[0][1])), F.lit(0.0), lambda s, d: s + d)) / 2
    return F.aggregate(F.transform(polygon, lambda r, k: F.when(k == 0, ring(r)).otherwise(-ring(r))), F.lit(0.0), lambda s, d: s + d)


def clipped(lines: DataFrame, polygons: DataFrame, size: float, whole_segments: bool = False) -> DataFrame:
    """(id, other, part, line): the parts of lines (id, g, envelope) inside polygons, cut there or by whole segments."""
    f = paired(lambda a, b: [x.tolist() for x in (trim_line if whole_segments else clip_line)(a, b)], POLYGON)
    return candidates(lines, polygons, size).select("id", "other", F.posexplode(f("a", "b")).alias("part", "line"))


def line_in_polygon(lines: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """(id, polygon, containing): the containing polygon of lowest id of each line and how many contain it; a line that runs along a boundary alone is in none.

    A line of the kind ``bank`` (a boolean column) that no polygon contains falls to the one that its end lies in or on, lowest id first.
    Null where there is none.
    """
    where = paired(lambda a, b: relate_line(a, b), "string")
    ends = paired(lambda a, b: float(locate(as_line(a)[-1:], rings_of(b))[0]), "double")
    pairs = candidates(lines, polygons, size).select("id", "other", where("a", "b").alias("m"), ends("a", "b").alias("end"))
    inside = F.col("m").like("T") | (F.substring("m", 1, 1) != "F") & (F.substring("m", 3, 1) == "F") & (F.substring("m", 6, 1) == "F")
    found = pairs.groupBy("id").agg(F.min(F.when(inside, F.col("other"))).alias("in"), F.count_if(inside).alias("containing"), F.min(F.when(F.col("end") >= 0, F.col("other"))).alias("at_end"))
    out = lines.select("id", "bank").join(found, "id", "left")
    return out.select("id", F.coalesce("in", F.when(F.col("bank"), F.col("at_end"))).alias("polygon"), F.coalesce("containing", F.lit(0)).alias("containing"))


# ---- boundaries of coverages


def ring_edges(polygons: DataFrame, key: str = "id") -> DataFrame:
    """(key, x1, y1, x2, y2) of all edges of polygons (key, g)."""
    r = polygons.select(key, F.explode("g").alias("r"))
    n = F.size("r") - 1
    edge = lambda p, q: F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2"))
    return r.select(key, F.explode(F.zip_with(F.slice("r", 1, n), F.slice("r", 2, n), edge)).alias("e")).select(key, "e.*").filter("x1 <> x2 OR y1 <> y2")


def shared_lengths(polygons: DataFrame, places: int = 6) -> DataFrame:
    """(id, other, shared): how long a boundary polygons (id, g) share, ordered pairs; edges may overlap in part.

    Edges on one straight line have the line's direction and distance from the origin as key; there they are intervals, which meet in buckets as
    long as the longest of the line.
    """
    e = ring_edges(polygons)
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    ux, uy = (F.col("x2") - F.col("x1")) / length, (F.col("y2") - F.col("y1")) / length
    flip = (F.round(ux, places) < 0) | (F.round(ux, places) == 0) & (uy < 0)
    sx, sy = F.when(flip, -ux).otherwise(ux), F.when(flip, -uy).otherwise(uy)
    on = e.select("id", "x1", "y1", "x2", "y2", length.alias("n"), sx.alias("sx"), sy.alias("sy"))
    along = lambda x, y: F.col(x) * F.col("sx") + F.col(y) * F.col("sy")
    zero = lambda c: F.round(c, places) + 0.0
    on = on.select("id", "n", zero(F.col("sx")).alias("kx"), zero(F.col("sy")).alias("ky"), zero(F.col("x1") * F.col("sy") - F.col("y1") * F.col("sx")).alias("kd"), F.least(along("x1", "y1"), along("x2", "y2")).alias("lo"), F.greatest(along("x1", "y1"), along("x2", "y2")).alias("hi"))
    keys = ["kx", "ky", "kd"]
    on = on.join(on.groupBy(*keys).agg(F.max("n").alias("step")), keys)
    spread = on.withColumn("b", F.explode(F.sequence(F.floor(F.col("lo") / F.col("step")), F.floor(F.col("hi") / F.col("step")))))
    a = spread.select(*keys, "b", "step", "id", "lo", "hi")
    b = spread.select(*keys, "b", F.col("id").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    both = a.join(b, [*keys, "b"]).filter("id <> other AND lo < hi2 AND lo2 < hi").withColumn("from", F.greatest("lo", "lo2"))
    once = both.filter(F.floor(F.col("from") / F.col("step")) == F.col("b"))
    total = F.sum(F.least("hi", "hi2") - F.col("from"))
    return once.groupBy("id", "other").agg(total.alias("shared")).filter(F.col("shared") > 10.0 ** -places)


def longest_neighbour(shared: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """(id, other, shared): of the neighbours (of ``allowed``, id) the one with the longest shared boundary, lowest id of equals."""
    if allowed is not None:
        shared = shared.join(allowed.select(F.col("id").alias("other")), "other", "left_semi")
    best = F.max_by(F.struct("other", "shared"), F.struct(F.round("shared", 9), -F.col("other")))
    return shared.groupBy("id").agg(best.alias("b")).select("id", "b.other", "b.shared")


def dissolved(polygons: DataFrame, key: str) -> DataFrame:
    """(key, parts): the union of the polygons (key, g) of a noded coverage by key, holes included.

    Inner edges occur once in either direction and cancel before anything is gathered; what a task gets is a key's outline, which is the result.
    """
    e = ring_edges(polygons.select(key, _left(F.col("g")).alias("g")), key)
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    net = e.select(key, F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.when(a <= b, 1).otherwise(-1).alias("way")).groupBy(key, "a", "b").agg(F.sum("way").alias("way")).filter("way <> 0")
    kind = dict(polygons.dtypes)[key]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        p, q = frame[["ax", "ay"]].to_numpy(float), frame[["bx", "by"]].to_numpy(float)
        back = frame["way"].to_numpy() < 0
        p[back], q[back] = q[back], p[back].copy()
        order = np.lexsort((q[:, 1], q[:, 0], p[:, 1], p[:, 0]))
        parts = [[r.tolist() for r in own] for own in polygons_of(chain_rings(p[order], q[order]))]
        return pd.DataFrame({key: frame[key].iloc[:1], "parts": [parts]})

    flat = net.select(key, F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"), "way")
    return flat.groupBy(key).applyInPandas(run, f"{key} {kind}, parts array<{POLYGON}>")


def _left(polygon: Column) -> Column:
    """A polygon with its interior on the left of all rings."""
    twice = lambda r: F.aggregate(F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: a[0] * b[1] - b[0] * a[1]), F.lit(0.0), lambda s, d: s + d)
    return F.transform(polygon, lambda r, k: F.when((twice(r) >= 0) == (k == 0), r).otherwise(F.reverse(r)))


def holes_of(parts: Column) -> Column:
    """The interior rings of polygons, each as a polygon of its own."""
    return F.flatten(F.transform(parts, lambda p: F.transform(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda r: F.array(F.reverse(r)))))


def without_holes(areas: DataFrame, catchments: DataFrame, size: float, columns: list[str]) -> DataFrame:
    """Drainage areas (key, parts) whose holes are filled: (key, parts, filled ids): the catchments (id, g, envelope) that overlap a hole areally are added."""
    holes = areas.select("key", F.posexplode(holes_of(F.col("parts"))).alias("n", "g")).withColumn("id", F.struct("key", "n"))
    found = related(bounded(holes, "g", True).select("id", "g", "minx", "miny", "maxx", "maxy"), catchments.select("id", "g", "minx", "miny", "maxx", "maxy"), size, "2********")
    added = found.select("id.key", "other").distinct().join(catchments.select(F.col("id").alias("other"), *columns), "other")
    outer = F.transform("parts", lambda p: F.slice(p, 1, 1))
    return areas.select("key", outer.alias("parts")).join(added.groupBy("key").agg(F.array_sort(F.collect_list("other")).alias("filled"), *[F.sum(c).alias(c) for c in columns]), "key", "left")


def interior_holes(claimed: DataFrame, catchments: DataFrame, size: float) -> DataFrame:
    """(id): the catchments (id, g, envelope) that lie in holes of the union of the ``claimed`` ones (id) without being claimed themselves."""
    own = catchments.join(claimed, "id", "left_semi").select(F.lit(1).alias("key"), "g")
    areas = dissolved(own, "key")
    filled = without_holes(areas, catchments, size, []).select(F.explode("filled").alias("id"))
    return filled.distinct().join(claimed, "id", "left_anti")


# ---- lines


def smoothed(lines: DataFrame, how: str) -> DataFrame:
    """(id, line) of lines (id, line) by one of the smoothers."""
    f = SMOOTHERS[how]

    @F.arrow_udf(LINE)
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else f(as_line(x)).tolist() for x in column.to_pylist()], _ARROW[LINE])

    return lines.select("id", run("line").alias("line"))


def point_along(line: Column, share: Column) -> Column:
    """The point of a line (array of [x, y]) at a share of its length; the first of a line of no length."""
    n = F.size(line) - 1
    steps = F.zip_with(F.slice(line, 1, n), F.slice(line, 2, n), lambda a, b: F.sqrt((b[0] - a[0]) * (b[0] - a[0]) + (b[1] - a[1]) * (b[1] - a[1])))
    total = F.aggregate(steps, F.lit(0.0), lambda s, d: s + d)
    start = F.struct(F.lit(0.0).alias("done"), F.lit(None).cast("array<double>").alias("at"), F.lit(0).alias("k"))

    def step(s: Column, d: Column) -> Column:
        a, b = F.get(line, s["k"]), F.get(line, s["k"] + 1)
        t = F.when(d > 0, (total * share - s["done"]) / d).otherwise(0.0)
        here = s["at"].isNull() & (s["done"] + d >= total * share)
        return F.struct((s["done"] + d).alias("done"), F.when(here, F.array(a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1]))).otherwise(s["at"]).alias("at"), (s["k"] + 1).alias("k"))

    return F.coalesce(F.aggregate(steps, start, step, lambda s: s["at"]), F.get(line, F.lit(0)))


def middle_of(line: Column, tolerance: float = 0.0) -> Column:
    """The middle of a line, moved to the nearest of its points if one is within the tolerance."""
    m = point_along(line, F.lit(0.5))
    away = lambda p: F.sqrt((p[0] - m[0]) * (p[0] - m[0]) + (p[1] - m[1]) * (p[1] - m[1]))
    near = F.array_min(F.transform(line, lambda p: F.struct(away(p).alias("d"), p[0].alias("x"), p[1].alias("y"))))
    return F.when(near["d"] <= tolerance, F.array(near["x"], near["y"])).otherwise(m)


def nearest_on_segment(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> tuple[Column, Column]:
    """The place on a segment that is nearest to a point."""
    dx, dy = x2 - x1, y2 - y1
    size = dx * dx + dy * dy
    t = F.when(size == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / size)))
    return x1 + t * dx, y1 + t * dy


def ring_side(ring: Column, a: Column, b: Column) -> Column:
    """-1 if the edge from a to b lies in a closed ring and the interior is on its left, 1 if on its right, 0 if no edge of the ring has just these ends."""
    twice = F.aggregate(F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda p, q: p[0] * q[1] - q[0] * p[1]), F.lit(0.0), lambda s, d: s + d)
    edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda p, q: F.when((p == a) & (q == b), -1).when((p == b) & (q == a), 1).otherwise(0))
    found = F.aggregate(edges, F.lit(0), lambda s, d: F.when(s == 0, d).otherwise(s))
    return F.when(twice >= 0, found).otherwise(-found)


def merged_lines(lines: DataFrame, places: int = 9) -> DataFrame:
    """(line) of lines (id, line) joined where exactly two ends meet: ends are matched by joins, a chain's lines are put in order by one task."""
    end = lambda k: F.concat_ws(" ", *[F.round(F.element_at("line", k)[i], places).cast("string") for i in (0, 1)])
    e = lines.select("id", end(1).alias("node")).union(lines.select("id", end(-1).alias("node")))
    two = e.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter("n = 2")
    comp = connected_components(two, "a", "b").select("id", "component")
    own = lines.join(comp, "id", "left").withColumn("chain", F.coalesce("component", "id"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        return pd.DataFrame({"line": [x.tolist() for x in merge_lines([as_line(v) for v in frame["line"]])]})

    return own.select("chain", "id", "line").groupBy("chain").applyInPandas(run, f"line {LINE}")


def polygonized(lines: DataFrame, key: str) -> DataFrame:
    """(key, polygons, dangles, cuts): what the noded lines (key, line) of each key bound, and how many bound nothing."""
    kind = dict(lines.dtypes)[key]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found, dangles, cuts = polygonize([as_line(v) for v in frame["line"]])
        return pd.DataFrame({key: frame[key].iloc[:1], "polygons": [[[r.tolist() for r in p] for p in found]], "dangles": [len(dangles)], "cuts": [len(cuts)]})

    return lines.select(key, "line").groupBy(key).applyInPandas(run, f"{key} {kind}, polygons array<{POLYGON}>, dangles int, cuts int")


def hulls(points: DataFrame, key: str, inset: float = 0.0) -> DataFrame:
    """(key, hull): the convex ring around the points (key, x, y) of each key, moved inwards; null if nothing remains.

    Each task first keeps the corners of what it has, so that few points of a key are gathered.
    """
    from thalweg.operators.spatial import convex_hull

    kind = dict(points.dtypes)[key]

    def corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for name, own in frame.groupby(key, dropna=False):
                found = convex_hull(own[["x", "y"]].to_numpy(float))
                yield pd.DataFrame({key: [name] * len(found), "x": found[:, 0], "y": found[:, 1]})

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        found = convex_hull(frame[["x", "y"]].to_numpy(float))
        if inset > 0 and len(found) > 2:
            found = hull_inset(found, inset)
        ring = np.vstack([found, found[:1]]).tolist() if len(found) > 2 else None
        return pd.DataFrame({key: frame[key].iloc[:1], "hull": [ring]})

    some = points.select(key, "x", "y").dropna().mapInPandas(corners, f"{key} {kind}, x double, y double")
    return some.groupBy(key).applyInPandas(whole, f"{key} {kind}, hull {LINE}")


# ---- vectors


def vector(x, y, z) -> Column:
    return F.struct(F.col(x).alias("x") if isinstance(x, str) else x.alias("x"), F.col(y).alias("y") if isinstance(y, str) else y.alias("y"), F.col(z).alias("z") if isinstance(z, str) else z.alias("z"))


def minus(a: Column, b: Column) -> Column:
    return vector(a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"])


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def cross(a: Column, b: Column) -> Column:
    return vector(a["y"] * b["z"] - a["z"] * b["y"], a["z"] * b["x"] - a["x"] * b["z"], a["x"] * b["y"] - a["y"] * b["x"])


def normalised(a: Column) -> Column:
    """The vector of length 1; of no length, itself."""
    n = F.sqrt(dot(a, a))
    return F.when(n > 0, vector(a["x"] / n, a["y"] / n, a["z"] / n)).otherwise(a)


def triangle_normal(a: Column, b: Column, c: Column) -> Column:
    return normalised(cross(minus(b, a), minus(c, a)))


def det(a: Column, b: Column, c: Column) -> Column:
    return dot(a, cross(b, c))


# ---- clipping to a box, in the JVM


def clip_shares(x1: Column, y1: Column, x2: Column, y2: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> tuple[Column, Column]:
    """The shares of a segment between which it lies in a box; it misses the box if the first is greater."""
    low, high = F.lit(0.0), F.lit(1.0)
    for a, b, lo, hi in ((x1, x2, minx, maxx), (y1, y2, miny, maxy)):
        d = b - a
        flat, inside = d == 0, (a >= lo) & (a <= hi)
        t1, t2 = F.try_divide(lo - a, d), F.try_divide(hi - a, d)
        low = F.greatest(low, F.when(flat, F.when(inside, 0.0).otherwise(2.0)).otherwise(F.least(t1, t2)))
        high = F.least(high, F.when(flat, F.when(inside, 1.0).otherwise(-1.0)).otherwise(F.greatest(t1, t2)))
    return low, high


def nearest_k(rows: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """The first k rows of each ``by`` in an order."""
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_place") <= k).drop("_place")
