"""Planar and spherical geometry as Column expressions, and spatial joins through a grid of buckets."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Half the width of the square world map, in metres (a fixed value).
MERCATOR_EDGE = 20037508.342789244
#: Buckets that one box may cover before it counts as a mistake.
MOST_BUCKETS = 1_000_000


# ---- scalar functions


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point to a segment; null if any coordinate is."""
    dx, dy = x2 - x1, y2 - y1
    size = dx * dx + dy * dy
    t = F.when(size == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / size)))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def line_length(line: Column) -> Column:
    """Length of an array of struct<x, y>; 0 of fewer than two points."""
    pairs = F.zip_with(F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))), lambda a, b: F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"])))
    return F.aggregate(pairs, F.lit(0.0), lambda s, d: s + d)


def ring_area(ring: Column) -> Column:
    """Signed area of a closed ring of struct<x, y>, positive if it turns left."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.aggregate(F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0), lambda s, d: s + d) / 2


def point_in_ring(px: Column, py: Column, ring: Column) -> Column:
    """A point strictly inside a closed ring, by crossings of a ray."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    hits = F.zip_with(
        F.slice(ring, 1, n), F.slice(ring, 2, n),
        lambda a, b: F.when(((a["y"] > py) != (b["y"] > py)) & (px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"]), 1).otherwise(0),
    )
    return F.aggregate(hits, F.lit(0), lambda s, d: s + d) % 2 == 1


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Initial great-circle bearing in radians, clockwise from north, in (-pi, pi]."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    return F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d))


def angle_between(first: Column, second: Column) -> Column:
    """Difference of two directions, folded into 0..pi."""
    d = F.abs(first - second)
    return F.when(d > math.pi, 2 * math.pi - d).otherwise(d)


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Geographic degrees to spherical Mercator metres."""
    return lon * (MERCATOR_EDGE / 180), F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * (MERCATOR_EDGE / math.pi)


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return x * (180 / MERCATOR_EDGE), F.degrees(F.atan(F.exp(y * (math.pi / MERCATOR_EDGE))) * 2 - math.pi / 2)


# The ellipsoid's axis and squared eccentricity, and the standard parallels, origin and offsets of the national conic projection.
_AXIS, _ECC2 = 6378137.0, 0.006694380022900787
_PARALLELS, _ORIGIN, _OFFSET = (49.0, 77.0), (-91.866666666666667, 63.390675), (6200000.0, 3000000.0)


def _conic() -> tuple[float, float, float]:
    """The cone's constant, its scale, and the radius of the origin's parallel."""
    m = lambda p: math.cos(p) / math.sqrt(1 - _ECC2 * math.sin(p) ** 2)
    e = math.sqrt(_ECC2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    one, two = map(math.radians, _PARALLELS)
    n = math.log(m(one) / m(two)) / math.log(t(one) / t(two))
    f = m(one) / (n * t(one) ** n)
    return n, _AXIS * f, _AXIS * f * t(math.radians(_ORIGIN[1])) ** n


def to_conic(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Geographic degrees to the metres of the conformal conic projection of two parallels (EPSG:3347)."""
    n, scale, rho0 = _conic()
    e = math.sqrt(_ECC2)
    sine = F.sin(F.radians(lat))
    t = F.tan(math.pi / 4 - F.radians(lat) / 2) / F.pow((1 - e * sine) / (1 + e * sine), F.lit(e / 2))
    rho, theta = scale * F.pow(t, F.lit(n)), n * F.radians(lon - _ORIGIN[0])
    return _OFFSET[0] + rho * F.sin(theta), _OFFSET[1] + rho0 - rho * F.cos(theta)


def from_conic(x: Column, y: Column) -> tuple[Column, Column]:
    """The way back, by six steps of iteration."""
    n, scale, rho0 = _conic()
    e = math.sqrt(_ECC2)
    dx, dy = x - _OFFSET[0], rho0 - (y - _OFFSET[1])
    t = F.pow(F.sqrt(dx * dx + dy * dy) / scale, F.lit(1 / n))
    lat = F.aggregate(
        F.sequence(F.lit(1), F.lit(6)),
        math.pi / 2 - 2 * F.atan(t),
        lambda p, _: math.pi / 2 - 2 * F.atan(t * F.pow((1 - e * F.sin(p)) / (1 + e * F.sin(p)), F.lit(e / 2))),
    )
    return F.degrees(F.atan2(dx, dy)) / n + _ORIGIN[0], F.degrees(lat)


def flipped_axes(line: Column) -> Column:
    """A line whose points have their two axes changed over, for systems that state north first."""
    return F.transform(line, lambda p: F.concat(F.array(p[1], p[0]), F.slice(p, 3, F.greatest(F.size(p) - 2, F.lit(0)))))


def snapped(value: Column, scale: float = 1e8) -> Column:
    """A coordinate on the precision grid."""
    return F.round(value * scale) / scale


def tile_envelope(z: Column, x: Column, y: Column) -> tuple[Column, Column, Column, Column]:
    """Mercator box of a map tile: minx, miny, maxx, maxy."""
    size = 2 * MERCATOR_EDGE / F.pow(F.lit(2.0), z)
    return x * size - MERCATOR_EDGE, MERCATOR_EDGE - (y + 1) * size, (x + 1) * size - MERCATOR_EDGE, MERCATOR_EDGE - y * size


def tile_key(layer: Column, z: Column, x: Column, y: Column) -> Column:
    """``LAYER__z_x_y``; null for a tile that the zoom doesn't have."""
    side = F.pow(F.lit(2.0), z)
    return F.when((x >= 0) & (y >= 0) & (x < side) & (y < side), F.concat(F.upper(layer), F.lit("__"), F.concat_ws("_", z.cast("string"), x.cast("string"), y.cast("string"))))


def simplify_tolerance(z: Column) -> Column:
    """Tolerance by zoom (fixed values); null where lines stay as they are."""
    return F.when(z <= 3, 0.05).when(z <= 7, 0.01).when(z <= 9, 0.001)


def simplify(line: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker on rows of x, y, without recursion; ends stay."""
    n = len(line)
    keep = np.zeros(n, bool)
    if n:
        keep[[0, -1]] = True
    stack = [(0, n - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        p, d = line[a], line[b] - line[a]
        rest = line[a + 1 : b] - p
        size = float(d @ d)
        t = np.clip(rest @ d / size, 0, 1) if size else np.zeros(len(rest))
        off = np.hypot(*(rest - t[:, None] * d).T)
        k = int(off.argmax())
        if off[k] > tolerance:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    return line[keep]


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Corners of the hull, counter-clockwise from the lowest x, by monotone chains."""
    rows = sorted(set(map(tuple, points.tolist())))
    if len(rows) < 3:
        return np.array(rows).reshape(-1, 2)

    def half(seq) -> list:
        out: list = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(rows) + half(rows[::-1]))


# ---- joins through buckets


def boxes_to_cells(boxes: DataFrame, size: float) -> DataFrame:
    """Each box once for each bucket (bx, by) it touches."""
    f = lambda c: F.floor(F.col(c) / size)
    count = (f("maxx") - f("minx") + 1) * (f("maxy") - f("miny") + 1)
    checked = boxes.withColumn("_n", F.when(count > MOST_BUCKETS, F.raise_error(F.lit("a box covers too many buckets; use larger ones"))).otherwise(count)).filter("_n IS NOT NULL")
    return checked.withColumn("bx", F.explode(F.sequence(f("minx"), f("maxx")))).withColumn("by", F.explode(F.sequence(f("miny"), f("maxy")))).drop("_n")


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    """(id, box) of points (id, x, y) strictly inside boxes (id, minx, miny, maxx, maxy)."""
    p = points.select("id", "x", "y", F.floor(F.col("x") / size).alias("bx"), F.floor(F.col("y") / size).alias("by"))
    b = boxes_to_cells(boxes.select(F.col("id").alias("box"), "minx", "miny", "maxx", "maxy"), size)
    return p.join(b, ["bx", "by"]).filter("x > minx AND x < maxx AND y > miny AND y < maxy").select("id", "box")


def nearest(points: DataFrame, targets: DataFrame, k: int, radius: float, inclusive: bool = True) -> DataFrame:
    """(id, target, distance, place) of the k nearest targets (id, x, y) of each point within ``radius``; ties by target id.

    Points look in the nine buckets of size ``radius`` around them, so nothing farther is ever compared.
    """
    cell = lambda c: F.floor(F.col(c) / radius)
    p = points.select("id", "x", "y", F.explode(F.array(*[F.struct((cell("x") + i).alias("bx"), (cell("y") + j).alias("by")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("b")).select("id", "x", "y", "b.bx", "b.by")
    t = targets.select(F.col("id").alias("target"), F.col("x").alias("tx"), F.col("y").alias("ty"), cell("x").alias("bx"), cell("y").alias("by"))
    d = F.sqrt((F.col("x") - F.col("tx")) * (F.col("x") - F.col("tx")) + (F.col("y") - F.col("ty")) * (F.col("y") - F.col("ty")))
    close = p.join(t, ["bx", "by"]).withColumn("distance", d).filter(F.col("distance") <= radius if inclusive else F.col("distance") < radius)
    w = Window.partitionBy("id").orderBy("distance", "target")
    return close.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select("id", "target", "distance", "place")


def shared_borders(boxes: DataFrame) -> DataFrame:
    """(id, other, shared) of rectangles of one grid that share a side: by equal segments, whichever way they run."""
    side = lambda a, b, c, d: F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2"))
    s = boxes.select("id", F.explode(F.array(side("minx", "miny", "maxx", "miny"), side("minx", "maxy", "maxx", "maxy"), side("minx", "miny", "minx", "maxy"), side("maxx", "miny", "maxx", "maxy"))).alias("s"))
    other = s.select(F.col("id").alias("other"), "s")
    both = s.join(other, "s").filter("id <> other")
    return both.groupBy("id", "other").agg(F.sum(F.col("s.x2") - F.col("s.x1") + F.col("s.y2") - F.col("s.y1")).alias("shared"))


def dissolve(boxes: DataFrame, key: str) -> DataFrame:
    """(key, segments, outline): sides that only one rectangle of a group has make the group's outline; inner sides cancel."""
    side = lambda a, b, c, d: F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2"))
    s = boxes.select(key, F.explode(F.array(side("minx", "miny", "maxx", "miny"), side("minx", "maxy", "maxx", "maxy"), side("minx", "miny", "minx", "maxy"), side("maxx", "miny", "maxx", "maxy"))).alias("s"))
    odd = s.groupBy(key, "s").agg(F.count("*").alias("n")).filter("n % 2 = 1")
    return odd.groupBy(key).agg(F.count("*").alias("segments"), F.sum(F.col("s.x2") - F.col("s.x1") + F.col("s.y2") - F.col("s.y1")).alias("outline"))


def repeated_segments(segments: DataFrame) -> DataFrame:
    """(x1, y1, x2, y2, n) of segments that occur more than once, whichever way they run."""
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    both = segments.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    found = both.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1")
    return found.select(F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), "n")


def near(rows: DataFrame, x: float, y: float, radius: float, most: int) -> DataFrame:
    """(id, distance) of the ``most`` rows (id, x, y) nearest to a place, within ``radius``; ties by id. The envelope of the circle is tested first."""
    box = rows.filter((F.col("x") >= x - radius) & (F.col("x") <= x + radius) & (F.col("y") >= y - radius) & (F.col("y") <= y + radius))
    d = F.sqrt((F.col("x") - x) * (F.col("x") - x) + (F.col("y") - y) * (F.col("y") - y))
    return box.select("id", d.alias("distance")).filter(F.col("distance") <= radius).orderBy("distance", "id").limit(most)


def within(rows: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Rows (x, y) in a box, edges included."""
    return rows.filter(F.col("x").between(minx, maxx) & F.col("y").between(miny, maxy))


def touched(nodes: DataFrame, edges: DataFrame, size: float) -> DataFrame:
    """(catchment, nexus): nodes (id, x, y) that lie on an edge (id, x1, y1, x2, y2) of a catchment's boundary."""
    boxes = edges.select("id", "x1", "y1", "x2", "y2", F.least("x1", "x2").alias("minx"), F.least("y1", "y2").alias("miny"), F.greatest("x1", "x2").alias("maxx"), F.greatest("y1", "y2").alias("maxy"))
    cells = boxes_to_cells(boxes, size).select("bx", "by", F.col("id").alias("catchment"), "x1", "y1", "x2", "y2")
    placed = nodes.select(F.col("id").alias("nexus"), "x", "y", F.floor(F.col("x") / size).alias("bx"), F.floor(F.col("y") / size).alias("by"))
    on = segment_distance(*[F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]) == 0
    return placed.join(cells, ["bx", "by"]).filter(on).select("catchment", "nexus").distinct()
