"""Map tiles: placing, quantising, simplifying by zoom, and the vector tile format; WKB of lines."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thalweg.operators.spatial import simplify, simplify_tolerance, tile_key

#: Units of a tile's side (a fixed value of the format).
EXTENT = 4096
_LINE = "array<array<double>>"


def simplified_by_zoom(lines: DataFrame, zooms: list[int]) -> DataFrame:
    """(id, z, line) of lines (id, line) at each zoom, by the zoom's tolerance; from zoom 10 on as they are. A line is simplified once for each tolerance."""

    @F.arrow_udf(_LINE)
    def run(line: pa.Array, tolerance: pa.Array) -> pa.Array:
        out = []
        for x, t in zip(line.to_pylist(), tolerance.to_pylist(), strict=True):
            out.append(x if x is None or t is None else simplify(np.array(x, float).reshape(-1, 2), t).tolist())
        return pa.array(out, pa.list_(pa.list_(pa.float64())))

    levels = lines.sparkSession.createDataFrame([(z,) for z in zooms], "z int").withColumn("tolerance", simplify_tolerance(F.col("z")))
    steps = sorted({r["tolerance"] for r in levels.select("tolerance").collect()}, key=lambda t: (t is None, t))
    spread = lines.withColumn("tolerance", F.explode(F.array(*[F.lit(t).cast("double") for t in steps])))
    done = spread.select("id", "tolerance", run("line", "tolerance").alias("line"))
    at = F.array(*[F.lit(z) for z in zooms])
    return done.withColumn("z", F.explode(F.filter(at, lambda z: simplify_tolerance(z).eqNullSafe(F.col("tolerance"))))).select("id", "z", "line")


def placed_in_tiles(points: DataFrame, lon: str, lat: str, z: int) -> DataFrame:
    """Add the tile (tx, ty) of a zoom that each place lies in, and its whole-number place there (px, py); what lies beyond the map goes to its edge."""
    side = 2**z
    north = F.log(F.tan(F.radians(F.col(lat)) / 2 + math.pi / 4)) / math.pi * 180
    u, v = (F.col(lon) + 180) / 360 * side, (180 - north) / 360 * side
    tile = lambda c: F.least(F.greatest(F.floor(c), F.lit(0)), F.lit(side - 1)).cast("int")
    at = points.withColumns({"_u": u, "_v": v}).withColumns({"tx": tile(F.col("_u")), "ty": tile(F.col("_v"))})
    unit = lambda c, t: F.round((F.col(c) - F.col(t)) * EXTENT).cast("int")
    return at.withColumns({"px": unit("_u", "tx"), "py": unit("_v", "ty")}).drop("_u", "_v")


# ---- the vector tile format (protocol buffers)


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, data: bytes | int) -> bytes:
    if isinstance(data, int):
        return _varint(number << 3) + _varint(data)
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _value(v) -> bytes:
    if isinstance(v, bool):
        return _field(7, int(v))
    if isinstance(v, int):
        return _field(4, v)
    if isinstance(v, float):
        return _varint(3 << 3 | 1) + struct.pack("<d", v)
    return _field(1, str(v).encode())


def _zigzag(n: int) -> int:
    return n << 1 ^ n >> 63


def geometry_commands(points: list[tuple[int, int]]) -> list[int]:
    """A point or a line as commands: go to the first place, then draw to the others."""
    out, x, y = [], 0, 0
    for k, (px, py) in enumerate(points):
        if k < 2:
            out.append(1 | 1 << 3 if k == 0 else 2 | len(points) - 1 << 3)
        out += [_zigzag(px - x), _zigzag(py - y)]
        x, y = px, py
    return out


def encode_layer(name: str, features: list[tuple[int, list[tuple[int, int]], dict]]) -> bytes:
    """A tile of one layer of (id, points, attributes); equal values are kept once, nulls not at all."""
    keys: dict[str, int] = {}
    values: dict[tuple, int] = {}
    body = b""
    for fid, points, attributes in features:
        tags = b""
        for k, v in attributes.items():
            if v is not None:
                tags += _varint(keys.setdefault(k, len(keys))) + _varint(values.setdefault((type(v), v), len(values)))
        geometry = b"".join(map(_varint, geometry_commands(points)))
        body += _field(2, _field(1, fid) + _field(2, tags) + _field(3, 1 if len(points) == 1 else 2) + _field(4, geometry))
    layer = _field(15, 2) + _field(1, name.encode()) + body + b"".join(_field(3, k.encode()) for k in keys) + b"".join(_field(4, _value(v)) for _, v in values) + _field(5, EXTENT)
    return _field(3, layer)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 1:
            at += 8
            yield tag >> 3, data[at - 8 : at]
        else:
            n = varint()
            at += n
            yield tag >> 3, data[at - n : at]


def _numbers(data: bytes) -> list[int]:
    out, n, shift = [], 0, 0
    for b in data:
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            out.append(n)
            n = shift = 0
    return out


def decode_tile(tile: bytes) -> dict[str, list[tuple[int, list[tuple[int, int]], dict]]]:
    """Features (id, points, attributes) of a tile by layer."""
    out = {}
    for _, layer in _fields(tile):
        parts: dict[int, list] = {}
        for n, v in _fields(layer):
            parts.setdefault(n, []).append(v)
        keys, values = [k.decode() for k in parts.get(3, [])], []
        for raw in parts.get(4, []):
            ((n, v),) = _fields(raw)
            signed = lambda u: u - (1 << 64) if u >> 63 else u
            values.append(v.decode() if n == 1 else struct.unpack("<d", v)[0] if n == 3 else bool(v) if n == 7 else signed(v))
        rows = []
        for raw in parts.get(2, []):
            f = dict(_fields(raw))
            tags, commands = _numbers(f.get(2, b"")), _numbers(f[4])
            points, x, y, at = [], 0, 0, 0
            while at < len(commands):
                for _ in range(commands[at] >> 3):
                    x, y = x + (commands[at + 1] >> 1 ^ -(commands[at + 1] & 1)), y + (commands[at + 2] >> 1 ^ -(commands[at + 2] & 1))
                    points.append((x, y))
                    at += 2
                at += 1
            rows.append((f[1], points, {keys[k]: values[v] for k, v in zip(tags[::2], tags[1::2], strict=True)}))
        out[parts[1][0].decode()] = rows
    return out


def encoded_tiles(placed: DataFrame, layer: str, z: int, attributes: list[str]) -> DataFrame:
    """(key, tile): a vector tile for each (tx, ty) of ``placed`` (id, tx, ty, px, py, attributes), features by id. A tile is one value, made by one task."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        plain = lambda v: None if v is None or v != v else v.item() if hasattr(v, "item") else v
        rows = [(int(r["id"]), [(int(r["px"]), int(r["py"]))], {a: plain(r[a]) for a in attributes}) for r in frame.to_dict("records")]
        return pd.DataFrame({"tx": frame["tx"].iloc[:1], "ty": frame["ty"].iloc[:1], "tile": [encode_layer(layer.lower(), rows)]})

    columns = list(dict.fromkeys(["id", "tx", "ty", "px", "py", *attributes]))
    made = placed.select(*columns).groupBy("tx", "ty").applyInPandas(run, "tx int, ty int, tile binary")
    return made.select(tile_key(F.lit(layer), F.lit(z), F.col("tx"), F.col("ty")).alias("key"), "tile")


def features_in(tile: Column) -> Column:
    """How many features a tile holds."""

    @F.arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if t is None else sum(map(len, decode_tile(t).values())) for t in column.to_pylist()], pa.int64())

    return run(tile)


# ---- WKB


def line_wkb(line: Column) -> Column:
    """A line (array of [x, y]) as little-endian WKB."""

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if p is None else struct.pack("<BII", 1, 2, len(p)) + np.array(p, "<f8").tobytes() for p in column.to_pylist()], pa.binary())

    return run(line)


def parsed_wkb(rows: DataFrame) -> DataFrame:
    """(id, kind, line) of rows (id, wkb) that hold points, lines or polygons; a polygon gives its outer ring, null stays null."""
    from thalweg.sources.readers import parse_wkb

    @F.arrow_udf(f"struct<kind:string,line:{_LINE}>")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for data in column.to_pylist():
            if data is None:
                out.append(None)
                continue
            kind, points = parse_wkb(data)
            out.append({"kind": kind, "line": [points] if kind == "Point" else points[0] if kind == "Polygon" else points})
        return pa.array(out, pa.struct([("kind", pa.string()), ("line", pa.list_(pa.list_(pa.float64())))]))

    return rows.select("id", run("wkb").alias("g")).select("id", "g.kind", "g.line")


def polygon_geojson(polygon: Column) -> Column:
    return F.struct(F.lit("Polygon").alias("type"), polygon.alias("coordinates"))
