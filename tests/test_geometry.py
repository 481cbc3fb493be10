import json
import math
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.operators import raster as R
from thalweg.operators import relational as Q
from thalweg.operators import sinks as S
from thalweg.operators import spatial as G
from thalweg.sources.readers import gpkg_wkb, parse_wkb, register_sources


def horn(z, cell):
    dx = (z[0][2] + 2 * z[1][2] + z[2][2]) - (z[0][0] + 2 * z[1][0] + z[2][0])
    dy = (z[2][0] + 2 * z[2][1] + z[2][2]) - (z[0][0] + 2 * z[0][1] + z[0][2])
    return math.degrees(math.atan(math.hypot(dx / (8 * cell), dy / (8 * cell))))


def test_slope_and_aspect(spark):
    r = np.random.default_rng(1)
    z = r.integers(0, 300, (12, 9)).astype(float)
    z[5, 5] = np.nan
    rows = [(i, j, None if np.isnan(z[i, j]) else float(z[i, j])) for i in range(12) for j in range(9)]
    got = {(x.r, x.c): x for x in R.slope_aspect(spark.createDataFrame(rows, "r long, c long, z double"), 100.0).collect()}
    assert len(got) == 108
    for i in range(12):
        for j in range(9):
            near = z[max(0, i - 1) : i + 2, max(0, j - 1) : j + 2]
            if near.shape == (3, 3) and not np.isnan(near).any():
                assert abs(got[i, j].slope - horn(near.tolist(), 100)) < 1e-5 and 0 <= got[i, j].aspect <= 360
            else:
                assert got[i, j].slope is None


@pytest.mark.parametrize(("plane", "faces"), [(lambda r, c: -c, "E"), (lambda r, c: c, "W"), (lambda r, c: r, "N"), (lambda r, c: -r, "S"), (lambda r, c: 0, "flat")])
def test_planes_face_their_way(spark, plane, faces):
    rows = [(r, c, 100.0 * plane(r, c)) for r in range(3) for c in range(3)]
    shaped = R.slope_aspect(spark.createDataFrame(rows, "r long, c long, z double"), 100.0).filter("r = 1 AND c = 1")
    assert shaped.select(R.aspect_class(F.col("slope"), F.col("aspect")).alias("k")).first().k == faces


def test_zones_and_their_neighbours(spark):
    grid = spark.createDataFrame([(r, c, float(10 * r + c)) for r in range(4) for c in range(4)], "r long, c long, z double")
    zones = spark.createDataFrame([(1, 0.0, 0.0, 200.0, 200.0), (2, 200.0, 0.0, 400.0, 200.0), (3, 0.0, 200.0, 10.0, 210.0)], "id long, minx double, miny double, maxx double, maxy double")
    stats = R.zonal_stats(R.zone_cells(R.slope_aspect(grid, 100.0), zones, 100.0, 150.0))
    got = {x.id: x for x in zones.select("id").join(stats, "id", "left").collect()}
    assert (got[1].elv_min, got[1].elv_max, got[1].elv_mean) == (0, 11, 5.5) and got[3].elv_min is None
    borders = spark.createDataFrame([(3, 1, 10.0), (3, 2, 10.0)], "id long, other long, shared double")
    filled = {x.id: x.elv_mean for x in R.fill_missing_zones(zones.select("id").join(stats, "id", "left"), borders).collect()}
    assert filled[3] == 5.5


def test_scalar_geometry(spark):
    d = spark.range(1)
    value = lambda c: d.select(c.alias("v")).first().v
    lit = lambda *v: [F.lit(float(x)) for x in v]
    assert value(G.segment_distance(*lit(5, 5, 0, 0, 10, 0))) == 5 and value(G.segment_distance(*lit(3, 4, 0, 0, 0, 0))) == 5
    assert abs(value(G.bearing(*lit(0, 0, 1, 0))) - math.pi / 2) < 1e-12
    assert abs(value(G.angle_between(*lit(3, -3))) - (2 * math.pi - 6)) < 1e-12
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 3), (0, 0))])
    assert value(G.ring_area(ring)) == 12 and value(G.line_length(ring)) == 14
    assert value(G.point_in_ring(*lit(1, 1), ring)) and not value(G.point_in_ring(*lit(5, 1), ring))
    x, y = G.to_mercator(*lit(-75.5, 45.25))
    lon, lat = G.from_mercator(x, y)
    assert abs(value(lon) + 75.5) < 1e-9 and abs(value(lat) - 45.25) < 1e-9
    assert [value(c) for c in G.tile_envelope(F.lit(0), F.lit(0), F.lit(0))] == [-G.MERCATOR_EDGE, -G.MERCATOR_EDGE, G.MERCATOR_EDGE, G.MERCATOR_EDGE]
    assert value(G.tile_key(F.lit("flow"), F.lit(2), F.lit(3), F.lit(0))) == "FLOW__2_3_0" and value(G.tile_key(F.lit("flow"), F.lit(2), F.lit(4), F.lit(0))) is None
    assert [value(Q.letters(F.lit(n))) for n in (0, 25, 26, 51, 52, 701, 702)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA"]


def test_kernels():
    line = np.array([[0, 0], [1, 0.01], [2, -0.01], [3, 5], [4, 0], [5, 0]])
    assert G.simplify(line, 0.1).tolist() == [[0, 0], [2, -0.01], [3, 5], [4, 0], [5, 0]] and len(G.simplify(line, 10)) == 2 and len(G.simplify(line[:1], 1)) == 1
    hull = G.convex_hull(np.array([[x, y] for x in range(5) for y in range(5)], float))
    assert sorted(hull.tolist()) == [[0, 0], [0, 4], [4, 0], [4, 4]]


def test_nearest_is_brute_force(spark):
    r = np.random.default_rng(3)
    xy = r.integers(0, 60, (80, 2)).astype(float)
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id long, x double, y double")
    got = sorted((a.id, a.target, a.place) for a in G.nearest(p, p, 3, 9.0).collect())
    want = []
    for i in range(80):
        near = sorted((float(np.hypot(*(xy[i] - xy[j]))), j) for j in range(80) if np.hypot(*(xy[i] - xy[j])) <= 9)[:3]
        want += [(i, j, k + 1) for k, (_, j) in enumerate(near)]
    assert got == sorted(want)


def test_predicates_and_patterns(spark):
    d = spark.createDataFrame([("a%b", 1), ("axb", 2), ("A%B", None)], "name string, v int")
    assert d.filter(F.col("name").ilike(Q.like_pattern("a%b"))).count() == 2
    assert d.filter(Q.predicate(F.col("v"), "notEquals", 1)).count() == 1
    with pytest.raises(ValueError):
        Q.predicate(F.col("v"), "like", 1)
    with pytest.raises(ValueError):
        Q.guarded(d, 2)


def test_geopackage_round_trip(spark, tmp_path):
    register_sources(spark)
    rows = [(i, float(i), 0.5, float(i) + 1, -0.5, f"n{i}" if i % 2 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, x1 double, y1 double, x2 double, y2 double, name string")
    path = f"{tmp_path}/out.gpkg"
    assert S.write_geopackage(df, path, "flow") == 50
    back = spark.read.format("gpkg").option("layer", "flow").load(path).collect()
    got = {int(r.id): (parse_wkb(bytes(r.wkb)), r.name) for r in back}
    assert got == {i: (("LineString", [[a, b], [c, e]]), n) for i, a, b, c, e, n in rows}
    with pytest.raises(ValueError):
        S.write_geopackage(df, path, "flow", most=10)
    with sqlite3.connect(path) as db:
        assert gpkg_wkb(db.execute("SELECT geometry FROM flow").fetchone()[0])[:5] == struct.pack("<BI", 1, 2)


def test_ascii_grid_and_shapefile(spark, tmp_path):
    register_sources(spark)
    (tmp_path / "a.asc").write_text("ncols 3\nnrows 2\nxllcorner 10\nyllcorner 20\ncellsize 2\nNODATA_value -9999\n1 2 3\n4 -9999 6\n")
    got = spark.read.format("asciigrid").load(f"{tmp_path}/a.asc").collect()
    assert [(r.r, r.c, r.x, r.y, r.z) for r in got] == [(0, 0, 11, 23, 1), (0, 1, 13, 23, 2), (0, 2, 15, 23, 3), (1, 0, 11, 21, 4), (1, 1, 13, 21, None), (1, 2, 15, 21, 6)]
    body = struct.pack("<i4dii i", 3, 0, 0, 1, 1, 1, 2, 0) + struct.pack("<4d", 0, 0, 1, 1)
    (tmp_path / "b.shp").write_bytes(b"\0" * 100 + struct.pack(">ii", 1, len(body) // 2) + body)
    field = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([5, 0]) + b"\0" * 14
    (tmp_path / "b.dbf").write_bytes(struct.pack("<4BIHH", 3, 0, 0, 0, 1, 65, 6) + b"\0" * 20 + field + b"\r" + b" river")
    (r,) = spark.read.format("shp").load(f"{tmp_path}/b.shp").collect()
    assert (r.kind, r.parts, r.attributes) == ("LineString", [[[0.0, 0.0], [1.0, 1.0]]], {"NAME": "river"})


def test_wkb_of_one_part_is_that_part():
    line = struct.pack("<BII4d", 1, 2, 2, 0, 0, 1, 1)
    assert parse_wkb(struct.pack("<BII", 1, 5, 1) + line) == ("LineString", [[0, 0], [1, 1]])
    with pytest.raises(ValueError):
        parse_wkb(struct.pack("<BII", 1, 5, 2) + line + line)


def test_geojson(spark):
    d = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 2.0, None)], "id long, x1 double, y1 double, x2 double, y2 double, name string")
    text = d.select(S.geojson_feature(F.lit("flowpath"), F.col("id"), {"name": F.col("name")}, S.line_geometry(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])).alias("f")).first().f
    assert json.loads(text) == {"type": "Feature", "id": "1", "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 2]]}, "properties": {"feature_type": "flowpath"}}


def test_loops_and_arrays_give_the_same_triangles(monkeypatch):
    from thalweg.operators import construct as C

    r = np.random.default_rng(11)
    for n in range(3, 60, 4):
        for points in (r.random((n, 2)) * 100, r.integers(0, 6, (n, 2)).astype(float), np.stack([np.cos(np.arange(n)), np.sin(np.arange(n))], 1) + 1e5):
            few = C.delaunay(points)
            monkeypatch.setattr(C, "FEW_POINTS", 0)
            assert few.tolist() == C.delaunay(points).tolist()
            monkeypatch.undo()
