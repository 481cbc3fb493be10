from thalweg.operators import tiles as T


def test_tiles_decode_as_they_were():
    features = [
        (7, [(1, 2)], {"name": "É", "n": -3, "x": 1.5, "flag": True, "none": None}),
        (8, [(0, 0), (4096, -5), (10, 10)], {"name": "É", "n": 3}),
        (1 << 40, [(5, 5), (5, 6)], {}),
    ]
    found = T.decode_tile(T.encode_layer("flow", features))
    assert found == {"flow": [(i, p, {k: v for k, v in a.items() if v is not None}) for i, p, a in features]}
    # the commands of the format's own example: a line of three places
    assert T.geometry_commands([(2, 2), (2, 10), (10, 10)]) == [9, 4, 4, 18, 0, 16, 16, 0]
    assert T.geometry_commands([(25, 17)]) == [9, 50, 34]


def test_places_beyond_the_map_go_to_its_edge(spark):
    rows = [(1, -180.0, 0.0), (2, 180.0, 89.9), (3, 0.0, -89.9), (4, 90.0, 66.5)]
    got = {r.id: (r.tx, r.ty) for r in T.placed_in_tiles(spark.createDataFrame(rows, "id long, lon double, lat double"), "lon", "lat", 2).collect()}
    assert got == {1: (0, 2), 2: (3, 0), 3: (2, 3), 4: (3, 1)}


def test_wkb_of_several_kinds(spark):
    import struct

    point = struct.pack("<BIdd", 1, 1, 3.0, 4.0)
    ring = struct.pack(">BIII", 0, 3, 1, 4) + struct.pack(">8d", 0, 0, 1, 0, 0, 1, 0, 0)
    got = {r.id: (r.kind, r.line) for r in T.parsed_wkb(spark.createDataFrame([(1, point), (2, ring), (3, None)], "id long, wkb binary")).collect()}
    assert got == {1: ("Point", [[3.0, 4.0]]), 2: ("Polygon", [[0.0, 0.0], [1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]), 3: (None, None)}
