import json
import math
import random

import pytest

from meshroad.operators.polygons import assign_zip, polygon_index
from meshroad.sources.geojson import polygons_from_features


def polys(spark, features):
    rows = [(i, z, g["type"], json.dumps(g["coordinates"])) for i, (z, g) in enumerate(features)]
    return polygons_from_features(spark.createDataFrame(rows, "polygon_id long, zip string, geometry_type string, coordinates string"))


def points(spark, xy):
    return spark.createDataFrame([(i, float(y), float(x), "old") for i, (x, y) in enumerate(xy)],
                                 "Crash_ID long, Latitude double, Longitude double, ZIP_Code string")


def poly(*rings):
    return {"type": "Polygon", "coordinates": [[list(map(float, p)) for p in r + [r[0]]] for r in rings]}


L_SHAPE = poly([(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)])
HOLED = poly([(10, 0), (14, 0), (14, 4), (10, 4)], [(11, 1), (13, 1), (13, 3), (11, 3)])
TWO = {"type": "MultiPolygon", "coordinates": [poly([(20, 0), (21, 0), (21, 1), (20, 1)])["coordinates"],
                                               poly([(22, 0), (23, 0), (22.5, 1)])["coordinates"]]}
SLANTED = poly([(-3, -3), (-1, -2), (-2, 0), (-4, -1)])
FEATURES = [("78001", L_SHAPE), ("78002", HOLED), ("78003", TWO), ("78004", SLANTED),
            ("00501", poly([(1, 1), (3, 1), (3, 3), (1, 3)])), ("none", poly([(30, 0), (31, 0), (31, 1), (30, 1)]))]
CASES = {
    (1.5, 0.5): [78001], (3, 3.5): [], (0.5, 3.5): [78001], (0, 1): [], (2, 2): [501], (4, 2): [], (0, 0): [], (2, 3): [],
    (1.5, 1.5): [501, 78001], (2.5, 2.5): [501], (1, 1): [78001], (10.5, 2): [78002], (12, 2): [], (11, 2): [], (12, 1): [],
    (13.5, 1): [78002], (13.5, 3): [78002], (10.5, 0): [], (20.5, 0.5): [78003], (22.5, 0.5): [78003], (21.5, 0.5): [],
    (22.5, 1): [], (-2.5, -1.5): [78004], (-3.5, -1): [78004], (-1.2, -2.9): [], (-4, -1): [], (30.5, 0.5): [], (50, 50): [],
}


@pytest.mark.parametrize("cell,how", [
    (0.3, {}), (3.0, {}), (40.0, {}), (3.0, dict(max_edges=2)), (40.0, dict(max_edges=8)), (1.0, dict(broadcast_bytes=0)),
    (40.0, dict(max_edges=8, broadcast_bytes=0)),
], ids=str)
def test_hand_cases(spark, cell, how):
    index = polygon_index(polys(spark, FEATURES), cell_degrees=cell, **how)
    found = assign_zip(points(spark, CASES), index, keep_outside=True).collect()
    got = {}
    for r in found:
        got.setdefault(r.Crash_ID, []).append(r.ZIP_Code)
    for i, (xy, want) in enumerate(CASES.items()):
        assert sorted(z for z in got[i] if z is not None) == want, xy
    dropped = assign_zip(points(spark, CASES), index).collect()
    assert sorted(r.ZIP_Code for r in dropped) == sorted(z for w in CASES.values() for z in w)


def test_smallest_of_overlapping(spark):
    index = polygon_index(polys(spark, FEATURES))
    got = assign_zip(points(spark, [(1.5, 1.5), (50, 50)]), index, overlaps="smallest").collect()
    assert [(r.Crash_ID, r.ZIP_Code) for r in got] == [(0, 501)]


def ray_cast(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                inside = not inside
    return inside


def star(cx, cy, n, rnd):
    return [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n))
            for k in range(n) for r in [rnd.uniform(0.3, 1.2)]]


@pytest.mark.parametrize("cell,max_edges", [(0.15, 64), (0.7, 64), (5.0, 12)])
def test_random_stars_against_ray_casting(spark, cell, max_edges):
    rnd = random.Random(cell)
    shapes = {str(1000 + k): [star(rnd.uniform(-3, 3), rnd.uniform(-3, 3), rnd.choice([5, 40, 300]), rnd)] for k in range(6)}
    for k, rings in list(shapes.items())[:2]:  # holes
        cx = sum(p[0] for p in rings[0]) / len(rings[0]); cy = sum(p[1] for p in rings[0]) / len(rings[0])
        rings.append([(cx - 0.1, cy - 0.1), (cx + 0.1, cy - 0.1), (cx + 0.1, cy + 0.1), (cx - 0.1, cy + 0.1)])
    xy = [(rnd.uniform(-4.5, 4.5), rnd.uniform(-4.5, 4.5)) for _ in range(1500)]
    index = polygon_index(polys(spark, [(z, poly(*r)) for z, r in shapes.items()]), cell_degrees=cell, max_edges=max_edges)
    got = sorted((r.Crash_ID, r.ZIP_Code) for r in assign_zip(points(spark, xy), index).collect())
    want = sorted((i, int(z)) for i, (x, y) in enumerate(xy) for z, rings in shapes.items() if ray_cast(rings, x, y))
    assert got == want


def test_grid_aligned_tiles(spark):
    # Borders of tiles coincide with borders of cells; each point is in exactly one tile or on a border.
    feats = [(str(100 + 10 * i + j), poly([(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)])) for i in range(4) for j in range(4)]
    xy = [(a / 8, b / 8) for a in range(0, 33) for b in range(0, 33)]
    for cell in (0.5, 1.0):
        index = polygon_index(polys(spark, feats), cell_degrees=cell)
        got = sorted((r.Crash_ID, r.ZIP_Code) for r in assign_zip(points(spark, xy), index).collect())
        want = [(k, 100 + 10 * int(x) + int(y)) for k, (x, y) in enumerate(xy) if x % 1 and y % 1]
        assert got == want


def test_split_cells_have_few_edges(spark):
    rnd = random.Random(1)
    index = polygon_index(polys(spark, [("1", poly(star(0, 0, 500, rnd)))]), cell_degrees=10, max_edges=16)
    assert index.splits
    worst = index.leaves.selectExpr("max(aggregate(polygons, 0, (n, g) -> n + size(g.edges))) as n").first().n
    assert worst <= 16


def test_many_polygons_over_one_cell(spark):
    # All polygons cover the points' cell whole, and one has a border through it.
    n, rnd = 1_100, random.Random(4)
    spread = lambda: rnd.uniform(0.5, 3)
    boxes = [(-spread(), -spread(), spread(), spread()) for _ in range(n)] + [(-0.01, 0.01, 0.01, 0.03)]
    polygons = polys(spark, [(str(i), poly([(a, b), (c, b), (c, d), (a, d)])) for i, (a, b, c, d) in enumerate(boxes)])
    p = points(spark, [(0, 0.02), (0, 0), (40, 45), (0, 0)])
    for how in (dict(), dict(broadcast_bytes=0)):
        index = polygon_index(polygons, cell_degrees=0.5, **how)
        assert index.wide is not None and index.wide.selectExpr("max(size(polygons)) n").first().n <= 1024
        assert index.leaves.selectExpr("max(size(polygons)) n").first().n <= 1024
        got = {}
        for r in assign_zip(p, index).collect():
            got.setdefault(r.Crash_ID, []).append(r.ZIP_Code)
        assert {i: sorted(z) for i, z in got.items()} == {0: list(range(n + 1)), 1: list(range(n)), 3: list(range(n))}
        least = assign_zip(p, index, overlaps="smallest", keep_outside=True).collect()
        assert {r.Crash_ID: r.ZIP_Code for r in least} == {0: 0, 1: 0, 2: None, 3: 0}
