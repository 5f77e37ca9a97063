"""Vector tiles: coding, clipping, zooms."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from cellgrove.sources import vector_tiles as vt

POINT = st.tuples(st.integers(-100, 5000), st.integers(-100, 5000))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(min_size=1, max_size=9), st.lists(st.lists(POINT, min_size=3, max_size=9), min_size=1, max_size=3)), min_size=1, max_size=150))
def test_tiles_are_read_as_written(features):
    assert vt.read_tile(vt.tile("layer", features, "name")) == [("layer", n, r) for n, r in features]


def test_polygons_keep_their_area_at_every_zoom(spark):
    ring = lambda cx, cy, r, n: [dict(x=cx + r * math.cos(2 * math.pi * k / n), y=cy + r * math.sin(2 * math.pi * k / n)) for k in range(n)]
    rows = [("disc", 0, ring(10, 20, 15, 90)), ("disc", 1, ring(10, 20, 5, 40)), ("far", 0, ring(-170, -60, 4, 12)), ("dust", 0, ring(100, 10, 1e-4, 5)), ("pole", 0, ring(0, 88, 1, 8))]
    rings = spark.createDataFrame(rows, "unit_id string, ring int, points array<struct<x: double, y: double>>")
    table = vt.tiles(rings, (0, 3, 5))
    got = {}
    for r in vt.features(table).collect():
        assert r.layer == "boundary" and 0 < r.area <= 1.001
        got[r.zoom, r.name] = got.get((r.zoom, r.name), 0) + r.area

    def place(p):
        return (p["x"] + 180) / 360, (1 - math.asinh(math.tan(math.radians(p["y"]))) / math.pi) / 2

    def area(ps):
        q = list(map(place, ps))
        return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(q, [*q[1:], q[0]], strict=True))) / 2

    want = {"disc": area(rows[0][2]) - area(rows[1][2]), "far": area(rows[2][2])}
    assert {n for _, n in got} == {"disc", "far"}  # dust is less than a step, beyond the pole nothing is left
    for zoom in (0, 3, 5):
        for name, a in want.items():
            assert math.isclose(got[zoom, name], a * 4**zoom, rel_tol=0.02 if zoom else 0.05), (zoom, name)
    assert len({(r.x, r.y) for r in table.where("zoom = 5").collect()}) > 6
    assert vt.tiles(rings.limit(0), (0, 1)).count() == 0
