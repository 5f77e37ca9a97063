"""Overlay, dissolve, repair, rings and buffers against plain even-odd counting."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrove.operators import geo, planar


def edges_of(rings):
    return [(u, *a, *b) for u, ps in rings for a, b in zip(ps, [*ps[1:], ps[0]], strict=True)]


def inside(edges, x, y):
    return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for x1, y1, x2, y2 in edges) % 2 == 1


def frame(spark, rows, key="unit"):
    return spark.createDataFrame([(str(u), *map(float, e)) for u, *e in rows], f"{key} string, x1 double, y1 double, x2 double, y2 double")


def places(n=400, size=10.0, seed=9):
    rng = random.Random(seed)
    return [(rng.uniform(-1, size + 1), rng.uniform(-1, size + 1)) for _ in range(n)]


def held(sides, x, y):
    return inside([(s.x1, s.y1, s.x2, s.y2) for s in sides], x, y)


@pytest.mark.parametrize("seed", range(2))
def test_rules_hold_the_right_places(spark, seed):
    rng = random.Random(seed)
    ring = lambda: [(rng.uniform(0, 10), rng.choice([rng.uniform(0, 10), float(rng.randint(0, 10))])) for _ in range(rng.randint(3, 7))]
    rows = edges_of([(k % 2, ring()) for k in range(4)])
    a, b = ([e[1:] for e in rows if e[0] == k] for k in (0, 1))
    df = frame(spark, rows).withColumn("layer", F.col("unit").cast("int")).withColumn("g", F.lit("one"))
    want = {"any": lambda p: inside(a, *p) or inside(b, *p), "both": lambda p: inside(a, *p) and inside(b, *p), "minus": lambda p: inside(a, *p) and not inside(b, *p)}
    for rule, f in want.items():
        got = planar.sides(df, ["g"], "layer", rule, band=2.5)
        rows_of = got.collect()
        assert all(held(rows_of, *p) == f(p) for p in places())
        found = planar.rings(got, ["g"]).collect()
        for r in found:
            assert r.points[0] == r.points[-1] and len(r.points) >= 4
        again = [(p.x, p.y, q.x, q.y) for r in found for p, q in zip(r.points, r.points[1:], strict=False)]
        assert all(inside(again, *p) == f(p) for p in places())
        total = planar.area(["g"], got).first()
        assert math.isclose(sum(r.signed_area for r in found), total.area if total else 0, abs_tol=1e-6)


def test_overlay_pairs(spark):
    rng = random.Random(3)
    ring = lambda x, y: [(x + rng.uniform(0, 4), y + rng.uniform(0, 4)) for _ in range(5)]
    one = [(f"a{k}", ring(k % 3 * 3, k // 3 * 3)) for k in range(9)]
    two = [(f"b{k}", ring(k % 3 * 3 + 1, k // 3 * 3 + 1)) for k in range(9)]
    got = planar.overlay(frame(spark, edges_of(one)), frame(spark, edges_of(two), "other"), "unit", "other", band=1.5).collect()
    pairs = {(r.unit, r.other) for r in got}
    for (u, p), (v, q) in ((x, y) for x in one for y in two):
        mine = [s for s in got if (s.unit, s.other) == (u, v)]
        e, f = ([e[1:] for e in edges_of([("", r)])] for r in (p, q))
        hits = [z for z in places(150) if inside(e, *z) and inside(f, *z)]
        assert all(held(mine, *z) for z in hits) and (not hits or (u, v) in pairs)
        assert not any(held(mine, *z) for z in places(150) if z not in hits)


def test_overlay_of_one_name_and_nothing(spark):
    square = frame(spark, edges_of([("a", [(0, 0), (2, 0), (2, 2), (0, 2)])]))
    got = planar.overlay(square, square, "unit", "unit")
    assert got.columns[:2] == ["unit", "unit_2"] and planar.area(["unit", "unit_2"], got).first().area == 4
    assert planar.overlay(square, square.limit(0), "unit", "unit").count() == 0
    assert planar.rings(got.limit(0), ["unit", "unit_2"]).count() == 0


def test_bow_tie_and_overlapping_rings_keep_their_area(spark):
    rows = edges_of([("tie", [(0, 0), (4, 4), (4, 0), (0, 4)]), ("two", [(0, 0), (4, 0), (4, 4), (0, 4)]), ("two", [(2, 2), (6, 2), (6, 6), (2, 6)]), ("flat", [(0, 0), (3, 0), (5, 0)])])
    got = planar.sides(frame(spark, rows), ["unit"])
    assert {r.unit: r.area for r in planar.area(["unit"], got).collect()} == {"tie": 8.0, "two": 24.0}
    found = planar.rings(got, ["unit"])
    assert sorted((r.unit, r.signed_area) for r in found.collect()) == [("tie", 4.0), ("tie", 4.0), ("two", 12.0), ("two", 12.0)]


def test_touching_cells_and_nested_holes(spark):
    from cellgrove.operators import grid

    art = ["#.#######", ".#.#...##", "##.#.#.#.", "..##...##", "#.#######"]
    cells = [(r, c, 1) for r, line in enumerate(art) for c, x in enumerate(line) if x == "#"]
    edges = grid.polygonise(spark.createDataFrame(cells, "row int, col int, value int")).withColumn("__x", F.lit(1))
    found = planar.nested(planar.rings(planar.sides(edges, ["value"], band=2.0), ["value"]), ["value"]).collect()

    def flood(start):
        seen, stack = {start}, [start]
        while stack:
            r, c = stack.pop()
            for x in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if x in left and x not in seen:
                    seen.add(x)
                    stack.append(x)
        return seen

    left, want = {(r, c) for r, c, _ in cells}, []
    while left:
        part = flood(min(left))
        want.append(len(part))
        left -= part
    shells = {r.ring: r.signed_area for r in found if not r.hole}
    for r in found:
        if r.hole:
            shells[r.shell] += r.signed_area
    assert sorted(shells.values()) == sorted(want) and sum(r.hole for r in found) == 1
    assert sum(r.signed_area for r in found) == len(cells)


def test_buffers_hold_what_is_near(spark):
    rng = random.Random(7)
    lines = [(str(k), rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(0, 10)) for k in range(6)] + [("dot", 5.0, 5.0, 5.0, 5.0)]
    df = frame(spark, lines)
    radius, quarter = 0.8, 16
    outline = planar.sides(planar.capsules(df, radius, "unit", quarter).withColumn("all", F.lit(1)), ["all"], "unit").collect()
    pts = spark.createDataFrame(places(500), "x double, y double")
    sure, near = ({(r.x, r.y) for r in geo.near_any(pts, df, r).collect()} for r in (radius * math.cos(math.pi / 4 / quarter), radius))
    got = {p for p in places(500) if held(outline, *p)}
    assert sure <= got <= near and len(got) > 50


def test_long_rings_and_clashing_names(spark):
    n = 300
    ring = [(10 + 5 * math.cos(2 * math.pi * k / n), 10 + 5 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    df = frame(spark, edges_of([("u", ring), ("v", [(x + 3, y) for x, y in ring])])).withColumnRenamed("unit", "band").withColumn("layer", F.lit(3))
    found = planar.rings(planar.sides(df, ["band"], band=0.7), ["band"]).collect()
    assert sorted(r.band for r in found) == ["u", "v"] and all(math.isclose(r.signed_area, n / 2 * 25 * math.sin(2 * math.pi / n), rel_tol=1e-9) for r in found)
    assert np.allclose(sorted(len(r.points) - 1 for r in found), [n, n], atol=2)
