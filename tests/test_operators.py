"""Hand-computed fixtures and properties of the engine's operators."""

import heapq
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrove.functions import drought_class, geometric_mean, ratio, rnd, row_mean, utm_forward
from cellgrove.operators import cost, geo, grid, series, table, zonal
from cellgrove.plans import risk, runs
from cellgrove.sources import Latest, catalogue, new_path, raster, stored, tabular, vector


def ring(spark, points, unit="A", n=0):
    return spark.createDataFrame([(unit, n, [(float(x), float(y)) for x, y in points])], "unit_id string, ring int, points array<struct<x: double, y: double>>")


def test_rounding_is_numpys(spark):
    values = [1.015, 2.675, 0.285, 66.665, 0.125, 2.5, -0.5, 1e9 + 0.005]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(rnd(F.col("v"), 2).alias("r"))
    assert [r.r for r in df.collect()] == list(np.round(values, 2))


def test_ratio_of_nothing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (1.0, 3.0)], "a double, b double")
    assert [tuple(r) for r in df.select(ratio(F.col("a"), F.col("b")), ratio(F.col("a"), F.col("b"), empty=None)).collect()] == [(0.0, None), (0.0, None), (33.33, 33.33)]


def test_row_mean_and_geometric_mean(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 4.0), (-1.0, 4.0)], "a double, b double")
    got = [tuple(r) for r in df.select(row_mean(F.col("a"), F.col("b")), geometric_mean(F.col("a"), F.col("b"))).collect()]
    assert got == [(1.0, None), (None, None), (3.0, math.sqrt(8)), (1.5, None)]


def test_drought_class_bounds(spark):
    df = spark.createDataFrame([(m,) for m in (0, 1, 18, 19, 36, 37, 54, 55)], "m int").select(drought_class(F.col("m")).alias("c"))
    assert [r.c for r in df.collect()] == [0, 1, 1, 2, 2, 3, 3, 4]


def test_utm_central_meridian(spark):
    e, n = utm_forward(F.lit(33.0), F.lit(0.0), 36)
    assert spark.range(1).select(rnd(e, 3), rnd(n, 3)).first()[:] == (500000.0, 0.0)


def test_square_with_hole_and_triangle(spark):
    cells = spark.range(10000).select((F.col("id") % 100).cast("int").alias("row"), F.floor(F.col("id") / 100).cast("int").alias("col"))
    rings = ring(spark, [(10, 10), (50, 10), (50, 50), (10, 50)]).union(ring(spark, [(20, 20), (30, 20), (30, 30), (20, 30)], n=1)).union(ring(spark, [(60, 10), (80, 10), (60, 110)], "B"))
    got = dict(geo.cells_in_polygons(cells, geo.edges_from_rings(rings)).groupBy("unit_id").count().collect())
    assert got["A"] == 1500 and got["B"] > 0


def test_translation_keeps_membership(spark):
    shape = [(1.3, 0.2), (9.1, 2.2), (7.7, 8.9), (0.4, 6.1)]
    cells = spark.range(400).select((F.col("id") % 20).cast("int").alias("row"), F.floor(F.col("id") / 20).cast("int").alias("col"))
    a = geo.cells_in_polygons(cells, geo.edges_from_rings(ring(spark, shape))).select("row", "col").collect()
    b = geo.cells_in_polygons(cells, geo.edges_from_rings(ring(spark, [(x + 5, y + 3) for x, y in shape]))).select("row", "col").collect()
    assert {(r.row + 3, r.col + 5) for r in a} == {tuple(r) for r in b}


def test_polygon_without_centre_is_zero(spark):
    units = spark.createDataFrame([("A",)], "unit_id string")
    cells = spark.createDataFrame([(0, 0, 5.0)], "row int, col int, value double")
    zone = geo.cells_in_polygons(cells, geo.edges_from_rings(ring(spark, [(0.6, 0.6), (0.9, 0.6), (0.9, 0.9)])))
    assert zonal.zonal(units, zone, cells, {"s": F.sum("value")}).first().s == 0.0


def test_distance_join_is_brute_force(spark):
    rng = np.random.default_rng(3)
    p = [(int(i), *map(float, rng.uniform(0, 30, 2))) for i in range(60)]
    s = [(int(i), *map(float, rng.uniform(0, 30, 4))) for i in range(40)]

    def near(a, b):
        (_, x, y), (_, x1, y1, x2, y2) = a, b
        d = (x2 - x1) ** 2 + (y2 - y1) ** 2
        t = max(0, min(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / d))
        return math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)) <= 2.5

    got = geo.within_distance(spark.createDataFrame(p, "id int, x double, y double"), spark.createDataFrame(s, "line int, x1 double, y1 double, x2 double, y2 double"), 2.5).select("id", "line").collect()
    assert sorted(map(tuple, got)) == sorted((a[0], b[0]) for a in p for b in s if near(a, b))


@pytest.mark.parametrize("flags", ["110", "111", "0111", "1111", "1101110", "11011", "1", "", "0110111"])
def test_run_events(spark, flags):
    want = [any(all(0 <= i + k + d < len(flags) and flags[i + k + d] == "1" for d in range(3)) for k in (-2, -1, 0)) for i in range(len(flags))]
    df = spark.createDataFrame([(1, i, f == "1") for i, f in enumerate(flags)], "c int, i int, f boolean")
    for f in (series.run_events, series.centred_run_events):
        assert [r.event for r in f(df, ["c"], "i", F.col("f")).orderBy("i").collect()] == want


def test_average_rank_sums(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 5, 3, None, 9, 5, 1])], "i int, v int")
    got = {r.i: r.r for r in series.average_rank(df, "v", "r").collect()}
    assert got == {0: 3.0, 1: 3.0, 5: 3.0, 2: 5.0, 3: None, 4: 1.0, 6: 6.0}


def test_chunks_stay_within_budget(spark):
    u = spark.createDataFrame([(f"U{i}", i, 10.0 * i, 0.0, 10.0 * i + 10, 10.0) for i in range(7)], "unit_id string, pos int, x_min double, y_min double, x_max double, y_max double")
    got = dict(series.chunks_under_budget(u, "pos", 250).collect())
    assert got == {"U0": 0, "U1": 0, "U2": 1, "U3": 1, "U4": 2, "U5": 2, "U6": 3}


def test_least_cost_forms_agree(spark):
    rng = np.random.default_rng(5)
    c = rng.uniform(1, 9, (8, 9))
    rows = [(0, i, j, float(c[i, j]), (i, j) in ((0, 0), (7, 8))) for i in range(8) for j in range(9)]
    cells = spark.createDataFrame(rows, "grid int, row int, col int, cost double, source boolean")
    dist, heap = {(0, 0): 0.0, (7, 8): 0.0}, [(0.0, (0, 0)), (0.0, (7, 8))]
    while heap:
        d, (i, j) = heapq.heappop(heap)
        for a in (-1, 0, 1):
            for b in (-1, 0, 1):
                x, y = i + a, j + b
                if (a or b) and 0 <= x < 8 and 0 <= y < 9:
                    e = d + (c[i, j] + c[x, y]) / 2 * math.hypot(a, b)
                    if e < dist.get((x, y), 1e18):
                        dist[x, y] = e
                        heapq.heappush(heap, (e, (x, y)))
    for got in (cost.least_cost_heap(cells).drop("grid"), cost.least_cost_relaxed(cells, Latest()), cost.least_cost(cells, tile=3)):
        found = {(r.row, r.col): r.distance for r in got.collect()}
        assert found.keys() == dist.keys() and all(abs(found[k] - dist[k]) < 1e-9 for k in dist)


def test_a_round_writes_the_tiles_that_changed(spark):
    cells = spark.createDataFrame([(0, 0, j, 1.0, j == 0) for j in range(12)] + [(0, 40, j, 1.0, j == 5) for j in range(12)], "grid int, row int, col int, cost double, source boolean")
    written = []
    got = cost.least_cost(cells, tile=3, written=written)
    # all eight at first; then along one strip from its end, along the other from its middle to both sides
    assert written == [8, 3, 2, 1] or (written[0] == 8 and max(written[1:]) <= 3)
    assert {(r.row, r.col): r.distance for r in got.collect()} == {(0, j): float(j) for j in range(12)} | {(40, j): float(abs(j - 5)) for j in range(12)}


def test_least_cost_limits_are_errors(spark):
    cells = spark.createDataFrame([(0, 0, j, 1.0, j == 0) for j in range(12)], "grid int, row int, col int, cost double, source boolean")
    with pytest.raises(RuntimeError):
        cost.least_cost(cells, tile=3, rounds=2)
    with pytest.raises(RuntimeError):
        cost.least_cost_relaxed(cells, Latest(), rounds=2)
    with pytest.raises(Exception, match="too large"):
        cost.least_cost_heap(cells, largest=5).collect()


def test_repeated_points_and_borders(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    edges = geo.edges_from_rings(spark.createDataFrame([("A", 0, ring)], "unit_id string, ring int, points array<struct<x: double, y: double>>"))
    rows = [("school", 5.0, 5.0), ("school", 5.0, 5.0), ("clinic", 5.0, 5.0), ("out", 11.0, 5.0), ("left", 0.0, 5.0), ("top", 5.0, 10.0), ("corner", 10.0, 10.0), (None, None, 5.0)]
    points = spark.createDataFrame(rows, "name string, x double, y double")
    names = lambda how: sorted(r.name for r in geo.points_in_polygons(points, edges, "unit_id", border=how).collect())
    assert names("within") == ["clinic", "school", "school"]
    assert names("intersects") == ["clinic", "corner", "left", "school", "school", "top"]


def test_distance_join_is_brute_force_at_any_radius(spark):
    rng = np.random.default_rng(2)
    p = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 40_000, (80, 2)))]
    s = [(i, *map(float, v), float(r)) for i, (v, r) in enumerate(zip(rng.uniform(0, 40_000, (40, 4)), rng.choice([0.5, 900, 2000, 7000], 40), strict=True))]
    points, lines = spark.createDataFrame(p, "id int, x double, y double"), spark.createDataFrame(s, "line int, x1 double, y1 double, x2 double, y2 double, r double")

    def apart(px, py, x1, y1, x2, y2):
        t = max(0, min(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
        return math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1))

    for radius, of in ((F.col("r"), lambda v: v[5]), (2000.0, lambda v: 2000.0)):
        got = sorted((r.id, r.line) for r in geo.within_distance(points, lines, radius).select("id", "line").collect())
        assert got == sorted((i, v[0]) for i, x, y in p for v in s if apart(x, y, *v[1:5]) <= of(v))


def test_segments_of_one_shape_are_met_once(spark, monkeypatch, data):
    from cellgrove.queries import spatial

    points = spark.createDataFrame([(i, float(i), 0.0) for i in range(6)], "id int, x double, y double")
    rows = [(1, 0.0, 0.0, 1.0, 0.0), (2, 0.0, 0.0, 1.0, 0.0), (3, -0.0, 0.0, 1.0, 0.0), (4, 5.0, 0.0, 5.0, 0.0), (None, 5.0, 0.0, 5.0, 0.0), (6, None, 0.0, 1.0, 0.0)]
    lines = spark.createDataFrame(rows, "line_id int, x1 double, y1 double, x2 double, y2 double")
    shapes = geo.by_shape(lines, n=F.count("*"), ids=F.sum("line_id"))
    got = geo.within_distance(points, shapes, 1.0).agg(F.sum("n"), F.sum("ids")).first()
    want = geo.within_distance(points, lines, 1.0).agg(F.count("*"), F.sum("line_id")).first()
    assert tuple(got) == tuple(want) == (13, 26)
    # whoever only sums pairs up joins no two segments of one shape and radius
    joined, join = [], geo.within_distance
    monkeypatch.setattr(geo, "within_distance", lambda p, s, r, **how: (joined.append((s, r)), join(p, s, r, **how))[1])
    assert {r.id for r in geo.near_any(points, lines, F.lit(1.0)).collect()} == {0, 1, 2, 4, 5}
    for name in ("j10_units_near_roads", "j16_distance_join", "j16_wide_radius"):
        spatial.FUNCTIONS[name](spark, data)
    for s, r in joined:
        assert s.count() == s.select("x1", "y1", "x2", "y2", r if not isinstance(r, float) else F.lit(r)).distinct().count()
    assert len(joined) == 4


def test_holes_count_off_whichever_way_they_run(spark):
    shell, hole = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0)]
    rows = [("A", 0, shell), ("A", 1, hole), ("B", 0, shell), ("B", 1, hole[::-1]), ("C", 0, shell), ("C", 1, [(x + 20, y) for x, y in hole])]
    edges = geo.edges_from_rings(spark.createDataFrame(rows, "unit_id string, ring int, points array<struct<x: double, y: double>>"))
    assert {r.unit_id: r.area for r in geo.area_and_centroid(edges).collect()} == {"A": 96.0, "B": 96.0, "C": 104.0}


def test_unreachable_is_null(spark):
    cells = spark.createDataFrame([(0, 0, 0, 1.0, True), (0, 5, 5, 1.0, False)], "grid int, row int, col int, cost double, source boolean")
    assert {r.row: r.distance for r in cost.least_cost_heap(cells).collect()} == {0: 0.0, 5: None}


def test_block_sums_keep_totals(spark):
    cells = spark.range(110).select((F.col("id") % 11).cast("int").alias("row"), F.floor(F.col("id") / 11).cast("int").alias("col"), F.col("id").cast("double").alias("value"))
    assert grid.block_sum(cells, 3).agg(F.sum("value")).first()[0] == sum(range(110))
    tiles = stored(grid.to_tiles(cells, 4))
    assert sorted(map(tuple, grid.from_tiles(tiles, size=4).collect())) == sorted(map(tuple, cells.collect()))


def test_risk_constant_and_missing(spark):
    df = spark.createDataFrame([("A", 1, None, 3, None), ("B", 1, 2, 5, None)], "unit_id string, cop_a int, vul_a int, exp_flo_a int, exp_cyc_a int")
    got = {r.unit_id: r for r in risk.risk(df).collect()}
    assert got["A"].cop == 0.0 and got["A"].vul == 1.0  # constant 1 stays, missing vulnerability is 1
    assert got["A"].exp_flood == 0.0 and got["B"].exp_flood == 1.0 and got["B"].exp_cyclone is None and got["B"].ranking_cyclone is None


def test_next_run(spark):
    h = spark.createDataFrame([("A", "SUCCESS", 1), ("B", "FAILURE", 1), ("B", "FAILURE", 2), ("B", "FAILURE", 3), ("C", "FAILURE", 2)], "country string, status string, t int")
    c = spark.createDataFrame([("A", 0), ("B", 1), ("C", 2), ("D", 3)], "country string, pos int")
    none = spark.createDataFrame([], "country string")
    one = runs.next_run(c, runs.states(h, ["t"]), none).first()
    assert one[:] == ("C", 2, 2, 1, 0)
    out = spark.createDataFrame([("C",), ("D",)], "country string")
    assert runs.next_run(c, runs.states(h, ["t"]), out).first()[:2] == ("B", 4)
    busy = h.union(spark.createDataFrame([("D", "STARTED", 9)], h.schema))
    assert runs.next_run(c, runs.states(busy, ["t"]), none).first().country is None


def test_outer_merge_suffix_and_update(spark):
    a = spark.createDataFrame([(1, 2), (2, 3)], "k int, v int")
    b = spark.createDataFrame([(2, 9), (3, 8)], "k int, v int")
    assert sorted(map(tuple, table.outer_merge({"a": a, "b": b}, "k").collect())) == [(1, 2, None), (2, 3, 9), (3, None, 8)]
    assert sorted(map(tuple, table.update_join(a, b, "k", ["v"]).collect())) == [(1, 2), (2, 9)]


def test_require_values_fails(spark):
    df = spark.createDataFrame([(1, None)], "k int, v int")
    with pytest.raises(Exception, match="has no value"):
        table.require_values(df, "v").collect()


def test_tiff_round_trip(spark, tmp_path):
    band = np.arange(12, dtype=np.float32).reshape(3, 4)
    (tmp_path / "a.tif").write_bytes(raster.write_tiff(band, 10.0, 20.0, 0.5, 0.5, nodata=5.0))
    got = raster.geotiff_cells(spark, f"file://{tmp_path}/a.tif").collect()
    assert {(r.row, r.col): r.value for r in got} == {(i, j): float(band[i, j]) for i in range(3) for j in range(4) if band[i, j] != 5}
    assert got[0].x0 == 10.0 and got[0].dy == 0.5


def test_ascii_grid(spark, tmp_path):
    (tmp_path / "g.asc").write_text("ncols 2\nnrows 2\nxllcorner 0\nyllcorner 0\ncellsize 1\nNODATA_value -9\n1 2\n-9 4\n")
    got = raster.ascii_grid_cells(spark, f"file://{tmp_path}/g.asc").collect()
    assert {(r.row, r.col): r.value for r in got} == {(0, 0): 1.0, (0, 1): 2.0, (1, 1): 4.0}


def test_wkb_and_shapefile(spark, tmp_path):
    polygon = struct.pack("<BIII", 1, 3, 1, 4) + struct.pack("<8d", 0, 0, 1, 0, 1, 1, 0, 0)
    df = spark.createDataFrame([(7, bytearray(polygon))], "id int, geometry binary")
    r = vector.wkb_parts(df).first()
    assert (r.id, r.kind, [tuple(p) for p in r.points]) == (7, "ring", [(0, 0), (1, 0), (1, 1), (0, 0)])
    import zipfile

    shape = struct.pack("<I4d2I", 5, 0, 0, 1, 1, 1, 4) + struct.pack("<I8d", 0, 0, 0, 1, 0, 1, 1, 0, 0)
    shp = b"\0" * 100 + struct.pack(">2I", 1, len(shape) // 2) + shape
    field = b"ADM1_PCODE".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([4, 0]) + b"\0" * 14
    dbf = bytes([3, 0, 0, 0]) + struct.pack("<IHH", 1, 32 + 32 + 1, 5) + b"\0" * 20 + field + b"\r" + b" RW01"
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        for n in ("x_adm1.shp", "x_adm3.shp"):
            z.writestr(n, shp)
            z.writestr(n[:-4] + ".dbf", dbf)
    got = vector.zipped_shapefiles(spark, f"file://{tmp_path}/b.zip").collect()
    assert [(r.level, r.properties["ADM1_PCODE"], len(r.points)) for r in got] == [(1, "RW01", 4)]


def test_geopackage(spark, tmp_path):
    import sqlite3

    with sqlite3.connect(tmp_path / "a.gpkg") as db:
        db.execute("create table ADM0 (value real, geom blob)")
        line = struct.pack("<BII4d", 1, 2, 2, 0, 0, 3, 4)
        db.execute("insert into ADM0 values (5, ?)", (b"GP\0\1" + b"\0" * 4 + line,))
    got = vector.wkb_parts(vector.geopackage(spark, f"file://{tmp_path}/a.gpkg", "ADM0", "value double")).first()
    assert (got.value, got.kind, [tuple(p) for p in got.points]) == (5.0, "line", [(0, 0), (3, 4)])


def test_worksheet(spark, tmp_path):
    import zipfile

    m = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {m}><sheets><sheet name="Notes" sheetId="1" r:id="rId7"/><sheet name="HRP_1" sheetId="2" r:id="rId3"/></sheets></workbook>'.replace("<workbook ", '<workbook xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" '))
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId3" Target="worksheets/sheet1.xml"/><Relationship Id="rId7" Target="/xl/worksheets/sheet9.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {m}><si><t> Year </t></si><si><t>Events</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {m}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2"><v>2020</v></c><c r="B2"><v>4</v></c></row></sheetData></worksheet>')
    got = tabular.worksheet(spark, f"file://{tmp_path}/a.xlsx", "HRP_1", ["Year"], {"Year": "year", "Events": "events"})
    assert [tuple(r) for r in got.collect()] == [("2020", "4")]
    with pytest.raises(Exception, match="lacks"):
        tabular.worksheet(spark, f"file://{tmp_path}/a.xlsx", "HRP_1", ["Fatalities"], {"Year": "year"}).collect()


def test_streamed_run_events(spark, tmp_path):
    from cellgrove.streaming import run_events

    # steps with gaps, runs over several batches, open ends; the last rows move the watermark on
    rows = [(1, s, 1.0) for s in (1, 2, 5, 6, 9)] + [(2, s, v) for s, v in enumerate([1.0, 1.0, 9.0, 1.0, 1.0, None, 1.0, 1.0, 1.0, 9.0, 1.0, 1.0])] + [(3, s, 1.0) for s in (4, 7)]
    table = spark.createDataFrame(rows, "c int, s long, v double").withColumn("t", F.timestamp_seconds(F.col("s") + 1000))
    for k in range(4):
        table.where(f"s div 3 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.createDataFrame([(4, 5000, 9.0)], "c int, s long, v double").withColumn("t", F.timestamp_seconds(F.col("s") + 1000)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("c int, s long, v double, t timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").withWatermark("t", "0 seconds")
    q = run_events(s, "c", "s", "v", 5.0, time="t", idle_ms=60_000).writeStream.format("memory").queryName("run_events_out").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.key, r.step): r.event for r in spark.table("run_events_out").collect()}
    want = {(r.c, r.s): r.event for r in series.run_events(table, ["c"], "s", F.col("v") < 5.0).collect()} | {(4, 5000): False}
    assert got == want and want[1, 9] and not want[2, 11]


def test_output_partition_is_replaced(spark):
    path = new_path(spark, "out")
    for n in (3, 2):
        tabular.write_indicator(spark.range(n), path, "RWA", "ADM1", "x")
    tabular.write_indicator(spark.range(5), path, "PER", "ADM1", "x")
    assert dict(spark.read.parquet(path).groupBy("country").count().collect()) == {"RWA": 2, "PER": 5}


def test_failed_payloads_stop_the_job(spark):
    rows = [('{"success": true, "result": {"id": "a", "resources": [{"name": "n", "format": "ZIP", "url": "u"}]}}',), ('{"success": false, "error": {"message": "Not found"}}',), ("no json",)]
    payloads = spark.createDataFrame(rows, "body string")
    assert [r.id for r in catalogue.resources(payloads, strict=False).collect()] == ["a"]
    with pytest.raises(Exception, match="Not found|unreadable"):
        catalogue.resources(payloads).collect()


def test_chunks_are_bounded(spark):
    u = spark.range(5).select(F.col("id").alias("unit_id"), F.col("id").alias("pos"), *(F.lit(1.0).alias(c) for c in ("x_min", "y_min", "x_max", "y_max")))
    with pytest.raises(ValueError):
        series.chunks_under_budget(u, "pos", 10, most=4)


def test_windowed_counts_of_a_stream(spark, tmp_path):
    from cellgrove import streaming

    rows = [("a", 0), ("a", 30), ("b", 59), ("a", 60), ("a", 200)]
    spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("t")).coalesce(1).write.parquet(f"{tmp_path}/in")
    events = spark.readStream.schema("k string, t timestamp").parquet(f"{tmp_path}/in")
    out = streaming.windowed_counts(events, "t", "1 minute", "10 seconds", ["k"])
    q = out.writeStream.format("memory").queryName("windowed").outputMode("complete").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.k, int(r.window.start.timestamp()) // 60): r.n for r in spark.table("windowed").collect()}
    assert got == {("a", 0): 2, ("b", 0): 1, ("a", 1): 1, ("a", 3): 1}


def test_scheduler_starts_what_is_next(spark, tmp_path):
    from cellgrove import streaming

    history = [("A", "SUCCESS", 1), ("B", "FAILURE", 2)]
    spark.createDataFrame(history, "country string, status string, created long").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("country string, status string, created long").parquet(f"{tmp_path}/in")
    countries = spark.createDataFrame([("A", 0), ("B", 1), ("C", 2)], "country string, pos int")
    none, started = spark.createDataFrame([], "country string"), []
    q = streaming.scheduler(stream, countries, none, ["created"], lambda c, n: started.append(c), f"{tmp_path}/log", f"{tmp_path}/ck", every="1 second")
    q.processAllAvailable()
    q.stop()
    assert started and started[0] in ("B", "C")


def test_shared_borders_stay_shared(spark):
    r = np.random.default_rng(3)
    border = [(10.0 + float(v), float(i)) for i, v in enumerate(r.normal(0, 0.4, 21))]
    left = [(0.0, 0.0), *border, (0.0, 20.0)]
    right = [(20.0, 20.0), *border[5:][::-1], border[4], *border[:4][::-1], (20.0, 0.0)]
    alone = [(30.0 + 5 * math.cos(i / 10), 5 * math.sin(i / 10)) for i in range(62)]
    rings = spark.createDataFrame([("L", 0, left), ("R", 0, right), ("O", 0, alone)], "unit_id string, ring int, points array<struct<x: double, y: double>>")
    got = {x.unit_id: [(p.x, p.y) for p in x.points] for x in geo.simplify_shared(rings, 0.6).collect()}
    common = set(border)
    assert [p for p in got["L"] if p in common] == [p for p in got["R"] if p in common][::-1]
    assert len(got["L"]) < len(left) and 4 <= len(got["O"]) < 20


def test_exact_median_is_percentile(spark, monkeypatch):
    from cellgrove.operators import zonal

    monkeypatch.setattr(zonal, "RANGES", 4)
    rng = np.random.default_rng(8)
    rows = [(u, float(v)) for u, n in enumerate((1, 2, 7, 8, 301)) for v in rng.choice([0.0, 1.0, 1.0, 2.5, -1e300, 1e300, 3e-300, 7.0], n)]
    rows += [(9, float(v)) for v in rng.normal(0, 1, 200)] + [(9, None), (9, float("nan")), (10, None), (11, 5.0), (11, 5.0)]
    df = spark.createDataFrame(rows, "band int, v double")
    got = {r.band: r.median for r in zonal.exact_median(df, "v", "band").collect()}
    want = {u: float(np.median([v for k, v in rows if k == u and v is not None and v == v])) for u in (0, 1, 2, 3, 4, 9, 11)}
    assert set(got) == set(want) and all(np.isclose(got[u], want[u]) for u in want)
    assert zonal.exact_median(df.limit(0), "v", "band").count() == 0


def test_risk_ranks_many_units_by_ranges(spark):
    from cellgrove.plans import risk

    df = spark.range(400).select(F.col("id").alias("unit_id"), (F.col("id") % 7).alias("cop_a"), (F.col("id") % 5).alias("vul_b"), (F.col("id") % 40).alias("exp_flo_c"))
    few, many = risk.risk(df), risk.risk(df, many=10)
    assert "SinglePartition" in few._jdf.queryExecution().toString()
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(few) == key(many)
    assert "__place" in many._jdf.queryExecution().toString()


def test_budgets_are_monotone_and_keep_borders(spark):
    rng = np.random.default_rng(5)
    line = [(5.0, 0.0), *((5 + float(rng.normal(0, 0.2)), y) for y in np.linspace(0.5, 9.5, 30).tolist()), (5.0, 10.0)]
    left, right = [(0.0, 0.0), *line, (0.0, 10.0)], [(10.0, 10.0), *line[::-1], (10.0, 0.0)]
    rows = [(u, 0, [dict(x=x, y=y) for x, y in p]) for u, p in (("a", left), ("b", right))]
    rings = spark.createDataFrame(rows, "unit_id string, ring int, points array<struct<x: double, y: double>>")
    v = geo.vertex_tolerances(rings)
    assert v.count() == len(left) + len(right)
    before = None
    for budget in (10_000, 900, 700, 400, 0):
        for of in ([], ["unit_id"]):
            got = {r.unit_id: r for r in geo.simplify_to_budget(v, budget, of).collect()}
            kept = {u: {(p.x, p.y) for p in r.points} for u, r in got.items()}
            size = {u: sum(len("[%.6f,%.6f]," % p) for p in ps) for u, ps in kept.items()}
            if budget >= 700:
                assert (sum(size.values()) if not of else max(size.values())) <= budget
            if not of:
                assert kept["a"] & set(line) == kept["b"] & set(line)
                assert before is None or all(kept[u] <= before[u] for u in kept)
                before = kept
                t = got["a"].tolerance
                same = {r.unit_id: {(p.x, p.y) for p in r.points} for r in geo.simplify_shared(rings, t).collect()}
                assert all(kept[u] >= same[u] for u in kept) and (budget == 0 or kept == same)


def test_helper_names_do_not_clash(spark):
    square = spark.createDataFrame([("a", 0, [dict(x=x, y=y) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0))])], "unit_id string, ring int, points array<struct<x: double, y: double>>")
    edges = geo.edges_from_rings(square)
    points = spark.createDataFrame([(1.0, 1.0, "k", 5), (9.0, 1.0, "l", 6)], "x double, y double, __x string, band int").withColumns({c: F.lit(7) for c in ("px", "py", "unit", "in", "__unit", "__r", "size", "part", "bx")})
    assert [(r["__x"], r.band, r.unit_id) for r in geo.points_in_polygons(points, edges, "unit_id").collect()] == [("k", 5, "a")]
    near = geo.within_distance(points, edges.select("x1", "y1", "x2", "y2").withColumn("r", F.lit(2)), 1.0)
    assert {r["__x"] for r in near.collect()} == {"k"} and "size" in near.columns and "r" in near.columns
