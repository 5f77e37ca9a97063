"""Raster algebra, series and cost surfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import analysis_scale_of, drought_class, exceeds, footprint_cells, rnd, settlement_class, storm_class
from ..operators import cost, geo, grid, series
from ..sources import Latest, new_path, stored, tiff
from . import fixtures as fx

query, FUNCTIONS, SQL = fx.collector()


@query("r01_reclassify", "SELECT row, col, CASE WHEN code IN (11, 12, 13) THEN 1 WHEN code IN (21, 22, 23, 30) THEN 2 ELSE 0 END AS code FROM settlement", "settlement")
def _(s, d):
    return grid.reclassify(fx.settlement(s, d), {11: 1, 12: 1, 13: 1, 21: 2, 22: 2, 23: 2, 30: 2}, "code")


@query("r02_threshold", "SELECT rp, row, col, CASE WHEN depth > 0.3e0 THEN 1 ELSE 0 END AS wet FROM hazard", "hazard")
def _(s, d):
    return fx.hazard(s, d).select("rp", "row", "col", exceeds(F.col("depth"), 0.3).alias("wet"))


@query("r03_mask_multiply", "SELECT row, col, total_pop * (CASE WHEN code IN (11, 12, 13) THEN 1 ELSE 0 END) AS value FROM population JOIN settlement USING (row, col)", "population", "settlement")
def _(s, d):
    mask = fx.settlement(s, d).select("row", "col", (settlement_class(F.col("code")) == 1).cast("int").alias("value"))
    return grid.multiply(fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), mask)


@query("r04_subtract_clamped", "SELECT row, col, greatest(elderly - children_u5, 0) AS value FROM population", "population")
def _(s, d):
    p = fx.population(s, d, ("elderly", "children_u5"))
    return grid.subtract_clamped(p.select("row", "col", F.col("elderly").alias("value")), p.select("row", "col", F.col("children_u5").alias("value")))


@query("r05_regrid_nearest", "SELECT g.row, g.col, p.total_pop AS value FROM grid g LEFT JOIN population p ON p.row = floor((g.row + 0.5e0) * 0.7e0) AND p.col = floor((g.col + 0.5e0) * 0.7e0)", "grid", "population")
def _(s, d):
    return grid.regrid_nearest(fx.grid(s), fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), 0.7, 1.0)


_BILINEAR = """SELECT row, col, round_even(sum(w * v) / sum(w) * 1e6, 0) / 1e6 AS value FROM (
  SELECT g.row, g.col, p.total_pop AS v, (CASE WHEN i = 1 THEN fv ELSE 1 - fv END) * (CASE WHEN j = 1 THEN fu ELSE 1 - fu END) AS w
  FROM (SELECT row, col, CAST(floor((row + 0.5e0) * 0.75e0 - 0.5e0) AS INTEGER) AS r0, CAST(floor((col + 0.5e0) * 0.75e0 - 0.5e0) AS INTEGER) AS c0,
               (row + 0.5e0) * 0.75e0 - 0.5e0 - floor((row + 0.5e0) * 0.75e0 - 0.5e0) AS fv, (col + 0.5e0) * 0.75e0 - 0.5e0 - floor((col + 0.5e0) * 0.75e0 - 0.5e0) AS fu FROM grid) g,
       range(2) a(i), range(2) b(j) JOIN population p ON p.row = g.r0 + i AND p.col = g.c0 + j) WHERE w > 0 GROUP BY row, col"""


@query("r06_regrid_bilinear", _BILINEAR, "grid", "population")
def _(s, d):
    out = grid.regrid_bilinear(fx.grid(s), fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), 0.75, 1.0)
    return out.select("row", "col", rnd(F.col("value"), 6).alias("value"))


@query("r07_downsample_mean", "SELECT CAST(row // 4 AS INTEGER) AS row, CAST(col // 4 AS INTEGER) AS col, round_even(avg(total_pop) * 1e6, 0) / 1e6 AS value FROM population GROUP BY ALL", "population")
def _(s, d):
    out = grid.block_mean(fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), 4)
    return out.select("row", "col", rnd(F.col("value"), 6).alias("value"))


@query("r07_downsample_nearest", "SELECT CAST(row // 4 AS INTEGER) AS row, CAST(col // 4 AS INTEGER) AS col, total_pop AS value FROM population WHERE row % 4 = 2 AND col % 4 = 2", "population")
def _(s, d):
    return grid.downsample_nearest(fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), 4)


@query("r08_upsample_nearest", "SELECT CAST(row * 2 + i AS INTEGER) AS row, CAST(col * 2 + j AS INTEGER) AS col, total_pop AS value FROM population, range(2) a(i), range(2) b(j)", "population")
def _(s, d):
    return grid.upsample_nearest(fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), 2)


def _at(old: int, new: int, name: str) -> str:
    return f"({name} * {(old - 1) / (new - 1)!r}::DOUBLE)"


_DENSE = ", dense AS (SELECT row, col, coalesce(total_pop, 0) AS value FROM grid LEFT JOIN population USING (row, col)), target AS (SELECT CAST(i // {w} AS INTEGER) AS row, CAST(i % {w} AS INTEGER) AS col FROM range({n}) t(i))"


def _dense(s, d):
    return fx.grid(s).join(fx.population(s, d, ("total_pop",)), ["row", "col"], "left").select("row", "col", F.coalesce("total_pop", F.lit(0.0)).alias("value"))


def _nearest_sql(side: int, value: str) -> str:
    return _DENSE.format(w=side, n=side * side) + f" SELECT t.row, t.col, {value} AS value FROM target t JOIN dense s ON s.row = floor({_at(100, side, 't.row')} + 0.5e0) AND s.col = floor({_at(100, side, 't.col')} + 0.5e0)"


def _linear_sql(side: int) -> str:
    v, u = _at(100, side, "t.row"), _at(100, side, "t.col")
    w = f"greatest(0, 1 - abs({v} - s.row)) * greatest(0, 1 - abs({u} - s.col))"
    return _DENSE.format(w=side, n=side * side) + f" SELECT t.row, t.col, round_even(sum({w} * value) / sum({w}) * 1e6, 0) / 1e6 AS value FROM target t JOIN dense s ON s.row BETWEEN floor({v}) AND floor({v}) + 1 AND s.col BETWEEN floor({u}) AND floor({u}) + 1 GROUP BY t.row, t.col"


@query("r07_zoom_nearest", _nearest_sql(25, "value"), "grid", "population")
def _(s, d):
    return grid.zoom_nearest(_dense(s, d), (100, 100), (25, 25))


@query("r07_zoom_flag", _nearest_sql(25, "value > 0.5e0"), "grid", "population")
def _(s, d):
    return grid.zoom_flag(_dense(s, d), (100, 100), (25, 25))


@query("r07_zoom_linear", _linear_sql(25), "grid", "population")
def _(s, d):
    return grid.zoom_linear(_dense(s, d), (100, 100), (25, 25)).withColumn("value", rnd(F.col("value"), 6))


@query("r08_zoom_linear", _linear_sql(160), "grid", "population")
def _(s, d):
    return grid.zoom_linear(_dense(s, d), (100, 100), (160, 160)).withColumn("value", rnd(F.col("value"), 6))


_SIDES = "SELECT code, TRUE AS flat, row AS line, col AS pos FROM settlement UNION ALL SELECT code, TRUE, row + 1, col FROM settlement UNION ALL SELECT code, FALSE, col, row FROM settlement UNION ALL SELECT code, FALSE, col + 1, row FROM settlement"


@query(
    "r11_polygonise",
    f""", outside AS (SELECT code, flat, line, pos FROM ({_SIDES}) GROUP BY ALL HAVING count(*) = 1),
    runs AS (SELECT code, flat, line, min(pos) AS a, max(pos) + 1 AS b FROM (SELECT *, pos - row_number() OVER (PARTITION BY code, flat, line ORDER BY pos) AS run FROM outside) GROUP BY code, flat, line, run)
    SELECT code, CAST(CASE WHEN flat THEN a ELSE line END AS DOUBLE) AS x1, CAST(CASE WHEN flat THEN line ELSE a END AS DOUBLE) AS y1, CAST(CASE WHEN flat THEN b ELSE line END AS DOUBLE) AS x2, CAST(CASE WHEN flat THEN line ELSE b END AS DOUBLE) AS y2 FROM runs""",
    "settlement",
)
def _(s, d):
    return grid.polygonise(fx.settlement(s, d), "code")


@query("r11_polygonise_and_back", "SELECT row, col, code FROM settlement WHERE code < 20", "settlement")
def _(s, d):
    """The outlines hold the cells that they were made of, and no others."""
    rural = fx.settlement(s, d).where("code < 20")
    return geo.cells_in_polygons(fx.grid(s), grid.polygonise(rural, "code"), "code").select("row", "col", "code")


@query("r09_mosaic_first_valid", "SELECT row, col, arg_min(depth, rp) AS depth FROM hazard WHERE depth > 0.1e0 GROUP BY row, col", "hazard")
def _(s, d):
    return grid.mosaic(fx.hazard(s, d).withColumn("depth", F.when(F.col("depth") > 0.1, F.col("depth"))), "rp", "depth")


@query("r12_storm_class", "SELECT line_id, CASE WHEN sshs = 1 THEN 1 WHEN sshs IN (2, 3) THEN 2 WHEN sshs IN (4, 5) THEN 3 ELSE 0 END AS cls FROM tracks", "tracks")
def _(s, d):
    return fx.tracks(s, d).select("line_id", storm_class(F.col("sshs")).alias("cls"))


@query("r13_drought_class", "SELECT o_custkey, count(*) AS months, CASE WHEN count(*) <= 18 THEN 1 WHEN count(*) <= 36 THEN 2 WHEN count(*) <= 54 THEN 3 ELSE 4 END AS cls FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey")
def _(s, d):
    """A class for each customer's number of items, as for a cell's event months."""
    items = fx.table(s, d, "orders").join(fx.table(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return items.groupBy("o_custkey").agg(F.count("*").alias("months")).select("o_custkey", "months", drought_class(F.col("months")).alias("cls"))


@query("r14_cost_surface", "SELECT row, col, CASE WHEN (row * 7 + col * 11) % 9 > 0 THEN (row * 7 + col * 11) % 9 * 111e0 ELSE 1e6 END AS cost, coalesce(depth > 0.3e0, FALSE) AS risky FROM grid LEFT JOIN (SELECT * FROM hazard WHERE rp = 100) USING (row, col)", "grid", "hazard")
def _(s, d):
    return _surface(s, d).select("row", "col", "cost", "risky")


def _surface(s, d):
    return surface_of(s, fx.hazard(s, d).where("rp = 100").select("row", "col", "depth")).drop("source")


def surface_of(s, hazard):
    """row, col, cost, risky, source (safe cells) over the grid, of a hazard's depth."""
    f = (F.col("row") * 7 + F.col("col") * 11) % 9
    g = fx.grid(s).join(hazard, ["row", "col"], "left")
    risky = cost.at_risk(F.col("depth"))
    return g.select("row", "col", cost.friction_cost(f, 111.0).alias("cost"), risky.alias("risky"), (~risky).alias("source"))


fx.SQL["surface"] = (
    ["grid", "hazard"],
    "SELECT row, col, CASE WHEN (row * 7 + col * 11) % 9 > 0 THEN (row * 7 + col * 11) % 9 * 111e0 ELSE 1e6 END AS cost, coalesce(depth > 0.3e0, FALSE) AS risky FROM grid LEFT JOIN (SELECT * FROM hazard WHERE rp = 100) USING (row, col)",
)
_OFFER = "t.distance + (a.cost + n.cost) / 2 * CASE WHEN n.row <> t.row AND n.col <> t.col THEN sqrt(2e0) ELSE 1 END"
#: Bellman-Ford over keyed rows: a recursive term that replaces a cell's distance where an offer is lower.
WALK = f""", steps AS (SELECT row - dr AS from_row, col - dc AS from_col, row, col, cost FROM surface, (SELECT unnest([-1, 0, 1]) AS dr), (SELECT unnest([-1, 0, 1]) AS dc) WHERE dr <> 0 OR dc <> 0),
walk(row, col, distance) USING KEY (row, col) AS (
  SELECT row, col, 0e0 FROM surface WHERE NOT risky
  UNION
  SELECT n.row, n.col, min({_OFFER}) FROM walk t JOIN surface a USING (row, col) JOIN steps n ON n.from_row = t.row AND n.from_col = t.col
    LEFT JOIN recurring.walk AS o ON o.row = n.row AND o.col = n.col
  WHERE o.distance IS NULL OR {_OFFER} < o.distance GROUP BY n.row, n.col)"""


def walked(body: str, *needs: str) -> str:
    return fx.with_sql(WALK + body, "surface", *needs).replace("WITH ", "WITH RECURSIVE ", 1)


def whole_surface(s, d):
    """Safe cells are the sources."""
    return _surface(s, d).select("row", "col", "cost", (~F.col("risky")).alias("source"))


_WALKED = " SELECT row, col, round_even(CASE WHEN distance < 1e9 THEN distance END * 1e3, 0) / 1e3 AS distance FROM surface LEFT JOIN walk USING (row, col)"


@query("r15_least_cost_heap")
def _(s, d):
    return cost.least_cost_heap(whole_surface(s, d).withColumn("grid", F.lit(0))).select("row", "col", rnd(F.col("distance"), 3).alias("distance"))


@query("r15_least_cost_tiled")
def _(s, d):
    return cost.least_cost(whole_surface(s, d), tile=32).select("row", "col", rnd(F.col("distance"), 3).alias("distance"))


@query("r15_least_cost_relaxed")
def _(s, d):
    return cost.least_cost_relaxed(whole_surface(s, d), Latest()).select("row", "col", rnd(F.col("distance"), 3).alias("distance"))


SQL |= {f"r15_least_cost_{how}": walked(_WALKED) for how in ("heap", "tiled", "relaxed")}


@query("r16_source_sample", "SELECT least(2000, count(CASE WHEN NOT coalesce(depth > 0.3e0, FALSE) THEN 1 END)) AS sources FROM grid LEFT JOIN (SELECT * FROM hazard WHERE rp = 100) USING (row, col)", "grid", "hazard")
def _(s, d):
    return cost.sample_sources(_surface(s, d).withColumn("source", ~F.col("risky")), 2000).agg(F.count("*").alias("sources"))


@query("r18_analysis_scale", "SELECT *, CASE WHEN cells <= 10000000 THEN 1e0 ELSE greatest(sqrt(cells / 1e7), 5e0) END AS scale FROM (SELECT unit_id, CAST((max(x1) - min(x1)) * (max(y1) - min(y1)) * (1 + ascii(unit_id[3])) * 1000 AS BIGINT) AS cells FROM edges GROUP BY unit_id)", "edges")
def _(s, d):
    """The scale of each unit's box at some resolution."""
    b = geo.bounds(fx.edges(s, d), ["unit_id"])
    cells = ((F.col("x_max") - F.col("x_min")) * (F.col("y_max") - F.col("y_min")) * (1 + F.ascii(F.substring("unit_id", 3, 1))) * 1000).cast("long")
    return b.select("unit_id", cells.alias("cells"), analysis_scale_of(cells, 100.0).alias("scale"))


@query("r19_footprint", "SELECT unit_id, CAST(ceil((max(greatest(x1, x2)) - min(least(x1, x2))) / 0.3e0) * ceil((max(greatest(y1, y2)) - min(least(y1, y2))) / 0.3e0) AS BIGINT) AS cells FROM edges GROUP BY unit_id", "edges")
def _(s, d):
    return geo.bounds(fx.edges(s, d), ["unit_id"]).select("unit_id", footprint_cells(F.col("x_min"), F.col("y_min"), F.col("x_max"), F.col("y_max"), 0.3).cast("long").alias("cells"))


@query("r20_people_at_risk", "SELECT unit_id, coalesce(sum(CASE WHEN depth > 0.3e0 THEN total_pop END), 0) AS people, coalesce(sum(total_pop), 0) AS total FROM units LEFT JOIN cell_zone USING (unit_id) LEFT JOIN population USING (row, col) LEFT JOIN (SELECT row, col, depth FROM hazard WHERE rp = 100) USING (row, col) GROUP BY unit_id", "units", "cell_zone", "population", "hazard")
def _(s, d):
    from ..operators import zonal

    cells = fx.population(s, d, ("total_pop",)).join(fx.hazard(s, d).where("rp = 100"), ["row", "col"], "left")
    return zonal.zonal(fx.units(s, d), fx.cell_zone(s, d), cells, {"people": F.sum(F.when(F.col("depth") > 0.3, F.col("total_pop"))), "total": F.sum("total_pop")})


@query("z14_block_sum", "SELECT CAST(row // 7 AS INTEGER) AS row, CAST(col // 7 AS INTEGER) AS col, sum(total_pop) AS value FROM population GROUP BY ALL", "population")
def _(s, d):
    return grid.block_sum(fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), 7)


@query("z14_block_sum_trimmed", "SELECT CAST(row // 7 AS INTEGER) AS row, CAST(col // 7 AS INTEGER) AS col, sum(total_pop) AS value FROM population WHERE row < 98 AND col < 98 GROUP BY ALL", "population")
def _(s, d):
    return grid.block_sum_trimmed(fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), 7, 100, 100)


@query("z15_stack_sum", "SELECT row, col, sum(value) AS value FROM pop_bins GROUP BY row, col", "pop_bins")
def _(s, d):
    return grid.stack_sum(fx.pop_bins(s, d))


@query("z16_population_stack", "SELECT row, col, " + ", ".join(fx.INDICATORS) + ", " + " + ".join(fx.INDICATORS) + " AS people FROM population", "population")
def _(s, d):
    from ..plans.indicators import vulnerable_people

    return fx.population(s, d).withColumn("people", vulnerable_people(None, list(fx.INDICATORS)))


@query("z17_histogram", "SELECT code, count(*) AS n FROM settlement GROUP BY code", "settlement")
def _(s, d):
    return grid.histogram(fx.settlement(s, d), "code")


_MODE = "SELECT row, col, label FROM (SELECT row, col, label, row_number() OVER (PARTITION BY row, col ORDER BY count(*) DESC, label) AS k FROM (SELECT CAST(l_partkey % 100 AS INTEGER) AS row, CAST(l_suppkey % 100 AS INTEGER) AS col, CAST(l_orderkey % 6 AS INTEGER) AS label FROM lineitem) GROUP BY row, col, label) WHERE k = 1"
fx.SQL["land_cover"] = ([], _MODE)


def land_cover(s, d):
    """Most frequent label of a stack of images; 4 is crops."""
    images = fx.table(s, d, "lineitem").select((F.col("l_partkey") % 100).cast("int").alias("row"), (F.col("l_suppkey") % 100).cast("int").alias("col"), (F.col("l_orderkey") % 6).cast("int").alias("label"))
    return grid.stack_mode(images, "label")


@query("z18_stack_mode", _MODE)
def _(s, d):
    return land_cover(s, d)


@query("z19_stack_max", "SELECT row, col, max(depth) AS depth FROM hazard GROUP BY row, col", "hazard")
def _(s, d):
    return grid.stack_max(fx.hazard(s, d), "depth")


@query("w06_painters_order", "SELECT row, col, max(rp) AS rp FROM hazard WHERE depth > 0.3e0 GROUP BY row, col", "hazard")
def _(s, d):
    return grid.stack_max(fx.hazard(s, d).where("depth > 0.3D"), "rp")


_EVENTS = f""", f AS (SELECT *, cents < {fx.DRY} * n AS dry FROM series), i AS (SELECT *, sum(CASE WHEN dry THEN 0 ELSE 1 END) OVER (PARTITION BY cell ORDER BY step) AS island FROM f)
SELECT cell, step, dry AND sum(CASE WHEN dry THEN 1 ELSE 0 END) OVER (PARTITION BY cell, island) >= 3 AS event FROM i"""


@query("w02_run_events", _EVENTS, "series")
def _(s, d):
    return series.run_events(fx.series(s, d), ["cell"], "step", F.col("cents") < fx.DRY * F.col("n")).select("cell", "step", "event")


@query("w02_run_events_by_frame", _EVENTS, "series")
def _(s, d):
    return series.centred_run_events(fx.series(s, d), ["cell"], "step", F.col("cents") < fx.DRY * F.col("n")).select("cell", "step", "event")


@query("w07_chunks_under_budget")
def _(s, d):
    b = geo.bounds(fx.edges(s, d), ["unit_id"])
    return series.chunks_under_budget(b.withColumn("pos", F.col("unit_id")), "pos", 900)


_BOX = [f"{f}({n}, o.{n})" for f, n in (("least", "x_min"), ("least", "y_min"), ("greatest", "x_max"), ("greatest", "y_max"))]
_FITS = f"({_BOX[2]} - {_BOX[0]}) * ({_BOX[3]} - {_BOX[1]}) <= 900"
SQL["w07_chunks_under_budget"] = fx.with_sql(
    ", o AS (SELECT unit_id AS u, row_number() OVER (ORDER BY unit_id) AS i, min(least(x1, x2)) AS x_min, min(least(y1, y2)) AS y_min, max(greatest(x1, x2)) AS x_max, max(greatest(y1, y2)) AS y_max FROM edges GROUP BY unit_id),"
    " w AS (SELECT u AS unit_id, i, CAST(0 AS BIGINT) AS chunk, x_min, y_min, x_max, y_max FROM o WHERE i = 1 UNION ALL SELECT o.u, o.i, w.chunk + CASE WHEN FITS THEN 0 ELSE 1 END, ".replace("FITS", _FITS.replace("(x_", "(w.x_").replace("(y_", "(w.y_"))
    + ", ".join(f"CASE WHEN {_FITS} THEN {e} ELSE o.{n} END".replace("(x_", "(w.x_").replace("(y_", "(w.y_") for e, n in zip(_BOX, ("x_min", "y_min", "x_max", "y_max"), strict=True))
    + " FROM w JOIN o ON o.i = w.i + 1) SELECT unit_id, chunk FROM w",
    "edges",
).replace("WITH ", "WITH RECURSIVE ", 1)


@query("s07_windowed_read", "SELECT row, col, total_pop AS value FROM population WHERE row BETWEEN 30 AND 61 AND col BETWEEN 10 AND 33", "population")
def _(s, d):
    tiles = stored(grid.to_tiles(fx.population(s, d, ("total_pop",)).withColumnRenamed("total_pop", "value"), 16))
    return grid.from_tiles(tiles, (30, 10, 32, 24), 16)


def _landed(s, d) -> str:
    """The folder of one GeoTIFF of the population, by strips of 16 rows."""
    folder = new_path(s, "geotiff")
    cells = fx.population(s, d, ("total_pop",)).select(F.lit("population.tif").alias("raster"), "row", "col", F.col("total_pop").alias("value"))
    tiff.landed(tiff.geotiffs(cells, (100, 100), 0.0, 0.0, 1.0, 1.0, rows=16, dtype="f8"), folder)
    return folder


@query("s07_geotiff_window", "SELECT 'population.tif' AS raster, row, col, CAST(total_pop AS DOUBLE) AS value FROM population WHERE row BETWEEN 30 AND 61 AND col BETWEEN 10 AND 33", "population")
def _(s, d):
    window = (30, 10, 32, 24)
    return tiff.cells(tiff.blocks(s, _landed(s, d), window), window).select("raster", "row", "col", "value")


def _triangle(row: str, old: int, new: int, cell: str) -> str:
    return f"greatest(0e0, 1 - abs({cell} - (({row} + 0.5e0) * {old / new!r}e0 - 0.5e0)) / {max(1.0, old / new)!r}e0)"


_SHAPE = (30, 160)
_REDUCED = f"""SELECT CAST(t.i // {_SHAPE[1]} AS INTEGER) AS row, CAST(t.i % {_SHAPE[1]} AS INTEGER) AS col, {_triangle(f"(t.i // {_SHAPE[1]})", 100, _SHAPE[0], "p.row")} * {_triangle(f"(t.i % {_SHAPE[1]})", 100, _SHAPE[1], "p.col")} AS w, total_pop AS v
  FROM range({_SHAPE[0] * _SHAPE[1]}) t(i) JOIN population p ON p.row BETWEEN (t.i // {_SHAPE[1]} + 0.5e0) * {100 / _SHAPE[0]!r}e0 - 5 AND (t.i // {_SHAPE[1]} + 0.5e0) * {100 / _SHAPE[0]!r}e0 + 5 AND p.col BETWEEN (t.i % {_SHAPE[1]}) * 0.625e0 - 3 AND (t.i % {_SHAPE[1]}) * 0.625e0 + 3"""


@query("s08_geotiff_reduced", f"SELECT row, col, round_even(sum(w * v) / sum(w) * 1e6, 0) / 1e6 AS value FROM ({_REDUCED}) WHERE w > 0 GROUP BY row, col", "population")
def _(s, d):
    """Rows fewer, columns more than the raster has."""
    return tiff.reduced(tiff.blocks(s, _landed(s, d)), _SHAPE).select("row", "col", rnd(F.col("value"), 6).alias("value"))
