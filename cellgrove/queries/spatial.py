"""Spatial joins, zonal statistics and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import mollweide_forward, pixel_metres, pixel_metres_at, rnd, tile_xyz, utm_forward, utm_zone
from ..operators import geo, grid, zonal
from . import fixtures as fx

query, FUNCTIONS, SQL = fx.collector()
_LISTED = list(fx.INDICATORS)


@query("j07_point_in_polygon", "SELECT id, category, unit_id FROM facility_zone", "facility_zone")
def _(s, d):
    return fx.facility_zone(s, d).select("id", "category", "unit_id")


@query("j07_repeated_points", "SELECT id, category, copy, unit_id FROM facility_zone, (SELECT unnest(['a', 'b', 'b']) AS copy)", "facility_zone")
def _(s, d):
    copies = fx.facilities(s, d).withColumn("copy", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("b"))))
    return geo.points_in_polygons(copies, fx.edges(s, d), "unit_id").select("id", "category", "copy", "unit_id")


_ON_EDGE = "(x2 - x1) * (py - y1) = (y2 - y1) * (px - x1) AND px BETWEEN least(x1, x2) AND greatest(x1, x2) AND py BETWEEN least(y1, y2) AND greatest(y1, y2)"
_CROSSES = "(y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / nullif(y2 - y1, 0) + x1"


@query(
    "j07_border_points",
    f""", p AS (SELECT CAST(i // 101 AS INTEGER) AS row, CAST(i % 101 AS INTEGER) AS col, CAST(i // 101 AS DOUBLE) AS py, CAST(i % 101 AS DOUBLE) AS px FROM range(10201) t(i)),
    m AS (SELECT row, col, unit_id, count(CASE WHEN {_CROSSES} THEN 1 END) % 2 = 1 AS odd, bool_or({_ON_EDGE}) AS border FROM p JOIN edges ON py BETWEEN least(y1, y2) AND greatest(y1, y2) GROUP BY ALL)
    SELECT unit_id, count(CASE WHEN odd OR border THEN 1 END) AS intersecting, count(CASE WHEN odd AND NOT border THEN 1 END) AS within FROM m GROUP BY unit_id""",
    "edges",
)
def _(s, d):
    corners = s.range(10201).select(F.floor(F.col("id") / 101).cast("double").alias("y"), (F.col("id") % 101).cast("double").alias("x"))
    n = lambda how: geo.points_in_polygons(corners, fx.edges(s, d), "unit_id", border=how).groupBy("unit_id").agg(F.count("*").alias("n"))
    return n("intersects").withColumnRenamed("n", "intersecting").join(n("within").withColumnRenamed("n", "within"), "unit_id", "left")


@query("r10_cells_in_polygons", "SELECT unit_id, count(*) AS cells, CAST(sum(row) AS BIGINT) AS rows, CAST(sum(col) AS BIGINT) AS cols FROM cell_zone GROUP BY unit_id", "cell_zone")
def _(s, d):
    return fx.cell_zone(s, d).groupBy("unit_id").agg(F.count("*").alias("cells"), F.sum("row").alias("rows"), F.sum("col").alias("cols"))


@query("j08_polygon_overlap_as_cells", "SELECT unit_id, piece, count(*) AS cells FROM cell_zone JOIN iso_cells USING (row, col) GROUP BY unit_id, piece", "cell_zone", "iso_cells")
def _(s, d):
    iso = geo.cells_in_polygons(fx.grid(s), fx.isochrones(s, d), "piece")
    return fx.cell_zone(s, d).join(iso, ["row", "col"]).groupBy("unit_id", "piece").agg(F.count("*").alias("cells"))


@query("j09_clip_to_units", "SELECT row, col, total_pop FROM population SEMI JOIN cell_zone USING (row, col)", "population", "cell_zone")
def _(s, d):
    return grid.clip(fx.population(s, d, ("total_pop",)), fx.cell_zone(s, d))


@query("j10_units_near_roads", f"SELECT DISTINCT unit_id FROM cell_zone z JOIN grid g USING (row, col) WHERE EXISTS (SELECT 1 FROM roads WHERE pred_label = 0 AND {fx.DISTANCE_SQL} <= 4e0)", "cell_zone", "roads")
def _(s, d):
    centres = fx.grid(s).withColumns({"x": F.col("col") + 0.5, "y": F.col("row") + 0.5})
    near = geo.near_any(centres, fx.roads(s, d).where("pred_label = 0"), 2.0)
    return geo.exists_near(fx.units(s, d).select("unit_id"), fx.cell_zone(s, d), near)


@query("j12_sample_cells_under_points", "SELECT id, rp, depth FROM facilities, (SELECT unnest([10, 50, 100, 500]) AS rp) LEFT JOIN hazard h USING (rp) WHERE h.row = floor(y) AND h.col = floor(x) UNION ALL SELECT id, NULL, NULL FROM facilities WHERE NOT EXISTS (SELECT 1 FROM hazard h WHERE h.row = floor(y) AND h.col = floor(x))", "facilities", "hazard")
def _(s, d):
    h = fx.hazard(s, d).select("row", "col", F.struct("rp", "depth").alias("value"))
    return grid.sample(fx.facilities(s, d), h).select("id", "value.rp", "value.depth")


@query("j16_distance_join", f"SELECT line_id, count(*) AS cells FROM grid JOIN roads ON {fx.DISTANCE_SQL} <= 4e0 GROUP BY line_id", "grid", "roads")
def _(s, d):
    centres = fx.grid(s).withColumns({"x": F.col("col") + 0.5, "y": F.col("row") + 0.5})
    roads = fx.roads(s, d).select("line_id", "x1", "y1", "x2", "y2")
    ends = ["x1", "y1", "x2", "y2"]
    cells = geo.within_distance(centres, geo.by_shape(roads), 2.0).groupBy(*ends).agg(F.count("*").alias("n"))
    return roads.join(cells, ends).groupBy("line_id").agg(F.sum("n").alias("cells"))


@query("j16_wide_radius", f"SELECT count(*) AS pairs, CAST(sum(line_id) AS BIGINT) AS lines FROM (SELECT line_id, px * 1000e0 AS px, py * 1000e0 AS py, x1 * 1000e0 AS x1, y1 * 1000e0 AS y1, x2 * 9000e0 AS x2, y2 * 1000e0 AS y2 FROM grid, roads) WHERE {fx.DISTANCE_SQL} <= 4e6", "grid", "roads")
def _(s, d):
    """Metres, long segments and a radius of 2,000."""
    centres = fx.grid(s).select(((F.col("col") + 0.5) * 1000).alias("x"), ((F.col("row") + 0.5) * 1000).alias("y"))
    lines = fx.roads(s, d).select("line_id", *((F.col(c) * (9000 if c == "x2" else 1000)).alias(c) for c in ("x1", "y1", "x2", "y2")))
    shapes = geo.by_shape(lines, n=F.count("*"), ids=F.sum("line_id"))
    return geo.within_distance(centres, shapes, 2000.0).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.sum("ids").alias("lines"))


@query("p09_box_overlap", "WITH_BOX SELECT a.unit_id AS a, b.unit_id AS b FROM box a JOIN box b ON a.unit_id < b.unit_id AND a.x_min - 4 < b.x_max AND a.x_max + 4 > b.x_min AND a.y_min - 4 < b.y_max AND a.y_max + 4 > b.y_min", "edges")
def _(s, d):
    b = geo.bounds(fx.edges(s, d), ["unit_id"])
    left = b.select(F.col("unit_id").alias("a"), *((F.col(c) + (4 if "max" in c else -4)).alias("l_" + c) for c in b.columns[1:]))
    right = b.select(F.col("unit_id").alias("b"), *(F.col(c).alias("r_" + c) for c in b.columns[1:]))
    # boxes are dealt to squares of the layout, so only neighbours meet
    cells = lambda df, p: df.withColumn("sx", F.explode(F.sequence(F.floor(F.col(p + "x_min") / 20), F.floor(F.col(p + "x_max") / 20)))).withColumn("sy", F.explode(F.sequence(F.floor(F.col(p + "y_min") / 20), F.floor(F.col(p + "y_max") / 20))))
    return cells(left, "l_").join(cells(right, "r_"), ["sx", "sy"]).where(geo.overlaps("l_", "r_") & (F.col("a") < F.col("b"))).select("a", "b").distinct()


SQL["p09_box_overlap"] = SQL["p09_box_overlap"].replace("WITH_BOX SELECT", ", box AS (SELECT unit_id, min(least(x1, x2)) AS x_min, min(least(y1, y2)) AS y_min, max(greatest(x1, x2)) AS x_max, max(greatest(y1, y2)) AS y_max FROM edges GROUP BY unit_id) SELECT")


@query(
    "p10_tile_bounds",
    """SELECT s_suppkey, CAST(lon AS INTEGER) AS west, CAST(lat - 10 AS INTEGER) AS south, CAST(lon + 10 AS INTEGER) AS east, CAST(lat AS INTEGER) AS north
    FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END * (s_suppkey % 9 * 10) AS lat, CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE 1 END * (s_suppkey % 17 * 10) AS lon FROM supplier)""",
)
def _(s, d):
    from ..operators.table import tile_bounds

    k = F.col("s_suppkey")
    name = F.format_string("%s%02d_%s%03d_RP10_depth.tif", F.when(k % 2 == 0, "N").otherwise("S"), k % 9 * 10, F.when(k % 3 == 0, "W").otherwise("E"), k % 17 * 10)
    return fx.table(s, d, "supplier").select("s_suppkey", *(c.alias(n) for n, c in tile_bounds(name).items()))


@query("p15_degenerate_rings_dropped", "SELECT unit_id, ring, count(*) AS edges FROM edges GROUP BY unit_id, ring", "edges")
def _(s, d):
    bad = s.createDataFrame([("BAD", 0, [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)])], "unit_id string, ring int, points array<struct<x: double, y: double>>")
    return geo.edges_from_rings(fx.rings(s, d).unionByName(bad)).groupBy("unit_id", "ring").agg(F.count("*").alias("edges"))


@query("z01_zonal_sum", "SELECT unit_id, coalesce(sum(total_pop), 0) AS total_pop, coalesce(sum(female_pop), 0) AS female_pop FROM units LEFT JOIN (SELECT * FROM cell_zone JOIN population USING (row, col)) USING (unit_id) GROUP BY unit_id", "units", "cell_zone", "population")
def _(s, d):
    return zonal.zonal(fx.units(s, d), fx.cell_zone(s, d), fx.population(s, d, ("total_pop", "female_pop")), {n: F.sum(n) for n in ("total_pop", "female_pop")})


@query(
    "z02_zonal_mean_max_median",
    """SELECT unit_id, nullif(round_even(avg(v) * 10, 0) / 10, 0) AS mean, nullif(round_even(max(v) * 10, 0) / 10, 0) AS max, nullif(round_even(quantile_cont(v, 0.5) * 10, 0) / 10, 0) AS median, count(v) AS count
    FROM (SELECT unit_id, CAST(total_pop AS DOUBLE) AS v FROM cell_zone JOIN population USING (row, col)) GROUP BY unit_id""",
    "cell_zone", "population",
)
def _(s, d):
    return zonal.travel_statistics(fx.population(s, d, ("total_pop",)).join(fx.cell_zone(s, d), ["row", "col"]), "total_pop")


_CLASSED = "classed AS (SELECT row, col, CASE WHEN depth > 0.8e0 THEN 3 WHEN depth > 0.5e0 THEN 2 WHEN depth > 0.2e0 THEN 1 ELSE 0 END AS cls FROM hazard WHERE rp = 500)"


@query(
    "z03_zonal_sum_by_class",
    f", {_CLASSED} SELECT unit_id, " + ", ".join(f"coalesce(sum(CASE WHEN cls = {k} THEN {v} END), 0) AS {v}_cat{k}" for k in (1, 2, 3) for v in ("total_pop", "elderly")) + " FROM units LEFT JOIN (SELECT * FROM cell_zone JOIN population USING (row, col) JOIN classed USING (row, col)) USING (unit_id) GROUP BY unit_id",
    "units", "cell_zone", "population", "hazard",
)
def _(s, d):
    x = F.col("depth")
    classed = fx.hazard(s, d).where("rp = 500").select("row", "col", F.when(x > 0.8, 3).when(x > 0.5, 2).when(x > 0.2, 1).otherwise(0).alias("cls"))
    cells = fx.population(s, d, ("total_pop", "elderly")).join(classed, ["row", "col"])
    return zonal.zonal(fx.units(s, d), fx.cell_zone(s, d), cells, zonal.class_sums([1, 2, 3], ["total_pop", "elderly"]))


@query("z04_zonal_sum_keeps_multiplicity", "SELECT unit_id, split_part(piece, ':', 2) AS cutoff, sum(total_pop) AS people FROM cell_zone JOIN iso_cells USING (row, col) JOIN population USING (row, col) GROUP BY ALL", "cell_zone", "iso_cells", "population")
def _(s, d):
    iso = geo.cells_in_polygons(fx.grid(s), fx.isochrones(s, d), "piece")
    cells = iso.join(fx.population(s, d, ("total_pop",)), ["row", "col"]).join(fx.cell_zone(s, d), ["row", "col"])
    return cells.groupBy("unit_id", F.split("piece", ":")[1].alias("cutoff")).agg(F.sum("total_pop").alias("people"))


@query("z05_group_count", "SELECT unit_id, category, count(*) AS n FROM facility_zone GROUP BY unit_id, category", "facility_zone")
def _(s, d):
    return fx.facility_zone(s, d).groupBy("unit_id", "category").agg(F.count("*").alias("n"))


@query("z06_flagged_share", "SELECT unit_id, round_even(avg(CASE WHEN depth > 0.3e0 THEN 1 ELSE 0 END) * 1000, 0) / 10 AS pct, count(CASE WHEN depth > 0.3e0 THEN 1 END) AS flooded FROM facility_zone LEFT JOIN (SELECT * FROM hazard WHERE rp = 100) h ON h.row = floor(y) AND h.col = floor(x) GROUP BY unit_id", "facility_zone", "hazard")
def _(s, d):
    at = grid.sample(fx.facility_zone(s, d), fx.hazard(s, d).where("rp = 100"), value="depth", empty=0.0)
    wet = F.col("depth") > 0.3
    return at.groupBy("unit_id").agg(rnd(F.avg(wet.cast("int")) * 100, 1).alias("pct"), F.count_if(wet).alias("flooded"))


@query("z12_bounding_box", "SELECT unit_id, min(least(x1, x2)) AS x_min, min(least(y1, y2)) AS y_min, max(greatest(x1, x2)) AS x_max, max(greatest(y1, y2)) AS y_max FROM edges GROUP BY unit_id", "edges")
def _(s, d):
    return geo.bounds(fx.edges(s, d), ["unit_id"])


@query("z13_dissolve", "SELECT split_part(piece, ':', 2) AS cutoff, count(*) AS cells FROM (SELECT DISTINCT split_part(piece, ':', 2) AS piece2, piece, row, col FROM iso_cells) GROUP BY 1", "iso_cells")
def _(s, d):
    iso = geo.cells_in_polygons(fx.grid(s), fx.isochrones(s, d), "piece")
    return iso.select(F.split("piece", ":")[1].alias("cutoff"), "row", "col").distinct().groupBy("cutoff").agg(F.count("*").alias("cells"))


SQL["z13_dissolve"] = fx.with_sql("SELECT cutoff, count(*) AS cells FROM (SELECT DISTINCT split_part(piece, ':', 2) AS cutoff, row, col FROM iso_cells) GROUP BY cutoff", "iso_cells")


@query(
    "g01_area_and_centroid",
    """SELECT unit_id, round_even(abs(sum(s * a)) / 2 * 1e6, 0) / 1e6 AS area, round_even(sum(s * x) / (3 * sum(s * a)) * 1e6, 0) / 1e6 AS cx, round_even(sum(s * y) / (3 * sum(s * a)) * 1e6, 0) / 1e6 AS cy
    FROM (SELECT unit_id, ring, sum(x1 * y2 - x2 * y1) AS a, sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS x, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS y, sign(sum(x1 * y2 - x2 * y1)) * CASE ring WHEN 0 THEN 1 ELSE -1 END AS s FROM edges GROUP BY unit_id, ring)
    GROUP BY unit_id""",
    "edges",
)
def _(s, d):
    return geo.area_and_centroid(fx.edges(s, d)).select("unit_id", *(rnd(F.col(c), 6).alias(c) for c in ("area", "cx", "cy")))


@query("g02_utm_zone_and_pixel", "SELECT id, 32600 + CAST(least(60, greatest(1, floor((x * 3 - 180 + 180) / 6) + 1)) AS INTEGER) AS zone, round_even(x * 111000e0 * 1e3, 0) / 1e3 AS metres, round_even(x * 111320e0 * cos(radians(least(60e0, y))) * 1e3, 0) / 1e3 AS metres_at FROM facilities", "facilities")
def _(s, d):
    return fx.facilities(s, d).select("id", utm_zone(F.col("x") * 3 - 180, F.col("y")).alias("zone"), rnd(pixel_metres(F.col("x")), 3).alias("metres"), rnd(pixel_metres_at(F.col("x"), F.col("y")), 3).alias("metres_at"))


@query("g03_map_tiles", "SELECT id, CAST(greatest(0, least(1023, floor((x - 50 + 180e0) / 360e0 * 1024e0))) AS BIGINT) AS tx, CAST(greatest(0, least(1023, floor((1e0 - ln(tan(radians(y - 50)) + 1 / cos(radians(y - 50))) / 3.141592653589793e0) / 2e0 * 1024e0))) AS BIGINT) AS ty FROM facilities", "facilities")
def _(s, d):
    x, y = tile_xyz(F.col("x") - 50, F.col("y") - 50, 10)
    return fx.facilities(s, d).select("id", x.alias("tx"), y.alias("ty"))


@query("g04_projections")
def _(s, d):
    f = fx.facilities(s, d).withColumns({"lon": F.lit(30.0) + F.col("x") / 50, "lat": F.col("y") / 2})
    e, n = utm_forward(F.col("lon"), F.col("lat"), 36)
    mx, my = mollweide_forward(F.col("lon"), F.col("lat"))
    return f.select("id", rnd(e, 3).alias("easting"), rnd(n, 3).alias("northing"), rnd(mx, 3).alias("mollweide_x"), rnd(my, 3).alias("mollweide_y"))


def _projection_sql() -> str:
    """The published series and Newton steps, written out."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e = f * (2 - f)
    p = e / (1 - e)
    m = f"{a!r} * ({1 - e / 4 - 3 * e**2 / 64 - 5 * e**3 / 256!r} * phi - {3 * e / 8 + 3 * e**2 / 32 + 45 * e**3 / 1024!r} * sin(2 * phi) + {15 * e**2 / 256 + 45 * e**3 / 1024!r} * sin(4 * phi) - {35 * e**3 / 3072!r} * sin(6 * phi))"
    x = f"{k0} * n * (g + (1 - t + c) * g ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - {58 * p!r}) * g ** 5 / 120) + 500000"
    y = f"{k0} * ({m} + n * tan(phi) * (g ** 2 / 2 + (5 - t + 9 * c + 4 * c * c) * g ** 4 / 24 + (61 - 58 * t + t * t + 600 * c - {330 * p!r}) * g ** 6 / 720))"
    step = "q - CASE WHEN 2 + 2 * cos(2 * q) > 1e-9 THEN (2 * q + sin(2 * q) - pi() * sin(phi)) / (2 + 2 * cos(2 * q)) ELSE 0 END"
    r = lambda v: f"round_even(({v}) * 1e3, 0) / 1e3"
    return f""", l AS (SELECT id, radians(y / 2) AS phi, radians(30 + x / 50 - 33) AS lam, radians(30 + x / 50) AS lon FROM facilities),
    v AS (SELECT *, {a!r} / sqrt(1 - {e!r} * sin(phi) ** 2) AS n, tan(phi) ** 2 AS t, {p!r} * cos(phi) ** 2 AS c, lam * cos(phi) AS g, list_reduce(list_concat([phi], [0e0 FOR i IN range(12)]), lambda q, z: {step}) AS theta FROM l)
    SELECT id, {r(x)} AS easting, {r(y)} AS northing, {r(f"{a!r} * 2 * sqrt(2e0) / pi() * lon * cos(theta)")} AS mollweide_x, {r(f"{a!r} * sqrt(2e0) * sin(theta)")} AS mollweide_y FROM v"""


SQL["g04_projections"] = fx.with_sql(_projection_sql(), "facilities")


@query("g05_simplified_rings", "SELECT unit_id, ring, 4 AS points FROM edges GROUP BY unit_id, ring", "edges")
def _(s, d):
    # every ring with the middle of its first edge added: simplification takes it out again
    p = F.col("points")
    mid = F.struct(((p[0].x + p[1].x) / 2).alias("x"), ((p[0].y + p[1].y) / 2).alias("y"))
    more = fx.rings(s, d).withColumn("points", F.concat(F.slice("points", 1, 1), F.array(mid), F.slice("points", 2, 3)))
    return geo.simplify_rings(more, 0.01).select("unit_id", "ring", F.size("points").alias("points"))


@query("g05_shared_borders", "SELECT unit_id, 4 AS points, CAST(4 - (n % 5 = 0)::INT - (n % 5 = 4)::INT - (n < 5)::INT - (n >= 20)::INT AS BIGINT) AS shared FROM units", "units")
def _(s, d):
    """Touching squares with bent sides: bends go, and what is left of a common side is the same for both."""
    n = F.col("n")
    x0, y0 = (n % 5 * 20).cast("double"), (F.floor(n / 5) * 20).cast("double")
    p = lambda x, y: F.struct((x0 + x).alias("x"), (y0 + y).alias("y"))
    bent = [(0.0, 0.0), (7.0, 0.125), (20.0, 0.0), (20.125, 7.0), (20.0, 20.0), (7.0, 20.125), (0.0, 20.0), (0.125, 7.0)]
    rings = fx.units(s, d).select("unit_id", F.lit(0).alias("ring"), F.array(*(p(x, y) for x, y in bent)).alias("points"))
    e = geo.edges_from_rings(geo.simplify_shared(rings, 0.5))
    a, b = (F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2))
    e = e.withColumn("side", F.struct(F.least(a, b), F.greatest(a, b)))
    both = e.groupBy("side").agg(F.count("*").alias("times"))
    return e.join(both, "side").groupBy("unit_id").agg(F.count("*").cast("int").alias("points"), F.count_if(F.col("times") == 2).alias("shared"))
