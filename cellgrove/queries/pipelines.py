"""The composite indicators, the risk score and the scheduler."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import analysis_scale, pixel_km2, rnd
from ..operators import cost, geo
from ..plans import indicators as ind
from ..plans import risk as risk_plan
from ..plans import runs as run_plan
from ..sources import new_path, tabular, tiff
from . import fixtures as fx
from .rasters import land_cover, surface_of, walked

query, FUNCTIONS, SQL = fx.collector()
_L = ind.LISTED
_ALL = [*_L, "dep_dependents", "dep_working"]


def _whole(x: str) -> str:
    return f"CAST(round_even(coalesce({x}, 0), 0) AS BIGINT)"


def _ratio(a: str, b: str, digits: int = 2, empty: str = "0") -> str:
    r = f"round_even(CAST(({a}) AS DOUBLE) / nullif({b}, 0) * 100 * 1e{digits}, 0) / 1e{digits}"
    return f"coalesce({r}, {empty})" if empty else r


_ZP = "zp AS (SELECT unit_id, population.* FROM units LEFT JOIN cell_zone USING (unit_id) LEFT JOIN population USING (row, col))"


@query(
    "c01_demographics",
    f", {_ZP} SELECT unit_id, " + ", ".join(f"{_whole(f'sum({n})')} AS {n}" for n in _L) + f", {_ratio(_whole('sum(dep_dependents)'), _whole('sum(dep_working)'))} AS dependency_ratio FROM zp GROUP BY unit_id",
    "units", "cell_zone", "population",
)
def demographics(s, d):
    return ind.demographics(fx.units(s, d), fx.cell_zone(s, d), fx.population(s, d))


@query("q17_dependents_by_difference", "SELECT row, col, dep_dependents FROM population", "population")
def _(s, d):
    return ind.dependents_by_difference(fx.population(s, d, ("total_pop", "dep_working"))).select("row", "col", "dep_dependents")


@query(
    "c02_rural_population",
    ", zr AS (SELECT unit_id, population.*, code IN (11, 12, 13) AS rural FROM units LEFT JOIN cell_zone USING (unit_id) LEFT JOIN population USING (row, col) LEFT JOIN settlement USING (row, col)), r AS (SELECT unit_id, sum(total_pop) AS total, "
    + ", ".join(f"sum(CASE WHEN rural THEN {n} END) AS {n}" for n in _ALL)
    + " FROM zr GROUP BY unit_id) SELECT unit_id, "
    + ", ".join(f"{_whole(n)} AS {n}_rural" for n in _L)
    + f", {_ratio('dep_dependents', 'dep_working')} AS dependency_ratio_rural, {_ratio('total_pop', 'total')} AS rural_pop_perc FROM r",
    "units", "cell_zone", "population", "settlement",
)
def rural(s, d):
    return ind.rural_population(fx.units(s, d), fx.cell_zone(s, d), fx.population(s, d), fx.settlement(s, d))


@query(
    "c03_rural_access",
    f", near AS (SELECT row, col FROM grid g WHERE EXISTS (SELECT 1 FROM roads WHERE pred_label = 0 AND {fx.DISTANCE_SQL} <= 4e0)), za AS (SELECT unit_id, p.*, n.row IS NOT NULL AS near FROM units LEFT JOIN cell_zone USING (unit_id) LEFT JOIN (SELECT * FROM population JOIN settlement USING (row, col) WHERE code IN (11, 12, 13)) p USING (row, col) LEFT JOIN near n USING (row, col)), a AS (SELECT unit_id, "
    + ", ".join(f"coalesce(sum({n}), 0) AS r_{n}, coalesce(sum(CASE WHEN near THEN {n} END), 0) AS a_{n}" for n in _ALL)
    + " FROM za GROUP BY unit_id) SELECT unit_id, "
    + ", ".join(f"{_whole(f'a_{n}')} AS rural_access_{n}, {_ratio(f'a_{n}', f'r_{n}', 1)} AS RAI_{n}" for n in _L)
    + f", {_ratio('a_dep_dependents', 'a_dep_working', 1, '')} AS rural_access_dependency_ratio FROM a",
    "units", "cell_zone", "population", "settlement", "roads", "grid",
)
def rai(s, d):
    """Two providers with different columns hold the even and the odd roads, a third has none."""
    r = fx.roads(s, d)
    one = r.where("line_id % 2 = 0").drop("line_id")
    other = r.where("line_id % 2 = 1").select(F.when(F.col("pred_label") == 0, "paved").otherwise("unpaved").alias("DL_road_class_2024"), "x1", "y1", "x2", "y2")
    return ind.rural_access(fx.units(s, d), fx.cell_zone(s, d), fx.population(s, d), fx.settlement(s, d), [tabular.optional_union(one, None), other], 2.0)


@query(
    "c04_service_access",
    ", people AS (SELECT row, col, " + " + ".join(_ALL) + " AS people FROM population), za AS (SELECT unit_id, split_part(piece, ':', 2) AS cutoff, people FROM cell_zone JOIN iso_cells USING (row, col) JOIN people USING (row, col)) SELECT unit_id, "
    + ", ".join(f"coalesce(sum(CASE WHEN cutoff = '{k}' THEN people END), 0) AS access_pop_{k}" for k in (3, 6, 12))
    + " FROM units LEFT JOIN za USING (unit_id) GROUP BY unit_id",
    "units", "cell_zone", "population", "iso_cells",
)
def access(s, d):
    iso = geo.cells_in_polygons(fx.grid(s), fx.isochrones(s, d), "piece").withColumn("cutoff", F.split("piece", ":")[1])
    p = fx.population(s, d).withColumn("people", ind.vulnerable_people(None, _ALL))
    return ind.service_access(fx.units(s, d), fx.cell_zone(s, d), p, iso)


@query("c05_facilities", "SELECT unit_id, " + ", ".join(f"count(CASE WHEN category = '{c}' THEN 1 END) AS {c}_count" for c in fx.CATEGORIES) + " FROM units LEFT JOIN facility_zone USING (unit_id) GROUP BY unit_id", "units", "facility_zone")
def facilities(s, d):
    return ind.facility_counts(fx.units(s, d), fx.facility_zone(s, d))


def _flood_sql() -> str:
    ps = fx.RETURN_PERIODS
    wet = ", wet AS (SELECT row, col, " + ", ".join(f"max(CASE WHEN rp = {p} THEN CASE WHEN depth > 0.3e0 THEN 1 ELSE 0 END END) AS w{p}" for p in ps) + " FROM hazard GROUP BY row, col)"
    z = "zf AS (SELECT unit_id, " + ", ".join(f"coalesce(sum(CASE WHEN w{p} = 1 THEN {n} END), 0) AS s{p}_{n}" for p in ps for n in _ALL) + " FROM units LEFT JOIN cell_zone USING (unit_id) LEFT JOIN population USING (row, col) LEFT JOIN wet USING (row, col) GROUP BY unit_id)"
    f = "ff AS (SELECT unit_id, " + ", ".join(f"round_even(avg(CASE WHEN category = '{k}' THEN CASE WHEN w{p} = 1 THEN 1 ELSE 0 END END) * 100 * 10, 0) / 10 AS p{p}_{k}, count(CASE WHEN category = '{k}' AND w{p} = 1 THEN 1 END) AS c{p}_{k}" for p in ps for k in fx.CATEGORIES) + " FROM facility_zone LEFT JOIN wet ON wet.row = floor(y) AND wet.col = floor(x) GROUP BY unit_id)"
    c = "fc AS (SELECT unit_id, count(cell_zone.row) AS area, count(l.row) AS crops, " + ", ".join(f"count(CASE WHEN l.row IS NOT NULL AND w{p} = 1 THEN 1 END) AS k{p}" for p in ps) + " FROM units LEFT JOIN cell_zone USING (unit_id) LEFT JOIN (SELECT row, col FROM land_cover WHERE label = 4) l USING (row, col) LEFT JOIN wet USING (row, col) GROUP BY unit_id)"
    out = []
    for p in ps:
        out += [f"{_whole(f's{p}_{n}')} AS RP{p}_{n}_30cm" for n in _L]
        out.append(f"{_whole(_ratio(f's{p}_dep_dependents', f's{p}_dep_working'))} AS RP{p}_dependency_ratio_30cm")
        for k in fx.CATEGORIES:
            out += [f"{_whole(f'p{p}_{k}')} AS RP{p}_{k}_30cm_pct", f"{_whole(f'c{p}_{k}')} AS RP{p}_{k}_30cm_count"]
        out += [f"CAST(k{p} AS DOUBLE) AS RP{p}_crops_30cm_km2", f"{_ratio(f'k{p}', 'area')} AS RP{p}_crops_30cm_areapct", f"{_ratio(f'k{p}', 'crops')} AS RP{p}_crops_30cm_croppct"]
    return f"{wet}, {z}, {f}, {c} SELECT unit_id, " + ", ".join(out) + " FROM zf LEFT JOIN ff USING (unit_id) LEFT JOIN fc USING (unit_id)"


@query("c06_flood_exposure", _flood_sql(), "units", "cell_zone", "population", "hazard", "facility_zone", "land_cover")
def flood(s, d):
    crops = land_cover(s, d).where("label = 4").select("row", "col")
    return ind.flood_exposure(fx.units(s, d), fx.cell_zone(s, d), fx.population(s, d), fx.hazard(s, d), fx.facility_zone(s, d), fx.RETURN_PERIODS, crops=crops)


def _class_sql(classes: list[int], prefix: str, tag: str) -> str:
    z = "zc AS (SELECT unit_id, " + ", ".join(f"coalesce(sum(CASE WHEN cls = {k} THEN {n} END), 0) AS s{k}_{n}" for k in classes for n in _ALL) + " FROM units LEFT JOIN cell_zone USING (unit_id) LEFT JOIN population USING (row, col) LEFT JOIN classed USING (row, col) GROUP BY unit_id)"
    f = "fk AS (SELECT unit_id, " + ", ".join(f"count(CASE WHEN category = '{c}' AND cls = {k} THEN 1 END) AS n{k}_{c}" for c in fx.CATEGORIES for k in classes) + ", " + ", ".join(f"count(CASE WHEN category = '{c}' THEN 1 END) AS all_{c}" for c in fx.CATEGORIES) + " FROM facility_zone LEFT JOIN classed ON classed.row = floor(y) AND classed.col = floor(x) GROUP BY unit_id)"
    out = []
    for k in classes:
        out += [f"{_whole(f's{k}_{n}')} AS {prefix}_{n}_{tag}{k}" for n in _L]
        out.append(f"{_ratio(f's{k}_dep_dependents', f's{k}_dep_working')} AS {prefix}_dependency_ratio_{tag}{k}")
        for c in fx.CATEGORIES:
            out += [f"coalesce(n{k}_{c}, 0) AS {prefix}_{c}_count_{tag}{k}", f"round_even(CAST(coalesce(n{k}_{c}, 0) AS DOUBLE) / coalesce(nullif(all_{c}, 0), 1) * 100 * 1e2, 0) / 1e2 AS {prefix}_{c}_perc_{tag}{k}"]
    return f"{z}, {f} SELECT unit_id, " + ", ".join(out) + " FROM zc LEFT JOIN fk USING (unit_id)"


_STORM = f""", strong AS (SELECT *, (coalesce(r_se, 0) + coalesce(r_ne, 0) + coalesce(r_nw, 0) + coalesce(r_sw, 0)) * 1e0 / nullif(CAST(r_se IS NOT NULL AS INT) + CAST(r_ne IS NOT NULL AS INT) + CAST(r_nw IS NOT NULL AS INT) + CAST(r_sw IS NOT NULL AS INT), 0) * 0.1e0 AS radius FROM tracks WHERE coalesce(sshs, 0) >= 1),
classed AS (SELECT row, col, CASE max(sshs) WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 3 ELSE 0 END AS cls FROM grid JOIN strong ON {fx.DISTANCE_SQL} <= radius * radius GROUP BY row, col), """


@query("c07_cyclone_exposure", _STORM + _class_sql([1, 2, 3], "kt34", "cat"), "units", "cell_zone", "population", "facility_zone", "grid", "tracks")
def cyclone(s, d):
    classed = ind.storm_cells(fx.grid(s), fx.tracks(s, d), 0.1)
    return ind.class_exposure(fx.units(s, d), fx.cell_zone(s, d), fx.population(s, d), classed, fx.facility_zone(s, d), [1, 2, 3], "kt34", "cat")


_DROUGHT = f""", f AS (SELECT *, cents < {fx.DRY} * n AS dry FROM series), i AS (SELECT *, sum(CASE WHEN dry THEN 0 ELSE 1 END) OVER (PARTITION BY cell ORDER BY step) AS island FROM f),
e AS (SELECT cell, step, dry AND sum(CASE WHEN dry THEN 1 ELSE 0 END) OVER (PARTITION BY cell, island) >= 3 AS event FROM i),
ev AS (SELECT cell, count(CASE WHEN event THEN 1 END) * 6 AS m FROM e GROUP BY cell),
classed AS (SELECT CAST(g.row AS INTEGER) AS row, g.col, max(CASE WHEN m <= 0 THEN 0 WHEN m <= 18 THEN 1 WHEN m <= 36 THEN 2 WHEN m <= 54 THEN 3 ELSE 4 END) AS cls FROM grid g JOIN ev ON (g.row * 3 + g.col // 4) % 97 = ev.cell GROUP BY ALL) """


def _drought(s, d):
    by_cell = ind.drought_cells(fx.series(s, d), ["cell"], "step", F.col("cents") < fx.DRY * F.col("n"), scale=6)
    g = fx.grid(s).withColumn("cell", (F.col("row") * 3 + F.floor(F.col("col") / 4)) % 97)
    return g.join(by_cell, "cell").select("row", "col", "cls")


@query("c08_drought_exposure", _DROUGHT + ", " + _class_sql([1, 2, 3, 4], "spei6", "class"), "units", "cell_zone", "population", "facility_zone", "grid", "series")
def drought(s, d):
    return ind.class_exposure(fx.units(s, d), fx.cell_zone(s, d), fx.population(s, d), _drought(s, d), fx.facility_zone(s, d), [1, 2, 3, 4], "spei6", "class")


_EVACUATION = """ SELECT unit_id, nullif(round_even(avg(m) * 10, 0) / 10, 0) AS RP100_evac_time_minutes_mean, nullif(round_even(max(m) * 10, 0) / 10, 0) AS RP100_evac_time_minutes_max, nullif(round_even(quantile_cont(m, 0.5) * 10, 0) / 10, 0) AS RP100_evac_time_minutes_median
  FROM units LEFT JOIN (SELECT unit_id, CASE WHEN distance < 1e9 THEN distance END / 60 AS m FROM cell_zone JOIN surface USING (row, col) JOIN walk USING (row, col) WHERE risky) USING (unit_id) GROUP BY unit_id"""


@query("c09_evacuability")
def evacuability(s, d):
    """Hazard from a GeoTIFF, read at the size that the analysis scale asks for; cost surface, sources, distances."""
    depth = fx.hazard(s, d).where("rp = 100").select(F.lit("RP100_depth.tif").alias("raster"), "row", "col", F.col("depth").alias("value"))
    folder = new_path(s, "hazard")
    tiff.landed(tiff.geotiffs(depth, (100, 100), 0.0, 0.0, 1.0, 1.0, rows=32, dtype="f8"), folder)
    scale = analysis_scale(100 * 100, 111.0)
    shape = round(100 / scale), round(100 / scale)
    hazard = tiff.reduced(tiff.blocks(s, folder), shape).select("row", "col", F.col("value").alias("depth"))
    cells = surface_of(s, hazard)
    sources = cost.sample_sources(cells).select("row", "col", F.lit(True).alias("chosen"))
    cells = cells.join(sources, ["row", "col"], "left").select("row", "col", "cost", "source", F.coalesce("chosen", F.lit(False)).alias("chosen"))
    starts = cells.select("row", "col", "cost", F.col("chosen").alias("source"))
    minutes = cost.least_cost(starts, tile=64).select("row", "col", (F.col("distance") / 60).alias("distance"))
    return ind.evacuation(fx.units(s, d), fx.cell_zone(s, d), minutes, cells.where("not source"), "RP100", strict=True)


SQL["c09_evacuability"] = walked(_EVACUATION, "units", "cell_zone")


def _merged(*names: str) -> str:
    """Twins that exist, joined on the unit."""
    first, *more = names
    return f"SELECT * FROM ({SQL[first]}) " + " ".join(f"LEFT JOIN ({SQL[n]}) USING (unit_id)" for n in more)


@query("c10_coping")
def coping(s, d):
    return ind.coping(access(s, d), facilities(s, d), evacuability(s, d), rai(s, d))


SQL["c10_coping"] = _merged("c04_service_access", "c05_facilities", "c09_evacuability", "c03_rural_access")


@query("c11_vulnerability")
def vulnerability(s, d):
    return ind.vulnerability(demographics(s, d), rural(s, d))


SQL["c11_vulnerability"] = _merged("c01_demographics", "c02_rural_population")


@query(
    "c12_combined_table",
    "SELECT coalesce(a.unit_id, b.unit_id) AS unit_id, cop_customers AS cop_customers, vul_total AS vul_total FROM (SELECT unit_id, cop_customers FROM indicators WHERE n < 20) a FULL JOIN (SELECT unit_id, count(*) AS vul_total FROM facility_zone GROUP BY unit_id) b ON a.unit_id = b.unit_id",
    "indicators", "facility_zone",
)
def _(s, d):
    c = fx.indicators(s, d).where("n < 20").select("unit_id", F.col("cop_customers").alias("customers"))
    v = fx.facility_zone(s, d).groupBy("unit_id").agg(F.count("*").alias("total"))
    return risk_plan.combined({"coping": c, "vulnerability": v}, "unit_id")


def _norm(c: str) -> str:
    return f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) * 1e0 / (max({c}) OVER () - min({c}) OVER ()) ELSE CAST({c} AS DOUBLE) END"


_COP, _VUL, _EXP = ["cop_customers", "cop_suppliers", "cop_constant"], ["vul_balance", "vul_supplier"], {"flood": ["exp_flo_orders", "exp_flo_price"], "cyclone": ["exp_cyc_open"]}
_FLAT = [*_COP, *_VUL, *(c for cs in _EXP.values() for c in cs)]


def _risk_sql() -> str:
    mean = lambda cs: f"({' + '.join(f'coalesce({c}, 0)' for c in cs)}) / nullif({' + '.join(f'CAST({c} IS NOT NULL AS INT)' for c in cs)}, 0)"
    n = ", n1 AS (SELECT *, " + ", ".join(f"{_norm(c)} AS n_{c}" for c in _FLAT) + " FROM indicators)"
    n += ", n2 AS (SELECT *, (" + " + ".join(f"(1 - coalesce(n_{c}, 0))" for c in _COP) + f") / {len(_COP)} AS cop, (" + " + ".join(f"coalesce(n_{c}, 1)" for c in _VUL) + f") / {len(_VUL)} AS vul FROM n1)"
    n += ", n3 AS (SELECT *, CASE WHEN vul * cop >= 0 THEN sqrt(vul * cop) END AS sus, " + ", ".join(f"{mean([f'n_{c}' for c in cs])} AS exp_{h}" for h, cs in _EXP.items()) + " FROM n2)"
    n += ", n4 AS (SELECT *, " + ", ".join(f"CASE WHEN exp_{h} * sus >= 0 THEN sqrt(exp_{h} * sus) END AS risk_{h}" for h in _EXP) + " FROM n3)"
    r = lambda x: f"round_even({x} * 1e9, 0) / 1e9"
    out = [f"{r('cop')} AS cop", f"{r('vul')} AS vul"]
    for h in _EXP:
        out += [f"{r(f'exp_{h}')} AS exp_{h}", f"{r('sus')} AS sus_{h}", f"{r(f'risk_{h}')} AS risk_{h}", f"CASE WHEN risk_{h} IS NOT NULL THEN rank() OVER (ORDER BY risk_{h} DESC NULLS LAST) + (count(*) OVER (PARTITION BY risk_{h}) - 1) / 2e0 END AS ranking_{h}"]
    return n + " SELECT unit_id, " + ", ".join([*_FLAT, *out]) + " FROM n4"


def _rounded(df):
    return df.select(*(rnd(F.col(c), 9).alias(c) if c in ("cop", "vul") or c.startswith(("risk_", "sus_")) or c in ("exp_flood", "exp_cyclone") else F.col(c) for c in df.columns))


@query("c13_risk_score", _risk_sql(), "indicators")
def risk(s, d):
    return _rounded(risk_plan.risk(fx.indicators(s, d)))


@query("c13_top_units", _risk_sql().replace(" SELECT unit_id, ", " SELECT unit_id, ranking_flood FROM (SELECT unit_id, ", 1).rstrip() + ") WHERE ranking_flood IS NOT NULL ORDER BY ranking_flood, unit_id LIMIT 5", "indicators")
def _(s, d):
    return risk_plan.top(risk_plan.risk(fx.indicators(s, d)), "flood", 5).select("unit_id", "ranking_flood")


_Y = range(2018, 2026)


@query(
    "c14_conflict",
    "SELECT unit_id, " + ", ".join(f"CAST(sum(CASE WHEN year = {y} THEN {c} END) AS BIGINT) AS acled_{n}_{y % 100}" for n, c in (("evts", "events"), ("fatl", "fatalities")) for y in _Y) + ", " + ", ".join(f"CAST(coalesce(sum({c} * pow(2, year - 2018)), 0) AS DOUBLE) AS acled_{n}_w" for n, c in (("evts", "events"), ("fatl", "fatalities"))) + " FROM units LEFT JOIN conflict USING (unit_id) GROUP BY unit_id",
    "units", "conflict",
)
def _(s, d):
    return ind.conflict(fx.units(s, d), fx.conflict(s, d))


_STATES = """, last AS (SELECT country, arg_max(status, event_id) AS last, count(*) AS attempts, bool_or(status IN ('STARTING', 'STARTED', 'QUEUED', 'CANCELING')) AS flying FROM runs GROUP BY country),
fails AS (SELECT country, CAST(sum(CASE WHEN ok = 0 THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM (SELECT country, sum(CASE WHEN status <> 'FAILURE' THEN 1 ELSE 0 END) OVER (PARTITION BY country ORDER BY event_id DESC) AS ok FROM runs) GROUP BY country),
st AS (SELECT *, last = 'SUCCESS' AS succeeded, failures >= 3 AS skipped FROM last JOIN fails USING (country))"""


@query("c15_run_states", _STATES + " SELECT country, last, attempts, flying, failures, succeeded, skipped FROM st", "runs")
def _(s, d):
    return run_plan.states(fx.runs(s, d), ["created", "event_id"])


@query(
    "c15_next_run",
    _STATES + ", j AS (SELECT country, row_number() OVER (ORDER BY CAST(substr(country, 2) AS BIGINT)) AS pos, attempts, succeeded, skipped, flying, country IN ('C0', 'C1', 'C7') AS gone FROM st) SELECT first(country) AS country, CAST(first(attempts) + 1 AS BIGINT) AS attempt, CAST((SELECT count(*) FROM j WHERE NOT gone AND NOT succeeded AND NOT skipped) AS BIGINT) AS pending, CAST((SELECT count(*) FROM j WHERE skipped) AS BIGINT) AS skipped, CAST((SELECT count(*) FROM j WHERE flying) AS BIGINT) AS in_flight FROM (SELECT * FROM j WHERE NOT gone AND NOT succeeded AND NOT skipped ORDER BY pos LIMIT 1)",
    "runs",
)
def _(s, d):
    h = fx.runs(s, d)
    countries = h.select("country").distinct().withColumn("pos", F.substring("country", 2, 9).cast("long"))
    excluded = s.createDataFrame([("C0",), ("C1",), ("C7",)], "country string")
    return run_plan.next_run(countries, run_plan.states(h, ["created", "event_id"]), excluded, most=10**6)


@query(
    "c16_drought_crops",
    _DROUGHT + ", zc AS (SELECT unit_id, cls FROM cell_zone JOIN classed USING (row, col) JOIN (SELECT row, col FROM land_cover WHERE label = 4) USING (row, col)) SELECT unit_id, " + ", ".join(f"round_even(count(CASE WHEN cls = {k} THEN 1 END) * 1.25e0 * 1e2, 0) / 1e2 AS crops_class{k}_km2" for k in (1, 2, 3, 4)) + " FROM units LEFT JOIN zc USING (unit_id) GROUP BY unit_id",
    "units", "cell_zone", "grid", "series", "land_cover",
)
def _(s, d):
    crops = land_cover(s, d).where("label = 4")
    return ind.drought_crops(fx.units(s, d), fx.cell_zone(s, d), _drought(s, d), crops, 1.25, [1, 2, 3, 4])


_COUNTRY = ", middle AS (SELECT sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS lat FROM edges WHERE ring = 0)"


@query(
    "c16_drought_crops_by_latitude",
    _DROUGHT + _COUNTRY + ", zc AS (SELECT unit_id, cls FROM cell_zone JOIN classed USING (row, col) JOIN (SELECT row, col FROM land_cover WHERE label = 4) USING (row, col)) SELECT unit_id, " + ", ".join(f"round_even(count(CASE WHEN cls = {k} THEN 1 END) * 0.5e0 * any_value(0.25e0 * 111.32e0 * cos(radians(lat)) * 0.25e0 * 111.32e0) * 1e2, 0) / 1e2 AS crops_class{k}_km2" for k in (1, 2, 3, 4)) + " FROM units LEFT JOIN zc USING (unit_id), middle GROUP BY unit_id",
    "units", "cell_zone", "grid", "series", "land_cover", "edges",
)
def _(s, d):
    """Half of each crop cell, cells of a quarter degree, at the latitude of all units' common centroid."""
    crops = land_cover(s, d).where("label = 4").withColumn("share", F.lit(0.5))
    middle = geo.area_and_centroid(fx.edges(s, d).where("ring = 0").withColumn("country", F.lit(1)).withColumn("ring", F.col("unit_id")), "country").select(F.col("cy").alias("lat"))
    u = fx.units(s, d).join(F.broadcast(middle))  # one row
    return ind.drought_crops(u, fx.cell_zone(s, d), _drought(s, d), crops, pixel_km2(F.col("lat"), 0.25, 0.25), [1, 2, 3, 4])
