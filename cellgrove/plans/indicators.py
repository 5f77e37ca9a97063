"""Indicators per admin unit. Each function is one lazy plan: units and a cell_zone table (unit, row, col)
on one side, cell, point or event tables on the other. Return periods, classes and population indicators
are columns of one aggregation, never loops over rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import drought_class, exceeds, ratio, rnd, settlement_class, storm_class, whole
from ..operators import geo, grid, series, table, zonal

#: Population indicators that outputs list, besides the two that only make the dependency ratio.
LISTED = ["total_pop", "female_pop", "children_u5", "female_u5", "elderly", "pop_u15", "female_u15", "wra_pop"]
DEPENDENTS, WORKING = "dep_dependents", "dep_working"
CATEGORIES = ["education", "hospitals", "primary_healthcare"]


def demographics(units: DataFrame, cell_zone: DataFrame, population: DataFrame, unit: str = "unit_id", block: int | None = None) -> DataFrame:
    """Rounded sums of every population indicator and the dependency ratio of the rounded numbers (0 if
    nobody is of working age). ``block``: sum s x s cells first; ``cell_zone`` must then be of that grid."""
    names = [*LISTED, DEPENDENTS, WORKING]
    if block:
        population = population.groupBy(F.floor(F.col("row") / block).cast("int").alias("row"), F.floor(F.col("col") / block).cast("int").alias("col")).agg(*(F.sum(n).alias(n) for n in names))
    z = zonal.zonal(units, cell_zone, population, {n: F.sum(n) for n in names}, unit)
    z = z.select(unit, *(whole(F.col(n)).alias(n) for n in names))
    return z.select(unit, *LISTED, ratio(F.col(DEPENDENTS), F.col(WORKING)).alias("dependency_ratio"))


def dependents_by_difference(population: DataFrame) -> DataFrame:
    """Dependents as total minus working age, at least 0: equal to their own sum, as ages part the total."""
    return population.withColumn(DEPENDENTS, F.greatest(F.col("total_pop") - F.col(WORKING), F.lit(0.0)))


def rural_population(units: DataFrame, cell_zone: DataFrame, population: DataFrame, settlement: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Indicators over rural cells, their dependency ratio (of unrounded sums), and the rural share."""
    rural = settlement.select("row", "col", (settlement_class(F.col("code")) == 1).alias("rural"))
    cells = population.join(rural, ["row", "col"], "left")
    names = [*LISTED, DEPENDENTS, WORKING]
    z = zonal.zonal(units, cell_zone, cells, {**{f"{n}_rural": F.sum(F.when(F.col("rural"), F.col(n))) for n in names}, "total": F.sum("total_pop")}, unit)
    return z.select(
        unit,
        *(whole(F.col(f"{n}_rural")).alias(f"{n}_rural") for n in LISTED),
        ratio(F.col(f"{DEPENDENTS}_rural"), F.col(f"{WORKING}_rural")).alias("dependency_ratio_rural"),
        ratio(F.col("total_pop_rural"), F.col("total")).alias("rural_pop_perc"),
    )


def rural_access(units: DataFrame, cell_zone: DataFrame, population: DataFrame, settlement: DataFrame, roads: list[DataFrame], radius: float, unit: str = "unit_id") -> DataFrame:
    """Rural people within ``radius`` of a paved road, and their share of all rural people (one digit).

    Road sources may differ in columns; each is filtered by the paved flag it has. A cell near several roads
    counts once."""
    paved = [table.filter_if_present(table.filter_if_present(r, "pred_label", lambda c: c == 0), "DL_road_class_2024", lambda c: c == "paved") for r in roads]
    lines = table.union_ragged(*paved).select("x1", "y1", "x2", "y2")
    rural = settlement.where(settlement_class(F.col("code")) == 1).select("row", "col")
    cells = population.join(rural, ["row", "col"], "left_semi")
    centres = rural.withColumns({"x": F.col("col") + 0.5, "y": F.col("row") + 0.5})
    near = geo.near_any(centres, lines, radius).select("row", "col", F.lit(True).alias("near"))
    names = [*LISTED, DEPENDENTS, WORKING]
    inside = F.coalesce(F.col("near"), F.lit(False))
    z = zonal.zonal(units, cell_zone, cells.join(near, ["row", "col"], "left"), {**{f"rural_{n}": F.sum(n) for n in names}, **{f"rural_access_{n}": F.sum(F.when(inside, F.col(n))) for n in names}}, unit)
    share = lambda n: ratio(F.col(f"rural_access_{n}"), F.col(f"rural_{n}"), digits=1).alias(f"RAI_{n}")
    return z.select(
        unit,
        *(whole(F.col(f"rural_access_{n}")).alias(f"rural_access_{n}") for n in LISTED),
        *(share(n) for n in LISTED),
        ratio(F.col(f"rural_access_{DEPENDENTS}"), F.col(f"rural_access_{WORKING}"), digits=1, empty=None).alias("rural_access_dependency_ratio"),
    )


def service_access(units: DataFrame, cell_zone: DataFrame, people: DataFrame, pieces: DataFrame, value: str = "people", unit: str = "unit_id") -> DataFrame:
    """Sum of ``people`` over isochrone pieces by cutoff (columns access_pop_<cutoff>). Pieces of one cutoff
    aren't dissolved: a cell in two of them counts twice. ``pieces``: piece, cutoff, row, col."""
    cutoffs = [r.cutoff for r in pieces.select("cutoff").distinct().orderBy("cutoff").collect()]
    cells = pieces.join(people.select("row", "col", value), ["row", "col"])
    return zonal.zonal(units, cell_zone, cells, {f"access_pop_{c}": F.sum(F.when(F.col("cutoff") == c, F.col(value))) for c in cutoffs}, unit)


def vulnerable_people(population: DataFrame, names: list[str]) -> Column:
    """The sum of (overlapping) indicators of a cell: a person counts once for each they belong to."""
    return sum((F.col(n) for n in names), F.lit(0.0))


def facility_counts(units: DataFrame, placed: DataFrame, unit: str = "unit_id", categories: list[str] | None = None) -> DataFrame:
    """Facilities of each category per unit. ``placed``: category and unit of each facility."""
    c = categories or CATEGORIES
    n = placed.groupBy(unit).agg(*(F.count(F.when(F.col("category") == k, 1)).alias(f"{k}_count") for k in c))
    return units.select(unit).join(n, unit, "left").select(unit, *(F.coalesce(f"{k}_count", F.lit(0)).alias(f"{k}_count") for k in c))


def flood_exposure(units: DataFrame, cell_zone: DataFrame, population: DataFrame, hazard: DataFrame, placed: DataFrame, periods: list[int], threshold: float = 0.3, crops: DataFrame | None = None, unit: str = "unit_id") -> DataFrame:
    """People, facilities and crops on cells whose depth is above the threshold, for all return periods.

    ``hazard``: rp, row, col, depth. ``placed``: facilities with unit, x, y. The ratio is rounded to two
    digits and then, with all figures but those of crops, to a whole number."""
    names = [*LISTED, DEPENDENTS, WORKING]
    wet = hazard.groupBy("row", "col").agg(*(F.max(F.when(F.col("rp") == p, exceeds(F.col("depth"), threshold))).alias(f"wet{p}") for p in periods))
    cells = population.join(wet, ["row", "col"], "left")
    is_wet = lambda p: F.coalesce(F.col(f"wet{p}"), F.lit(0)) == 1
    z = zonal.zonal(units, cell_zone, cells, {f"RP{p}_{n}": F.sum(F.when(is_wet(p), F.col(n))) for p in periods for n in names}, unit)
    at = grid.sample(placed, wet.withColumn("value", F.lit(1)), value="value").drop("value").join(wet, ["row", "col"], "left")
    share = at.groupBy(unit).agg(*(f for p in periods for k in CATEGORIES for f in (rnd(F.avg(F.when(F.col("category") == k, is_wet(p).cast("int"))) * 100, 1).alias(f"RP{p}_{k}_pct"), F.sum(F.when((F.col("category") == k) & is_wet(p), 1).otherwise(0)).alias(f"RP{p}_{k}_count"))))
    out = z.join(share, unit, "left")
    columns = []
    for p in periods:
        columns += [whole(F.col(f"RP{p}_{n}")).alias(f"RP{p}_{n}_30cm") for n in LISTED]
        columns.append(whole(ratio(F.col(f"RP{p}_{DEPENDENTS}"), F.col(f"RP{p}_{WORKING}"))).alias(f"RP{p}_dependency_ratio_30cm"))
        for k in CATEGORIES:
            columns += [whole(F.col(f"RP{p}_{k}_pct")).alias(f"RP{p}_{k}_30cm_pct"), whole(F.col(f"RP{p}_{k}_count")).alias(f"RP{p}_{k}_30cm_count")]
    out = out.select(unit, *columns)
    return out if crops is None else out.join(flooded_crops(units, cell_zone, crops, wet, periods, unit), unit)


def flooded_crops(units: DataFrame, cell_zone: DataFrame, crops: DataFrame, wet: DataFrame, periods: list[int], unit: str = "unit_id", cell_km2: float = 1.0) -> DataFrame:
    """Flooded crop area, its share of the unit's area and of the unit's crop area. ``crops``: row, col of
    cells whose most frequent land cover is crops; ``wet``: row, col, wet<rp>."""
    cells = grid_of(cell_zone).join(crops.select("row", "col", F.lit(1).alias("crop")), ["row", "col"], "left").join(wet, ["row", "col"], "left")
    crop = F.coalesce(F.col("crop"), F.lit(0))
    sums = {"area": F.count("*").cast("double"), "crops": F.sum(crop).cast("double"), **{f"wet{p}": F.sum(crop * F.coalesce(F.col(f"wet{p}"), F.lit(0))).cast("double") for p in periods}}
    z = zonal.zonal(units, cell_zone, cells, sums, unit)
    out = []
    for p in periods:
        out += [rnd(F.col(f"wet{p}") * cell_km2, 2).alias(f"RP{p}_crops_30cm_km2"), ratio(F.col(f"wet{p}"), F.col("area")).alias(f"RP{p}_crops_30cm_areapct"), ratio(F.col(f"wet{p}"), F.col("crops")).alias(f"RP{p}_crops_30cm_croppct")]
    return z.select(unit, *out)


def grid_of(cell_zone: DataFrame) -> DataFrame:
    return cell_zone.select("row", "col").distinct()


def class_exposure(units: DataFrame, cell_zone: DataFrame, population: DataFrame, classed: DataFrame, placed: DataFrame, classes: list[int], prefix: str, tag: str, unit: str = "unit_id") -> DataFrame:
    """People and facilities by class of the cell they are on. ``classed``: row, col, cls.

    Sums are whole numbers; each class's dependency ratio has two digits; facility shares (of all facilities
    of the category in the unit, 1 if there are none) too."""
    names = [*LISTED, DEPENDENTS, WORKING]
    cells = population.join(classed.select("row", "col", "cls"), ["row", "col"], "left")
    z = zonal.zonal(units, cell_zone, cells, {f"{n}_{k}": F.sum(F.when(F.col("cls") == k, F.col(n))) for k in classes for n in names}, unit)
    at = grid.sample(placed, classed.select("row", "col", F.col("cls").alias("value")))
    share = at.groupBy(unit).agg(*(f for c in CATEGORIES for k in classes for f in (F.count(F.when((F.col("category") == c) & (F.col("value") == k), 1)).alias(f"n_{c}_{k}"),)), *(F.count(F.when(F.col("category") == c, 1)).alias(f"all_{c}") for c in CATEGORIES))
    out = z.join(share, unit, "left")
    columns: list[Column] = []
    for k in classes:
        columns += [whole(F.col(f"{n}_{k}")).alias(f"{prefix}_{n}_{tag}{k}") for n in LISTED]
        columns.append(ratio(F.col(f"{DEPENDENTS}_{k}"), F.col(f"{WORKING}_{k}")).alias(f"{prefix}_dependency_ratio_{tag}{k}"))
        for c in CATEGORIES:
            n, total = F.coalesce(f"n_{c}_{k}", F.lit(0)), F.coalesce(F.nullif(F.col(f"all_{c}"), F.lit(0)), F.lit(1))
            columns += [n.alias(f"{prefix}_{c}_count_{tag}{k}"), rnd(n.cast("double") / total.cast("double") * 100.0, 2).alias(f"{prefix}_{c}_perc_{tag}{k}")]
    return out.select(unit, *columns)


def storm_cells(cells: DataFrame, tracks: DataFrame, metres_per_radius: float = 1.0, least: int = 1, x: Column | None = None, y: Column | None = None) -> DataFrame:
    """row, col, cls of cells within the mean wind radius of a track; the strongest track of a cell decides.

    Tracks without a category, or below ``least``, and tracks without any radius are left out."""
    r = ["r_se", "r_ne", "r_nw", "r_sw"]
    n = sum((F.col(c).isNotNull().cast("int") for c in r), F.lit(0))
    mean = sum((F.coalesce(F.col(c), F.lit(0)) for c in r), F.lit(0)).cast("double") / F.nullif(n, F.lit(0))
    strong = tracks.where(F.coalesce(F.col("sshs"), F.lit(0)) >= least).withColumn("radius", mean * metres_per_radius).where("radius is not null")
    centres = cells.select("row", "col").withColumns({"x": F.col("col") + 0.5 if x is None else x, "y": F.col("row") + 0.5 if y is None else y})
    met = geo.within_distance(centres, geo.by_shape(strong, "radius", sshs=F.max("sshs")), F.col("radius"))
    return met.groupBy("row", "col").agg(F.max("sshs").alias("sshs")).select("row", "col", storm_class(F.col("sshs")).alias("cls"))


def drought_cells(months: DataFrame, keys: list[str], order: str, dry: Column, bounds: tuple[int, int, int] = (18, 36, 54), scale: int = 1) -> DataFrame:
    """keys and cls: how many steps lie in runs of at least three dry ones, as a class."""
    events = series.run_events(months, keys, order, dry)
    n = events.groupBy(*keys).agg(F.sum(F.col("event").cast("int")).alias("event_months"))
    return n.select(*keys, "event_months", drought_class(F.col("event_months") * scale, bounds).alias("cls"))


def drought_crops(units: DataFrame, cell_zone: DataFrame, classed: DataFrame, crops: DataFrame, cell_km2: Column | float, classes: list[int], unit: str = "unit_id") -> DataFrame:
    """Crop area by drought class. ``crops``: row, col and, if only parts of cells are crops, share. ``cell_km2``: the
    area of a cell, as a number or a column over ``units`` (see ``functions.pixel_km2``)."""
    part = F.col("share") if "share" in crops.columns else F.lit(1.0)
    cells = classed.join(crops.select("row", "col", part.cast("double").alias("share")), ["row", "col"])
    z = zonal.zonal(units, cell_zone, cells, {f"class{k}": F.sum(F.when(F.col("cls") == k, F.col("share"))) for k in classes}, unit)
    area = cell_km2 if isinstance(cell_km2, Column) else F.lit(float(cell_km2))
    own = units.select(unit, area.alias("__km2"))
    return z.join(own, unit).select(unit, *(rnd(F.col(f"class{k}") * F.col("__km2"), 2).alias(f"crops_class{k}_km2") for k in classes))


def evacuation(units: DataFrame, cell_zone: DataFrame, minutes: DataFrame, risky: DataFrame, prefix: str, unit: str = "unit_id", strict: bool = False) -> DataFrame:
    """Mean, maximum and median travel time to safety over cells at risk. ``minutes``: row, col, distance;
    ``risky``: row, col. Units without such cells have nulls; ``strict`` fails if all have."""
    cells = minutes.join(risky.select("row", "col"), ["row", "col"], "left_semi").join(cell_zone, ["row", "col"])
    s = zonal.travel_statistics(cells, "distance", unit)
    out = units.select(unit).join(s, unit, "left").select(unit, *(F.col(n).alias(f"{prefix}_evac_time_minutes_{n}") for n in ("mean", "max", "median")))
    return table.require_values(out, f"{prefix}_evac_time_minutes_mean") if strict else out


def coping(access: DataFrame, facilities: DataFrame, evacuability: DataFrame, rai: DataFrame, unit: str = "unit_id") -> DataFrame:
    return table.left_merge(access, facilities, evacuability, rai, on=unit)


def vulnerability(demographics: DataFrame, rural: DataFrame, unit: str = "unit_id") -> DataFrame:
    return table.left_merge(demographics, rural, on=unit)


def conflict(units: DataFrame, events: DataFrame, years: range = range(2018, 2026), unit: str = "unit_id") -> DataFrame:
    """Events and deaths by year, and their sums weighted by 2^(years since the first). Rows of other units
    or years, and years that aren't numbers, are left out; a year without rows is null, all columns exist."""
    y = events.withColumn("year", F.col("year").try_cast("int")).where(F.col("year").between(years[0], years[-1])).join(units.select(unit), unit, "left_semi")
    wide = table.yearly_pivot(y, unit, "year", years, {"acled_evts": "events", "acled_fatl": "fatalities"})
    out = units.select(unit).join(wide, unit, "left")
    return out.withColumns({f"{p}_w": table.weighted_years(out, p, years) for p in ("acled_evts", "acled_fatl")})
