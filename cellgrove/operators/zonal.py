"""Zonal statistics: cells grouped by the units their centres lie in.

``cell_zone`` (unit, row, col) is built once per admin level and reused. All measures of one raster stack
come from one aggregation; sums are partial before the shuffle, and units without cells stay (left join
from the units)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rnd
from ..sources import Workspace, stored


def zonal(units: DataFrame, cell_zone: DataFrame, cells: DataFrame, measures: dict[str, Column], unit: str = "unit_id", empty: float | None = 0.0) -> DataFrame:
    """unit and one column per measure (an aggregate over the cells' columns)."""
    sums = cell_zone.join(cells, ["row", "col"]).groupBy(unit).agg(*(m.alias(n) for n, m in measures.items()))
    out = units.select(unit).join(sums, unit, "left")
    return out if empty is None else out.select(unit, *(F.coalesce(n, F.lit(empty)).alias(n) for n in measures))


def class_sums(classes: list[int], values: list[str], class_column: str = "cls", name=lambda v, k: f"{v}_cat{k}") -> dict[str, Column]:
    """Sums of each value over each class, all in one pass."""
    return {name(v, k): F.sum(F.when(F.col(class_column) == k, F.col(v))) for k in classes for v in values}


def share_of_class(classes: list[int], class_column: str, prefix: str) -> dict[str, Column]:
    """Counts and percentages (of all rows; 1 if there are none) of each class."""
    out: dict[str, Column] = {}
    for k in classes:
        n = F.count(F.when(F.col(class_column) == k, 1))
        out[f"{prefix}_count_cat{k}"] = n
        out[f"{prefix}_perc_cat{k}"] = n.cast("double") / F.coalesce(F.nullif(F.count("*"), F.lit(0)), F.lit(1)) * 100
    return out


#: Ranges that a unit's values are counted in, a round.
RANGES = 1024


def exact_median(cells: DataFrame, value: str = "value", unit: str = "unit_id", most: int = 500) -> DataFrame:
    """unit, median: the middle value, or the mean of the two in the middle, of each unit.

    No unit's values are gathered. Each round counts the values between two bounds in ``RANGES`` ranges, with the least
    and greatest value of each, and goes on in the range that holds the middle, until its values are all equal: a few
    rounds, two figures a unit as state. Counts are summed before they are shuffled, so one huge unit is many tasks.
    Nulls and NaN don't count; infinite values count as the largest finite ones; a unit without values has no row."""
    large = 1.7976931348623157e308
    v = F.least(F.greatest(F.col(value).cast("double"), F.lit(-large)), F.lit(large))
    with Workspace(cells.sparkSession) as work:
        values = work.put("values", cells.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(F.col(unit).alias("unit"), v.alias("v")))
        first = values.groupBy("unit").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        # rank: how many values between the bounds come before the wanted one
        state = work.put("state", first.select("unit", F.posexplode(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))).alias("which", "rank"), "low", "high"))
        for _ in range(most):
            open_ = state.where("low < high")
            if open_.isEmpty():
                middle = state.groupBy("unit").agg(F.avg(F.col("low") / 2).alias("half"))
                return stored(middle.select(F.col("unit").alias(unit), (F.col("half") * 2).alias("median")), "medians")
            met = values.join(open_, "unit").where("v between low and high")
            place = F.floor((F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * RANGES)
            counts = met.groupBy("unit", "which", "rank", F.least(place, F.lit(RANGES - 1)).alias("range")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            w = Window.partitionBy("unit", "which").orderBy("range")  # RANGES rows at most
            before = F.sum("n").over(w) - F.col("n")
            inside = counts.withColumn("before", before).where("rank >= before and rank < before + n")
            state = work.put("state", state.where("low = high").unionByName(inside.select("unit", "which", (F.col("rank") - F.col("before")).alias("rank"), "low", "high")))
    raise RuntimeError(f"medians still open after {most} rounds")


def travel_statistics(cells: DataFrame, value: str = "value", unit: str = "unit_id") -> DataFrame:
    """Mean, maximum, median (one digit, half to even) and count; a statistic that is 0 counts as missing."""
    stat = lambda c: F.when(rnd(c, 1) != 0, rnd(c, 1))
    out = cells.groupBy(unit).agg(stat(F.avg(value)).alias("mean"), stat(F.max(value).cast("double")).alias("max"), F.count(value).alias("count"))
    median = exact_median(cells, value, unit).withColumn("median", stat(F.col("median")))
    return out.join(median, unit, "left").select(unit, "mean", "max", "median", "count")
