"""Ordered operators: run events, average ranks, latest states, scheduling, contiguous chunks."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_events(series: DataFrame, keys: list[str], order: str, flag: Column, length: int = 3) -> DataFrame:
    """``series`` with ``event``: the step lies in a run of at least ``length`` flagged consecutive rows.

    By gaps and islands: the running count of unflagged rows names the island, its size decides; one
    shuffle on the keys for any length. A step that is absent breaks no run, as rows are counted."""
    w = Window.partitionBy(*keys).orderBy(order)
    f = F.coalesce(flag, F.lit(False))
    out = series.withColumn("__f", f).withColumn("__island", F.sum(F.when(F.col("__f"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    n = F.sum(F.col("__f").cast("int")).over(Window.partitionBy(*keys, "__island"))
    return out.withColumn("event", F.col("__f") & (n >= length)).drop("__f", "__island")


def centred_run_events(series: DataFrame, keys: list[str], order: str, flag: Column) -> DataFrame:
    """The same for runs of three by a frame of five rows, ends padded with false."""
    w = Window.partitionBy(*keys).orderBy(order)
    f = lambda k: F.coalesce(F.lag("__f", -k).over(w) if k else F.col("__f"), F.lit(False))
    out = series.withColumn("__f", F.coalesce(flag, F.lit(False)))
    event = f(0) & ((f(-2) & f(-1)) | (f(-1) & f(1)) | (f(1) & f(2)))
    return out.withColumn("event", event).drop("__f")


def average_rank(df: DataFrame, value: str, name: str, partition: list[str] | None = None, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with the descending rank of ``value``; ties share their mean rank, null has none.

    Ranks are taken over the distinct values (counted map-side), then joined back: the ordered window sees
    one row per value, not per unit. Without ``partition`` all values are one window, in one task; for many values
    give ``store`` (writes a table and reads it back): values are then dealt by ranges, ranked in each, and moved on
    by the number of rows in the ranges before, one figure a range."""
    keys = partition or []
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    order = F.col(value).desc()
    before = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if store is None or keys:
        w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(order)
        ranks = n.withColumn(name, before(w) + (F.col("__n") + 1) / 2.0)
    else:
        dealt = store(n.repartitionByRange(order).withColumn("__range", F.spark_partition_id()))
        sums = dealt.groupBy("__range").agg(F.sum("__n").alias("__n"))
        moved = sums.select("__range", before(Window.orderBy("__range")).alias("__before"))  # one row a range
        inside = dealt.withColumn("__place", before(Window.partitionBy("__range").orderBy(order)) + (F.col("__n") + 1) / 2.0)
        ranks = inside.join(F.broadcast(moved), "__range").select(value, (F.col("__before") + F.col("__place")).alias(name))
    return df.join(ranks.select(*keys, value, name), [*keys, value], "left")


def latest(history: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """Each key's value at its last row."""
    return history.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def leading_failures(history: DataFrame, key: str, status: str, order: list[str], failure: str = "FAILURE") -> DataFrame:
    """Per key, how many rows from the newest back fail before the first that doesn't: those newer than the
    newest row of another status. Two aggregates, no ordered window."""
    at = F.struct(*order)
    other = F.max(F.when(~F.col(status).eqNullSafe(F.lit(failure)), at))
    last = history.groupBy(key).agg(other.alias("__last"))
    out = history.join(last, key).where(F.col("__last").isNull() | (at > F.col("__last")))
    n = out.groupBy(key).agg(F.count("*").alias("failures"))
    return last.select(key).join(n, key, "left").select(key, F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))


def chunks_under_budget(units: DataFrame, order: str, budget: int, unit: str = "unit_id", most: int = 20_000) -> DataFrame:
    """Consecutive units whose common bounding box has at most ``budget`` cells; a larger unit stands alone.

    Greedy and sequential by nature, so one task reads the list of units (administrative units of one country) in
    order, linear in their number; more than ``most`` of them are an error. Columns: unit, order, x_min, y_min, x_max,
    y_max in whole cells. Returns unit, chunk."""
    if units.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} units in one sequence of chunks: split them by country")
    box = ["x_min", "y_min", "x_max", "y_max"]
    kind = units.schema[unit].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "unit", *box], kind="stable")
        chunk, held, out = 0, None, []
        for x0, y0, x1, y1 in pdf[box].itertuples(index=False):
            grown = (x0, y0, x1, y1) if held is None else (min(held[0], x0), min(held[1], y0), max(held[2], x1), max(held[3], y1))
            if held is not None and (grown[2] - grown[0]) * (grown[3] - grown[1]) > budget:
                chunk, grown = chunk + 1, (x0, y0, x1, y1)
            held = grown
            out.append(chunk)
        return pd.DataFrame({unit: pdf["unit"].to_numpy(object), "chunk": out})

    rows = units.select(F.col(unit).alias("unit"), F.col(order).alias("place"), *(F.col(c).cast("double").alias(c) for c in box), F.lit(1).alias("all"))
    return rows.groupBy("all").applyInPandas(run, f"`{unit}` {kind}, chunk long")
