"""Which country to run next, from the run history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import series

IN_FLIGHT = ("STARTING", "STARTED", "QUEUED", "CANCELING")


def states(history: DataFrame, order: list[str], key: str = "country", status: str = "status", give_up: int = 3) -> DataFrame:
    """key, last status, attempts, leading failures, succeeded (the last run did), skipped (the last
    ``give_up`` runs failed), flying (some run is in progress)."""
    at = F.struct(*order)
    h = history.groupBy(key).agg(F.max_by(status, at).alias("last"), F.count("*").alias("attempts"), F.bool_or(F.col(status).isin(*IN_FLIGHT)).alias("flying"))
    f = series.leading_failures(history, key, status, order)
    return h.join(f, key).withColumns({"succeeded": F.col("last") == "SUCCESS", "skipped": F.col("failures") >= give_up})


def next_run(countries: DataFrame, states: DataFrame, excluded: DataFrame, most: int = 1, key: str = "country") -> DataFrame:
    """One row: the next country (first pending in configured order, else first skipped), its attempt number,
    the numbers pending, skipped and in flight; country is null when nothing is left or ``most`` runs are in
    flight. ``countries``: key and pos; ``excluded``: key."""
    rows = countries.join(states, key, "left").join(excluded.select(key, F.lit(True).alias("out")), key, "left")
    kept = F.col("out").isNull()
    done, skip, flying = (F.coalesce(c, F.lit(False)) for c in ("succeeded", "skipped", "flying"))
    choice = lambda cond: F.min(F.when(cond, F.struct("pos", key, (F.coalesce("attempts", F.lit(0)) + 1).alias("attempt"))))
    one = rows.agg(
        choice(kept & ~done & ~skip).alias("a"),
        choice(kept & skip).alias("b"),
        F.count(F.when(kept & ~done & ~skip, 1)).alias("pending"),
        F.count(F.when(skip, 1)).alias("skipped"),
        F.count(F.when(flying, 1)).alias("in_flight"),
    )
    pick = F.when(F.col("in_flight") < most, F.coalesce("a", "b"))
    return one.select(pick.getField(key).alias(key), pick.getField("attempt").alias("attempt"), "pending", "skipped", "in_flight")
