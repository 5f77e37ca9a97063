"""The same operators on streams (Structured Streaming). The reference has none; these are extensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..plans import runs


def scheduler(history: DataFrame, countries: DataFrame, excluded: DataFrame, order: list[str], launch: Callable[[str, int], None], log: str, checkpoint: str, most: int = 1, every: str = "60 seconds") -> StreamingQuery:
    """A sensor: each micro-batch of run records is appended to ``log`` and the next run is chosen from the
    whole log. ``launch(country, attempt)`` must be idempotent per attempt, as a batch may be replayed."""

    def tick(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")  # the same folder if replayed
        seen = spark.read.parquet(log).drop("batch")
        choice = runs.next_run(countries, runs.states(seen, order), excluded, most).first()  # one row
        if choice and choice[0] is not None:
            launch(choice[0], choice[1])

    return history.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def windowed_counts(events: DataFrame, time: str, width: str, late: str, keys: list[str]) -> DataFrame:
    """Counts per tumbling window and key; rows later than ``late`` are dropped by the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))


_STATE = "run long, open array<bigint>, last bigint"


def run_events(series: DataFrame, key: str, step: str, value: str, threshold: float, length: int = 3, time: str | None = None, idle_ms: int = 0) -> DataFrame:
    """key, step, event: whether each step lies in a run of at least ``length`` values below the threshold, as
    ``series.run_events`` has it of a whole table. A step that is absent breaks no run; a null value does.

    A key's state is the length of its present run and the steps of it that are not decided yet (``length`` - 1 at
    most): they are once the run is long enough or broken. With ``time`` (an event-time column with a watermark) a run
    also ends when no row of the key has come for ``idle_ms`` of event time; without it the last open steps of a key
    wait. Steps of a key must arrive in order; one that isn't later than the last one is left out."""
    kind = series.schema[key].dataType.simpleString()

    def advance(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, waiting, last = state.get if state.exists else (0, [], None)
        waiting, out, latest = list(waiting), [], None
        if state.hasTimedOut:
            out = [(s, False) for s in waiting]
            state.remove()
        else:
            for pdf in batches:
                for s, v in sorted(zip(pdf[step].tolist(), pdf[value].tolist(), strict=True), key=lambda x: x[0]):
                    if last is not None and s <= last:
                        continue
                    last = s
                    if v is not None and v < threshold:  # a NaN is no value
                        run, waiting = run + 1, [*waiting, s]
                        if run >= length:
                            out, waiting = [*out, *((x, True) for x in waiting)], []
                    else:
                        out, waiting, run = [*out, *((x, False) for x in waiting), (s, False)], [], 0
                if time:
                    seen = pdf[time].max()
                    latest = seen if latest is None else max(latest, seen)
            state.update((run, waiting, last))
            if latest is not None:
                state.setTimeoutTimestamp(max(int(latest.timestamp() * 1000) + idle_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [k[0]] * len(out), "step": [int(s) for s, _ in out], "event": [e for _, e in out]}) if out else pd.DataFrame(columns=["key", "step", "event"])

    timer = GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout
    return series.groupBy(key).applyInPandasWithState(advance, f"key {kind}, step long, event boolean", _STATE, "append", timer)
