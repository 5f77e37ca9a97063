"""Cost surfaces and multi-source least-cost distance on 8-connected grids.

A step between neighbours costs the mean of their costs times its length (1 or the square root of 2).
Three forms give the same distances: tiles with a heap in each, which exchange what changed at their borders until
nothing does, for grids of any size; relaxation, one shuffle a round without Python; and a heap per grid id, for
many grids of a bounded size each."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import Workspace, stored

UNREACHABLE = 1e9
#: Cost of a cell without a valid friction.
BARRIER = 1e6
_DIAGONAL = math.sqrt(2.0)


def friction_cost(friction: Column, pixel_m: float = 1.0) -> Column:
    return F.when((friction > 0) & ~F.isnan(friction.cast("double")), friction * F.lit(pixel_m)).otherwise(F.lit(BARRIER))


def at_risk(hazard: Column, threshold: float = 0.3) -> Column:
    return F.coalesce(hazard > F.lit(threshold), F.lit(False))


_STEPS = [(i, j, _DIAGONAL if i and j else 1.0) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]
#: Cells of the box that one heap may hold: two arrays of eight bytes each.
LARGEST = 25_000_000


def _settle(cost: np.ndarray, dist: np.ndarray, own: np.ndarray, begin: list[tuple[int, int]]) -> None:
    """Lowers ``dist`` of ``own`` cells as far as steps from the cells ``begin`` lead; cost is NaN where no cell is."""
    h, w = cost.shape
    heap = [(float(dist[i, j]), i, j) for i, j in begin]
    heapq.heapify(heap)
    while heap:
        d, i, j = heapq.heappop(heap)
        if d > dist[i, j]:
            continue
        for a, b, length in _STEPS:
            x, y = i + a, j + b
            if 0 <= x < h and 0 <= y < w and own[x, y]:
                e = d + (cost[i, j] + cost[x, y]) / 2 * length
                if e < dist[x, y]:
                    dist[x, y] = e
                    heapq.heappush(heap, (e, x, y))


def _boxed(pdf: pd.DataFrame, largest: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    r, c = (pdf[n].to_numpy() - pdf[n].min() for n in ("row", "col"))
    shape = (int(r.max()) + 1, int(c.max()) + 1)
    if shape[0] * shape[1] > largest:
        raise ValueError(f"a grid of {shape[0]} x {shape[1]} cells is too large for one heap: use least_cost")
    return r, c, shape


def least_cost_heap(cells: DataFrame, grid: str = "grid", largest: int = LARGEST) -> DataFrame:
    """grid, row, col, distance from the nearest source. ``cells``: grid, row, col, cost, source. A grid whose
    box has more than ``largest`` cells is an error."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c, shape = _boxed(pdf, largest)
        cost, dist = np.full(shape, np.nan), np.full(shape, np.inf)
        cost[r, c] = pdf["cost"]
        begin = [(int(i), int(j)) for i, j, s in zip(r, c, pdf["source"], strict=True) if s]
        for i, j in begin:
            dist[i, j] = 0.0
        _settle(cost, dist, ~np.isnan(cost), begin)
        out = dist[r, c]
        return pdf[[grid, "row", "col"]].assign(distance=np.where(out >= UNREACHABLE, None, out))

    kind = cells.schema[grid].dataType.simpleString()
    return cells.select(grid, "row", "col", "cost", "source").groupBy(grid).applyInPandas(run, f"{grid} {kind}, row int, col int, distance double")


def _finished(state: DataFrame) -> DataFrame:
    return state.select("row", "col", F.when(F.col("distance") < UNREACHABLE, F.col("distance")).alias("distance"))


def _start(cells: DataFrame) -> DataFrame:
    source = F.coalesce(F.col("source"), F.lit(False))
    return cells.select("row", "col", "cost", F.when(source, F.lit(0.0)).otherwise(F.lit(float("inf"))).alias("distance"), source.alias("changed"))


def least_cost(cells: DataFrame, tile: int = 256, rounds: int = 10_000, written: list[int] | None = None) -> DataFrame:
    """row, col, distance from the nearest source, for a grid of any size. ``cells``: row, col, cost, source.

    Every tile settles its own cells by a heap, starting from its sources; then cells that changed beside a border
    are sent to the neighbouring tiles, and only tiles that got some run again. A task holds one tile. The number of
    rounds is that of borders a path crosses, not of its cells.

    The state is kept in versions: a round reads the tiles that got something and writes those of them that changed,
    and a small table says which version of each tile counts. ``written`` gets the number of tiles of every round. An
    error if ``rounds`` don't suffice. The result is written to the shared folder, all versions go."""
    kinds = "tr long, tc long, row int, col int, cost double, distance double, changed boolean"
    names = ["tr", "tc", "row", "col", "cost", "distance", "changed"]
    place = [F.floor(F.col("row") / tile).alias("tr"), F.floor(F.col("col") / tile).alias("tc")]
    start = _start(cells.select(F.col("row").cast("int"), F.col("col").cast("int"), F.col("cost").cast("double"), "source")).select(*place, "row", "col", "cost", "distance", "changed")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        r, c, shape = _boxed(pdf, 2 * (tile + 2) ** 2)
        cost, dist, own = np.full(shape, np.nan), np.full(shape, np.inf), np.zeros(shape, bool)
        inner = ~pdf["guest"].to_numpy()
        cost[r, c], dist[r, c] = pdf["cost"], pdf["distance"]
        own[r[inner], c[inner]] = True
        begin = pdf["changed"].to_numpy()
        _settle(cost, dist, own, list(zip(r[begin].tolist(), c[begin].tolist(), strict=True)))
        out = pdf[inner]
        new = dist[r[inner], c[inner]]
        changed = (new < out["distance"]) | (out["changed"] & out["first"])
        # a tile without a change isn't written again
        return out.assign(changed=changed, distance=new)[names] if changed.any() or out["first"].any() else out.iloc[:0][names]

    spark = cells.sparkSession
    with Workspace(spark) as work:
        versions, number = f"{work.folder}/versions", 0

        def settle(placed: DataFrame, first: bool) -> DataFrame:
            """Writes the next version: the tiles that changed."""
            nonlocal number
            out = placed.withColumn("first", F.lit(first)).groupBy("tr", "tc").applyInPandas(run, kinds)
            out.write.parquet(f"{versions}/version={number}")
            now = spark.read.schema(kinds).parquet(f"{versions}/version={number}")
            number += 1
            return now

        now = settle(start.withColumn("guest", F.lit(False)), True)
        tips = work.put("tips", now.select("tr", "tc", F.lit(0).alias("version")).distinct())
        for _ in range(rounds):
            if written is not None:
                written.append(now.select("tr", "tc").distinct().count())
            around = F.array_distinct(F.array(*(F.struct(F.floor((F.col("row") + i) / tile).alias("tr"), F.floor((F.col("col") + j) / tile).alias("tc")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
            sent = now.where("changed").select(*names, F.explode(around).alias("to")).where((F.col("to.tr") != F.col("tr")) | (F.col("to.tc") != F.col("tc")))
            guests = work.put("guests", sent.select(F.col("to.tr").alias("tr"), F.col("to.tc").alias("tc"), *names[2:], F.lit(True).alias("guest")))
            hosts = work.put("hosts", guests.select("tr", "tc").distinct().join(tips, ["tr", "tc"]))
            wanted = [r.version for r in hosts.select("version").distinct().collect()]  # a number a round at most
            every = spark.read.schema(f"{kinds}, version int").parquet(versions)
            if not wanted:
                final = every.join(tips, ["tr", "tc", "version"], "left_semi")
                return stored(_finished(final), "distances")
            own = every.where(F.col("version").isin(wanted)).join(hosts, ["tr", "tc", "version"], "left_semi").select(*names[:-1], F.lit(False).alias("changed"), F.lit(False).alias("guest"))
            now = settle(own.unionByName(guests), False)
            fresh = now.select("tr", "tc").distinct().withColumn("new", F.lit(number - 1))
            tips = work.put("tips", tips.join(fresh, ["tr", "tc"], "left").select("tr", "tc", F.coalesce("new", "version").alias("version")))
    raise RuntimeError(f"least-cost distances still change after {rounds} rounds")


def least_cost_relaxed(cells: DataFrame, store, rounds: int = 100_000) -> DataFrame:
    """row, col, distance, by frontier relaxation. ``store`` writes a version of the state and reads it back
    (``sources.Latest``); each round only cells that changed send offers to their neighbours. An error if
    ``rounds`` don't suffice."""
    state = store(_start(cells))
    for _ in range(rounds):
        sent = state.where("changed")
        moves = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(length).alias("len")) for i, j, length in _STEPS))
        offers = sent.select("row", "col", "cost", "distance", F.explode(moves).alias("m")).select((F.col("row") + F.col("m.i")).alias("row"), (F.col("col") + F.col("m.j")).alias("col"), (F.col("distance") + F.col("cost") / 2 * F.col("m.len")).alias("base"), F.col("m.len").alias("len"))
        # the receiver adds its own half: the best straight and the best diagonal offer are enough
        best = offers.groupBy("row", "col").agg(F.min(F.when(F.col("len") == 1.0, F.col("base"))).alias("s"), F.min(F.when(F.col("len") != 1.0, F.col("base"))).alias("d"))
        inf = F.lit(float("inf"))
        new = F.least(F.coalesce(F.col("s") + F.col("cost") / 2, inf), F.coalesce(F.col("d") + F.col("cost") / 2 * _DIAGONAL, inf))
        joined = state.join(best, ["row", "col"], "left").withColumn("new", new)
        state = store(joined.select("row", "col", "cost", F.least("distance", "new").alias("distance"), (F.col("new") < F.col("distance")).alias("changed")))
        if state.where("changed").isEmpty():
            return _finished(state)
    raise RuntimeError(f"least-cost distances still change after {rounds} rounds")


def sample_sources(cells: DataFrame, limit: int = 20_000) -> DataFrame:
    """At most ``limit`` source cells, chosen by a hash of their place: the same on every run."""
    return cells.where("source").orderBy(F.xxhash64("row", "col"), "row", "col").limit(limit)
