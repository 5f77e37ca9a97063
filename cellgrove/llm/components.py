"""Connected components of a table of links, by alternating large-star and small-star rounds.

Defined results: null ends and links of a node to itself join nothing (a null end is no node); repeated links
count once; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

#: Links that one task may write.
TASK_ROWS = 200_000


def _minimum(pairs: DataFrame) -> DataFrame:
    """u, v of each pair with m, the smallest of u and its partners."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "least").alias("m"))


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(links: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = store.written) -> DataFrame:
    """``links``: a, b (long). Returns node, component (the smallest node reachable) for linked nodes, stored by
    ``keep``.

    Every round is stored, so lineage stays short, and only the last two rounds are kept; their number grows
    with the logarithm of the longest chain. No node's partners are gathered: minima are aggregated map-side
    and joined back.
    """
    with store.Scratch(links.sparkSession) as tables:
        pairs = tables.put("links", links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and u <> v").distinct())
        before = _state(pairs)
        while before[0]:
            both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = _minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = _minimum(large)
            small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
            pairs = tables.put("links", small.coalesce(-(-2 * before[0] // TASK_ROWS)))
            after = _state(pairs)
            if after == before:
                break
            before = after
        # a star now: every node but the smallest points at the smallest
        star = pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(pairs.select("v", "v").distinct().toDF("node", "component"))
        return keep(star, "components")


def extended(parts: DataFrame, links: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = store.written) -> DataFrame:
    """``parts`` (node, component as ``components`` gives it) after more links (a, b), stored by ``keep``. Only links
    between different components are dealt with, as links of components."""
    end = lambda c: F.coalesce(F.col(f"{c}_parts.component"), c)
    at = links
    for c in ("a", "b"):
        at = at.join(parts.alias(f"{c}_parts"), F.col(c) == F.col(f"{c}_parts.node"), "left")
    between = at.select(end("a").alias("x"), end("b").alias("y")).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    with store.Scratch(links.sparkSession) as tables:
        joined = components(between, lambda df, name: tables.put(name, df))
        return keep(_moved(parts, joined), "components")


def _moved(parts: DataFrame, joined: DataFrame) -> DataFrame:
    ends = joined.select("node", F.col("node").alias("component"))
    moved = joined.select(F.col("node").alias("old"), F.col("component").alias("new"))
    every = parts.select("node", "component").unionAll(ends).distinct()
    return every.join(moved, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
