"""Indicator-table algebra: keys, names, nulls, joins and level fallback.

Schemas are inspected on the driver (``df.columns``) and turned into static projections."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ---- keys and names


def key_column(columns: list[str], level: int) -> str | None:
    """The column that holds the place code of a level: ``ADM<n>_PCODE`` in any case; else one that holds
    the digit and 'cod' or 'id'; else any with 'pcode'."""
    exact = [c for c in columns if c.upper() == f"ADM{level}_PCODE"]
    loose = [c for c in columns if str(level) in c and ("cod" in c.lower() or "id" in c.lower())]
    pcode = [c for c in columns if "pcode" in c.lower()]
    return next(iter([*exact, *loose, *pcode]), None)


def with_key(df: DataFrame, level: int) -> DataFrame:
    """``df`` with its place-code column named ADM<level>_PCODE."""
    found = key_column(df.columns, level)
    if found is None:
        raise ValueError(f"no place code of level {level} among {df.columns}")
    return df.withColumnRenamed(found, f"ADM{level}_PCODE")


def with_plain_key(df: DataFrame, level: int) -> DataFrame:
    """A copy of the key as ADM_PCODE, next to it."""
    own = f"ADM{level}_PCODE"
    rest = [c for c in df.columns if c not in (own, "ADM_PCODE")]
    return df.select(own, F.col(own).alias("ADM_PCODE"), *rest)


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def prefix_names(df: DataFrame, prefix: str, keep: str = "ADM") -> DataFrame:
    """All columns that don't start with ``keep`` get the prefix."""
    return df.select(*(F.col(c) if c.startswith(keep) else F.col(c).alias(prefix + c) for c in df.columns))


def collapse_suffixes(df: DataFrame) -> DataFrame:
    """Each pair ``c_x``, ``c_y`` that a merge left becomes ``c`` (x, or y where x is null), at the end."""
    bases = [c[:-2] for c in df.columns if c.endswith("_x") and c[:-2] + "_y" in df.columns]
    gone = {b + s for b in bases for s in ("_x", "_y")} | set(bases)
    return df.select(*(c for c in df.columns if c not in gone), *(F.coalesce(F.col(b + "_x"), F.col(b + "_y")).alias(b) for b in bases))


def ordered(df: DataFrame, order: list[str]) -> DataFrame:
    """The columns of ``order`` that exist, in that order."""
    return df.select(*(c for c in order if c in df.columns))


def filter_if_present(df: DataFrame, column: str, condition) -> DataFrame:
    """Filter on a column that only some sources have."""
    return df.where(condition(F.col(column))) if column in df.columns else df


def value_column(df: DataFrame, candidates: tuple[str, ...] = ("value", "range", "cost", "distance", "time")) -> str:
    """The value field of isochrones: a known name (any case), else the first numeric column."""
    lower = {c.lower(): c for c in df.columns}
    for c in candidates:
        if c in lower:
            return lower[c]
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "float", "double", "short", "byte")]
    if not numeric:
        raise ValueError("no numeric column")
    return numeric[0]


def require_values(df: DataFrame, column: str) -> DataFrame:
    """``df``, failing at run time if the column has no value at all (one extra aggregate, no collect)."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    some = df.agg(F.assert_true(F.count(column) > 0, F.lit(f"{column} has no value")).alias("__ok"))
    # one row; the filter keeps the check from being pruned away
    return df.crossJoin(F.broadcast(some)).where(F.col("__ok").isNull()).drop("__ok")


# ---- tags


def tag_is(column: Column, *values: str) -> Column:
    return F.coalesce(column.isin(*values), F.lit(False))


def tag_is_not(column: Column, value: str) -> Column:
    """True where the tag is absent too: NULL <> 'x' would drop the row."""
    return ~column.eqNullSafe(F.lit(value))


def tag_matches(column: Column, pattern: str) -> Column:
    return F.coalesce(column.rlike(pattern), F.lit(False))


# ---- joins


def left_merge(first: DataFrame, *others: DataFrame, on: str) -> DataFrame:
    """Left equi-joins on one key; columns that both sides have collapse to the first value that isn't null."""
    out = first
    for other in others:
        both = [c for c in other.columns if c in out.columns and c != on]
        x = out.select(*(F.col(c).alias(c + "_x") if c in both else F.col(c) for c in out.columns))
        y = other.select(*(F.col(c).alias(c + "_y") if c in both else F.col(c) for c in other.columns))
        out = collapse_suffixes(x.join(y, on, "left"))
    return out


def outer_merge(sources: dict[str, DataFrame], on: str) -> DataFrame:
    """Full outer equi-joins on one key; a column that exists already gets ``_<source>``."""
    out: DataFrame | None = None
    for name, df in sources.items():
        if on not in df.columns:
            if "ADM_PCODE" not in df.columns:
                continue
            df = df.withColumnRenamed("ADM_PCODE", on)
        elif "ADM_PCODE" in df.columns and on != "ADM_PCODE":
            df = df.drop("ADM_PCODE")
        if out is None:
            out = df
        else:
            df = df.select(*(F.col(c).alias(f"{c}_{name}") if c != on and c in out.columns else F.col(c) for c in df.columns))
            out = out.join(df, on, "full")
    if out is None:
        raise ValueError(f"no source has {on}")
    return out


def map_join(df: DataFrame, values: DataFrame, on: str, value: str, empty=0) -> DataFrame:
    """A dictionary look-up: ``value`` by key, ``empty`` where there is none."""
    return df.join(values.select(on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(empty)))


def update_join(df: DataFrame, new: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Values of ``new`` over those of ``df``, by key."""
    n = new.select(on, *(F.col(c).alias(f"__{c}") for c in columns))
    out = df.join(n, on, "left")
    return out.select(*(F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def union_ragged(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that one lacks are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def best_level(rows: DataFrame, keys: list[str], level: str, requested: int) -> DataFrame:
    """Of each key the rows of its deepest level not below the one requested."""
    w = Window.partitionBy(*keys)
    ok = rows.where(F.col(level) <= requested)
    return ok.withColumn("__best", F.max(level).over(w)).where(F.col(level) == F.col("__best")).drop("__best")


def country_code2(df: DataFrame, lookup: DataFrame, iso3: str = "iso3") -> DataFrame:
    """ISO 2 code by look-up, else the first two letters."""
    return df.join(F.broadcast(lookup.select(F.col("iso3").alias("__3"), F.col("iso2"))), F.col(iso3) == F.col("__3"), "left").withColumn("iso2", F.coalesce("iso2", F.substring(iso3, 1, 2))).drop("__3")


# ---- aggregation helpers


def min_max(df: DataFrame, columns: list[str], partition: list[str] | None = None) -> DataFrame:
    """(x - min) / (max - min); unchanged where a column is constant or all null. One aggregate, joined
    back: on the partition's key, or as a single row."""
    ends = [f(c).cast("double").alias(f"__{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    out = df.join(df.groupBy(*partition).agg(*ends), partition) if partition else df.crossJoin(F.broadcast(df.agg(*ends)))

    def scaled(c: str) -> Column:
        lo, hi = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        return F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.col(c).cast("double")).alias(c)

    return out.select(*(scaled(c) if c in columns else F.col(c) for c in df.columns))


def yearly_pivot(events: DataFrame, key: str, year: str, years: range, sums: dict[str, str], suffix=lambda y: str(y)[2:]) -> DataFrame:
    """One column per year and measure; years without rows stay null."""
    return events.groupBy(key).agg(*(F.sum(F.when(F.col(year) == y, F.col(c))).alias(f"{name}_{suffix(y)}") for name, c in sums.items() for y in years))


def weighted_years(df: DataFrame, prefix: str, years: range, suffix=lambda y: str(y)[2:]) -> Column:
    """Sum over years of 2^(year - first) times the year's value, null as 0."""
    return sum((F.coalesce(F.col(f"{prefix}_{suffix(y)}"), F.lit(0)).cast("double") * float(2**k) for k, y in enumerate(years)), F.lit(0.0))


def tile_bounds(name: Column) -> dict[str, Column]:
    """Bounds of a ten-degree tile from its file name (N|S)<lat>_(E|W)<lon>."""
    pattern = r"([NS])(\d+)_([EW])(\d+)"
    part = lambda i: F.regexp_extract(name, pattern, i)
    lat = F.when(part(1) == "S", -1).otherwise(1) * part(2).try_cast("int")
    lon = F.when(part(3) == "W", -1).otherwise(1) * part(4).try_cast("int")
    return {"west": lon, "south": lat - 10, "east": lon + 10, "north": lat}


def safe_name(text: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", text)
