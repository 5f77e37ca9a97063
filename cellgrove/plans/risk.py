"""The combined table and the risk score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometric_mean, row_mean
from ..operators import series, table
from ..sources import stored

PREFIXES = {"coping": "cop_", "vulnerability": "vul_", "flood": "exp_flo_", "cyclone": "exp_cyc_", "drought": "exp_dro_"}
HAZARDS = {"flood": "exp_flo_", "cyclone": "exp_cyc_", "drought": "exp_dro_"}


def combined(sources: dict[str, DataFrame], key: str) -> DataFrame:
    """One row per unit of any source; columns get their source's prefix."""
    return table.outer_merge({name: table.prefix_names(df, PREFIXES[name], keep=key) for name, df in sources.items()}, key)


def fallback(levels: dict[int, DataFrame | None], required: bool = True) -> tuple[int, DataFrame] | None:
    """The deepest level whose table exists."""
    found = [(n, df) for n, df in sorted(levels.items(), reverse=True) if df is not None]
    if not found and required:
        raise FileNotFoundError("no level of a required source")
    return found[0] if found else None


#: Units from which on ranks are taken by ranges.
MANY = 50_000


def risk(df: DataFrame, unit: str = "unit_id", partition: list[str] | None = None, many: int = MANY) -> DataFrame:
    """Coping, vulnerability, and per hazard exposure, susceptibility, risk and rank, beside the raw columns.

    Indicators are min-max normalised (constant ones stay as they are), missing coping becomes 0, missing
    vulnerability 1, missing exposure stays; cop = mean(1 - coping), vul = mean(vulnerability), sus =
    sqrt(vul * cop), exp = mean(exposure), risk = sqrt(exp * sus); ranks descend, ties share their mean. A
    root of a negative product is null. ``partition``: normalise and rank within these columns. ``many`` units or more
    are written once and ranked by ranges, in many tasks."""
    cop = [c for c in df.columns if c.startswith("cop_")]
    vul = [c for c in df.columns if c.startswith("vul_")]
    exposures = {h: [c for c in df.columns if c.startswith(p)] for h, p in HAZARDS.items()}
    exposures = {h: cs for h, cs in exposures.items() if cs}
    every = [*cop, *vul, *(c for cs in exposures.values() for c in cs)]
    scaled = df.select(*(partition or []), unit, *every, *(F.col(c).cast("double").alias(f"n_{c}") for c in every))
    scaled = table.min_max(scaled, [f"n_{c}" for c in every], partition)
    c_score = row_mean(*(1 - F.coalesce(f"n_{c}", F.lit(0.0)) for c in cop))
    v_score = row_mean(*(F.coalesce(f"n_{c}", F.lit(1.0)) for c in vul))
    out = scaled.withColumns({"cop": c_score, "vul": v_score}).withColumn("sus", geometric_mean(F.col("vul"), F.col("cop")))
    for h, cs in exposures.items():
        out = out.withColumn(f"exp_{h}", row_mean(*(F.col(f"n_{c}") for c in cs))).withColumn(f"sus_{h}", F.col("sus")).withColumn(f"risk_{h}", geometric_mean(F.col(f"exp_{h}"), F.col("sus")))
    out = out.drop("sus", *(f"n_{c}" for c in every))
    if exposures and not partition and df.limit(many).count() >= many:
        out, store = stored(out, "risk"), stored
    else:
        store = None
    for h in exposures:
        out = series.average_rank(out, f"risk_{h}", f"ranking_{h}", partition, store)
    last = [f"{n}_{h}" for h in exposures for n in ("exp", "sus", "risk", "ranking")]
    return out.select(*(partition or []), unit, *every, "cop", "vul", *last)


def top(df: DataFrame, hazard: str, k: int, unit: str = "unit_id") -> DataFrame:
    """The k units at greatest risk."""
    return df.where(F.col(f"ranking_{hazard}").isNotNull()).orderBy(f"ranking_{hazard}", unit).limit(k)
