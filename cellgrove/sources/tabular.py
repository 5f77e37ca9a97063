"""Tables from files: CSV with level fallback, worksheets, ragged optional sources, and manifests."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.option("header", True)
    return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)


def with_fallback(spark: SparkSession, pattern: str, levels: tuple[str, ...] = ("ADM2", "ADM1"), required: bool = True, schema: str | None = None) -> tuple[str, DataFrame] | None:
    """(level, table) of the first level whose file exists; ``pattern`` holds {level}."""
    for level in levels:
        path = pattern.format(level=level)
        if exists(spark, path):
            return level, csv(spark, path, schema)
    if required:
        raise FileNotFoundError(pattern)
    return None


def worksheet(spark: SparkSession, path: str, sheet: str, required: list[str], columns: dict[str, str]) -> DataFrame:
    """Rows of one sheet of .xlsx files. Header names are stripped; ``required`` must be there; ``columns``
    maps header names to output names (strings, to be cast by the caller)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    names = list(columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows = _sheet(content, sheet)
                head = [str(h).strip() for h in rows[0]]
                if missing := [r for r in required if r not in head]:
                    raise ValueError(f"the sheet lacks {missing}")
                at = [head.index(n) if n in head else None for n in names]
                yield pd.DataFrame([[None if i is None or i >= len(r) else r[i] for i in at] for r in rows[1:]], columns=list(columns.values()))

    return files.mapInPandas(run, ", ".join(f"`{c}` string" for c in columns.values()))


def _sheet(content: bytes, sheet: str) -> list[list]:
    n = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{n['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", n)]
        link = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
        sheets = {s.get("name"): s.get(link) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets", n)}
        if sheet not in sheets:
            raise ValueError(f"no sheet {sheet} among {list(sheets)}")
        # the relationship file says which part a sheet is, whatever its place in the list
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        part = targets[sheets[sheet]]
        root = ElementTree.fromstring(z.read(part.lstrip("/") if part.startswith("/") else f"xl/{part}"))
    out = []
    for row in root.iter(f"{{{n['m']}}}row"):
        values: list = []
        for c in row.findall("m:c", n):
            letters = re.match(r"[A-Z]+", c.get("r", "A")).group()
            at = 0
            for x in letters:
                at = at * 26 + ord(x) - 64
            values += [None] * (at - 1 - len(values))
            v, inline = c.find("m:v", n), c.find("m:is", n)
            text = "".join(t.text or "" for t in inline.iter(f"{{{n['m']}}}t")) if inline is not None else v.text if v is not None else None
            values.append(shared[int(text)] if c.get("t") == "s" and text is not None else text)
        out.append(values)
    return out


def optional_union(*frames: DataFrame | None) -> DataFrame | None:
    """Rows of the sources that are there, whatever their columns; nothing if none is."""
    there = [f for f in frames if f is not None]
    out = there[0] if there else None
    for f in there[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---- sinks


def write_indicator(df: DataFrame, path: str, country: str, level: str, dataset: str, kind: str = "parquet") -> None:
    """One dataset of one country and level, as a partition of the output folder; a partition is replaced
    as a whole, and readers never see a part of it."""
    out = df.withColumns({"country": F.lit(country), "level": F.lit(level), "dataset": F.lit(dataset)})
    w = out.write.partitionBy("country", "level", "dataset").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.option("header", True).csv(path) if kind == "csv" else w.parquet(path)


def geojson_lines(rings: DataFrame, key: str, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row (column value), for a text sink."""
    g = rings.groupBy(key, *properties).agg(F.sort_array(F.collect_list(F.struct("ring", "points"))).alias("r"))
    coordinates = F.transform("r", lambda x: F.transform(x.points, lambda p: F.array(p.x, p.y)))
    return g.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(key, *properties).alias("properties"), F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"))).alias("value"))


def to_upload(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Files (path, size) that the store lacks or holds in another size."""
    return local.join(remote, ["path", "size"], "left_anti")


def not_uploaded(local: DataFrame, remote: DataFrame) -> DataFrame:
    """After an upload: files whose size in the store is not theirs, with what is there."""
    r = remote.select("path", F.col("size").alias("remote_size"))
    return local.join(r, "path", "left").where(~F.col("size").eqNullSafe(F.col("remote_size")))


def audit(expected: DataFrame, published: DataFrame, levels: list[str]) -> DataFrame:
    """Per country: files found (at the first level that has one), expected, and status: all or none is ok,
    some is partial. ``expected``: country, type; ``published``: country, type, level."""
    rank = F.array_position(F.array(*map(F.lit, levels)), F.col("level"))
    best = published.where(rank > 0).groupBy("country", "type").agg(F.min_by("level", rank).alias("level"))
    j = expected.join(best, ["country", "type"], "left")
    out = j.groupBy("country").agg(F.count("level").alias("found"), F.count("*").alias("expected"))
    return out.withColumn("status", F.when(F.col("found") == 0, "none").when(F.col("found") == F.col("expected"), "all").otherwise("partial"))


def missing_groups(wanted: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The column groups that an incremental output still lacks (both as long rows)."""
    return wanted.join(existing.select(*keys).distinct(), keys, "left_anti")


def cleanup(files: DataFrame, keep: str = "Output", path: str = "path") -> DataFrame:
    """Paths outside the folder that is kept."""
    return files.where(~F.col(path).rlike(f"(^|/){keep}/"))
