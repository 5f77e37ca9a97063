"""GeoParquet: WKB geometries with a bounding box beside each, so that a box query skips row groups.

A file's ``geo`` metadata names the geometry column and, as its covering, the columns of the box. Rows are written in
the order of squares along a Z curve, so a row group is a patch of the map and its statistics are a small box; a query
by box is a filter on plain columns that Spark pushes to the row groups.
"""

from __future__ import annotations

import io
import json
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tiff import _uri, landed

_BOX = ("xmin", "ymin", "xmax", "ymax")


def polygon_wkb(rings: list) -> bytes:
    """Rings (lists of points with x and y, open or closed) as one polygon."""
    out = struct.pack("<BII", 1, 3, len(rings))
    for ps in rings:
        xy = [(p["x"], p["y"]) for p in ps]
        xy += [xy[0]] if xy[0] != xy[-1] else []
        out += struct.pack("<I", len(xy)) + b"".join(struct.pack("<2d", *p) for p in xy)
    return out


def features(rings: DataFrame, key: str = "unit_id", ring: str = "ring", points: str = "points") -> DataFrame:
    """key, geometry (WKB polygon, rings in order) and bbox (struct of xmin, ymin, xmax, ymax) of rings."""
    kind = rings.schema[key].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [list(ps) for ps in pdf.sort_values(ring)[points]]
        xs, ys = [p["x"] for r in own for p in r], [p["y"] for r in own for p in r]
        return pd.DataFrame({key: [pdf[key].iloc[0]], "geometry": [polygon_wkb(own)], "bbox": [dict(zip(_BOX, (min(xs), min(ys), max(xs), max(ys)), strict=True))]})

    return rings.select(key, ring, points).groupBy(key).applyInPandas(run, f"`{key}` {kind}, geometry binary, bbox struct<{', '.join(f'{c}: double' for c in _BOX)}>")


def _metadata(geometry: str, crs: str | None) -> bytes:
    column = {"encoding": "WKB", "geometry_types": ["Polygon"], "covering": {"bbox": {c: ["bbox", c] for c in _BOX}}}
    return json.dumps({"version": "1.1.0", "primary_column": geometry, "columns": {geometry: column | ({"crs": crs} if crs else {})}}).encode()


def write(df: DataFrame, folder: str, size: float = 1.0, rows: int = 10_000, files: int | None = None, geometry: str = "geometry") -> None:
    """``df`` with a geometry and its ``bbox`` as GeoParquet files, by squares of ``size`` along a Z curve, ``rows`` a row
    group. Each task writes the file of its range of squares."""
    # the bits of both square numbers in turn
    x, y = (F.floor(F.col(f"bbox.{c}") / size).cast("long") + F.lit(1 << 20) for c in ("xmin", "ymin"))
    z = F.lit(0).cast("long")
    for bit in range(21):
        z = z.bitwiseOR(F.shiftleft(F.shiftright(x, bit).bitwiseAND(F.lit(1)), 2 * bit)).bitwiseOR(F.shiftleft(F.shiftright(y, bit).bitwiseAND(F.lit(1)), 2 * bit + 1))
    ordered = df.withColumn("__z", z)
    ordered = (ordered.repartitionByRange(files, "__z") if files else ordered.repartitionByRange("__z")).sortWithinPartitions("__z").drop("__z")
    meta = _metadata(geometry, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, writer = io.BytesIO(), None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if writer is None:
                schema = table.schema.with_metadata({b"geo": meta})
                writer = pq.ParquetWriter(out, schema)
            for a in range(0, len(table), rows):
                writer.write_table(table.slice(a, rows).replace_schema_metadata({b"geo": meta}), row_group_size=rows)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"part-{TaskContext.get().partitionId():05d}.parquet"]), pa.array([out.getvalue()], pa.binary())], names=["name", "content"])

    landed(ordered.mapInArrow(run, "name string, content binary"), folder, "name")


def _geo(path: str) -> dict:
    """The ``geo`` metadata of the first file of a folder, or of a file."""
    system, name = fs.FileSystem.from_uri(_uri(path))
    info = system.get_file_info(name)
    if info.type == fs.FileType.Directory:
        found = sorted(f.path for f in system.get_file_info(fs.FileSelector(name, recursive=True)) if f.path.endswith(".parquet"))
        if not found:
            raise FileNotFoundError(f"no Parquet file in {path}")
        name = found[0]
    with system.open_input_file(name) as f:
        meta = pq.ParquetFile(f).schema_arrow.metadata or {}
    if b"geo" not in meta:
        raise ValueError(f"{path} has no geo metadata")
    return json.loads(meta[b"geo"])


def meets(box: tuple[float, float, float, float], columns: dict[str, str]) -> Column:
    """Whether a row's box meets (x_min, y_min, x_max, y_max), borders included."""
    x0, y0, x1, y1 = box
    return (F.col(columns["xmin"]) <= x1) & (F.col(columns["xmax"]) >= x0) & (F.col(columns["ymin"]) <= y1) & (F.col(columns["ymax"]) >= y0)


def read(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The rows of GeoParquet files; with ``box`` those whose bounding box meets it. The geometry column of the metadata is
    called geometry. Files without a covering have no box to filter by: asking for one is an error."""
    geo = _geo(path)
    own = geo["columns"][geo["primary_column"]]
    if own["encoding"] != "WKB":
        raise ValueError(f"encoding {own['encoding']} isn't read")
    df = spark.read.parquet(path)
    if box:
        if "covering" not in own:
            raise ValueError(f"{path} has no bounding boxes")
        df = df.where(meets(box, {k: ".".join(v) for k, v in own["covering"]["bbox"].items()}))
    return df if geo["primary_column"] == "geometry" else df.withColumnRenamed(geo["primary_column"], "geometry")
