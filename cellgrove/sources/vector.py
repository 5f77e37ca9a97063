"""Vector files to rows: GeoJSON by JSON functions, WKB, GeoPackage and zipped shapefiles by parsers."""

from __future__ import annotations

import contextlib
import io
import os
import sqlite3
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTS = "array<struct<x: double, y: double>>"


def geojson_rings(spark: SparkSession, path: str, key: str, lines: bool = False) -> DataFrame:
    """key, ring, points of the polygons and multi-polygons of GeoJSON files: feature collections, or with ``lines`` files
    of a feature a line, which are read in parts. Fails if a file lacks the key."""
    feature = "properties: map<string, string>, geometry: struct<type: string, coordinates: string>"
    if lines:
        features = spark.read.json(path, schema=feature.replace("properties:", "properties").replace("geometry:", "geometry")).select(F.struct("properties", "geometry").alias("f"))
    else:
        features = spark.read.option("multiLine", True).json(path, schema=f"features array<struct<{feature}>>").select(F.explode("features").alias("f"))
    g = features.select(F.col("f.properties").getItem(key).alias(key), F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("c"))
    one = F.from_json("c", "array<array<array<double>>>")
    many = F.from_json("c", "array<array<array<array<double>>>>")
    rings = F.when(F.col("type") == "Polygon", one).when(F.col("type") == "MultiPolygon", F.flatten(many))
    checked = g.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a feature without {key}"))).otherwise(F.col(key)))
    each = checked.select(key, F.posexplode(rings).alias("ring", "r"))
    return each.select(key, "ring", F.transform("r", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("points"))


def _wkb(b: bytes, at: int = 0) -> tuple[list[tuple[str, list]], int]:
    """(kind, points) of each part of a WKB geometry, and where it ends."""
    order = "<" if b[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", b, at + 1)
    at += 5
    if code & 0x20000000:
        at += 4
    code, extra = code & 0xFFFF, (bool(code & 0x80000000) + bool(code & 0x40000000))
    extra += (code // 1000) in (1, 2) or 2 * ((code // 1000) == 3)
    code %= 1000
    size = 8 * (2 + extra)

    def points(n: int, at: int) -> tuple[list, int]:
        return [struct.unpack_from(order + "2d", b, at + i * size) for i in range(n)], at + n * size

    def number(at: int) -> tuple[int, int]:
        return struct.unpack_from(order + "I", b, at)[0], at + 4

    if code == 1:
        p, at = points(1, at)
        return [("point", p)], at
    if code == 2:
        n, at = number(at)
        p, at = points(n, at)
        return [("line", p)], at
    out = []
    n, at = number(at)
    for _ in range(n):
        if code == 3:
            m, at = number(at)
            p, at = points(m, at)
            out.append(("ring", p))
        else:
            parts, at = _wkb(b, at)
            out += parts
    return out, at


def wkb_parts(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """The other columns, part, kind (point, line, ring) and points, one row per part of a WKB geometry."""
    rest = [f for f in df.schema.fields if f.name != geometry]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                g = r.pop(geometry)
                for i, (kind, points) in enumerate(_wkb(bytes(g))[0] if g is not None else []):
                    rows.append({**r, "part": i, "kind": kind, "points": [{"x": x, "y": y} for x, y in points]})
            yield pd.DataFrame(rows, columns=[f.name for f in rest] + ["part", "kind", "points"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)
    return df.mapInPandas(run, f"{kinds}part int, kind string, points {_POINTS}")


def geopackage(spark: SparkSession, path: str, layer: str, columns: str, geometry: str = "geom") -> DataFrame:
    """``columns`` (a DDL list) and ``geometry`` (WKB) of a layer, one task per file. A file is small enough
    to hold."""
    names = [c.split()[0].strip("`") for c in columns.split(",")]
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                with contextlib.closing(sqlite3.connect(":memory:")) as db:
                    db.deserialize(content)
                    rows = db.execute(f"SELECT {', '.join(f'"{n}"' for n in names)}, \"{geometry}\" FROM \"{layer}\"").fetchall()  # noqa: S608
                out = pd.DataFrame(rows, columns=[*names, "geometry"])
                # the header before the WKB: 8 bytes and an envelope by its flags
                out["geometry"] = [None if g is None else g[8 + 8 * [0, 4, 6, 6, 8][g[3] >> 1 & 7] :] for g in out["geometry"]]
                yield out

    return files.mapInPandas(run, f"{columns}, geometry binary")


def _dbf(data: bytes) -> list[dict]:
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("latin-1"), data[at + 16]))
        at += 32
    out = []
    for i in range(n):
        p, row = head + i * size + 1, {}
        for name, width in fields:
            row[name] = data[p : p + width].decode("utf-8", "replace").strip()
            p += width
        out.append(row)
    return out


def _shp(data: bytes) -> list[list[list[tuple]]]:
    out, at = [], 100
    while at + 8 <= len(data):
        (words,) = struct.unpack_from(">I", data, at + 4)
        kind = struct.unpack_from("<I", data, at + 8)[0] % 10
        rings: list = []
        if kind in (3, 5):
            parts, points = struct.unpack_from("<2I", data, at + 44)
            begins = [*struct.unpack_from(f"<{parts}I", data, at + 52), points]
            xy = struct.unpack_from(f"<{2 * points}d", data, at + 52 + 4 * parts)
            rings = [[(xy[2 * i], xy[2 * i + 1]) for i in range(a, b)] for a, b in zip(begins[:-1], begins[1:], strict=True)]
        out.append(rings)
        at += 8 + 2 * words
    return out


def zipped_shapefiles(spark: SparkSession, path: str) -> DataFrame:
    """file, level (of the name; deeper than 2 is dropped), properties, ring, points."""
    from .catalogue import admin_level

    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    rows = []
                    for name in [n for n in z.namelist() if n.lower().endswith(".shp")]:
                        shapes, records = _shp(z.read(name)), _dbf(z.read(name[:-4] + ".dbf"))
                        for rings, r in zip(shapes, records, strict=True):
                            rows += [{"file": os.path.basename(name), "properties": r, "ring": i, "points": [{"x": x, "y": y} for x, y in p]} for i, p in enumerate(rings)]
                    yield pd.DataFrame(rows, columns=["file", "properties", "ring", "points"])

    out = files.mapInPandas(run, f"file string, properties map<string, string>, ring int, points {_POINTS}")
    return out.withColumn("level", admin_level(F.col("file"))).where("level is not null")
