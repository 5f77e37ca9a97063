"""Vector tiles of polygons, zoom by zoom, as a table zoom, x, y, data.

Rings are projected once (Web Mercator, the world as one square), and the tolerance at which each vertex goes is found
once; a zoom keeps the vertices that are further than half a step of its grid from the line without them, so borders
stay shared at every zoom. Polygons are clipped to tiles by slab sweeps, a tile row being a band, chained into rings
and written as version 2 tiles: delta-coded whole numbers on a grid of ``EXTENT`` steps a tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import geo, planar

EXTENT = 4096


def world(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Place in the unit square, y downwards; latitudes beyond the square's edge are moved to it."""
    most = math.degrees(math.atan(math.sinh(math.pi)))
    inside = F.radians(F.greatest(F.lit(-most), F.least(F.lit(most), lat)))
    return (lon + 180) / 360, (1 - F.asinh(F.tan(inside)) / F.pi()) / 2


def clipped(edges: DataFrame, by: list[str]) -> DataFrame:
    """by, x, y, and the sides of what lies in each tile, of edges in units of tiles. A tile of a row meets the edges of
    one key in that row."""
    xy = ["x1", "y1", "x2", "y2"]
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    dealt = edges.select(*by, *xy).where("y1 <> y2").withColumn("y", F.explode(F.sequence(F.floor(low), F.ceil(high) - 1)))
    reach = dealt.groupBy(*by, "y").agg(F.floor(F.min(F.least("x1", "x2"))).alias("a"), F.ceil(F.max(F.greatest("x1", "x2"))).alias("b"))
    tiles = reach.select(*by, "y", F.explode(F.sequence("a", F.greatest("a", F.col("b") - 1))).alias("x"))
    at = lambda k: F.struct((F.col("x") + k).cast("double").alias("x1"), F.col("y").cast("double").alias("y1"), (F.col("x") + k).cast("double").alias("x2"), (F.col("y") + 1).cast("double").alias("y2"))
    walls = tiles.select(*by, "x", "y", F.explode(F.array(at(0), at(1))).alias("e")).select(*by, "x", "y", "e.*", F.lit(1).alias("layer"))
    met = dealt.join(tiles, [*by, "y"]).select(*by, "x", "y", *xy, F.lit(0).alias("layer")).unionByName(walls)
    kinds = {c: edges.schema[c].dataType.simpleString() for c in by} | {"x": "long", "y": "long"}

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return planar._rows(pdf[xy].to_numpy(float), pdf["layer"].to_numpy(), "both", int(key[-1]), 1.0, 1e-9, dict(zip([*by, "x", "y"], key, strict=True)))

    return met.groupBy(*by, "x", "y").applyInPandas(run, planar._schema(kinds))


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, body: bytes | int) -> bytes:
    return _varint(number << 3) + _varint(body) if isinstance(body, int) else _varint(number << 3 | 2) + _varint(len(body)) + body


def geometry(rings: list[list[tuple[int, int]]]) -> bytes:
    """Move, line and close commands of open rings; steps are from point to point, signs in the lowest bit."""
    zigzag = lambda v: _varint(v << 1 if v >= 0 else (-v << 1) - 1)
    out, x, y = b"", 0, 0
    for ring in rings:
        out += _varint(1 << 3 | 1)
        for k, (a, b) in enumerate(ring):
            if k == 1:
                out += _varint(len(ring) - 1 << 3 | 2)
            out += zigzag(a - x) + zigzag(b - y)
            x, y = a, b
        out += _varint(1 << 3 | 7)
    return out


def tile(layer: str, features: list[tuple[str, list[list[tuple[int, int]]]]], key: str) -> bytes:
    """One layer of polygons, each with one text property."""
    body = _field(15, 2) + _field(1, layer.encode())
    for n, (_, rings) in enumerate(features):
        body += _field(2, _field(1, n + 1) + _field(2, _varint(0) + _varint(n)) + _field(3, 3) + _field(4, geometry(rings)))
    body += _field(3, key.encode()) + b"".join(_field(4, _field(1, name.encode())) for name, _ in features) + _field(5, EXTENT)
    return _field(3, body)


def _number(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return n, at


def numbers_of(data: bytes) -> list[int]:
    """Packed numbers."""
    out, at = [], 0
    while at < len(data):
        n, at = _number(data, at)
        out.append(n)
    return out


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        tag, at = _number(data, at)
        n, at = _number(data, at)
        if tag & 7 == 0:
            yield tag >> 3, n
        else:
            yield tag >> 3, data[at : at + n]
            at += n


def read_tile(data: bytes) -> list[tuple[str, str, list[list[tuple[int, int]]]]]:
    """(layer, first property, rings) of the polygons of a tile."""
    out = []
    for _, layer in (f for f in _fields(data) if f[0] == 3):
        parts = list(_fields(layer))
        name = next(v for k, v in parts if k == 1).decode()
        values = [next(x for n, x in _fields(v) if n == 1).decode() for k, v in parts if k == 4]
        for feature in (v for k, v in parts if k == 2):
            f = dict(_fields(feature))
            numbers, rings, x, y, at = numbers_of(f[4]), [], 0, 0, 0
            while at < len(numbers):
                command, count = numbers[at] & 7, numbers[at] >> 3
                at += 1
                if command == 7:
                    continue
                if command == 1:
                    rings.append([])
                for _ in range(count):
                    dx, dy = ((v >> 1) ^ -(v & 1) for v in numbers[at : at + 2])
                    x, y, at = x + dx, y + dy, at + 2
                    rings[-1].append((x, y))
            out.append((name, values[numbers_of(f[2])[1]], rings))
    return out


def tiles(rings: DataFrame, zooms: range, layer: str = "boundary", unit: str = "unit_id", ring: str = "ring", points: str = "points") -> DataFrame:
    """zoom, x, y, data of the tiles that polygons (unit, ring, points in degrees) reach. Rings smaller than a step of the
    grid vanish; a unit without any left in a tile isn't in it. A tile's features meet in one task."""
    lon_lat = F.transform(points, lambda p: F.struct(*(c.alias(n) for c, n in zip(world(p.x, p.y), "xy", strict=True))))
    vertices = geo.vertex_tolerances(rings.select(unit, ring, lon_lat.alias("points")), (unit, ring))
    scale = F.pow(F.lit(2.0), F.col("zoom"))
    each = vertices.withColumn("zoom", F.explode(F.array(*map(F.lit, zooms)))).where(F.col("goes") * scale > 0.5 / EXTENT)
    kept = each.groupBy("zoom", unit, ring).agg(F.sort_array(F.collect_list(F.struct("place", "x", "y"))).alias("p"))
    kept = kept.select(F.struct("zoom", unit).alias("feature"), ring, F.transform("p", lambda q: F.struct((q.x * scale).alias("x"), (q.y * scale).alias("y"))).alias("points"))
    edges = geo.edges_from_rings(kept, "feature", ring).select("feature.*", "x1", "y1", "x2", "y2")
    keys = ["zoom", unit, "x", "y"]
    found = planar.nested(planar.rings(clipped(edges, ["zoom", unit]), keys), keys)
    rows = found.select(*keys, "shell", "hole", "ring", F.transform("points", lambda p: F.array(F.rint((p.x - F.col("x")) * EXTENT).cast("int"), F.rint((p.y - F.col("y")) * EXTENT).cast("int"))).alias("path"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        features = []
        for name, own in pdf.sort_values([unit, "shell", "hole", "ring"]).groupby(unit):
            paths = []
            for r in own.itertuples():
                path = [tuple(map(int, p)) for p in r.path[:-1]]
                path = [p for k, p in enumerate(path) if p != path[k - 1]]
                size = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(path, [*path[1:], *path[:1]], strict=True))
                if len(path) > 2 and size and (size < 0) == r.hole:
                    paths.append(path)
            if paths:
                features.append((str(name), paths))
        rows = [(*map(int, key), tile(layer, features, unit))] if features else []
        return pd.DataFrame(rows, columns=["zoom", "x", "y", "data"])

    return rows.groupBy("zoom", "x", "y").applyInPandas(run, "zoom int, x int, y int, data binary")


def features(table: DataFrame) -> DataFrame:
    """zoom, x, y, layer, name, area (of a whole tile's) of the polygons of decoded tiles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                for name, value, rings in read_tile(bytes(r.data)):
                    doubled = sum(a[0] * b[1] - b[0] * a[1] for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]], strict=True))
                    out.append((r.zoom, r.x, r.y, name, value, doubled / 2 / EXTENT**2))
            yield pd.DataFrame(out, columns=["zoom", "x", "y", "layer", "name", "area"])

    return table.select("zoom", "x", "y", "data").mapInPandas(run, "zoom int, x int, y int, layer string, name string, area double")
