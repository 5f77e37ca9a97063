"""GeoTIFFs by blocks: the header is read first, then only the byte ranges that a window needs.

``blocks`` lists the strips or tiles of files as rows (place in the file, cells covered, how to decode), ``cells`` and
``reduced`` read them, some megabytes a task. So one file is read by many tasks, a window costs its own blocks, and a
reduced raster leaves each task as partial sums of its target cells. Classic and BigTIFF; none, LZW or deflate; no,
horizontal or floating-point differencing; any band of chunky or planar files.

Byte ranges are read through pyarrow's file systems (local, HDFS, S3, GCS); folders are listed by Spark.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .raster import _CELLS, _lzw

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8, 17: 8, 18: 8}
_FORMATS = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
_BLOCKS = (
    "path string, block int, at long, size long, row int, col int, height int, width int, image_height int, image_width int, tile_height int, tile_width int, "
    "kind string, packing int, predictor int, samples int, sample int, x0 double, y0 double, dx double, dy double, nodata double"
)
#: Bytes of blocks that a task reads, on average.
TASK_BYTES = 32 << 20
#: Bytes that a classic TIFF can't address.
CLASSIC = 1 << 32

Read = Callable[[int, int], bytes]


def _uri(path: str) -> str:
    return "file:///" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) else path


def opened(path: str) -> Read:
    """A function of (place, bytes) of a file."""
    system, name = fs.FileSystem.from_uri(_uri(path))
    f = system.open_input_file(name)
    return lambda at, n: f.read_at(n, at)


def tags(read: Read) -> dict[int, tuple]:
    """The first image's tags; texts are one bytes value."""
    head = read(0, 16)
    o = "<" if head[:2] == b"II" else ">"
    big = struct.unpack_from(o + "H", head, 2)[0] == 43
    word, entry, at = ("Q", 20, struct.unpack_from(o + "Q", head, 8)[0]) if big else ("I", 12, struct.unpack_from(o + "I", head, 4)[0])
    first = 8 if big else 2
    n = struct.unpack(o + ("Q" if big else "H"), read(at, first))[0]
    body, out = read(at + first, n * entry), {0: (o,)}
    for i in range(n):
        tag, kind = struct.unpack_from(o + "HH", body, i * entry)
        count = struct.unpack_from(o + word, body, i * entry + 4)[0]
        size, inline = _SIZES.get(kind, 1) * count, 8 if big else 4
        place = i * entry + 4 + inline
        data = body[place : place + size] if size <= inline else read(struct.unpack_from(o + word, body, place)[0], size)
        out[tag] = (data,) if kind == 2 else struct.unpack(f"{o}{count}{_FORMATS[kind]}", data) if kind in _FORMATS else ()
    return out


def block_rows(path: str, read: Read, window: tuple[int, int, int, int] | None = None, band: int = 1) -> pd.DataFrame:
    """The blocks of a file that a window (row, col, height, width) touches."""
    t = tags(read)
    w, h, samples = t[256][0], t[257][0], t.get(277, (1,))[0]
    if not 1 <= band <= samples:
        raise ValueError(f"{path} has {samples} bands, not {band}")
    kind = f"{t[0][0]}{({1: 'u', 2: 'i', 3: 'f'})[t.get(339, (1,))[0]]}{t.get(258, (8,))[0] // 8}"
    tw, th, offsets, counts = (t[322][0], t[323][0], t[324], t[325]) if 322 in t else (w, min(t.get(278, (h,))[0], h), t[273], t[279])
    across, down = -(-w // tw), -(-h // th)
    split = t.get(284, (1,))[0] == 2  # each band has blocks of its own
    row, col = np.divmod(np.arange(across * down), across)
    row, col = row * th, col * tw
    own = np.arange(across * down) + (band - 1) * across * down * split
    r, c, wh, ww = window or (0, 0, h, w)
    keep = (row < r + wh) & (row + th > r) & (col < c + ww) & (col + tw > c)
    scale, tie = t.get(33550, (1.0, 1.0, 0.0)), t.get(33922, (0.0,) * 6)
    nodata = float(t[42113][0].strip(b"\0 ")) if 42113 in t else None
    return pd.DataFrame({
        "path": path, "block": own[keep], "at": np.array(offsets, np.int64)[own][keep], "size": np.array(counts, np.int64)[own][keep], "row": row[keep], "col": col[keep],
        "height": np.minimum(th, h - row)[keep], "width": np.minimum(tw, w - col)[keep], "image_height": h, "image_width": w, "tile_height": th, "tile_width": tw,
        "kind": kind, "packing": t.get(259, (1,))[0], "predictor": t.get(317, (1,))[0], "samples": 1 if split else samples, "sample": 0 if split else band - 1,
        "x0": tie[3] - tie[0] * scale[0], "y0": tie[4] + tie[1] * scale[1], "dx": scale[0], "dy": scale[1], "nodata": nodata,
    })


def decoded(b, raw: bytes) -> np.ndarray:
    """The cells of one block (a row of ``blocks``), as doubles, NaN where there is no data."""
    if b.packing not in (1, 5, 8, 32946):
        raise ValueError(f"{b.path}: compression {b.packing} is not read")
    raw = {1: bytes, 5: _lzw}.get(b.packing, zlib.decompress)(raw)
    dtype, across = np.dtype(b.kind), b.tile_width * b.samples
    if b.predictor == 3:  # bytes of a row differenced, most significant plane first
        planes = np.frombuffer(raw, np.uint8).reshape(-1, b.tile_width * dtype.itemsize, b.samples).cumsum(1, dtype=np.uint8)
        planes = planes.reshape(-1, dtype.itemsize, across).transpose(0, 2, 1)
        block = np.ascontiguousarray(planes).view(dtype.newbyteorder(">")).reshape(-1, b.tile_width, b.samples)
    else:
        block = np.frombuffer(raw, dtype)
        block = block[: len(block) // across * across].reshape(-1, b.tile_width, b.samples)
        if b.predictor == 2:
            block = np.cumsum(block, 1, dtype=dtype.newbyteorder("="))
    out = block[: b.height, : b.width, b.sample].astype(np.float64)
    return out if b.nodata is None or np.isnan(b.nodata) else np.where(out == b.nodata, np.nan, out)


def blocks(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None, band: int = 1) -> DataFrame:
    """The blocks of the GeoTIFFs at ``path`` (a file, a folder or a pattern) that a window touches. Only headers are read."""
    files = spark.read.format("binaryFile").load(path).select("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["path"]:
                yield block_rows(p, opened(p), window, band)

    return files.mapInPandas(run, _BLOCKS)


def _dealt(found: DataFrame, task_bytes: int) -> DataFrame:
    """Block rows over as many tasks as their bytes ask for; the rows are small, their blocks aren't."""
    total = found.agg(F.sum("size")).first()[0] or 0
    return found.repartition(max(1, -(-total // task_bytes)), "path", "block")


def cells(found: DataFrame, window: tuple[int, int, int, int] | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """raster (the last part of the path), row, col, value, x0, y0, dx, dy of ``blocks``, within the window; cells without
    data are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, own in pdf.groupby("path", sort=False):
                read = opened(p)
                for b in own.itertuples():
                    v = decoded(b, read(b.at, b.size))
                    i, j = np.nonzero(~np.isnan(v))
                    out = pd.DataFrame({"raster": p.rsplit("/", 1)[-1], "row": (i + b.row).astype(np.int32), "col": (j + b.col).astype(np.int32), "value": v[i, j], "x0": b.x0, "y0": b.y0, "dx": b.dx, "dy": b.dy})
                    if window:
                        r, c, h, w = window
                        out = out[out["row"].between(r, r + h - 1) & out["col"].between(c, c + w - 1)]
                    yield out

    return _dealt(found, task_bytes).mapInPandas(run, _CELLS)


def _weights(first: int, n: int, size: int, to: int) -> tuple[int, np.ndarray]:
    """The first target cell that cells ``first`` to ``first + n`` of an axis of ``size`` reach, and what each target
    cell (rows) takes of each of them: a triangle as wide as a target cell to both sides, one cell at least."""
    step = size / to
    wide = max(1.0, step)
    a = max(0, int(np.floor((first - wide + 0.5) / step - 0.5)))
    b = min(to - 1, int(np.ceil((first + n - 1 + wide + 0.5) / step - 0.5)))
    centre = (np.arange(a, b + 1) + 0.5) * step - 0.5
    return a, np.maximum(0.0, 1 - np.abs(np.arange(first, first + n)[None] - centre[:, None]) / wide)


def reduced(found: DataFrame, shape: tuple[int, int], task_bytes: int = TASK_BYTES) -> DataFrame:
    """raster, row, col, value of whole rasters (``blocks`` without a window) read at another size, bilinearly: a target
    cell is the mean of the cells around its centre, weighted by a triangle of a target cell's size. Cells without data
    drop out of the weights; a target cell without any is left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, own in pdf.groupby("path", sort=False):
                read = opened(p)
                for b in own.itertuples():
                    v = decoded(b, read(b.at, b.size))
                    (r, down), (c, right) = _weights(b.row, b.height, b.image_height, shape[0]), _weights(b.col, b.width, b.image_width, shape[1])
                    there = ~np.isnan(v)
                    weight, total = down @ there @ right.T, down @ np.where(there, v, 0.0) @ right.T
                    i, j = np.nonzero(weight)
                    yield pd.DataFrame({"raster": p.rsplit("/", 1)[-1], "path": p, "row": (i + r).astype(np.int32), "col": (j + c).astype(np.int32), "total": total[i, j], "weight": weight[i, j]})

    parts = _dealt(found, task_bytes).mapInPandas(run, "raster string, path string, row int, col int, total double, weight double")
    return parts.groupBy("path", "raster", "row", "col").agg((F.sum("total") / F.sum("weight")).alias("value")).drop("path")


def _packed(cut: np.ndarray, shape: tuple[int, int], predictor: int, packed: bool) -> bytes:
    """One block of a given shape, the rest of it zero."""
    dtype = cut.dtype.newbyteorder("<")
    full = np.zeros(shape, dtype)
    full[: cut.shape[0], : cut.shape[1]] = cut
    if predictor == 2:
        full[:, 1:] -= full[:, :-1].copy()
    raw = full.tobytes()
    if predictor == 3:
        planes = np.ascontiguousarray(full.astype(dtype.newbyteorder(">"))).view(np.uint8).reshape(*shape, dtype.itemsize).transpose(0, 2, 1).reshape(shape[0], -1)
        raw = np.diff(planes, axis=1, prepend=np.uint8(0)).astype(np.uint8).tobytes()
    return zlib.compress(raw) if packed else raw


def assembled(parts: list[bytes], shape: tuple[int, int, int], dtype: np.dtype, x0: float, y0: float, dx: float, dy: float, nodata: float | None = None, block: tuple[int, int] = (256, 256), tiled: bool = True, predictor: int = 1, packed: bool = True) -> bytes:
    """A GeoTIFF of blocks in order. ``shape``: bands (planar), rows, columns. Files of 4 GB or more are BigTIFF."""
    n, h, w = shape
    big = sum(map(len, parts)) + 64 * len(parts) >= CLASSIC
    word, inline = ("Q", 8) if big else ("I", 4)
    text = (str(nodata) + "\0").encode() if nodata is not None else b""
    shorts = lambda *v: struct.pack(f"<{len(v)}H", *v)
    longs = lambda *v: struct.pack(f"<{len(v)}I", *v)
    places, counts = (16 if big else 4, len(parts), "offsets"), (4, len(parts), longs(*map(len, parts)))
    own = [(322, 4, 1, longs(block[1])), (323, 4, 1, longs(block[0])), (324, *places), (325, *counts)] if tiled else [(273, *places), (278, 4, 1, longs(block[0])), (279, *counts)]
    entries = sorted([
        (256, 4, 1, longs(w)), (257, 4, 1, longs(h)), (258, 3, n, shorts(*[dtype.itemsize * 8] * n)), (259, 3, 1, shorts(8 if packed else 1)), (262, 3, 1, shorts(1)), (277, 3, 1, shorts(n)),
        (284, 3, 1, shorts(2)), (317, 3, 1, shorts(predictor)), (339, 3, n, shorts(*[{"u": 1, "i": 2, "f": 3}[dtype.kind]] * n)), (33550, 12, 3, struct.pack("<3d", dx, dy, 0.0)),
        (33922, 12, 6, struct.pack("<6d", 0, 0, 0, x0, y0, 0)), (34735, 3, 16, shorts(1, 1, 0, 3, 1024, 0, 1, 2, 1025, 0, 1, 1, 2048, 0, 1, 4326)), *([(42113, 2, len(text), text)] if text else []), *own,
    ], key=lambda e: e[0])
    size = lambda v: struct.calcsize(word) * len(parts) if v == "offsets" else len(v)
    begin = 16 if big else 8
    free = begin + (8 if big else 2) + (20 if big else 12) * len(entries) + inline
    body = free + sum(size(v) + size(v) % 2 for *_, v in entries if size(v) > inline)
    starts = (body + np.cumsum([0, *map(len, parts)]))[:-1].tolist()
    head = extra = b""
    for tag, kind, count, v in entries:
        v = struct.pack(f"<{len(parts)}{word}", *starts) if v == "offsets" else v
        head += struct.pack(f"<HH{word}", tag, kind, count) + (v.ljust(inline, b"\0") if len(v) <= inline else struct.pack(f"<{word}", free + len(extra)))
        extra += v + b"\0" * (len(v) % 2) if len(v) > inline else b""
    first = b"II+\0" + struct.pack("<HHQQ", 8, 0, 16, len(entries)) if big else b"II*\0" + struct.pack("<IH", 8, len(entries))
    return b"".join([first, head, b"\0" * inline, extra, *parts])


def encoded(band: np.ndarray, x0: float, y0: float, dx: float, dy: float, nodata: float | None = None, block: tuple[int, int] = (256, 256), tiled: bool = True, predictor: int = 1, packed: bool = True) -> bytes:
    """A GeoTIFF of one band (rows, columns) or of several (bands, rows, columns; planar), by tiles or by strips of
    ``block[0]`` rows, deflated unless ``packed`` is false."""
    bands = band[None] if band.ndim == 2 else band
    h, w = bands.shape[1:]
    th, tw = block if tiled else (block[0], w)
    parts = []
    for one in bands:
        for r in range(0, h, th):
            for c in range(0, w, tw):
                cut = one[r : r + th, c : c + tw]
                parts.append(_packed(cut, (th, tw) if tiled else cut.shape, predictor, packed))
    return assembled(parts, bands.shape, bands.dtype, x0, y0, dx, dy, nodata, block, tiled, predictor, packed)


def geotiffs(cells: DataFrame, shape: tuple[int, int], x0: float, y0: float, dx: float, dy: float, by: str = "raster", nodata: float = -9999.0, rows: int = 256, dtype: str = "f4") -> DataFrame:
    """``by``, content: a GeoTIFF of ``shape`` (rows, columns) for each raster of cells (``by``, row, col, value), by strips
    of ``rows``. Strips are made and deflated apart, some tasks a raster; only deflated strips meet in one. Cells outside
    the shape are left out."""
    kind, strips = cells.schema[by].dataType.simpleString(), -(-shape[0] // rows)
    inside = cells.where(F.col("row").between(0, shape[0] - 1) & F.col("col").between(0, shape[1] - 1))
    own = inside.select(F.col(by).alias("raster"), F.floor(F.col("row") / rows).cast("int").alias("strip"), "row", "col", F.col("value").cast("double").alias("value"))

    def strip(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(key[1]) * rows
        band = np.full((min(rows, shape[0] - first), shape[1]), nodata, dtype)
        band[pdf["row"].to_numpy() - first, pdf["col"].to_numpy()] = pdf["value"].fillna(nodata)
        return pd.DataFrame({"raster": [key[0]], "strip": [key[1]], "data": [_packed(band, band.shape, 1, True)]})

    def whole(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        have = dict(zip(pdf["strip"], pdf["data"], strict=True))
        empty = lambda k: _packed(np.full((min(rows, shape[0] - k * rows), shape[1]), nodata, dtype), (min(rows, shape[0] - k * rows), shape[1]), 1, True)
        parts = [have[k] if k in have else empty(k) for k in range(strips)]
        return pd.DataFrame({by: [key[0]], "content": [assembled(parts, (1, *shape), np.dtype(dtype), x0, y0, dx, dy, nodata, (rows, shape[1]), tiled=False)]})

    each = own.groupBy("raster", "strip").applyInPandas(strip, f"raster {kind}, strip int, data binary")
    return each.groupBy("raster").applyInPandas(whole, f"`{by}` {kind}, content binary")


def landed(files: DataFrame, folder: str, name: str = "raster") -> list[str]:
    """Files written from (name, content) into a folder, by the tasks; a file is there whole or not at all. Returns
    their paths."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for n, data in zip(pdf["name"], pdf["content"], strict=True):
                system, path = fs.FileSystem.from_uri(_uri(f"{folder}/{n}"))
                system.create_dir(path.rsplit("/", 1)[0])
                part = f"{path}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as f:
                    f.write(data)
                system.move(part, path)
                out.append(f"{folder}/{n}")
            yield pd.DataFrame({"path": out})

    rows = files.select(F.col(name).cast("string").alias("name"), "content").mapInPandas(run, "path string")
    return sorted(r.path for r in rows.collect())
