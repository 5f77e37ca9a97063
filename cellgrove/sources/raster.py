"""Raster files to cell tables: a baseline GeoTIFF reader and writer, ASCII grids, monthly series.

Files are read whole by one task each (``binaryFile``); large rasters come as many tiles, and the cell or
tile tables made from them are what queries read."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8}
_FORMATS = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


def _lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bit first, 256 clears and 257 ends."""
    out, table, width, previous = bytearray(), [], 9, b""
    bits = n = 0
    for byte in data:
        bits, n = bits << 8 | byte, n + 8
        if n < width:
            continue
        code = bits >> n - width & (1 << width) - 1
        n -= width
        bits &= (1 << n) - 1
        if code == 257:
            break
        if code == 256:
            table, width, previous = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        entry = table[code] if code < len(table) else previous + previous[:1]
        out += entry
        if previous:
            table.append(previous + entry[:1])
        previous = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)


def read_tiff(data: bytes) -> tuple[np.ndarray, dict]:
    """First band and metadata (x0, y0, dx, dy, nodata) of a strip or tile GeoTIFF, uncompressed, LZW or
    deflate, with or without horizontal differencing."""
    o = "<" if data[:2] == b"II" else ">"
    at = struct.unpack_from(o + "I", data, 4)[0]
    tags: dict[int, tuple] = {}
    for i in range(struct.unpack_from(o + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(o + "HHI", data, at + 2 + 12 * i)
        size = _SIZES[kind] * n
        place = at + 10 + 12 * i if size <= 4 else struct.unpack_from(o + "I", data, at + 10 + 12 * i)[0]
        tags[tag] = (data[place : place + n],) if kind == 2 else struct.unpack_from(f"{o}{n}{_FORMATS[kind]}", data, place) if kind in _FORMATS else ()
    w, h = tags[256][0], tags[257][0]
    kind = {1: "u", 2: "i", 3: "f"}[tags.get(339, (1,))[0]]
    dtype = np.dtype(f"{o}{kind}{tags.get(258, (8,))[0] // 8}")
    packing, predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
    if 322 in tags:
        tw, th, offsets, counts = tags[322][0], tags[323][0], tags[324], tags[325]
    else:
        tw, th, offsets, counts = w, tags.get(278, (h,))[0], tags[273], tags[279]
    across = -(-w // tw)
    out = np.zeros((-(-h // th) * th, across * tw), dtype.newbyteorder("="))
    for i, (p, n) in enumerate(zip(offsets, counts, strict=True)):
        raw = data[p : p + n]
        raw = {1: lambda b: b, 5: _lzw, 8: zlib.decompress, 32946: zlib.decompress}[packing](raw)
        block = np.frombuffer(raw, dtype)
        block = block[: len(block) // tw * tw].reshape(-1, tw)
        if predictor == 2:
            block = np.cumsum(block, 1, dtype=dtype.newbyteorder("="))
        r, c = i // across * th, i % across * tw
        out[r : r + len(block), c : c + tw] = block[: len(out) - r]
    scale, tie = tags.get(33550, (1.0, 1.0, 0.0)), tags.get(33922, (0.0,) * 6)
    nodata = tags.get(42113)
    meta = {"x0": tie[3] - tie[0] * scale[0], "y0": tie[4] + tie[1] * scale[1], "dx": scale[0], "dy": scale[1], "nodata": float(nodata[0].strip(b"\0 ")) if nodata else None}
    return out[:h, :w], meta


def write_tiff(band: np.ndarray, x0: float, y0: float, dx: float, dy: float, nodata: float | None = None) -> bytes:
    """A single-strip deflate GeoTIFF in geographic coordinates."""
    band = np.ascontiguousarray(band)
    kind = {"u": 1, "i": 2, "f": 3}[band.dtype.kind]
    body = zlib.compress(band.astype(band.dtype.newbyteorder("<")).tobytes())
    h, w = band.shape
    text = (str(nodata) + "\0").encode() if nodata is not None else b""
    long_values: list[tuple[int, int, int, bytes]] = [
        (256, 4, 1, struct.pack("<I", w)), (257, 4, 1, struct.pack("<I", h)), (258, 3, 1, struct.pack("<HH", band.itemsize * 8, 0)), (259, 3, 1, struct.pack("<HH", 8, 0)), (262, 3, 1, struct.pack("<HH", 1, 0)),
        (273, 4, 1, b"STRP"), (277, 3, 1, struct.pack("<HH", 1, 0)), (278, 4, 1, struct.pack("<I", h)), (279, 4, 1, struct.pack("<I", len(body))), (339, 3, 1, struct.pack("<HH", kind, 0)),
        (33550, 12, 3, struct.pack("<3d", dx, dy, 0.0)), (33922, 12, 6, struct.pack("<6d", 0, 0, 0, x0, y0, 0)), (34735, 3, 16, struct.pack("<16H", 1, 1, 0, 3, 1024, 0, 1, 2, 1025, 0, 1, 1, 2048, 0, 1, 4326)),
        *([(42113, 2, len(text), text)] if text else []),
    ]
    head, free, blocks = 8 + 2 + 12 * len(long_values) + 4, 0, b""
    entries = b""
    strip = head + sum(len(v) + len(v) % 2 for *_, v in long_values if len(v) > 4)
    for tag, code, n, v in long_values:
        if v == b"STRP":
            v = struct.pack("<I", strip)
        if len(v) > 4:
            entries += struct.pack("<HHII", tag, code, n, head + free)
            blocks += v + b"\0" * (len(v) % 2)
            free = len(blocks)
        else:
            entries += struct.pack("<HHI", tag, code, n) + v.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(long_values)) + entries + b"\0" * 4 + blocks + body


def _cells(band: np.ndarray, meta: dict, name: str) -> pd.DataFrame:
    r, c = np.indices(band.shape)
    v = band.astype(np.float64).ravel()
    if meta["nodata"] is not None:
        v = np.where(v == meta["nodata"], np.nan, v)
    keep = ~np.isnan(v)
    pdf = pd.DataFrame({"raster": name, "row": r.ravel()[keep].astype(np.int32), "col": c.ravel()[keep].astype(np.int32), "value": v[keep]})
    return pdf.assign(**{k: meta[k] for k in ("x0", "y0", "dx", "dy")})


_CELLS = "raster string, row int, col int, value double, x0 double, y0 double, dx double, dy double"


def tiff_cells(files: DataFrame, name: str = "path", content: str = "content") -> DataFrame:
    """raster (the last part of the name), row, col, value, x0, y0, dx, dy of files given as bytes; cells without data
    are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, data in zip(pdf["name"], pdf["content"], strict=True):
                band, meta = read_tiff(data)
                yield _cells(band, meta, p.rsplit("/", 1)[-1])

    return files.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInPandas(run, _CELLS)


def geotiff_cells(spark: SparkSession, path: str) -> DataFrame:
    """The same of the GeoTIFF files at ``path``."""
    return tiff_cells(spark.read.format("binaryFile").load(path).select("path", "content"))


#: Cells of the box that one GeoTIFF may hold (8 bytes each in one task).
LARGEST = 100_000_000


def geotiffs(cells: DataFrame, x0: float, y0: float, dx: float, dy: float, nodata: float = -9999.0, by: str = "raster", largest: int = LARGEST) -> DataFrame:
    """``by``, row, col (of the first cell) and content: a float32 GeoTIFF for each raster, over the box from row and
    column 0 of its cells (``by``, row, col, value). For a raster of more than ``largest`` cells give ``by`` a tile."""
    kind = cells.schema[by].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        top, left = min(0, int(r.min())), min(0, int(c.min()))
        shape = int(r.max()) - top + 1, int(c.max()) - left + 1
        if shape[0] * shape[1] > largest:
            raise ValueError(f"a raster of {shape[0]} x {shape[1]} cells is too large for one file")
        band = np.full(shape, nodata, np.float32)
        band[r - top, c - left] = pdf["value"].fillna(nodata)
        return pd.DataFrame({by: [pdf[by].iloc[0]], "row": [top], "col": [left], "content": [write_tiff(band, x0 + left * dx, y0 - top * dy, dx, dy, nodata)]})

    return cells.select(by, "row", "col", "value").groupBy(by).applyInPandas(run, f"{by} {kind}, row int, col int, content binary")


def ascii_grid_cells(spark: SparkSession, path: str) -> DataFrame:
    """The same from ESRI ASCII grids."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, text in zip(pdf["path"], pdf["value"], strict=True):
                lines = text.split("\n")
                head = {k.lower(): float(v) for k, v in (x.split() for x in lines[:6] if x and x.split()[0][0].isalpha())}
                n = len(head)
                band = np.array(" ".join(lines[n:]).split(), float).reshape(int(head["nrows"]), int(head["ncols"]))
                s = head["cellsize"]
                yield _cells(band, {"x0": head["xllcorner"], "y0": head["yllcorner"] + s * band.shape[0], "dx": s, "dy": s, "nodata": head.get("nodata_value")}, p.rsplit("/", 1)[-1])

    return files.mapInPandas(run, "raster string, row int, col int, value double, x0 double, y0 double, dx double, dy double")


def month_index(cells: DataFrame, year: str = "year", band: str = "band", first: int = 1991) -> DataFrame:
    """Monthly bands of yearly files as one series: month 0, 1, ... from January of the first year."""
    return cells.withColumn("month", (F.col(year) - first) * 12 + F.col(band) - 1)
