"""NetCDF-3 (classic) files by record slabs.

Only the header of a file is read to list the slabs of a variable, one for each step of its first dimension (or the
record dimension); a task reads the byte ranges of some slabs. NetCDF-4 is another format (HDF5) and is refused.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tiff import TASK_BYTES, Read, opened

#: Types by number: byte, char, short, int, float, double; and what stands for no data by default.
_TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}
_FILL = {1: -127, 3: -32767, 4: -2147483647, 5: 9.969209968386869e36, 6: 9.969209968386869e36}
_SLABS = "path string, step int, at long, size long, kind string, height int, width int, fill double, scale double, shift double"
_CELLS = "file string, step int, row int, col int, value double"


class Header:
    """Dimensions (name to length), attributes and variables of a file."""

    def __init__(self, read: Read):
        self.read, self.at, self.block = read, 0, b""
        magic = self._take(4)
        if magic[:3] != b"CDF" or magic[3] not in (1, 2):
            raise ValueError("not a classic NetCDF file (NetCDF-4 isn't read)")
        self.wide = magic[3] == 2
        self.records = self._int()
        self.dimensions = self._list(10, lambda: (self._name(), self._int()))
        self.attributes = dict(self._list(12, self._attribute))
        self.variables = {v["name"]: v for v in self._list(11, self._variable)}
        records = [v for v in self.variables.values() if v["record"]]
        for v in self.variables.values():
            # a single record variable isn't padded
            v["step"] = sum(x["size"] for x in records) if len(records) > 1 else v["bytes"]

    def _take(self, n: int) -> bytes:
        while len(self.block) < self.at + n:
            more = self.read(len(self.block), max(1 << 16, n))
            if not more:
                raise ValueError("the file ends within its header")
            self.block += more
        out = self.block[self.at : self.at + n]
        self.at += n
        return out

    def _int(self) -> int:
        return struct.unpack(">I", self._take(4))[0]

    def _name(self) -> str:
        n = self._int()
        return self._take(n + -n % 4)[:n].decode()

    def _list(self, tag: int, item) -> list:
        found, n = self._int(), self._int()
        if found not in (0, tag):
            raise ValueError("the header can't be read")
        return [item() for _ in range(n)]

    def _attribute(self) -> tuple:
        name, kind, n = self._name(), self._int(), self._int()
        size = np.dtype(_TYPES[kind]).itemsize * n
        data = self._take(size + -size % 4)[:size]
        return name, data.decode("utf-8", "replace") if kind == 2 else np.frombuffer(data, _TYPES[kind])

    def _variable(self) -> dict:
        name = self._name()
        ids = [self._int() for _ in range(self._int())]
        own, kind, size = dict(self._list(12, self._attribute)), self._int(), self._int()
        begin = struct.unpack(">Q", self._take(8))[0] if self.wide else self._int()
        shape = [self.dimensions[i][1] for i in ids]
        record = bool(ids) and shape[0] == 0
        inner = int(np.prod(shape[1:] if record or len(shape) > 2 else shape, dtype=np.int64)) * np.dtype(_TYPES[kind]).itemsize
        return {"name": name, "shape": shape, "attributes": own, "kind": kind, "size": size, "begin": begin, "record": record, "bytes": inner}


def slab_rows(path: str, read: Read, variable: str) -> pd.DataFrame:
    head = Header(read)
    if variable not in head.variables:
        raise ValueError(f"{path} has no variable {variable}")
    v = head.variables[variable]
    if len(v["shape"]) not in (2, 3) or v["kind"] == 2 or (v["record"] and len(v["shape"]) != 3):
        raise ValueError(f"{variable} is no grid or series of grids")
    height, width = v["shape"][-2:]
    steps = head.records if v["record"] else v["shape"][0] if len(v["shape"]) == 3 else 1
    a = v["attributes"]
    one = lambda name, other: float(a[name][0]) if name in a and not isinstance(a[name], str) else other
    at = v["begin"] + np.arange(steps, dtype=np.int64) * (v["step"] if v["record"] else v["bytes"])
    return pd.DataFrame({
        "path": path, "step": np.arange(steps), "at": at, "size": v["bytes"], "kind": _TYPES[v["kind"]], "height": height, "width": width,
        "fill": one("_FillValue", one("missing_value", float(_FILL[v["kind"]]))), "scale": one("scale_factor", 1.0), "shift": one("add_offset", 0.0),
    })


def slabs(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """The slabs of a variable (time, row, col or row, col) of the files at ``path``. Only headers are read; steps can be
    chosen by ``step`` before anything else is."""
    files = spark.read.format("binaryFile").load(path).select("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["path"]:
                yield slab_rows(p, opened(p), variable)

    return files.mapInPandas(run, _SLABS)


def cells(found: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """file (the last part of the path), step, row, col, value of ``slabs``, scaled; cells without data are left out."""
    total = found.agg(F.sum("size")).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, own in pdf.groupby("path", sort=False):
                read = opened(p)
                for s in own.itertuples():
                    raw = np.frombuffer(read(s.at, s.size), s.kind).reshape(s.height, s.width).astype(np.float64)
                    i, j = np.nonzero(~np.isnan(raw) & (raw != s.fill))
                    yield pd.DataFrame({"file": p.rsplit("/", 1)[-1], "step": s.step, "row": i.astype(np.int32), "col": j.astype(np.int32), "value": raw[i, j] * s.scale + s.shift})

    return found.repartition(max(1, -(-total // task_bytes)), "path", "step").mapInPandas(run, _CELLS)


def written(series: dict[str, np.ndarray], attributes: dict[str, dict[str, float]] | None = None, record: bool = True) -> bytes:
    """A classic file of variables (steps, rows, columns) of one shape (16- or 32-bit integers, floats); the first dimension
    is the record dimension unless ``record`` is false."""
    steps, height, width = next(iter(series.values())).shape
    name = lambda x: struct.pack(">I", len(x)) + x.encode() + b"\0" * (-len(x) % 4)
    kinds = {n: {"i2": 3, "i4": 4, "f4": 5, "f8": 6}[v.dtype.str[1:]] for n, v in series.items()}
    slab = {n: height * width * np.dtype(_TYPES[k]).itemsize for n, k in kinds.items()}
    padded = {n: s + -s % 4 if len(series) > 1 or not record else s for n, s in slab.items()}

    def attribute(key: str, value: float, kind: int) -> bytes:
        data = np.array([value], _TYPES[kind]).tobytes()
        return name(key) + struct.pack(">II", kind, 1) + data + b"\0" * (-len(data) % 4)

    def head(begins: dict[str, int]) -> bytes:
        out = b"CDF\1" + struct.pack(">I", steps if record else 0) + struct.pack(">II", 10, 3)
        out += name("time") + struct.pack(">I", 0 if record else steps) + name("lat") + struct.pack(">I", height) + name("lon") + struct.pack(">I", width)
        out += struct.pack(">II", 0, 0) + struct.pack(">II", 11, len(series))
        for n, k in kinds.items():
            own = (attributes or {}).get(n, {})
            own_bytes = b"".join(attribute(a, v, k if a == "_FillValue" else 6) for a, v in own.items())
            whole = padded[n] if record else slab[n] * steps + -(slab[n] * steps) % 4
            out += name(n) + struct.pack(">IIII", 3, 0, 1, 2) + struct.pack(">II", 12 if own else 0, len(own)) + own_bytes + struct.pack(">III", k, whole, begins[n])
        return out

    at, begins = len(head(dict.fromkeys(series, 0))), {}
    for n in series:
        begins[n] = at
        at += padded[n] if record else slab[n] * steps + -(slab[n] * steps) % 4
    body = []
    if record:
        for t in range(steps):
            for n, v in series.items():
                body.append(v[t].astype(_TYPES[kinds[n]]).tobytes().ljust(padded[n], b"\0"))
    else:
        body = [v.astype(_TYPES[kinds[n]]).tobytes() + b"\0" * (-(slab[n] * steps) % 4) for n, v in series.items()]
    return head(begins) + b"".join(body)
