"""Files copied by tasks: uploads that skip what is there, caches of what is needed."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stored
from .tiff import _uri


def mirrored(files: DataFrame, source: str, target: str, path: str = "path", tasks: int = 8) -> DataFrame:
    """path, size, status, error of each distinct file (a path within ``source``), copied to the same path within
    ``target``: "same" if it is there in the same size, "copied" if it was copied and then has that size, "failed" with
    the error otherwise; the others go on. A copy is there whole or not at all, so a task may run again. The report is
    written to the shared folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (a, top), (b, out) = fs.FileSystem.from_uri(_uri(source)), fs.FileSystem.from_uri(_uri(target))
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                own, there, part = f"{top}/{p}", f"{out}/{p}", f"{out}/{p}.{uuid.uuid4().hex}"
                size, status, error = None, "failed", None
                try:
                    info = a.get_file_info(own)
                    if not info.is_file:
                        raise FileNotFoundError(f"no file {p}")
                    size = info.size
                    if b.get_file_info(there).size == size:
                        status = "same"
                    else:
                        b.create_dir(there.rsplit("/", 1)[0])
                        with a.open_input_stream(own) as x, b.open_output_stream(part) as y:
                            while block := x.read(1 << 20):
                                y.write(block)
                        if (found := b.get_file_info(part).size) != size:
                            raise OSError(f"{found} of {size} bytes arrived")
                        b.move(part, there)
                        status = "copied"
                except OSError as e:
                    error = str(e)
                rows.append((p, size, status, error))
            yield pd.DataFrame(rows, columns=["path", "size", "status", "error"])

    each = files.select(F.col(path).alias("path")).where("path is not null").distinct().repartition(tasks, "path")
    return stored(each.mapInPandas(run, "path string, size long, status string, error string"), "copies")
