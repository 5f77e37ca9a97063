"""Tables written to the folder that all executors share, used to cut lineage and to keep state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only where that setting is absent and the master is local (as in tests) a temporary folder takes
    its place; a cluster without the setting is an error, as machine-local folders are not shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = f"file://{tempfile.mkdtemp(prefix='cellgrove-')}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


#: What the scopes that are open have written, the innermost last.
_OPEN: list[list[str]] = []


class Scope:
    """Deletes at the end of the ``with`` block all tables and folders that were made within it by ``written`` and
    ``new_path``, whoever asked for them; what shall stay gets its path before. Plans made within read nothing of it
    afterwards."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> Scope:
        _OPEN.append([])
        return self

    def __exit__(self, *_) -> None:
        for path in _OPEN.pop():
            discard(self.spark, path)


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/cellgrove/{label}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def written(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later plans start from the
    files, so a lost executor costs a re-read and never a recomputation."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Named intermediate tables of one computation, in a folder of their own that goes at the end of the
    ``with`` block. A table put under a used name takes the place of the earlier one, which is deleted as soon
    as the new one is written; nothing that outlives the block may read them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, new_path(spark, "scratch")
        self.paths: dict[str, str] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        discard(self.spark, self.folder)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        if name in self.paths:
            discard(self.spark, self.paths[name])
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            discard(self.spark, self.paths.pop(name))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared store has this file or folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store (best effort is not enough: errors surface)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
