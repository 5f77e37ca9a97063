"""Readers of landed files, and tables stored in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master without it gets a temporary folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = f"file://{tempfile.mkdtemp(prefix='cellgrove-')}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_path(spark: SparkSession, label: str = "table") -> str:
    return f"{shared_folder(spark)}/cellgrove/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written as Parquet and read back: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Workspace:
    """Tables of one computation, in a folder that goes at the end of the ``with`` block. A table put under a used name
    takes the place of the earlier one, which goes once the new one is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, new_path(spark, "work")
        self.paths: dict[str, str] = {}

    def __enter__(self) -> Workspace:
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


class Latest:
    """Stores versions of one table; the one before goes once the next is written. For loops that make each
    version from the last: nothing else may still read an older one."""

    def __init__(self, label: str = "rounds"):
        self.label, self.path = label, None

    def __call__(self, df: DataFrame) -> DataFrame:
        spark, path = df.sparkSession, new_path(df.sparkSession, self.label)
        df.write.parquet(path)
        if self.path:
            discard(spark, self.path)
        self.path = path
        return spark.read.schema(df.schema).parquet(path)
