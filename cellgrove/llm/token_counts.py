"""Token counts through a digest cache.

Counts are stored under (tokenizer digest, content digest), both SHA-256. A request joins the digests
of its documents to the stored counts; only digests without one are encoded, each once, and appended.
Contents are equal when their bytes are: no further normalisation is safe, as each character may
change the number of tokens; null counts as the empty text.

The cache is a Parquet folder; every append adds files and a reader takes one count per key, so two
writers that add the same key do no harm.

Defined results: empty and null texts have 0 tokens; repeated rows are each counted; an empty table
gives no rows and appends nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store, tokens

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
_SCHEMA = "tokenizer string, content binary, n_tokens long"


class CountCache:
    """Stored token counts in ``folder`` (by default a new one in the shared folder)."""

    def __init__(self, spark: SparkSession, folder: str | None = None, tokenizer: str | None = None):
        self.spark = spark
        self.folder = folder or store.new_path(spark, "token-counts")
        self.path = tokenizer or tokens.default_path(TOKENIZER)
        self.version = tokens.file_digest(self.path)
        if folder is None:
            spark.createDataFrame([], _SCHEMA).write.mode("append").parquet(self.folder)

    def stored(self) -> DataFrame:
        """content, n_tokens of this tokenizer's version."""
        rows = self.spark.read.schema(_SCHEMA).parquet(self.folder).where(F.col("tokenizer") == self.version)
        return rows.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))

    def encode(self, texts: DataFrame) -> DataFrame:
        """content, n_tokens of a table content, text."""
        path = self.path

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from .words import utf8

            counter = tokens.byte_bpe_counter(path)
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.count(utf8(batch.column(1))), pa.int64())], names=["content", "n_tokens"])

        return texts.mapInArrow(run, "content binary, n_tokens long")

    def count(self, docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
        """key, n_bytes, n_tokens for every row of ``docs``; new counts are appended to the cache."""
        body = F.coalesce(F.col(text), F.lit(""))
        digests = store.written(docs.select(F.col(key).alias("key"), F.unhex(F.sha2(body, 256)).alias("content"), F.octet_length(body).cast("long").alias("n_bytes")), "digests")
        # one row stands for each missing content; only its text goes on to the encoder
        missing = digests.groupBy("content").agg(F.min("key").alias("key")).join(self.stored(), "content", "left_anti")
        texts = docs.select(F.col(key).alias("key"), body.alias("text"), F.unhex(F.sha2(body, 256)).alias("content"))
        m = missing.select(F.col("key").alias("m_key"), F.col("content").alias("m_content")).hint("shuffle_hash")
        chosen = texts.join(m, (F.col("content") == F.col("m_content")) & F.col("key").eqNullSafe(F.col("m_key")), "left_semi").select("content", "text")
        new = self.encode(chosen)
        new.select(F.lit(self.version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(self.folder)
        return digests.join(self.stored(), "content").select(F.col("key").alias(key), "n_bytes", "n_tokens")


def token_counts(docs: DataFrame, *, cache: CountCache | None = None, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit."""
    cache = cache or CountCache(docs.sparkSession)
    return cache.count(docs, key=key, text=text).withColumn("over_limit", F.col("n_tokens") > limit)
