"""A training corpus from raw documents: filter, deduplicate, decontaminate, pack.

Every stage takes (spark, docs, sf_dir) and reads the whole table its predecessor left; the result is
written as Parquet and read again for the next one. All but the last return the columns of documents.

Defined results of the stages (drop_toxic, drop_copies, drop_near_copies, drop_contaminated, pack):

* null and empty texts are scored by the bias alone and stay; they are one group of exact copies, of which one row
  stays; they are no near copies, never contaminated, and are packed as the end token alone;
* a null doc_id is a key like any other; nulls in other columns are carried along;
* rows repeated with the same key and text are one row after drop_copies;
* of ties the smaller key stays, null first among exact copies and last among near copies;
* very long texts are read whole in every stage, and cut in pack only, at whole sequences;
* an empty table stays empty; without labels nothing is toxic, without a benchmark nothing is contaminated;
* further columns stay, whatever their names, up to pack, which returns its own.

Stages leave a session without a bound on the bytes of an Arrow batch with one of ``BATCH_BYTES``: it must hold when their
results are written. ``run`` takes it back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from cellgrove.llm import decontaminate, exact_dedup, ngram_join, packing, store, toxicity


#: Bytes of one Arrow batch: a task's texts come to its worker so many at a time, and not 10,000 rows, whatever their size.
BATCH_BYTES, _BOUND = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_small_batches(stage: Callable) -> Callable:
    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(_BOUND, None) is None:
            spark.conf.set(_BOUND, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return bounded


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove(docs, _table(spark, sf_dir, "labels"))


@_in_small_batches
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


@_in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicate(docs)


@_in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, _table(spark, sf_dir, "benchmark"))


@_in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Training, components and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus, in one table of the shared folder. A stage's table goes when the next one is written, and what
    a stage wrote on its way goes with it."""
    result, bound = store.new_path(spark, "pipeline"), spark.conf.get(_BOUND, None)
    try:
        with store.Scratch(spark) as tables:
            docs = _table(spark, sf_dir, "documents")
            for _, stage in STAGES[:-1]:
                with store.Scope(spark):
                    docs = tables.put("docs", stage(spark, docs, sf_dir))
            with store.Scope(spark):
                packed = STAGES[-1][1](spark, docs, sf_dir)
                packed.write.parquet(result)
    finally:
        if bound is None:
            spark.conf.unset(_BOUND)
    return spark.read.schema(packed.schema).parquet(result)
