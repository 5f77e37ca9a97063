"""How filters interact: a packed bitmap index of their failures, and what every order of them removes.

Every document gets one bit per filter (set where it fails) and per label. Within a partition of the table the
documents of a part stand together, from a whole 64-bit word on, so one AND-NOT over all words and a popcount per
part count what a set of filters lets through. A filter's effect after others depends on the set of those alone, not
on their order: the 32 subsets of five filters, summed over partitions, give all 120 orders and the Shapley shares.

Filters (failure conditions): A under 200 words; B fewer than half of the words distinct; C more than 3 % of the code
points in A-Z; D any of # $ % & * |; E the text is that of a smaller key, anywhere in the table, removed or not.

Defined results: a null text is empty, a null part the empty string; a row without a key never fails E and lets no
other fail it; repeated rows (same key and text) don't fail E by each other; a key with several label rows has a label
if one of them says 1; documents without a label row have none; an empty table gives no rows; extra columns are ignored.
Orders are counted for up to eight filters at once (``MOST``), as the subsets double with each.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .words import utf8

FILTERS = "ABCDE"
MOST = 8
_UPPER, _MARKS = bytes(range(0x41, 0x5B)), b"#$%&*|"
#: Bytes that go on a character of UTF-8.
_INNER = bytes(range(0x80, 0xC0))


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # at [\x20\x09-\x0D], as bytes are split at ASCII white space only
    points = len(text.translate(None, _INNER))
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, _UPPER))) > 3 * points) << 2
        | (len(text) != len(text.translate(None, _MARKS))) << 3
    )


def flags(docs: DataFrame, labels: DataFrame, tables: store.Scratch, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, fails (bit i: the i-th filter), good, toxic of every document. What each text fails is put into ``tables``,
    a few bytes and a digest a row: texts are read once and never shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(2))
            fails = pa.array([failures(t) for t in texts], pa.int32())
            marks = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fails, marks], names=["key", "part", "fails", "mark"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    own = tables.put("own", rows.mapInArrow(run, f"key {kind}, part string, fails int, mark binary"))
    # only texts held by several keys can fail E: one row for each of them, whatever its copies
    # (written, so that the join has a shuffle of its own on either side and a hot text can be split)
    held = tables.put("held", own.groupBy("mark").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most").select("mark", "least"))
    seen = labels.groupBy(F.col(key).alias("key")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    both = own.join(held, "mark", "left").join(seen, "key", "left")
    again = F.coalesce((F.col("key") > F.col("least")).cast("int"), F.lit(0))
    return both.select("part", (F.col("fails") + again * 16).alias("fails"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")))


def index(rows: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """The packed bitmap index of ``flags``: for each batch of rows part, n, and for each filter and label a bitmap
    (binary, whole 64-bit words, little-endian, the part's documents in one order for all of them)."""
    names = [*(f"filter_{i}" for i in range(n_filters)), "good", "toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            n = np.bincount(code, minlength=len(coded.dictionary))
            words = -(-n // 64)
            first = np.cumsum(words) - words
            place = np.repeat(first * 64 - (np.cumsum(n) - n), n) + np.arange(len(code))
            fails, labels = batch.column(1).to_numpy(), [batch.column(2).to_numpy(), batch.column(3).to_numpy()]
            columns = []
            for bit in [*(fails >> i & 1 for i in range(n_filters)), *labels]:
                bits = np.zeros(64 * int(words.sum()), np.uint8)
                bits[place] = bit[order]
                packed = np.packbits(bits, bitorder="little")
                columns.append(pa.array([packed[8 * a : 8 * (a + b)].tobytes() for a, b in zip(first.tolist(), words.tolist(), strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(n, pa.int64()), *columns], names=["part", "n", *names])

    return rows.select("part", "fails", "good", "toxic").mapInArrow(run, f"part string, n long, {', '.join(f'{c} binary' for c in names)}")


def subset_counts(bitmaps: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """part, subset (bits of filters), n, good, toxic: the documents of the part that pass every filter of the subset,
    and those of them with a label. Popcounts of a partition are summed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.frombuffer(b"".join(batch.column(2 + i).to_pylist()), "<u8") for i in range(n_filters + 2)]
            n = batch.column(1).to_numpy()
            words = -(-n // 64)
            first = np.cumsum(words) - words
            full = np.full(len(columns[0]), ~np.uint64(0))  # a part's last word may be used in part
            rest = n % 64
            full[(first + words - 1)[rest > 0]] = (np.uint64(1) << rest[rest > 0].astype(np.uint64)) - np.uint64(1)
            passed = {0: full}
            out = []
            for subset in range(1 << n_filters):
                if subset:
                    low = subset & -subset
                    passed[subset] = passed[subset ^ low] & ~columns[low.bit_length() - 1]
                kept = passed[subset]
                out.append([np.add.reduceat(np.bitwise_count(x).astype(np.int64), first) for x in (kept, kept & columns[-2], kept & columns[-1])])
            parts = batch.column(0).take(pa.array(np.tile(np.arange(len(n)), 1 << n_filters)))
            subsets = pa.array(np.repeat(np.arange(1 << n_filters, dtype=np.int32), len(n)))
            yield pa.RecordBatch.from_arrays([parts, subsets, *(pa.array(np.concatenate([x[k] for x in out])) for k in range(3))], names=["part", "subset", "n", "good", "toxic"])

    counted = bitmaps.mapInArrow(run, "part string, subset int, n long, good long, toxic long")
    return counted.groupBy("part", "subset").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def _steps(names: str) -> list[tuple]:
    """filter_order, step, bit, subset before, of every order."""
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for k, i in enumerate(order, 1):
            out.append(("".join(names[j] for j in order), k, 1 << i, before))
            before |= 1 << i
    return out


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for every part,
    order of all filters and step of it, from ``subset_counts``."""
    if len(names) > MOST:
        raise ValueError(f"at most {MOST} filters in every order")
    spark, size, every = counts.sparkSession, len(names), (1 << len(names)) - 1
    # one row for each set of filters and one more: at most 8 * 2^7 of them, and the orders as a table of a fixed size
    pairs = [(s, 1 << i, s | 1 << i, math.factorial(bin(s).count("1")) * math.factorial(size - 1 - bin(s).count("1"))) for s in range(every + 1) for i in range(size) if not s >> i & 1]
    moves = spark.createDataFrame(pairs, "before int, bit int, after int, orders long")
    steps = spark.createDataFrame(_steps(names), "filter_order string, step int, bit int, before int")
    one = counts.select("part", F.col("subset").alias("before"), *(F.col(c).alias(f"{c}_before") for c in ("n", "good", "toxic")))
    two = counts.select("part", F.col("subset").alias("after"), "n", "good", "toxic")
    gain = one.join(F.broadcast(moves), "before").join(two, ["part", "after"])
    gain = gain.select("part", "before", "bit", "orders", F.col("n").alias("kept"), (F.col("n_before") - F.col("n")).alias("removed"), *((F.col(f"{c}_before") - F.col(c)).alias(f"{c}_lost") for c in ("good", "toxic")))
    by_filter = gain.groupBy("part", "bit").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("before") + F.col("bit") == every, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * F.col("orders")).alias("shapley"),
    )
    out = gain.join(F.broadcast(steps), ["before", "bit"]).join(by_filter, ["part", "bit"])
    return out.select("part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


def report(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """``audit`` of a whole table. Only the counts, a row for each part and subset, stay in the shared folder."""
    with store.Scratch(docs.sparkSession) as tables:
        counts = store.written(subset_counts(index(flags(docs, labels, tables, **columns))), "filter-counts")
    return audit(counts)
