"""Benchmark decontamination: a broadcast hash set of normalised test n-grams and one map-only scan.

Every window of ``window`` consecutive words of a benchmark item is hashed; items with fewer words
are one window of their own length. Workers hash all word windows of each text with numpy, probe the
sorted hash set, and compare the words themselves before a hit counts. No shuffle takes place.

Defined results: null or empty texts have no words and are clean; an item without words matches
nothing; an empty benchmark leaves all documents clean; repeated rows are each reported; items that
share an item_id count once for a document; items without an item_id are searched like all others, count as
one item together and are left out of the item list (items_sha256); extra columns are ignored (report) or kept
(removal), whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store
from .columns import free_name
from .words import ALNUM, SMALL_CHUNK, Words, chunks, utf8

WINDOW = 10
#: Benchmark text that one broadcast may hold, with about 28 bytes a window besides; a larger benchmark is scanned in
#: several such parts, one after the other.
PART_BYTES = 16 << 20


class _Grams:
    """The windows of one part of the benchmark, as sent to the executors: for each length sorted hashes, and of each
    window its item and its place in the words of all items."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.names: list[str | None] = []
        texts, at, found = [], 0, defaultdict(list)
        for item, text in items:
            w = Words([text], ALNUM)
            n = len(w.starts)
            if not n:
                continue
            k = min(window, n)
            hashes, first = w.runs(k)
            sizes = w.ends - w.starts
            begin = at + np.cumsum(sizes + 1) - sizes - 1
            found[k].append((hashes, begin[first], begin[first + k - 1] + sizes[first + k - 1], np.full(len(first), len(self.names), np.int32)))
            texts.append(w.text(0, n))
            at += len(texts[-1]) + 1
            self.names.append(item)
        self.words = b" ".join(texts)
        self.by_length = {}
        for k, parts in found.items():
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            order = np.argsort(columns[0], kind="stable")
            self.by_length[k] = tuple(c[order] for c in columns)
        #: 2^20 flags by the low bits: most windows are turned away by one look-up.
        self.flags = {}
        for k, (hashes, *_) in self.by_length.items():
            self.flags[k] = np.zeros(1 << 20, bool)
            self.flags[k][hashes & np.uint64((1 << 20) - 1)] = True

    def scan(self, w: Words) -> tuple[np.ndarray, dict[int, set[str | None]]]:
        """Hit words as a mask, and the items by text."""
        mask, items = np.zeros(len(w.starts), bool), defaultdict(set)
        for k, (known, begin, end, owner) in self.by_length.items():
            hashes, at = w.runs(k)
            maybe = np.flatnonzero(self.flags[k][hashes & np.uint64((1 << 20) - 1)])
            hashes, at = hashes[maybe], at[maybe]
            low, high = np.searchsorted(known, hashes), np.searchsorted(known, hashes, "right")
            for i in np.flatnonzero(high > low):
                own, a = w.text(at[i], at[i] + k), at[i]
                if names := {self.names[owner[j]] for j in range(low[i], high[i]) if self.words[begin[j] : end[j]] == own}:
                    mask[a : a + k] = True
                    items[int(np.searchsorted(w.first, a, "right")) - 1].update(names)
        return mask, items


_SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))


def _parts(benchmark: DataFrame, item: str, text: str) -> list[DataFrame]:
    """The benchmark (item, text) in parts of about PART_BYTES of text (one at least)."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // PART_BYTES))
    return [rows] if n == 1 else [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)]


def _nulls_last(item: str | None) -> tuple[bool, str]:
    return item is None, item or ""


def _mark(df: DataFrame, grams) -> DataFrame:
    """Add this part's hit words (ranges of word indices) and items to the columns runs and items."""
    fields = df.schema.names
    keep = ["doc", "text"]
    schema = T.StructType([*(df.schema[f] for f in keep), T.StructField("words", T.LongType()), T.StructField("runs", _SPANS), T.StructField("items", T.ArrayType(T.StringType()))])
    types = [pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = grams.value
        for batch in batches:
            texts = utf8(batch.column("text"))
            n_words, runs, items = [], [], []
            for begin, end in chunks(texts, SMALL_CHUNK):
                w = Words(texts[begin:end], ALNUM)
                mask, found = g.scan(w)
                for i in range(end - begin):
                    a, b = w.first[i], w.first[i + 1]
                    n_words.append(int(b - a))
                    if i not in found:
                        runs.append([])
                        items.append([])
                        continue
                    edges = np.flatnonzero(np.diff(mask[a:b].astype(np.int8), prepend=0, append=0))
                    runs.append([{"begin": int(x), "end": int(y)} for x, y in zip(edges[0::2], edges[1::2], strict=True)])
                    items.append(sorted(found[i], key=_nulls_last))
            if "runs" in fields:
                runs = [[*(x or []), *y] for x, y in zip(batch.column("runs").to_pylist(), runs, strict=True)]
                items = [sorted({*(x or []), *y}, key=_nulls_last) for x, y in zip(batch.column("items").to_pylist(), items, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in keep), *(pa.array(v, t) for v, t in zip((n_words, runs, items), types, strict=True))], names=schema.names)

    return df.mapInArrow(run, schema)


def scan(docs: DataFrame, benchmark: DataFrame, *, carry: list[str], text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """For each row ``doc`` (a struct of the ``carry`` columns), ``text``, ``words`` (their number), ``runs`` (ranges of
    hit word indices, end exclusive; ranges of several benchmark parts may overlap) and ``items``."""
    out = docs.select(F.struct(*(F.col(c) for c in carry)).alias("doc"), F.col(text).alias("text"))
    parts = _parts(benchmark, item, item_text)
    for part in parts:
        # at most PART_BYTES of text, and only this part's windows, at a time
        grams = docs.sparkSession.sparkContext.broadcast(_Grams([(r.item, r.text.encode()) for r in part.toLocalIterator()], window))
        out = _mark(out, grams)
        if len(parts) > 1:
            out = store.written(out, "decontaminate")
            grams.destroy()
    return out


def report(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = scan(docs, benchmark, carry=[key], text=text, item=item, item_text=item_text, window=window)
    # ranges sorted by begin: a word counts where no earlier range has covered it
    hit = F.aggregate(
        F.array_sort("runs"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda s, r: F.struct((s.n + F.greatest(F.lit(0).cast("long"), r.end - F.greatest(r.begin, s.upto))).alias("n"), F.greatest(s.upto, r.end).alias("upto")),
        lambda s: s.n,
    )
    return marked.select(
        F.col("doc").getField(key).alias(key),
        F.col("words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **names) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns stay."""
    marked = scan(docs, benchmark, carry=docs.columns, text=text, **names)
    return marked.where(F.size("runs") == 0).select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **names) -> DataFrame:
    """``docs`` with the hit words cut out of the text (up to the next word); all columns stay, and
    ``removed_words`` (long) is added, as removed_words_1 and so on if the name is taken. Texts without a hit are
    returned unchanged."""
    marked = scan(docs, benchmark, carry=docs.columns, text=text, **names)
    schema = T.StructType([marked.schema["doc"], T.StructField("clean", T.StringType()), T.StructField("removed", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, runs = utf8(batch.column("text")), batch.column("runs").to_pylist()
            out, removed = batch.column("text").to_pylist(), []
            for i, (t, spans) in enumerate(zip(raw, runs, strict=True)):
                gone = 0
                if spans:
                    w = Words([t], ALNUM)
                    keep = np.ones(len(t), bool)
                    hit = np.zeros(len(w.starts) + 1, bool)
                    for s in spans:
                        hit[s["begin"] : s["end"]] = True
                    until = np.append(w.starts[1:], len(t))
                    for k in np.flatnonzero(hit):
                        keep[w.starts[k] : until[k]] = False
                    gone = int(hit.sum())
                    out[i] = np.frombuffer(t, np.uint8)[keep].tobytes().decode("utf-8", "replace")
                removed.append(gone)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, pa.string()), pa.array(removed, pa.int64())], names=schema.names)

    cleaned = marked.mapInArrow(cut, schema)
    own = lambda c: F.col("clean") if c == text else F.col("doc").getField(c)
    return cleaned.select(*(own(c).alias(c) for c in docs.columns), F.col("removed").alias(free_name("removed_words", docs.columns)))
