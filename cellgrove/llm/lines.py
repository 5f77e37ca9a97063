"""Substring dedup by line (or paragraph) hashing.

Each text is cut into units: paragraphs, lines, or lines cut further after sentences (".", "!" or "?" and a
space), which is what finds a passage in a line that was edited elsewhere. A unit is normalised (ASCII letters
lower-cased, white space collapsed) and digested (128 bits); digests are grouped over the whole table, and the
document with the smallest key keeps a unit. In every other document the unit is a repeat. Repeats are removed in
runs: consecutive repeats (units without words between them included) of ``run_words`` words or more in all. So
long passages go, in whatever short lines they are written, while a stock phrase, a license line or a chance
repeat in other text stays. Offsets are those of the original text.

Only digests, never texts, are grouped. A document gives each of its digests once, frequent ones are counted
map-side before they are dealt out, and joining the frequent ones back is an ordinary equi-join of two stored
tables with one row per digest on one side, which adaptive execution splits where a digest is hot.

Defined results: null texts are empty and have no units; rows of one key are one document: what they repeat of
each other stays, and what they repeat of others goes from each; rows with a null key are left as they are and keep
nothing for others; units repeated within one document only stay; an empty table gives no rows; extra columns
stay (deduplicate) or are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store
from .columns import free_name
from .words import SPACED, Words, _power, chunks, mix, utf8

UNIT = "sentence"
#: Words of a run of repeats that is removed. Below about 15 chance repeats go too; above 50 a passage whose middle was
#: edited stays. README states the figures.
RUN_WORDS = 30
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


@dataclass
class Units:
    """The units of several texts: byte ``start`` and ``end`` in all of them joined by spaces, the text each belongs
    to, its number of words and its digest in two halves."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    words: np.ndarray
    high: np.ndarray
    low: np.ndarray


def _breaks(data: np.ndarray, unit: str) -> np.ndarray:
    """The places at which a unit ends, each with its last byte."""
    newline = data == 0x0A
    if unit == "line":
        return np.flatnonzero(newline)
    if unit == "sentence":
        stop = np.zeros(len(data), bool)
        stop[1:] = (data[1:] == 0x20) & _STOP[data[:-1]]
        return np.flatnonzero(newline | stop)
    # a paragraph ends with an empty or blank line
    at = np.flatnonzero(newline)
    solid = np.maximum.accumulate(np.where(_BLANK[data], -1, np.arange(len(data))))
    return at[(at > 0) & newline[solid[at - 1]] & (solid[at - 1] >= 0)]


def cut(texts: list[bytes], unit: str = UNIT) -> Units:
    w = Words(texts, SPACED)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    start = np.unique(np.concatenate([offsets[:-1], _breaks(w.data, unit) + 1]))
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start < offsets[np.minimum(text + 1, len(texts))] - 1
    start, text = start[inside], text[inside]
    end = np.minimum(np.append(start[1:], len(w.data)), offsets[text + 1] - 1)
    a, b = np.searchsorted(w.starts, start), np.searchsorted(w.starts, end)
    up, down = _power(len(w.hashes) + 1)
    halves = []
    for seed in (1, 2):
        sums = np.zeros(len(w.hashes) + 1, np.uint64)
        np.cumsum(mix(w.hashes + np.uint64(seed)) * up[: len(w.hashes)], out=sums[1:])
        halves.append(mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)).view(np.int64))
    return Units(start, end, text, b - a, *halves)


def digests(docs: DataFrame, *, key: str = "doc_id", text: str = "text", unit: str = UNIT) -> DataFrame:
    """key, high, low (a digest), words (of all its units in this text); each digest of a text once."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = utf8(batch.column("text")), batch.column("key")
            for begin, end in chunks(texts):
                u = cut(texts[begin:end], unit)
                some = np.flatnonzero(u.words)
                order = some[np.lexsort((u.low[some], u.high[some], u.text[some]))]
                t, h, g, n = u.text[order], u.high[order], u.low[order], u.words[order]
                first = np.ones(len(order), bool)
                first[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1]) | (g[1:] != g[:-1])
                at = np.flatnonzero(first)
                total = np.add.reduceat(n, at) if len(at) else n
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(t[at] + begin)), pa.array(h[at]), pa.array(g[at]), pa.array(total.astype(np.int64))], names=["key", "high", "low", "words"])

    return rows.mapInArrow(run, f"key {kind}, high long, low long, words long")


def repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", unit: str = UNIT, run_words: int = RUN_WORDS) -> DataFrame:
    """Stored: key and its repeats (array of high, low, first: the key that keeps the unit), for each document with
    repeats of ``run_words`` words in all."""
    with store.Scratch(docs.sparkSession) as tables:
        found = tables.put("digests", digests(docs, key=key, text=text, unit=unit))
        frequent = found.groupBy("high", "low").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last")
        frequent = tables.put("frequent", frequent.drop("last"))
        again = found.join(frequent, ["high", "low"]).where("key <> first").distinct()
        by_key = again.groupBy("key").agg(F.sum("words").alias("words"), F.collect_list(F.struct("high", "low", "first")).alias("repeats"))
        return store.written(by_key.where(F.col("words") >= run_words).select("key", "repeats"), "repeats")


def _runs(words: list[int], again: list[bool], least: int) -> list[tuple[int, int, int]]:
    """First unit, last unit and words of each run of repeats of at least ``least`` words."""
    out, first, last, size = [], -1, -1, 0
    for i, (n, repeat) in enumerate(zip([*words, 1], [*again, False], strict=True)):
        if not n:
            continue
        if repeat:
            first, last, size = (i if first < 0 else first), i, size + n
            continue
        if first >= 0 and size >= least:
            out.append((first, last, size))
        first, size = -1, 0
    return out


def _cut_out(rows: DataFrame, kind: T.DataType, unit: str, least: int) -> DataFrame:
    """``rows`` (doc, text, repeats) as doc, clean (the text without its runs) and spans of them."""
    spans = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("start", T.LongType()), ("end", T.LongType()), ("words", T.LongType()), ("first_keys", T.ArrayType(kind)))]))
    schema = T.StructType([rows.schema["doc"], T.StructField("clean", T.StringType()), T.StructField("spans", spans)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, out = batch.column("text").to_pylist(), []
            for i, known in enumerate(batch.column("repeats").to_pylist()):
                found = []
                if known:
                    raw = clean[i].encode()
                    first = {(r["high"], r["low"]): r["first"] for r in known}
                    u = cut([raw], unit)
                    its = [first.get(x) for x in zip(u.high.tolist(), u.low.tolist(), strict=True)]
                    # offsets in code points: all bytes but those that go on with a character
                    points = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
                    for a, b, size in _runs(u.words.tolist(), [x is not None for x in its], least):
                        keys = sorted({x for x in its[a : b + 1] if x is not None})
                        found.append({"start": int(points[u.start[a]]), "end": int(points[u.end[b]]), "words": size, "first_keys": keys})
                    kept, at = [], 0
                    for s in found:
                        kept.append(clean[i][at : s["start"]])
                        at = s["end"]
                    clean[i] = "".join([*kept, clean[i][at:]])
                out.append(found)
            keys = pa.list_(batch.schema.field("repeats").type.value_type.field("first").type)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64()), ("first_keys", keys)])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(clean, pa.string()), pa.array(out, pa.list_(span))], names=["doc", "clean", "spans"])

    return rows.mapInArrow(run, schema)


def _cleaned(docs: DataFrame, key: str, text: str, unit: str, run_words: int, columns: list[str]) -> DataFrame:
    known = repeats(docs, key=key, text=text, unit=unit, run_words=run_words)
    rows = docs.select(F.struct(*(docs[c] for c in columns)).alias("doc"), docs[key].alias("own"), F.coalesce(docs[text], F.lit("")).alias("text"))
    joined = rows.join(known, F.col("own") == F.col("key"), "left").select("doc", "text", "repeats")
    return _cut_out(joined, docs.schema[key].dataType, unit, run_words)


def deduplicate(docs: DataFrame, *, key: str = "doc_id", text: str = "text", unit: str = UNIT, run_words: int = RUN_WORDS) -> DataFrame:
    """``docs`` with repeats cut out of the texts; all columns stay, and ``removed_spans`` (array of start, end, words,
    first_keys; original offsets in code points) is added, as removed_spans_1 and so on if the name is taken. A
    null text comes back as null."""
    out = _cleaned(docs, key, text, unit, run_words, docs.columns)
    own = lambda c: F.col("doc").getField(c)
    return out.select(*((F.when(own(c).isNotNull(), F.col("clean")) if c == text else own(c)).alias(c) for c in docs.columns), F.col("spans").alias(free_name("removed_spans", docs.columns)))


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", unit: str = UNIT, run_words: int = RUN_WORDS) -> DataFrame:
    """key, n_removed (runs), removed_words, removed_chars, spans ("start:end", comma-joined), first_docs (keys
    that keep the removed units, comma-joined), clean_chars, clean_sha256; one row per document."""
    clean = _cleaned(docs, key, text, unit, run_words, [key])
    total = lambda f: F.aggregate(F.transform("spans", f), F.lit(0).cast("long"), lambda a, x: a + x)
    return clean.select(
        F.col("doc").getField(key).alias(key),
        F.size("spans").cast("long").alias("n_removed"),
        total(lambda x: x.words).alias("removed_words"),
        total(lambda x: x.end - x.start).alias("removed_chars"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x.start.cast("string"), x.end.cast("string"))), ",").alias("spans"),
        F.array_join(F.transform(F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda x: x.first_keys)))), lambda k: k.cast("string")), ",").alias("first_docs"),
        F.char_length("clean").cast("long").alias("clean_chars"),
        F.sha2("clean", 256).alias("clean_sha256"),
    )
