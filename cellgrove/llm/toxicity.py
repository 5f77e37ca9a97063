"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams (with word ends marked) and itself, each hashed to a row of an
embedding table; a document is the mean of its words' mean vectors; a linear softmax gives the two
classes. Embeddings and softmax are trained jointly in numpy, so a misspelling never seen is scored by
the n-grams it shares with words that were.

Fitting takes a bounded sample of labelled rows (``toxic``, ``clean`` and ``most_bytes`` of ``sample``; of each
class the rows with the smallest hash of the key, wherever they lie in the table, weighted back to the classes'
shares) and learns from every word of it, however rare, in one task; only the folded table, of a fixed size, comes
to the driver. Scoring reads every whole text: as the softmax of a mean is linear before its last step, each table
row is folded into one number and workers keep the numbers of words in a bounded table. The mean of a text counts
``PRIOR_WORDS`` neutral words besides its own.

Defined results: null or empty texts get the score of the bias alone; several labels of one key are
averaged (0.5 and more is toxic); without labels of both classes every score is the share of toxic
labels, 0 if there are none; repeated rows are each scored; extra columns are ignored or kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import free_name
from .words import _BYTE_VALUE, ALNUM, SMALL_CHUNK, Words, _power, chunks, mix, utf8

SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES = 1600, 2800, 24 << 20
#: Rows of the embedding table, and their width.
BUCKET_BITS, WIDTH = 18, 4
GRAMS = (3, 4, 5, 6)
#: Weight decay: the least summed loss (sf0.1, check_s) among 1e-6, 3e-6, 1e-5 and 3e-5 on rows whose crc32 modulo 5 is 1, learned from 2, 3 and 4.
STEPS, RATE, DECAY, GAIN = 80, 0.1, 1e-5, 60.0
#: A mean counts so many neutral words besides a text's own, so a few odd ones don't decide on a short text.
PRIOR_WORDS = 20
#: Words (or table rows) handled at a time while training.
BLOCK_WORDS = 10_000
#: Words a worker's table may hold.
TABLE_ROWS = 400_000


def held_out(key: Column) -> Column:
    """The fold that is never learned from: crc32 of the key as text, modulo 5, is 0."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all words' subwords, flat, and where each word's begin."""
    marked = [b"<" + w + b">" for w in words]
    sizes = np.array([len(m) for m in marked], np.int64)
    data = np.frombuffer(b"".join(marked), np.uint8)
    begin = np.cumsum(sizes) - sizes
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    hashes, owners = [mix((sums[begin + sizes] - sums[begin]) * down[begin] + np.uint64(99))], [np.arange(len(words))]
    of = np.repeat(np.arange(len(words)), sizes)
    last = np.repeat(begin + sizes, sizes)
    place = np.arange(len(data))
    for n in GRAMS:
        at = np.flatnonzero(place + n <= last)
        hashes.append(mix((sums[at + n] - sums[at]) * down[at] + np.uint64(n)))
        owners.append(of[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    rows = (np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)[order]
    return rows, np.searchsorted(owner[order], np.arange(len(words)))


@dataclass
class Model:
    """One number per table row (the difference of the two classes' logits) and the bias."""

    weight: np.ndarray
    bias: float

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        rows, begin = subwords(words)
        sums = np.add.reduceat(self.weight[rows], begin)
        return sums / np.diff(np.append(begin, len(rows)))


def _gathered(x: np.ndarray, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """np.add.reduceat(x[at], begin) in blocks, so that x[at] is never held as a whole."""
    out = np.empty((len(begin), x.shape[1]), x.dtype)
    for a in range(0, len(begin), BLOCK_WORDS):
        b = min(a + BLOCK_WORDS, len(begin))
        first, last = begin[a], begin[b] if b < len(begin) else len(at)
        out[a:b] = np.add.reduceat(x[at[first:last]], begin[a:b] - first)
    return out


def train(texts: list[bytes], labels: np.ndarray, share: float, seed: int = 0) -> Model:
    """Full-batch Adam on embeddings and softmax together. ``share``: of toxic rows in the population."""
    labels = np.asarray(labels, np.int64)
    if not len(labels) or labels.min() == labels.max():
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(p / (1 - p))))
    # every word of the sample gets a number as it comes, and its table rows at once: words themselves aren't kept
    known, number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and their words' numbers
    rows, sizes, docs, words, values = [], [], [], [], []
    for begin, end in chunks(texts):
        w = Words(texts[begin:end], ALNUM)
        each, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        fresh = np.flatnonzero(~np.isin(each, known, assume_unique=True))
        for at in range(0, len(fresh), BLOCK_WORDS):
            place = first[fresh[at : at + BLOCK_WORDS]]
            some, start = subwords([w.data[i:j].tobytes() for i, j in zip(w.starts[place].tolist(), w.ends[place].tolist(), strict=True)])
            rows.append(some)
            sizes.append(np.diff(np.append(start, len(some))).astype(np.int32))
        where = np.searchsorted(known, each[fresh])
        number = np.insert(number, where, np.arange(len(known), len(known) + len(fresh), dtype=np.int32))
        known = np.insert(known, where, each[fresh])
        of = number[np.searchsorted(known, each)][back]
        for i in range(end - begin):
            mine, n = np.unique(of[w.first[i] : w.first[i + 1]], return_counts=True)
            docs.append(np.full(len(mine), begin + i, np.int32))
            words.append(mine)
            values.append((n / (n.sum() + PRIOR_WORDS)).astype(np.float32))
    n_words = len(known)
    del known, number
    doc, word, value = (np.concatenate(x) for x in (docs, words, values))
    del docs, words, values
    by_word = np.argsort(word, kind="stable").astype(np.int32)
    word_begin = np.searchsorted(word[by_word], np.arange(n_words))
    some = np.flatnonzero(np.bincount(doc, minlength=len(texts)))
    doc_begin = np.searchsorted(doc, some)
    rows, sizes = np.concatenate([np.zeros(0, np.int32), *rows]), np.concatenate([np.zeros(0, np.int32), *sizes])
    begin = np.cumsum(sizes, dtype=np.int64) - sizes
    counts = np.bincount(rows, minlength=1 << BUCKET_BITS)
    used = np.flatnonzero(counts)  # only these table rows are trained
    rank = (np.cumsum(counts > 0, dtype=np.int32) - 1).astype(np.int32)
    for at in range(0, len(rows), 1 << 20):
        rows[at : at + (1 << 20)] = rank[rows[at : at + (1 << 20)]]
    # the words of each table row, sorted a range of rows at a time: the whole order would take twice the room
    row_begin = np.append(0, np.cumsum(counts[used]))
    owner, word_by_row = np.repeat(np.arange(n_words, dtype=np.int32), sizes), np.empty(len(rows), np.int32)
    step = -(-len(used) // 16)
    for low in range(0, len(used), step):
        high = min(low + step, len(used))
        at = np.flatnonzero((rows >= low) & (rows < high))
        word_by_row[row_begin[low] : row_begin[high]] = owner[at[np.argsort(rows[at], kind="stable")]]
    del owner, counts
    row_begin = row_begin[:-1]

    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.05, (len(used), WIDTH)).astype(np.float32)
    out = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    p = labels.mean()
    balance = np.where(labels == 1, share / p, (1 - share) / (1 - p)).astype(np.float32)
    balance /= balance.sum()
    bias = np.log(np.array([1 - share, share], np.float32))
    target = np.eye(2, dtype=np.float32)[labels]
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (e, out, bias)]
    inverse = (1 / sizes).astype(np.float32)[:, None]
    for step in range(1, STEPS + 1):
        vectors = _gathered(e, rows, begin) * inverse
        h = np.zeros((len(texts), WIDTH), np.float32)
        h[some] = np.add.reduceat(vectors[word] * value[:, None], doc_begin) * GAIN
        logits = h @ out + bias
        logits -= logits.max(1, keepdims=True)
        q = np.exp(logits)
        q /= q.sum(1, keepdims=True)
        d = (q - target) * balance[:, None]
        d_h = d @ out.T * GAIN
        d_words = np.add.reduceat((d_h[doc] * value[:, None])[by_word], word_begin) * inverse
        d_e = _gathered(d_words, word_by_row, row_begin) + DECAY * e
        for x, g, (m, v) in zip((e, out, bias), (d_e, h.T @ d, d.sum(0)), state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weight = np.zeros(1 << BUCKET_BITS, np.float32)
    weight[used] = GAIN * (e @ (out[:, 1] - out[:, 0]))
    return Model(weight, float(bias[1] - bias[0]))


def within(sizes: list[tuple], toxic: int, clean: int, most_bytes: int) -> list:
    """The keys of the sampled texts (turn, key, class, bytes; in order) that ``most_bytes`` hold: of each class the
    first ones, up to its part of the bytes and what the other class leaves of its own. A text larger than that
    alone is passed over."""
    parts = {1: toxic, 0: clean}
    need = {y: sum(s[3] for s in sizes if s[2] == y) for y in parts}
    room = {y: most_bytes * n // max(1, sum(parts.values())) for y, n in parts.items()}
    room = {y: room[y] + max(0, room[1 - y] - need[1 - y]) for y in room}
    out = []
    for y, most in room.items():
        size = 0
        for _, k, _, n in (s for s in sizes if s[2] == y and s[3] <= most):
            size += n
            if size > most:
                break
            out.append(k)
    return out


def sample(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN, most_bytes: int = SAMPLE_BYTES) -> tuple[DataFrame | None, float]:
    """turn, k, y and text of the labelled rows outside the held-out fold that are learned from (None if there are
    none), and the share of toxic ones among all labelled rows outside it."""
    rows = labels.where(~held_out(F.col(key)) & F.col(label).isNotNull()).groupBy(F.col(key).alias("k")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = n.get(1, 0) / max(1, sum(n.values()))
    order = F.xxhash64("k")
    some = rows.where("y = 1").orderBy(order, "k").limit(toxic).unionAll(rows.where("y = 0").orderBy(order, "k").limit(clean))
    # at most toxic + clean keys: small enough to send to all executors
    found = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(some), "k").withColumn("turn", order)
    sizes = found.groupBy("turn", "k", "y").agg(F.sum(F.octet_length("text")).alias("size")).collect()
    chosen = within(sorted((r.turn, r.k, r.y, r.size) for r in sizes), toxic, clean, most_bytes)
    if not chosen:
        return None, share
    taken = docs.sparkSession.createDataFrame([(k,) for k in chosen], some.select("k").schema)
    return found.join(F.broadcast(taken), "k", "left_semi").select("turn", "k", "y", "text"), share


def fit(docs: DataFrame, labels: DataFrame, **names) -> Model:
    """Train on the bounded sample (see ``sample`` for the parameters), in one task."""
    rows, share = sample(docs, labels, **names)
    if rows is None:
        return train([], np.zeros(0, np.int64), share)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(t, k, x, y) for b in batches for t, k, x, y in zip(b.column("turn").to_pylist(), b.column("k").to_pylist(), utf8(b.column("text")), b.column("y").to_pylist(), strict=True)]
        parts.sort()
        model = train([x for *_, x, _ in parts], np.array([y for *_, y in parts], np.int64), share)
        del parts
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.tobytes()], pa.binary()), pa.array([model.bias])], names=["weight", "bias"])

    row = rows.repartition(1).mapInArrow(learn, "weight binary, bias double").first()
    return Model(np.frombuffer(bytes(row.weight), np.float32), row.bias)


class _Known:
    """Scores of words by hash, bounded."""

    def __init__(self) -> None:
        self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0, np.float32)

    def scores(self, model: Model, w: Words) -> np.ndarray:
        each, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        out = np.zeros(len(each), np.float32)
        place = np.minimum(np.searchsorted(self.hashes, each), max(0, len(self.hashes) - 1))
        known = self.hashes[place] == each if len(self.hashes) else np.zeros(len(each), bool)
        out[known] = self.values[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            at = first[new]
            out[new] = model.word_scores([w.data[s:e].tobytes() for s, e in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)])
            if len(self.hashes) + len(new) > TABLE_ROWS:
                self.hashes, self.values = each, out
            else:
                where = np.searchsorted(self.hashes, each[new])
                self.hashes, self.values = np.insert(self.hashes, where, each[new]), np.insert(self.values, where, out[new])
        return out[back]


def score(docs: DataFrame, model: Model, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name`` (double, 0 to 1), or the first free one of name_1, name_2, ..."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes a table row: a fixed size
    schema = T.StructType([*docs.schema.fields, T.StructField(free_name(name, docs.columns), T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, _Known()
        for batch in batches:
            texts, out = utf8(batch.column(text)), []
            for begin, end in chunks(texts, SMALL_CHUNK):
                w = Words(texts[begin:end], ALNUM)
                upto = np.append(0, np.cumsum(known.scores(model, w), dtype=np.float64)) if len(w.hashes) else np.zeros(1)
                n = np.diff(w.first)
                out.append((upto[w.first[1:]] - upto[w.first[:-1]]) / (n + PRIOR_WORDS) + model.bias)
            logit = np.clip(np.concatenate(out), -500, 500) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-logit)), pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", **bounds) -> DataFrame:
    """key, held_out, score, predicted."""
    model = fit(docs, labels, key=key, text=text, label=label, **bounds)
    scored = score(docs.select(F.col(key), F.col(text).alias("__text")), model, text="__text")
    found = F.col(scored.columns[-1])
    return scored.select(key, held_out(F.col(key)).alias("held_out"), found.alias("score"), (found >= 0.5).cast("int").alias("predicted"))


def remove(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", **bounds) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    scored = score(docs, fit(docs, labels, key=key, text=text, label=label, **bounds), text=text)
    return scored.where(F.col(scored.columns[-1]) < 0.5).drop(scored.columns[-1])
