"""Quality classifier by co-training of a text-content view and a page-metadata view.

Text view: shape of the whole text (transitions between character classes, repetition, word and line
lengths), one pass, a fixed number of figures per document. Metadata view: source, language and declared
length, hashed to a fixed number of columns. Each view is a logistic regression fitted on labelled rows;
in every round each view scores all unlabelled documents and hands its most confident ones, of either
class, to the other view as pseudo-labels. At last both views are calibrated (Platt scaling) and combined
on labelled rows that neither was fitted on, and all documents are scored.

Distinct feature rows are ranked, not keys: copies are one text, rows of one metadata combination one rank.
A view hands over, of each class and in each round, its best texts or combinations not handed over before,
``GROWTH`` or ``GROWTH_SHARE`` of the pool, whichever is more; those tied with the last (text logits in steps
of 1 / ``BINS``) go with it, and all rows of what is handed over count. What was handed over is known by rule
(metadata combinations; text models and their cuts), so no keys are kept. Metadata pseudo-labels are counted
by combination, those of texts are fitted where they lie: each Newton step sums gradients over them.

Fitting takes bounded numbers of labelled rows (``SAMPLE_ROWS``, weighted back to all of them, and
``CALIBRATION_ROWS``); the unlabelled pool is every row of a key without a label, in any fold; pseudo-labels, features, scores and the search for confident rows have no such bound.

Defined results: null texts are empty; null metadata is a value of its own; several labels of one key are
averaged (0.5 and more is good); without labels of both classes every score is the share of good labels
(0.5 without labels); repeated rows are each scored; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .words import SPACED, Words, chunks, utf8

SAMPLE_ROWS, CALIBRATION_ROWS = 8000, 4000
#: Texts or rows a class, view and round: so many at least, and this share of the pool.
ROUNDS, GROWTH, GROWTH_SHARE = 2, 300, 0.01
#: A pseudo-label counts as so much of a labelled row.
PSEUDO_WEIGHT = 0.5
#: Text logits are ranked in steps of 1 / BINS.
BINS = 100
#: A pseudo-label needs this much confidence in its class.
CONFIDENT = 0.9
META_COLUMNS = 64
_CLASSES = 8
_CLASS = np.full(256, 7, np.uint8)  # other printable: symbols
_CLASS[0x61:0x7B] = 0  # lower case
_CLASS[0x41:0x5B] = 1  # upper case
_CLASS[0x30:0x3A] = 2  # digits
_CLASS[0x20] = 3
_CLASS[[0x0A, 0x0D]] = 4
_CLASS[[ord(c) for c in ".,;:'\"?-()"]] = 5
_CLASS[0x80:] = 6
TEXT_COLUMNS = _CLASSES * _CLASSES + 8


def text_features(texts: list[bytes]) -> np.ndarray:
    """One row of TEXT_COLUMNS figures per text."""
    out = np.zeros((len(texts), TEXT_COLUMNS), np.float32)
    for begin, end in chunks(texts):
        part = texts[begin:end]
        n = end - begin
        w = Words(part, SPACED, lower=False)
        sizes = np.array([len(t) + 1 for t in part], np.int64)
        kinds = _CLASS[w.data].astype(np.int64)
        of = np.repeat(np.arange(n), sizes)
        pairs = np.bincount(of[:-1] * 64 + kinds[:-1] * _CLASSES + kinds[1:], minlength=64 * n).reshape(n, 64) if len(of) > 1 else np.zeros((n, 64))
        rows = out[begin:end]
        rows[:, :64] = np.sqrt(pairs / sizes[:, None])
        count = np.diff(w.first)
        owner = np.repeat(np.arange(n), count)
        lengths = (w.ends - w.starts).astype(np.float64)
        some = np.maximum(count, 1)
        order = np.lexsort((w.hashes, owner))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (w.hashes[order][1:] != w.hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        twin = np.zeros(len(owner), bool)
        twin[1:] = (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])
        mean = np.bincount(owner, lengths, n) / some
        rows[:, 64] = np.log1p(count)
        rows[:, 65] = mean
        rows[:, 66] = np.sqrt(np.maximum(0, np.bincount(owner, lengths**2, n) / some - mean**2))
        rows[:, 67] = np.bincount(owner[order], fresh, n) / some
        rows[:, 68] = np.bincount(owner, twin, n) / some
        rows[:, 69] = np.bincount(owner, lengths == 1, n) / some
        rows[:, 70] = np.bincount(owner, lengths > 20, n) / some
        lines = np.bincount(of, w.data == 0x0A, n) + 1
        rows[:, 71] = np.log1p(count / lines)
    return out


def meta_features(source: list, lang: list, size: list) -> np.ndarray:
    """Hashed one-hot columns of source, language and the declared length's power of two, and both."""
    out = np.zeros((len(source), META_COLUMNS), np.float32)
    values = [[f"{name}={v}" for v in column] for name, column in (("s", source), ("l", lang), ("n", [None if x is None else int(abs(x)).bit_length() for x in size]))]
    for column in values:
        where = {v: crc32(v.encode()) % META_COLUMNS for v in dict.fromkeys(column)}
        out[np.arange(len(column)), [where[v] for v in column]] = 1
    return out


class _Elsewhere:
    """Pseudo-labelled texts (text_view, y) as a stored table: only sums over them come to the driver."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def _sum(self, of, shape: tuple[int, int]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for b in batches:
                if b.num_rows:
                    total += of(_unpacked(b.column("text_view").to_pylist(), np.float32).astype(np.float64), b.column("y").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

        return sum((np.frombuffer(bytes(r.total)).reshape(shape) for r in self.rows.mapInArrow(run, "total binary").collect()), np.zeros(shape))

    def moments(self) -> np.ndarray:
        return self._sum(lambda x, y: PSEUDO_WEIGHT * np.array([np.full(x.shape[1], len(x)), x.sum(0), (x**2).sum(0)]), (3, TEXT_COLUMNS))

    def slope(self, model: Logistic) -> np.ndarray:
        return self._sum(lambda x, y: model.slope(x, y, np.full(len(x), PSEUDO_WEIGHT)), (TEXT_COLUMNS + 2, TEXT_COLUMNS + 1))


class Logistic:
    """Ridge logistic regression on standardised columns, by Newton steps. ``more``: rows fitted on elsewhere
    (see _Elsewhere), besides ``x``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, more: _Elsewhere | None = None):
        x = np.asarray(x, np.float64)
        weight = np.ones(len(x)) if weight is None else weight
        sums = np.array([np.full(x.shape[1], weight.sum()), weight @ x, weight @ x**2]) + (more.moments() if more else 0)
        self.mean = sums[1] / sums[0]
        self.scale = np.sqrt(np.maximum(0, sums[2] / sums[0] - self.mean**2)) + 1e-6
        self.w = np.zeros(x.shape[1] + 1)
        penalty = np.full(len(self.w), ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            slope = self.slope(x, y, weight) + (more.slope(self) if more else 0)
            step = np.linalg.solve(slope[1:] + np.diag(penalty), slope[0] + penalty * self.w)
            self.w -= step * min(1, 5 / np.abs(step).max(initial=1e-9))
            if np.abs(step).max() < 1e-6:
                break

    def slope(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The gradient (first row) and the Hessian (the others) over these rows."""
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
        return np.vstack([z.T @ (weight * (p - y)), (z * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((np.asarray(x, np.float64) - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5: 0 is held out, 1 calibrates, the rest is fitted on."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def _features(docs: DataFrame, key: str, text: str, source: str, lang: str, size: str) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.col(size).cast("long").alias("size"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = text_features(utf8(b.column("text")))
            m = meta_features(*(b.column(c).to_pylist() for c in ("source", "lang", "size")))
            yield pa.RecordBatch.from_arrays([b.column("key"), _packed(t), _packed(m.astype(np.uint8))], names=["key", "text_view", "meta_view"])

    return rows.mapInArrow(run, f"key {kind}, text_view binary, meta_view binary")


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _unpacked(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _scored(rows: DataFrame, models: tuple[Logistic, Logistic]) -> DataFrame:
    """``rows`` without the views and with both logits."""
    keep = [c for c in rows.columns if c not in ("text_view", "meta_view")]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, meta = shared.value
        for b in batches:
            if b.num_rows:
                t, m = (_unpacked(b.column(c).to_pylist(), k) for c, k in (("text_view", np.float32), ("meta_view", np.uint8)))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(text.logit(t)), pa.array(meta.logit(m))], names=[*keep, "text_logit", "meta_logit"])

    return rows.mapInArrow(run, f"{kinds}, text_logit double, meta_logit double")


def _with_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored: ``features`` with y and whether ``labels`` (key, y) knows the key."""
    known = labels.select(F.col("key").alias("k"), "y")
    return store.written(features.join(known, features["key"] == known["k"], "left").withColumn("known", F.col("k").isNotNull()).drop("k"), "quality")


def _handed_by_text(pool: DataFrame, past: list[tuple[Logistic, float, float]], model: Logistic, limit: float) -> DataFrame:
    """meta_view, text (a hash of the view) and bin of the rows whose text ``model`` is sure of and which no
    earlier model handed over (bin at least its upper or at most its lower cut)."""
    shared = pool.sparkSession.sparkContext.broadcast((past, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past, model = shared.value
        for b in batches:
            if b.num_rows:
                x = _unpacked(b.column("text_view").to_pylist(), np.float32)
                logit = model.logit(x)
                bins = _bins(logit)
                ok = np.abs(logit) > limit
                for m, low, high in past:
                    was = m.logit(x)
                    ok &= (np.abs(was) <= limit) | ((_bins(was) > low) & (_bins(was) < high))
                at = pa.array(np.flatnonzero(ok))
                yield pa.RecordBatch.from_arrays([b.column("meta_view").take(at), b.column("text_view").take(at), pa.array(bins[ok], pa.int32())], names=["meta_view", "text_view", "bin"])

    rows = pool.select("meta_view", "text_view").mapInArrow(run, "meta_view binary, text_view binary, bin int")
    return rows.select("meta_view", F.xxhash64("text_view").alias("text"), "bin")


def _bins(logit: np.ndarray) -> np.ndarray:
    """Away from 0, so that no bin holds both classes."""
    return (np.sign(logit) * np.ceil(np.abs(logit) * BINS)).astype(np.int32)


def best(ranks: np.ndarray, counts: np.ndarray, growth: int) -> float:
    """The rank down to which ranks are taken from the top until their counts reach ``growth``."""
    if not len(ranks):
        return float("inf")
    order = np.argsort(-ranks, kind="stable")
    at = np.searchsorted(np.cumsum(counts[order]), growth)
    return float(ranks[order][min(at, len(order) - 1)])


def co_train(features: DataFrame, labels: DataFrame, rounds: int = ROUNDS, growth: int = GROWTH):
    """(text model, metadata model, combination of both logits), or the share of good labels alone if there
    is nothing to learn. ``labels``: key, y. Also returns the numbers of pseudo-labelled rows by round."""
    return _co_train(_with_labels(features, labels), rounds, growth)


def _co_train(rows: DataFrame, rounds: int, growth: int):
    labelled = rows.where("known and y is not null")
    order = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    n = {r.fit: r.n for r in labelled.where(fold(F.col("key")) > 0).groupBy((fold(F.col("key")) > 1).alias("fit")).agg(F.count("*").alias("n")).collect()}

    def sample(fit: bool, most: int) -> list:
        """The rows of smallest hash; each task only sends those below a bound that half as many more pass."""
        bound = int(min(1.0, 1.5 * most / max(1, n.get(fit, 0))) * (1 << 30))
        some = labelled.where((fold(F.col("key")) > 0) & ((fold(F.col("key")) > 1) == fit) & (order < bound))
        return some.orderBy(order, "key").limit(most).select("text_view", "meta_view", "y").collect()

    def arrays(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _unpacked([bytes(r.text_view) for r in rows], np.float32), _unpacked([bytes(r.meta_view) for r in rows], np.uint8), np.array([r.y for r in rows], np.float64)

    fitted, tested = sample(True, SAMPLE_ROWS), sample(False, CALIBRATION_ROWS)
    ys = [r.y for r in fitted]
    if not fitted or min(ys) == max(ys):
        return None, (sum(ys) + 1) / (len(ys) + 2), []
    t, m, y = arrays(fitted)
    weight = np.full(len(y), n[True] / len(y))
    pool = rows.where(~F.col("known")).select("text_view", "meta_view")
    # at most the number of ways to set a column for each of three values, whatever the corpus
    combinations = {bytes(r.meta_view): r.n for r in pool.groupBy("meta_view").agg(F.count("*").alias("n")).collect()}
    growth = max(growth, int(np.ceil(GROWTH_SHARE * sum(combinations.values()))))
    by_meta: dict[bytes, float] = {}  # combinations handed to the text view
    by_text: dict[tuple[bytes, float], int] = {}  # rows handed to the metadata view
    past: list[tuple[Logistic, float, float]] = []
    numbers = []
    limit = float(np.log(CONFIDENT / (1 - CONFIDENT)))

    def models() -> tuple[Logistic, Logistic]:
        more = None
        if by_meta:
            chosen = rows.sparkSession.createDataFrame([(bytearray(k), v) for k, v in by_meta.items()], "meta_view binary, y double")
            more = _Elsewhere(store.written(pool.join(F.broadcast(chosen), "meta_view").select("text_view", "y"), "quality"))
        x = np.vstack([m, *([_unpacked([k for k, _ in by_text], np.uint8)] if by_text else [])])
        target = np.append(y, [v for _, v in by_text])
        return Logistic(t, y, weight, more=more), Logistic(x, target, np.append(weight, [PSEUDO_WEIGHT * c for c in by_text.values()]))

    both = models()
    for _ in range(rounds):
        got = 0
        left = [k for k in combinations if k not in by_meta]
        sure = both[1].logit(_unpacked(left, np.uint8)) if left else np.zeros(0)
        size = np.array([combinations[k] for k in left])
        for label, rank in ((1.0, sure), (0.0, -sure)):
            cut = best(rank[rank > limit], size[rank > limit], growth)
            for i in np.flatnonzero((rank > limit) & (rank >= cut)):
                by_meta[left[i]] = label
                got += int(size[i])
        found = _handed_by_text(pool, past, both[0], limit)
        bins = np.array([(r.bin, r.n) for r in found.select("bin", "text").distinct().groupBy("bin").agg(F.count("*").alias("n")).collect()], np.int64).reshape(-1, 2)
        up, down = bins[bins[:, 0] > 0], bins[bins[:, 0] < 0]
        high, low = best(up[:, 0], up[:, 1], growth), -best(-down[:, 0], down[:, 1], growth)
        label = F.when(F.col("bin") >= high, 1.0).when(F.col("bin") <= low, 0.0)
        for r in found.select("meta_view", label.alias("y")).where("y is not null").groupBy("meta_view", "y").agg(F.count("*").alias("n")).collect():
            by_text[bytes(r.meta_view), r.y] = by_text.get((bytes(r.meta_view), r.y), 0) + r.n
            got += r.n
        past.append((both[0], low, high))
        numbers.append(got)
        if not got:
            break
        both = models()
    ct, cm, cy = arrays(tested) if tested else (t, m, y)
    if cy.min() == cy.max():
        ct, cm, cy = t, m, y
    a, b = both[0].logit(ct), both[1].logit(cm)
    platt = [Logistic(v[:, None], cy, ridge=1e-3) for v in (a, b)]
    combined = Logistic(np.column_stack([p.logit(v[:, None]) for p, v in zip(platt, (a, b), strict=True)]), cy, ridge=1e-2)
    return (both, platt, combined), None, numbers


def report(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", source: str = "source", lang: str = "lang", size: str = "n_chars", rounds: int = ROUNDS) -> DataFrame:
    """key, held_out, text_score, meta_score (calibrated), score (combined), predicted."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("double").alias("y"))
    # labels of the held-out fold are never seen; their rows are no part of the unlabelled pool either
    known = known.withColumn("y", F.when(fold(F.col("key")) > 0, F.col("y")))
    features = _with_labels(_features(docs, key, text, source, lang, size), known)
    model, share, _ = _co_train(features, rounds, GROWTH)
    if model is None:
        out = features.select("key", *(F.lit(float(share)).alias(c) for c in ("text_score", "meta_score", "score")))
    else:
        both, platt, combined = model
        p = [F.col(c) for c in ("text_logit", "meta_logit")]
        p = [(c - F.lit(float(q.mean[0]))) / F.lit(float(q.scale[0])) * F.lit(float(q.w[0])) + F.lit(float(q.w[1])) for c, q in zip(p, platt, strict=True)]
        total = F.lit(float(combined.w[2]))
        for i in (0, 1):
            total = total + (p[i] - F.lit(float(combined.mean[i]))) / F.lit(float(combined.scale[i])) * F.lit(float(combined.w[i]))
        sigmoid = lambda x: 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), x))))
        out = _scored(features.drop("y", "known"), both).select("key", sigmoid(p[0]).alias("text_score"), sigmoid(p[1]).alias("meta_score"), sigmoid(total).alias("score"))
    return out.select(F.col("key").alias(key), (fold(F.col("key")) == 0).alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
