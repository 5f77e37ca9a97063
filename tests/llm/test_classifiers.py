"""Toxicity and quality: held-out accuracy and edge cases. The pipeline against its stages' meaning."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellgrove.llm import decontaminate, ngram_join, quality, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_toxicity_held_out(tables):
    docs, labels = tables
    out = toxicity.report(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").where("held_out").collect()
    p, y = np.array([r.predicted for r in rows]), np.array([r.toxic for r in rows])
    assert (p == y).mean() > 0.85 and p[y == 0].mean() < 0.1


def test_misspellings_share_subwords():
    clean = [f"the plain words of text {i} are calm".encode() for i in range(60)]
    bad = [f"the plain words of text {i} are horridbad{i}".encode() for i in range(60)]
    m = toxicity.train(clean + bad, np.array([0] * 60 + [1] * 60), 0.5)
    never = m.word_scores([b"horridbadly", b"horidbad", b"calmly", b"words"])
    assert never[:2].min() > never[2:].max()


def test_rare_words_teach_in_large_samples():
    """More than 50,000 distinct words, the toxic ones each in a single text."""
    r = np.random.default_rng(0)
    other = ["".join(map(chr, x)) for x in r.integers(97, 123, (54000, 6))]
    clean = [f"the plain words of text {i} are calm {' '.join(other[i * 900 : i * 900 + 900])}".encode() for i in range(60)]
    bad = [f"the plain words of text {i} are horridbad{i}".encode() for i in range(60)]
    m = toxicity.train(clean + bad, np.array([0] * 60 + [1] * 60), 0.5)
    never = m.word_scores([b"horridbadly", b"horidbad", b"calmly"])
    assert never[:2].min() > 1 and never[2] < 0


def test_byte_bound_takes_smallest_hashes(spark):
    """Wherever rows lie in the table and however long they are."""
    rows = [(i, f"{i} {'toxic' if i % 2 else 'clean'} " + "x" * (60 + i)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    taken, share = toxicity.sample(docs, labels, toxic=1600, clean=2800, most_bytes=44 * 100)
    seen = [r.k for r in taken.orderBy("turn", "k").collect()]
    assert 0.4 < share < 0.6
    order = [r.doc_id for r in labels.where(~toxicity.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).collect()]
    for y, most in ((1, 1600), (0, 2800)):
        want, size = [], 0
        for k in (k for k in order if k % 2 == y):
            size += len(rows[k][1])
            if size > most:
                break
            want.append(k)
        assert want and [k for k in seen if k % 2 == y] == want
    few, _ = toxicity.sample(docs, labels, toxic=3, clean=5)
    assert sorted(r.y for r in few.collect()) == [0] * 5 + [1] * 3


def test_scores_are_the_softmax_of_the_mean(spark):
    """Against a plain loop over words and their subwords."""
    r = np.random.default_rng(0)
    model = toxicity.Model(r.normal(size=1 << toxicity.BUCKET_BITS).astype(np.float32), -0.3)
    texts = ["one two two THREE", "", None, "été, x-y 42", "word " * 500]
    docs = spark.createDataFrame([(i, t, "kept", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score string, Score_1 double")
    out = toxicity.score(docs, model)
    assert out.columns == ["doc_id", "text", "score", "Score_1", "score_2"]
    for row in out.collect():
        words = "".join(c if c.isalnum() and c.isascii() or not c.isascii() else " " for c in (row.text or "")).lower().split()
        total = 0.0
        for w in words:
            rows, _ = toxicity.subwords([w.encode()])
            total += sum(float(model.weight[i]) for i in rows) / len(rows)
        want = 1 / (1 + np.exp(-(total / (len(words) + toxicity.PRIOR_WORDS) - 0.3)))
        assert abs(row.score_2 - want) < 1e-4


def test_training_follows_the_gradient():
    """One step of the joint training lowers the loss of a plain forward pass."""
    clean, bad = [b"calm plain words here"] * 20, [b"horrid words here"] * 20
    m = toxicity.train(clean + bad, np.array([0] * 20 + [1] * 20), 0.5)
    logit = lambda t: sum(m.word_scores(t.split())) / (len(t.split()) + toxicity.PRIOR_WORDS) + m.bias
    assert logit(clean[0]) < -1 < 1 < logit(bad[0])


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (2, "", 1.0), (None, "x y", 2.0), (3, "word " * 30000, 1.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.report(docs, none).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1e-5 and r.predicted == 0 for r in got)
    assert toxicity.remove(docs, none).columns == docs.columns
    one = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.report(docs, one).collect()} == {1}
    assert toxicity.report(docs.limit(0), one).count() == 0


def test_held_out_fold(spark):
    import zlib

    got = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_quality_held_out(tables):
    docs, labels = tables
    out = quality.report(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").where("held_out").collect()
    p, y = np.array([r.predicted for r in rows]), np.array([r.quality for r in rows])
    assert (p == y).mean() > 0.85


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "s", "en", 0), (2, "", "s", "en", 0), (3, "word " * 30000, "s", "de", -5)], "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {(r.score, r.predicted) for r in quality.report(docs, labels).collect()} == {(0.5, 1)}
    assert quality.report(docs.limit(0), labels).count() == 0


def test_pseudo_labels_are_exchanged(spark):
    """Views that agree: the pool's confident rows are handed over."""
    rows = [(i, "good words flow on." if i % 2 else "### $$$ @@@ !!!", "a" if i % 2 else "b", "en", 10) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(120)], "key long, y double")
    features = quality.store.written(quality._features(docs, "doc_id", "text", "source", "lang", "n_chars"))
    model, _, handed = quality.co_train(features, labels.where(quality.fold(F.col("key")) > 0), rounds=2, growth=20)
    assert model is not None and handed[0] > 0


def test_ties_and_copies_do_not_fill_the_exchange(spark):
    """All rows of a metadata combination and all copies of a text are handed over together, none twice."""
    rows = [(i, "good words flow on." if i % 2 else "### $$$ @@@ !!!", "a" if i % 2 else "b", "en", 10) for i in range(120)]
    rows += [(i, "good words flow on.", "a", "en", 10) for i in range(120, 1100)]  # one text, one combination
    rows += [(i, f"good words flow on{'.' * (i % 7)} and on {i}.", "a", "en", 10) for i in range(1100, 1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(120)], "key long, y double")
    features = quality.store.written(quality._features(docs, "doc_id", "text", "source", "lang", "n_chars"))
    _, _, handed = quality.co_train(features, labels, rounds=2, growth=5)
    pool = docs.where("doc_id >= 120").where(quality.fold(F.col("doc_id")) > 1).count()
    copies = docs.where("doc_id between 120 and 1099").where(quality.fold(F.col("doc_id")) > 1).count()
    assert pool <= handed[0] and sum(handed) <= 2 * 1280  # the whole combination in round 1, nothing twice
    x = np.array([3.0, 2.0, 2.5])
    assert quality.best(x, np.array([copies, 1, 1]), 5) == 3.0 and quality.best(x, np.ones(3), 2) == 2.5 and quality.best(x, np.ones(3), 9) == 2.0


def test_all_unlabelled_rows_are_searched(spark):
    rows = [(i, "good words flow on." if i % 2 else "### $$$ @@@ !!!", "a" if i % 2 else "b", "en", 10) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, float(i % 2) if i % 7 else None) for i in range(120)], "key long, y double")
    features = quality._features(docs, "doc_id", "text", "source", "lang", "n_chars")
    _, _, handed = quality.co_train(features, labels, rounds=1, growth=1000)
    assert handed == [2 * 280]  # by both views; rows of keys with a hidden label are not in the pool


def test_pseudo_labels_are_fitted_where_they_lie(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(60, quality.TEXT_COLUMNS)).astype(np.float32)
    y = (x[:, 0] > 0).astype(float)
    rows = spark.createDataFrame([(bytearray(v.tobytes()), float(t)) for v, t in zip(x[20:], y[20:], strict=True)], "text_view binary, y double")
    got = quality.Logistic(x[:20], y[:20], more=quality._Elsewhere(rows))
    want = quality.Logistic(x, y, np.append(np.ones(20), np.full(40, quality.PSEUDO_WEIGHT)))
    assert np.allclose(got.logit(x), want.logit(x), atol=1e-6)


def test_text_features_of_nothing():
    f = quality.text_features([b"", b"a", b"a a a\nb"])
    assert f.shape == (3, quality.TEXT_COLUMNS) and np.isfinite(f).all()


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    left, names = docs, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "ngram_join", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, data)
        assert left.columns == docs.columns
    assert 0 < left.count() < docs.count()
    assert ngram_join.report(left).where("doc_id <> component_id").count() == 0
    assert decontaminate.report(left, spark.read.parquet(f"{data}/benchmark.parquet")).where("contaminated").count() == 0
    packed = corpus_pipeline.run(spark, data)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in left.select("doc_id").collect()}


def test_pipeline_edges(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns; then empty tables."""
    import corpus_pipeline

    here = f"file://{tmp_path}"
    leak = "one two three four five six seven eight nine ten eleven"
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n"), (4, base), (5, base.replace(" ", "  ")), (4, base), (6, base.replace("word59", "edit")), (7, f"so {leak} there"), (8, "long " * 40_000), (None, "no key"), (9, "plain text"), (9, "another text")]
    docs = spark.createDataFrame([(i, t, None, "s", 1, "kept", 2.0, "r") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, doc string, score double, runs string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{here}/labels.parquet")
    spark.createDataFrame([(1, leak), (None, None)], "item_id long, text string").write.parquet(f"{here}/benchmark.parquet")
    docs.write.parquet(f"{here}/documents.parquet")
    left, seen = spark.read.parquet(f"{here}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = quality.store.written(stage(spark, left, here))
        assert left.columns == docs.columns
        seen[name] = sorted((r.doc_id if r.doc_id is not None else -1, (r.text or "")[:12]) for r in left.collect())
        assert {(r.doc, r.score, r.runs) for r in left.collect()} == {("kept", 2.0, "r")}
    assert len(seen["toxicity"]) == len(rows)
    once = [(-1, "no key"), (3, " \n"), (5, base.replace(" ", "  ")[:12]), (6, base[:12]), (7, "so one two t"), (8, "long long lo"), (9, "another text"), (9, "plain text")]
    assert seen["exact_dedup"] == once
    assert seen["ngram_join"] == [x for x in once if x[0] != 6] and seen["decontamination"] == [x for x in once if x[0] not in (6, 7)]
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/cellgrove"
    before = set(os.listdir(folder))
    packed = corpus_pipeline.run(spark, here)
    assert [x.split("-")[0] for x in set(os.listdir(folder)) - before] == ["pipeline"]
    assert sorted({-1 if r.doc_id is None else r.doc_id for r in packed.collect()}) == [-1, 3, 5, 8, 9]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, here).count() == 0


def test_held_out_labels_change_nothing(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("documents", "labels"))
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert other.exceptAll(labels).count() > 0
    (one, a), (two, b) = toxicity.sample(docs, labels), toxicity.sample(docs, other)
    assert a == b and sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_pipeline_workers_hold_small_parts(spark, data):
    """Arrow batches are bounded by bytes once a stage was called, not by rows alone, and ``run`` takes the bound back."""
    import corpus_pipeline
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])

    bound = corpus_pipeline._BOUND
    docs = spark.read.parquet(f"{data}/documents.parquet")
    many = spark.range(0, 400, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 10000) AS text")
    spark.conf.unset(bound)
    try:
        corpus_pipeline.drop_copies(spark, docs, data)
        got = [r.size for r in many.mapInArrow(sizes, "size long").collect()]
        assert sum(got) > 3 * corpus_pipeline.BATCH_BYTES and max(got) < 1.1 * corpus_pipeline.BATCH_BYTES
        spark.conf.unset(bound)
        corpus_pipeline.run(spark, data)
        assert spark.conf.get(bound, None) is None
        spark.conf.set(bound, "1m")
        corpus_pipeline.drop_copies(spark, docs, data)
        assert spark.conf.get(bound) == "1m"
    finally:
        spark.conf.unset(bound)


def test_texts_are_hashed_in_small_parts():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([f"w{i} " * 900 for i in range(1500)])
    tracemalloc.start()
    try:
        assert sum(map(len, ngram_join._sets(texts, 5))) == 1500
        assert tracemalloc.get_traced_memory()[1] < 25e6
    finally:
        tracemalloc.stop()
