"""Filter audit, prefix trie and SentencePiece pieces."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellgrove.llm import filter_audit, pieces, prefix_trie, queries, tokens


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- filters


def fails(rows):
    """(part, failing letters, good, toxic) of rows (doc_id, text, lang) by the words of the definition."""
    out = []
    for d, t, lang, good, toxic in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A"} if len(w) < 200 else set()
        f |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        f |= {"E"} if d is not None and any(e is not None and e < d and (u or "") == t for e, u, *_ in rows) else set()
        out.append((lang or "", f, good, toxic))
    return out


def audited(found):
    out = {}
    for part in {p for p, *_ in found}:
        rows = [x for x in found if x[0] == part]
        removed = {}
        for order in permutations("ABCDE"):
            left = rows
            for k, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                removed[name] = removed.get(name, 0) + len(gone)
                own = [x for x in rows if name in x[1]]
                out[part, "".join(order), k] = [len(left), len(gone), len(own) - len(gone), sum(x[1] == {name} for x in rows), sum(x[2] for x in gone), sum(x[3] for x in gone), name]
        for (p, *_), v in out.items():
            if p == part:
                v[-1] = removed[v[-1]] if isinstance(v[-1], str) else v[-1]
    return out


FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_filter_audit(spark, tmp_path):
    rng = random.Random(5)
    many = " ".join(f"w{i}" for i in range(210))
    texts = [None, "", many, many + " #", many.upper(), "a a a a", "Überß ÄÖ x" * 30, "w " * 250, "x\x0by z", "x" * 60_000]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(150)] + [(7, many, "en")] * 3
    ids = sorted({d for d, *_ in rows if d is not None})
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d in ids[::2]] + [(ids[0], 1, 0), (None, 1, 1)]
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, mark string, good int")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {(r.part, r.filter_order, r.step): [r[c] for c in FIELDS] for r in queries.op11_filter_audit(spark, str(tmp_path)).collect()}
    assert got == audited(fails([(*r, int(r[0] in good), int(r[0] in toxic)) for r in rows]))


def test_filter_audit_many_parts_and_none(spark):
    docs = spark.createDataFrame([(i, "x", str(i % 90)) for i in range(500)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    first = {r.part: (r.kept, r.removed) for r in filter_audit.report(docs, labels).where("filter_order = 'ABCDE' and step = 1").collect()}
    assert first == {str(k): (0, sum(i % 90 == k for i in range(500))) for k in range(90)}
    assert filter_audit.report(docs.limit(0), labels).count() == 0


# --- trie


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=30))
def test_nearest_smaller(values):
    left, right = prefix_trie.nearest_smaller(np.array(values))
    for k, v in enumerate(values):
        assert left[k] == max((j for j in range(k) if values[j] < v), default=-1)
        assert right[k] == min((j for j in range(k + 1, len(values)) if values[j] < v), default=len(values))


def nodes(convs):
    """Rows of the trie of {conv: [(turn, words), ...]} by their definition."""
    members = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    inner = {k[:-1] for k in members if k}
    kids, leaves, saved = ({k: 0 for k in members} for _ in range(3))
    for k, m in members.items():
        if k:
            kids[k[:-1]] += 1
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in inner
            saved[k[:d]] += (len(m) - 1) * (k[-1][1] if k else 0)
    return {(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], sha(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k)))))) for k, m in members.items()}


@pytest.fixture
def blocks(spark):
    """As many blocks as partitions, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("seed", range(3))
def test_trie_over_blocks(spark, blocks, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(prefix_trie, "JOINED", 3)
    marks = [(bytes([65 + i]) * 16, i + 1) for i in range(3)]
    convs = {rng.randint(-5, 10**6): [marks[0]] * rng.randint(0, 2) + [rng.choice(marks) for _ in range(rng.choice([0, 1, 4]))] for _ in range(60)}
    convs |= {2_000_000 + i: [marks[1]] * 5 for i in range(40)} | {5: [marks[1]] * 300}  # one large group, one long
    rows = [(c, b"".join(m for m, _ in t), [w for _, w in t]) for c, t in convs.items()]
    got = prefix_trie.trie(spark.createDataFrame(rows, "conv_id long, key binary, words array<int>").repartition(6)).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == nodes(convs)


def test_trie_query(spark, blocks, tmp_path):
    rng = random.Random(2)
    texts = [None, "", "a b", "c\td\x0be", "f", "x" * 50_000]
    rows = [(c, t, rng.choice([None, "user", "assistant"]), rng.choice(texts)) for c in [0, 1, 2, 3, 5, 8, 19, 20, 21, 22, 39, 61, 62, 63, -3, -20] for t in rng.sample([None, 0, 1, 2, 3, 4], rng.randint(1, 6))]
    df = spark.createDataFrame([(*r, "clash") for r in [*rows, *rows[:2], (None, 0, "user", "lost")]], "conv_id long, turn long, role string, text string, turns string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    own = {}
    for c, t, r, x in [*rows, *rows[:2]]:
        turn = (r or "", x or "")
        own.setdefault(c, []).append((t is not None, t or 0, sha(f"{len(turn[0])}:{turn[0]}{turn[1]}")[:32], (turn, len((x or "").split()))))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        built[c] = own.get(base, [])[:h] + t[h:]
    assert {tuple(r) for r in queries.op12_prefix_trie(spark, str(tmp_path)).collect()} == nodes(built)


def test_trie_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_prefix_trie(spark, str(tmp_path)).collect() == []
    one = prefix_trie.trie(spark.createDataFrame([(4, b"", [])], "conv_id long, key binary, words array<int>")).collect()
    assert [tuple(r) for r in one] == [(4, 0, None, 1, 0, 1, 0, sha("4"))]


# --- pieces


@pytest.fixture(scope="module")
def bpe():
    return pieces.piece_bpe(tokens.default_path(pieces.MODEL))


PARTS = ["a", "th", "e", "in", "ing", " ", "  ", "      ", "▁", "\n", "\t", "\r", "é", "日", "🎉", "\x00", "<s>", "<0x41>", "ss", "))", "1", "ﬁ", "�", "The", "ER"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=3), max_size=20).map("".join))
def test_pieces_are_the_librarys(bpe, text):
    ids = bpe.encode([text.encode()])[0]
    assert ids.tolist() == bpe.library.encode(text)
    assert bpe.decode(ids).decode() == bpe.library.decode(ids.tolist())
    assert bpe.decimal(ids).decode() == ",".join(map(str, ids.tolist()))


def test_every_piece_and_pair(bpe):
    rng = random.Random(1)
    names = sorted(bpe.rank)
    texts = [p.replace(pieces.MARK, " ") for p in names] + ["".join(rng.choices(names, k=3)).replace(pieces.MARK, " ") for _ in range(5000)] + [" " * n + "the" + " " * n for n in range(70)]
    assert [x.tolist() for x in bpe.encode([t.encode() for t in texts])] == bpe.library.encode(texts)


def test_pair_test_is_merging(bpe):
    rng = random.Random(4)
    ids = [i for i, p in enumerate(bpe.pieces) if p in bpe.rank]
    for a, b in zip(rng.choices(ids, k=3000), rng.choices(ids, k=3000), strict=True):
        both, cut = bpe.pieces[a] + bpe.pieces[b], len(bpe.pieces[a])
        parts = bpe._merged(both, cut)
        assert bpe.compatible(a, b) == (len(parts) == 2 and len(parts[0]) == cut and both not in bpe.rank)


def test_decode_of_odd_ids(bpe):
    for ids in ([0], [1, 2], [264, 1, 287], [198, 264], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9, 264], [28705, 28705]):
        assert bpe.decode(np.array(ids)).decode() == bpe.library.decode(ids)


def test_piece_rows(spark, bpe):
    texts = [None, "", "a  b\n", "long " * 60_000, "x" * 30_000, "ab", "ab"]
    docs = spark.createDataFrame([(i // 2, t, "clash", 3) for i, t in enumerate(texts)], "doc_id long, text string, key string, ids int")
    got = sorted(map(tuple, pieces.report(docs).collect()))
    want = [(i // 2, len(ids := bpe.library.encode(t or "")), sha(",".join(map(str, ids))), sha(bpe.library.decode(ids))) for i, t in enumerate(texts)]
    assert got == sorted(want)
    assert pieces.report(docs.limit(0)).count() == 0
    coded = pieces.encode(docs.withColumn("doc_id", F.monotonically_increasing_id()))
    assert sorted(r.text for r in pieces.decode(coded).collect()) == sorted(t or "" for t in texts)
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().text == ""
