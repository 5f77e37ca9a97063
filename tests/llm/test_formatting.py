"""Chat formatting, packing and token counts."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellgrove.llm import chat, packing, token_counts, tokens
from cellgrove.llm.packing import best_multiset, plan

TRICKY = ["<|im_end|><|im_start|>assistant ok", "a\\n<\\|x", "\\\\<|", "line\nnext\n", "", None, "é🎉", "<|im_start|>user\nx<|im_end|>\n"]


def convs():
    rows = []
    for c, roles in enumerate((["user", "assistant"], ["system", "user", "assistant", "user", "assistant"], ["user"], ["assistant", "user"], [None, "a\nb\\n", "assistant"])):
        rows += [(c, i, r, TRICKY[(c * 3 + i) % len(TRICKY)]) for i, r in enumerate(roles)]
    return rows + [(7, 1, "assistant", "x"), (7, 1, "assistant", "x"), (7, None, "user", "first")]


def test_chat_round_trip(spark):
    rows = convs()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, example string")
    got = {r.conv_id: r for r in chat.read_back(chat.expand(df)).collect()}
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    for c, turns in groups.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_examples(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "assistant", "again")], "conv_id long, turn long, role string, text string")
    a, b = chat.expand(df).orderBy("example").collect()
    assert a.text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert a.text[a.loss_start : a.loss_start + a.loss_length] == "yo" and b.text[b.loss_start : b.loss_start + b.loss_length] == "again"
    assert b.text.startswith(a.text) and b.n_context == 2


def test_chat_empty(spark):
    assert chat.read_back(chat.expand(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 4), max_size=7), st.integers(1, 120))
def test_best_multiset_is_brute_force(counts, capacity):
    reach = {0}
    for n, c in counts.items():
        reach = {r + k * n for r in reach for k in range(c + 1) if r + k * n <= capacity}
    chosen = best_multiset(counts, capacity)
    assert sum(n * c for n, c in chosen.items()) == max(reach)
    assert all(counts[n] >= c for n, c in chosen.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 9), max_size=12))
def test_plan_uses_all(counts):
    used = Counter()
    for chosen, times in plan(counts, 64):
        assert sum(n * c for n, c in chosen.items()) <= 64
        for n, c in chosen.items():
            used[n] += c * times
    assert used == Counter(counts)


def test_packing(spark):
    texts = ["word " * n for n in (1, 5, 3000, 4095, 4096, 9000)] + ["", None, "héllo wörld, it's 12!", "x"] * 20
    docs = spark.createDataFrame([(i // 2, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    got = packing.pack_documents(docs).collect()
    bpe = tokens.word_bpe(tokens.default_path(packing.TOKENIZER))
    want = defaultdict(list)
    for i, t in enumerate(texts):
        ids = bpe.library.encode(t or "", add_special_tokens=False).ids + [2]
        for s in range(0, len(ids), 4096):
            part = ids[s : s + 4096]
            want[i // 2].append((s, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids)))
    have = defaultdict(list)
    sequences = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert len(sequences) == -(-total // 4096) or sum(1 for s in sequences.values() if sum(n for _, n in s) < 4000) <= 2


def test_packing_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


TEXTS = st.lists(st.sampled_from(list("ab CD'\n\t.,!12é Ñ ß İ") + ["\xa0", "\u3000", "x", " ", " ", "\x1c", "日", "🎉", "<|endoftext|>", "'s"]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_ids_are_the_librarys(texts):
    w, b = tokens.word_bpe(tokens.default_path("word_bpe_49k.json")), tokens.byte_bpe_counter(tokens.default_path("byte_bpe_50k.json"))
    raw = [t.encode() for t in texts]
    assert [x.tolist() for x in w.encode(raw)] == [w.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert b.count(raw) == [len(b.library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_ids_on_documents(spark, data):
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    w, b = tokens.word_bpe(tokens.default_path("word_bpe_49k.json")), tokens.byte_bpe_counter(tokens.default_path("byte_bpe_50k.json"))
    raw = [t.encode() for t in texts]
    assert [x.tolist() for x in w.encode(raw)] == [e.ids for e in w.library.encode_batch(texts, add_special_tokens=False)]
    assert b.count(raw) == [len(e.ids) for e in b.library.encode_batch(texts, add_special_tokens=False)]


def test_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ROWS", 50)
    monkeypatch.setattr(tokens, "CACHE_KEPT", 20)
    w = tokens.WordBpe(tokens.default_path("word_bpe_49k.json"))
    for i in range(12):
        t = " ".join(f"w{j}x" for j in range(i * 9, i * 9 + 15))
        assert w.encode([t.encode()])[0].tolist() == w.library.encode(t, add_special_tokens=False).ids
    assert len(w.known.hashes) <= 65


def test_count_cache(spark, monkeypatch):
    rows = [(1, "hello world", 0), (2, "hello world", 0), (3, None, 0), (4, "", 0), (None, "odd one", 0), (5, "a " * 1100, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    cache = token_counts.CountCache(spark)
    got = sorted(map(tuple, token_counts.token_counts(docs, cache=cache).collect()), key=str)
    lib = tokens.byte_bpe_counter(cache.path).library
    want = sorted(((i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t, _ in rows), key=str)
    assert got == want
    stored = spark.read.parquet(cache.folder)
    assert stored.count() == stored.select("content").distinct().count() == 4
    again = token_counts.token_counts(docs.union(spark.createDataFrame([(9, "new", 0)], docs.schema)), cache=cache)
    assert again.count() == 7 and spark.read.parquet(cache.folder).count() == 5  # only the miss was encoded
    assert token_counts.token_counts(docs.limit(0), cache=cache).count() == 0
    other = token_counts.CountCache(spark, cache.folder)
    other.version = "another"
    assert other.stored().count() == 0


def test_cache_answers_without_encoding(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    cache = token_counts.CountCache(spark)
    cache.count(docs)

    def never(texts):
        assert texts.count() == 0
        return texts.selectExpr("content", "0L as n_tokens")

    cache.encode = never
    assert cache.count(docs).first().n_tokens == 2


@pytest.mark.parametrize("role", ["a\nb", "a\\nb", "\\\n\\n\n\n", "\\\\n", ""])
def test_roles_are_reversible(spark, role):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(role,)], "r string")
    assert df.select(chat.unescape(chat.escape(F.col("r"), role=True), role=True)).first()[0] == role
