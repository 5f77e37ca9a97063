"""N-gram Jaccard self-join by grouped prefixes, with exact verification and connected components.

1. Every whole text becomes its set of ``SHINGLE``-word shingles (64-bit hashes; a pair is wrong only if two
   hashes of its own few thousand collide). Shingles are put in one global order, rarest first by a fixed-size
   count sketch over all texts; any order gives the same links, this one keeps common passages out of
   prefixes. Two sets of Jaccard ``T`` or more share a shingle among their first n - ceil(T n) + 1.
2. Texts with equal sets are one class; classes with identical prefixes and size are one group, which is
   listed once under each prefix shingle. Entries without another group of a similar size in their list are dropped.
3. Links that span most components are found first: every class is verified against a few leaders, those
   it shares most lists with, and then against some members of the largest component of each of its lists.
4. Then all pairs of classes that still lie in different components are filtered where a list is joined with
   itself, before they become rows: sizes must fit, the shared shingle must stand early enough in both
   prefixes for the overlap that these two sizes need, and from it on both prefixes must have as many shingles in lists
   with other components as a link has in common there. A pair with a common shingle shortly before is left to that
   one's list. Of distinct pairs the Hamming distance of the sets' parity
   bitmaps, which no symmetric difference is smaller than, must not exceed what the threshold allows. All this
   only turns away pairs that can't link. Pairs within one component need no verification, and no link between
   components is lost.
5. What is left is verified on the whole sets.

Verification sends the sets of pair partners to one place, computed from the texts again, of which only those in pairs
(and what a bitmap of their hashes takes for them) are moved; leaders of
many are salted. Long lists are dealt over several tasks by salts.

Defined results: null and empty texts have no shingles and are linked with nothing; a text of fewer
words is one shingle of all of them; rows with equal keys are all returned; an empty table gives no rows;
extra columns are ignored or kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store
from .components import components, extended
from .words import SMALL_CHUNK, SPACED, Words, chunks, utf8

SHINGLE = 5
#: The threshold in hundredths: 100 * intersection >= T * union.
T = 80
#: Counters of the sketch, as a power of two: a fixed size, whatever the input's.
SKETCH_BITS, _SLICES = 22, 64
#: Shingles of so high a level, far more frequent than the sketch's noise, are taken as shared without a count, so
#: that their lists need not meet in one task.
HOT_LEVEL, HOT_SALTS = 11, 64
#: Cells of a set's parity bitmap for each element, and 64-cell words that it has at least; a power of two in all.
CELLS, LEAST_WORDS = 2, 16
#: Leaders that every class is verified against; more would only save pairs of the last step.
LEADERS = 4
#: Members of a large component that other classes are first held against.
REPRESENTATIVES = 64
#: Bits of the map that texts pass before they are shuffled, as a power of two: 2^18 rows of 64 bits at most, good for some
#: millions of texts in pairs.
FILTER_BITS = 24
#: Partners of one leader that are verified in one place, and entries of one list that meet in one task.
SALT_ROWS, LIST_ROWS = 2000, 4000
#: Live shingles before its own that an entry names: a pair that has one of them in common meets there.
EARLIER = 8


def shingles(w: Words, n_texts: int, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, at = w.runs(k)
    cuts = np.searchsorted(at, w.first)
    out = []
    short: dict[int, Words] = {}
    for i in range(n_texts):
        n = w.first[i + 1] - w.first[i]
        if n >= k:
            s = np.sort(hashes[cuts[i] : cuts[i + 1]])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif n:
            if n not in short:
                short[n] = w.runs(int(n))
            h, a = short[n]
            out.append(h[np.searchsorted(a, w.first[i])][None])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int, t: int = T) -> int:
    return n + (-t * n // 100) + 1 if n else 0


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    texts = utf8(column)
    for begin, end in chunks(texts, SMALL_CHUNK):
        yield from shingles(Words(texts[begin:end], SPACED), end - begin, k)


def frequencies(docs: DataFrame, *, text: str = "text", k: int = SHINGLE) -> np.ndarray:
    """A level (0: rare) for each counter of the sketch of all texts' shingles. Sketches are added up by
    slice in the executors; the driver gets one byte for each of the 2^SKETCH_BITS counters."""
    width = (1 << SKETCH_BITS) // _SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, n = np.zeros(1 << SKETCH_BITS, np.uint32), [], 0

        def flush() -> None:
            if held:
                each, n = np.unique(np.concatenate(held) & np.uint64((1 << SKETCH_BITS) - 1), return_counts=True)
                table[each] += n.astype(np.uint32)
                held.clear()

        for batch in batches:
            for s in _sets(batch.column(0), k):
                held.append(s)
                n += len(s)
                if n > 500_000:
                    flush()
                    n = 0
        flush()
        # a task's counter saturates at 255: frequent is all that matters
        parts = np.minimum(table, 255).astype(np.uint8).reshape(_SLICES, width)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([parts[i].tobytes() for i in some], pa.binary())], names=["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i not in sums:
                    sums[i] = np.zeros(width, np.uint32)
                sums[i] += np.frombuffer(c, np.uint8)
        # eight steps to a doubling: one byte a counter
        codes = [np.rint(8 * np.log2(1 + s.astype(np.float64))).astype(np.uint8).tobytes() for s in sums.values()]
        totals = [int(s.sum(dtype=np.int64)) for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(codes, pa.binary()), pa.array(totals, pa.int64())], names=["slice", "codes", "total"])

    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "slice long, counts binary").repartition("slice").mapInArrow(add, "slice long, codes binary, total long")
    codes, total = np.zeros((_SLICES, width), np.uint8), 0
    for row in parts.collect():  # one byte a counter: a fixed size
        codes[row.slice] = np.frombuffer(row.codes, np.uint8)
        total += row.total
    # a counter holds a shingle's own count and about the mean of others: frequent is what stands out of that
    mean = total / (1 << SKETCH_BITS)
    above = (2 ** (np.arange(256) / 8) - 1 - mean) / (4 + 4 * mean**0.5)
    level = np.where(above < 1, 0, np.minimum(31, 1 + 2 * np.log2(np.maximum(above, 1)))).astype(np.uint8)
    return level[codes.reshape(-1)]


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of the set's elements by cells: two bitmaps of one size differ in no more cells than their sets in
    elements. The cell is the low end of a hash, so the halves of a bitmap, one upon the other, are one of half the
    size."""
    size = 64 * LEAST_WORDS
    while size < CELLS * len(s):
        size *= 2
    cells = np.bincount((s >> np.uint64(40)).astype(np.int64) & (size - 1), minlength=size)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, levels: np.ndarray, *, key: str = "doc_id", text: str = "text", k: int = SHINGLE, t: int = T) -> DataFrame:
    """key, mark, n (set size), set (16 bytes), prefix (16 bytes), tokens (the prefix), bits (the parity bitmap), in
    one pass."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # one byte a counter: a fixed size
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"), F.col(text).alias("text"))
    low, six, top = np.uint64((1 << SKETCH_BITS) - 1), np.uint64(6), np.uint64(58)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in batches:
            sizes, sets, prefixes, tokens, bits = [], [], [], [], []
            for s in _sets(batch.column("text"), k):
                p = prefix_length(len(s), t)
                ordered = levels[s & low].astype(np.uint64) << top | s >> six
                if p < len(ordered):
                    ordered = np.partition(ordered, p - 1)[:p]
                ordered = np.sort(ordered)
                sizes.append(len(s))
                sets.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                prefixes.append(hashlib.blake2b(ordered.tobytes(), digest_size=16).digest())
                tokens.append(ordered.astype(np.int64))
                bits.append(bitmap(s))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(prefixes, pa.binary()), pa.array(tokens, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], names=["key", "mark", "n", "set", "prefix", "tokens", "bits"])

    return rows.mapInArrow(run, f"key {kind}, mark long, n long, set binary, prefix binary, tokens array<long>, bits array<long>")


def _candidates(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """key, mark, text of all rows that ``wanted`` (w_key, w_mark) holds, and of a few others: a bitmap of hashes, of a
    fixed size, keeps most other texts from being shuffled. With more keys than it is made for it only lets more
    through."""
    place = lambda k, mark: F.pmod(F.xxhash64(k, mark), F.lit(1 << FILTER_BITS))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = wanted.select(place("w_key", "w_mark").alias("place")).groupBy(F.expr("place div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"), F.col(text).alias("text")).withColumn("place", place("key", "mark"))
    # a row for each 64 bits of the map at most
    there = (F.expr("place div 64") == F.col("word")) & (bit.bitwiseAND(F.col("bits")) != 0)
    return rows.join(F.broadcast(words), there, "left_semi").select("key", "mark", "text")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, tables: store.Scratch, *, key: str, text: str, k: int, t: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough. ``pairs`` is stored and distinct."""
    many = pairs.groupBy("a").agg(F.count("*").alias("partners")).select("a", F.ceil(F.col("partners") / SALT_ROWS).alias("salts"))
    salted = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    # where each class's set goes: to each of its leaders, and a leader's own set to each of its salts
    own = many.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    places = salted.select(F.col("b").alias("cid"), "a", "salt", F.lit(1).alias("role")).unionAll(own.select(F.col("a").alias("cid"), "a", "salt", F.lit(0).alias("role")))
    ends = pairs.select(F.col("a").alias("cid")).unionAll(pairs.select("b")).distinct()
    wanted = tables.put("wanted", ends.join(classes, "cid").select(F.col("rep.key").alias("w_key"), F.col("rep.mark").alias("w_mark"), "cid"))
    rows = _candidates(docs, wanted, key, text)
    same = F.col("key").eqNullSafe(F.col("w_key")) & (F.col("mark") == F.col("w_mark"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in _sets(batch.column("text"), k)]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(sets, pa.binary())], names=["cid", "items"])

    # rows repeated with the same key and text give their class's set more than once: harmless, links are distinct
    sets = rows.join(wanted, same).select("text", "cid").mapInArrow(compute, "cid long, items binary")
    sent = places.join(sets, "cid")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for a, role, cid, items in zip(*(batch.column(c).to_pylist() for c in ("a", "role", "cid", "items")), strict=True):
                s = np.frombuffer(items, np.uint64)
                if role == 0:
                    leader, own = a, s
                    continue
                if leader != a:
                    raise AssertionError("a leader's set comes before its partners'")
                small, large = (s, own) if len(s) < len(own) else (own, s)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                if 100 * both >= t * (len(s) + len(own) - both):
                    out[0].append(a)
                    out[1].append(cid)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    return sent.repartition("a", "salt").sortWithinPartitions("a", "salt", "role").mapInArrow(compare, "a long, b long").distinct()


def _needed(n_a: Column, n_b: Column, t: int) -> Column:
    """The overlap that sets of these sizes need."""
    return F.ceil(t * (n_a + n_b) / (100.0 + t))


def _within_reach(shared: Column, twin: Column, n_a: Column, n_b: Column, t: int) -> Column:
    """Whether ``shared`` common prefix shingles can make a link. Up to the end of the shorter-reaching prefix
    all common shingles are counted; beyond it there are at most the rest of that set. Classes of one group
    (which share a list of a negative number) have equal prefixes."""
    rest = lambda n: F.ceil(t * n / 100.0) - 1
    return (twin < 0) | (shared >= _needed(n_a, n_b, t) - F.greatest(rest(n_a), rest(n_b)))


def _may_link(a: str, b: str, t: int) -> Column:
    """What two entries of one list must fulfil if their sets link and no shingle before this one is common: sizes,
    places of the shingle in both prefixes, as many live entries left in both as the prefixes need in common, and no
    common one among the last before. The first common shingle fulfils it for every link."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    need = _needed(x("n"), y("n"), t)
    sizes = (100 * x("n") >= t * y("n")) & (100 * y("n") >= t * x("n"))
    left = _within_reach(F.least(x("left"), y("left")), x("token"), x("n"), y("n"), t)
    return sizes & (x("pos") <= x("n") - need) & (y("pos") <= y("n") - need) & left & ~F.arrays_overlap(x("earlier"), y("earlier"))


def _with_left(live: DataFrame, t: int) -> DataFrame:
    """``live`` entries with ``left``, how many the class has from this shingle on (every prefix shingle that two classes
    of different components share is live in both), and the last ones ``earlier``, without those that have too few left
    for any size in their list (from ``low`` to ``high``). What a link needs in common is least for the sizes farthest
    from its own; rounding takes one."""
    w = Window.partitionBy("cid").orderBy(F.desc("token"))
    counted = live.withColumns({"left": F.row_number().over(w), "earlier": F.collect_list("token").over(w.rowsBetween(1, EARLIER))})
    far = (F.greatest("low", t * F.col("n") / 100.0), F.least("high", 100.0 * F.col("n") / t))
    smaller, larger = (_within_reach(F.col("left") + 1, F.col("token"), F.col("n"), size, t) for size in far)
    return counted.where(smaller | larger).drop("low", "high")


def _by_bitmaps(pairs: DataFrame, classes: DataFrame, tables: store.Scratch, t: int) -> DataFrame:
    """The stored pairs (a, b) of classes whose bitmaps don't rule a link out. Sizes that may link are less than two
    powers of two apart: the larger bitmap is folded once where needed."""
    # only the bitmaps of classes in pairs are moved
    ends = pairs.select(F.col("a").alias("cid")).unionAll(pairs.select("b")).distinct()
    some = tables.put("bitmaps", classes.select("cid", "n", "bits").join(ends, "cid", "left_semi"))
    for c in ("a", "b"):
        pairs = pairs.join(some.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")), c)
    xor = lambda x, y: F.zip_with(x, y, lambda i, j: i.bitwiseXOR(j))
    half = lambda x: F.floor(F.size(x) / 2).cast("int")
    folded = lambda x, y: F.when(F.size(x) > F.size(y), xor(F.slice(x, F.lit(1), half(x)), F.slice(x, half(x) + 1, half(x)))).otherwise(x)
    differ = xor(folded(F.col("bits_a"), F.col("bits_b")), folded(F.col("bits_b"), F.col("bits_a")))
    apart = F.aggregate(differ, F.lit(0), lambda n, x: n + F.bit_count(x))
    return pairs.where(apart <= F.col("n_a") + F.col("n_b") - 2 * _needed(F.col("n_a"), F.col("n_b"), t)).select("a", "b")


def _labelled(entries: DataFrame, parts: DataFrame) -> DataFrame:
    return entries.join(parts, entries["cid"] == parts["node"], "left").select("token", "cid", "n", "pos", F.coalesce("component", "cid").alias("component"))


def _cross_pairs(entries: DataFrame, parts: DataFrame, classes: DataFrame, tables: store.Scratch, t: int, some: bool) -> DataFrame:
    """Stored distinct pairs (a, b) of classes in different components that may link. ``some``: only pairs with
    representatives of the component that has most members in the list."""
    now = _labelled(entries, parts)
    blocks = now.groupBy("token", "component").agg(F.count("*").alias("members"), F.min("n").alias("low"), F.max("n").alias("high"))
    lists = blocks.groupBy("token").agg(F.count("*").alias("blocks"), F.sum("members").alias("size"), F.min("low").alias("low"), F.max("high").alias("high"), F.max(F.struct("members", "component")).alias("top")).where("blocks > 1")
    lists = lists.select("token", F.ceil(F.col("size") / LIST_ROWS).alias("salts"), F.col("top.component").alias("top"), "low", "high")
    live = tables.put("live", _with_left(now.join(lists, "token"), t))
    # outside the largest component, against all of the list: the largest one isn't paired with itself
    a = live.where("component <> top").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    b = live.withColumn("salt", F.pmod(F.xxhash64("cid"), F.col("salts")))
    if some:
        # some members of a component, by hash, stand for it here; the last step knows no such bound
        nodes = live.where("component = top").select("cid", "component").distinct()
        sizes = nodes.groupBy("component").agg(F.ceil(F.count("*") / REPRESENTATIVES).alias("part"))
        chosen = nodes.join(sizes, "component").where(F.pmod(F.xxhash64("cid"), F.col("part")) == 0).select("cid")
        b = b.where("component = top").join(chosen, "cid", "left_semi")
    once = F.expr("a.component <> b.component and (b.component = b.top or a.cid < b.cid)")
    met = a.alias("a").join(b.alias("b"), F.expr("a.token = b.token and a.salt = b.salt") & once & _may_link("a", "b", t))
    pairs = tables.put("met", met.select(F.least("a.cid", "b.cid").alias("a"), F.greatest("a.cid", "b.cid").alias("b")).distinct())
    return tables.put("pairs", _by_bitmaps(pairs, classes, tables, t))


def link(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = SHINGLE, t: int = T) -> tuple[DataFrame, DataFrame]:
    """Stored tables: documents (key, n, mark, component; null without words) and verified links between classes
    (a, b; they span every component). All other tables written on the way are deleted."""
    with store.Scratch(docs.sparkSession) as tables:
        return _link(docs, tables, key, text, k, t)


def _link(docs: DataFrame, tables: store.Scratch, key: str, text: str, k: int, t: int) -> tuple[DataFrame, DataFrame]:
    names = {"key": key, "text": text, "k": k, "t": t}
    sig = tables.put("signatures", signatures(docs, frequencies(docs, text=text, k=k), **names))
    # one row per set, with its tokens: copies are put together before they are dealt out
    classes = sig.where("n > 0").groupBy("set", "n", "prefix").agg(F.min(F.struct("key", "mark")).alias("rep"), F.first("bits").alias("bits"), F.first("tokens").alias("tokens"))
    classes = tables.put("classes", classes.withColumn("cid", F.monotonically_increasing_id()))
    groups = classes.groupBy("prefix", "n").agg(F.min("cid").alias("gid"), F.count("*").alias("size")).where("size > 1")
    # classes of groups of several, with their group; all other classes are groups of their own
    grouped = tables.put("grouped", classes.select("cid", "prefix", "n").join(groups.select("prefix", F.col("n").alias("g_n"), "gid"), "prefix").where("n = g_n").select("gid", "cid", "n"))

    # each group once in the list of each shingle of its prefix
    heads = classes.join(grouped.where("gid <> cid").select("cid"), "cid", "left_anti")
    listed = heads.select(F.col("cid").alias("gid"), "n", F.posexplode("tokens").alias("pos", "token"))
    # rare shingles are dealt out once, and stay where another group of a similar size has them (the next smaller or
    # the next larger one); frequent ones are spread and all stay
    level = F.shiftright("token", 58)
    dealt = listed.withColumn("part", F.when(level >= HOT_LEVEL, F.pmod(F.xxhash64("gid"), F.lit(HOT_SALTS))).otherwise(-1)).repartition("token", "part")
    by_size = Window.partitionBy("token", "part").orderBy("n")
    beside = dealt.select("gid", "n", "pos", "token", "part", F.lag("n").over(by_size).alias("smaller"), F.lead("n").over(by_size).alias("larger"))
    kept = beside.where((F.col("part") >= 0) | (100 * F.col("smaller") >= t * F.col("n")) | (t * F.col("larger") <= 100 * F.col("n")))
    kept = kept.select("token", F.col("gid").alias("cid"), "n", "pos")
    # expanded to classes; the classes of one group also share a list of their own
    whole = grouped.select(F.col("gid").alias("its"), F.col("cid").alias("member"))
    expanded = kept.join(whole, F.col("cid") == F.col("its"), "left").select("token", F.coalesce("member", "cid").alias("cid"), "n", "pos")
    twins = grouped.select((-F.col("gid") - 1).alias("token"), "cid", "n", F.lit(0).alias("pos"))
    entries = tables.put("entries", expanded.unionAll(twins))
    members = tables.put("members", sig.select("key", "n", "mark", F.col("set").alias("d_set")).join(classes.select("set", "cid"), F.col("d_set") == F.col("set"), "left").select("key", "n", "cid", "mark"))
    tables.drop("signatures")

    # leaders for each class: those it shares most lists with, of a similar size; by several orders, as of copies
    # that vary around the threshold each leader catches a part
    now = entries.withColumn("size", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / t))))
    several = [F.min(F.struct(F.xxhash64("cid", F.lit(i)), "cid", "n")) for i in range(LEADERS)]
    lists = now.groupBy("token", "size").agg(F.array_distinct(F.transform(F.array(*several), lambda x: x.dropFields("col1"))).alias("chosen"), F.min("cid").alias("low"), F.max("cid").alias("high"))
    leaders = lists.where("low <> high").select("token", "size", F.explode("chosen").alias("first"))
    leaders = leaders.select("token", "size", F.col("first.cid").alias("leader"), F.col("first.n").alias("n_leader"))
    votes = now.join(leaders, ["token", "size"]).where("cid <> leader").groupBy("cid", "leader").agg(F.count("*").alias("votes"), F.min("token").alias("twin"), F.first("n").alias("n_a"), F.first("n_leader").alias("n_b"))
    # lists with another leader aren't counted here, so half the votes will do
    votes = votes.where(_within_reach(2 * F.col("votes"), F.col("twin"), F.col("n_a"), F.col("n_b"), t))
    w = Window.partitionBy("cid").orderBy(F.desc("votes"), "leader")
    best = votes.withColumn("place", F.row_number().over(w)).where(F.col("place") <= LEADERS)
    led = tables.put("led", best.select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct())
    pairs = tables.put("pairs", _by_bitmaps(led, classes, tables, t))  # bitmaps are a small part of the sets that go on
    keep = lambda df, name: tables.put(name, df)
    links = tables.put("verified", _verified(docs, classes, pairs, tables, **names))
    parts = components(links, keep)

    # lists that still hold several components: first against some of the largest of each list, which joins most
    # of what is left without pairing the rest among itself; then all that are still apart
    for some in (True, False):
        rest = _cross_pairs(entries, parts, classes, tables, t, some)
        if rest.isEmpty():
            continue
        found = tables.put("found", _verified(docs, classes, rest, tables, **names))
        parts = extended(parts, found, keep)
        links = tables.put("verified", links.unionAll(found))
    documents = members.join(parts, members["cid"] == parts["node"], "left").select("key", "n", "mark", F.coalesce("component", "cid").alias("component"))
    return store.written(documents, "placed"), store.written(links, "links")


def report(docs: DataFrame, **names) -> DataFrame:
    """key, n_shingles, component_id (smallest key reachable by links) for every row."""
    key = names.get("key", "doc_id")
    placed, _ = link(docs, **names)
    least = placed.where("component is not null").groupBy("component").agg(F.min("key").alias("component_id"))
    out = placed.join(least, "component", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("component").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"))


def deduplicate(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``docs`` with the row of the smallest key (null last) and, among texts of that key, of the smallest mark
    of each component; all columns stay. Rows without words are all kept, and so are rows repeated with the
    same key and text."""
    placed, _ = link(docs, key=key, text=text, **names)
    first = placed.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mark")).alias("first"))
    kept = first.select("first.key", "first.mark").unionAll(placed.where("component is null").select("key", "mark"))
    kept = kept.distinct()
    same = docs[key].eqNullSafe(kept["key"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == kept["mark"])
    return docs.join(kept, same, "left_semi")
