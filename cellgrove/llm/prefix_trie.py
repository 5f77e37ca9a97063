"""The trie of conversation prefixes, from the sorted conversations and the common prefixes of neighbours.

A conversation is the row of its turns' digests, so byte order is an order of turn sequences. Sorted and dealt by
ranges, each task holds a block of neighbours. The lengths of the prefixes that neighbours share form an array whose
Cartesian tree is the trie: an entry and its nearest smaller values on both sides bound the conversations below one
branching node, entries of equal length with the same bounds are one node, and the depths between a node and the one
above it are nodes with the same bounds. Sums over bounds come from running sums.

Blocks are solved on their own, as if nothing stood before or after them. What a block shares with the block before is
a prefix of its first conversation; those nodes belong to the nearest earlier block whose smallest entry is below
their depth. The minima of blocks, a few numbers for each task, find it. Only nodes on a block's two edges meet again, in
one aggregation.

Defined results: null role or text is empty; turns are ordered by turn (null first), equal turns by the digest of role
and text, repeated rows are all kept; rows with a null conversation are left out; conversations without turns are
members of the root alone; an empty table gives no nodes; extra columns are ignored. A conversation's digests
(16 bytes a turn) are held by one task, a group of equal conversations is not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

#: Bytes of a turn's digest; conversation ids joined into one string; nodes of one Arrow batch.
MARK, JOINED, ROWS = 16, 50_000, 50_000
_NOTHING = hashlib.sha256(b"").hexdigest()
_NODE = ["block", "pos", "depth", "up", "right", "up_edge", "n", "conv", "up_conv", "kids", "leaves", "saved", "before", "ends"]
_SCHEMA = "kind int, block int, pos long, depth int, up long, right boolean, up_edge boolean, n long, conv long, up_conv long, kids long, leaves long, saved long, before long, ends string, first binary, last binary, words binary"
_TYPES = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _SCHEMA.split(", ")])
TRIE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_rows(turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id (long), turns: array of (turn, mark, words) in order, mark the hexadecimal digest of role and text."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    mark = F.substring(F.sha2(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t), 256), 1, 2 * MARK)
    each = F.struct(F.col(turn).alias("turn"), mark.alias("mark"), F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    own = turns.select(F.col(conversation).cast("long").alias("conv_id"), each.alias("each")).where("conv_id is not null")
    return own.groupBy("conv_id").agg(F.sort_array(F.collect_list("each")).alias("turns"))


def sequences(rows: DataFrame) -> DataFrame:
    """conv_id, key (the digests in a row), words (array of int) of ``turn_rows``."""
    return rows.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: x.mark), "")).alias("key"), F.transform("turns", lambda x: x.words).alias("words"))


def common(a: bytes, b: bytes) -> int:
    """Digests that two keys share at their begin."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // MARK
    x, y = (np.frombuffer(k, "u1", n).reshape(-1, MARK) for k in (a, b))
    return int(np.argmax((x != y).any(1)))


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value the place of the nearest smaller one to its left (-1) and right (the length)."""
    n, v = len(values), values.tolist()
    left, right, stack = [-1] * n, [n] * n, []
    for k, x in enumerate(v):
        while stack and v[stack[-1]] > x:
            right[stack.pop()] = k
        left[k] = stack[-1] if stack else -1
        if stack and v[stack[-1]] == x:
            left[k] = left[stack[-1]]
        stack.append(k)
    return np.array(left, np.int64), np.array(right, np.int64)


class _Least:
    """Minima of ranges, by tables of doubling lengths."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while (half := 1 << (len(self.tables) - 1)) * 2 <= len(values):
            t = self.tables[-1]
            self.tables.append(np.minimum(t[: len(t) - half], t[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """From a to b, both included."""
        size = np.frexp(b - a + 1)[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(size):
            at = size == k
            out[at] = np.minimum(self.tables[k][a[at]], self.tables[k][b[at] - (1 << int(k)) + 1])
        return out


class Block:
    """Neighbours in order: their ids, lengths, words by turn and shared prefixes (-1 before the first)."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, words: np.ndarray, shared: np.ndarray):
        self.ids, self.lengths, self.shared, m = ids, lengths, shared, len(ids)
        self.offsets = np.append(0, np.cumsum(lengths))
        self.upto = np.append(0, np.cumsum(words))
        total = self.upto[self.offsets[1:]] - self.upto[self.offsets[:-1]]
        self.total = np.append(0, np.cumsum(total))
        self.fresh = np.append(0, np.cumsum(total - self.first_words(np.arange(m), np.maximum(shared, 0))))
        # a conversation is a leaf unless the next one goes on from it; of the last one that isn't known here
        leaf = shared[1:] < lengths[:-1]
        self.leaf = np.append(0, np.cumsum(np.append(leaf, False)))
        self.least = _Least(ids)
        self._tree()

    def first_words(self, k: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Words in the first n turns of conversations k."""
        return self.upto[self.offsets[k] + n] - self.upto[self.offsets[k]]

    def _tree(self) -> None:
        """Edges of the tree: the nodes from depth ``low`` + 1 to ``high`` over the conversations ``begin`` to ``end``,
        and the bounds of the node above."""
        m, lcp = len(self.ids), np.append(self.shared, -1)
        left, right = nearest_smaller(self.shared)
        k = np.arange(1, m)
        # entries of equal length within the same bounds are one node, each of them begins one child
        order = np.lexsort((self.shared[k], left[k]))
        k = k[order]
        new = np.ones(len(k), bool)
        new[1:] = (left[k[1:]] != left[k[:-1]]) | (self.shared[k[1:]] != self.shared[k[:-1]])
        at = np.flatnonzero(new)
        kids = np.add.reduceat((self.lengths[k] > self.shared[k]).astype(np.int64), at) if len(k) else np.zeros(0, np.int64)
        one = k[at]
        begin, end, high = left[one], right[one] - 1, self.shared[one]
        kids = kids + (self.lengths[begin] > high)
        # what a conversation has for itself
        alone = np.flatnonzero(self.lengths > np.maximum(lcp[:-1], lcp[1:]))
        self.begin = np.concatenate([begin, alone])
        self.end = np.concatenate([end, alone])
        self.high = np.concatenate([high, self.lengths[alone]])
        self.kids = np.concatenate([kids, np.zeros(len(alone), np.int64)])
        self.low = np.maximum(lcp[self.begin], lcp[self.end + 1])
        by_left = lcp[self.begin] == self.low
        after = np.minimum(self.end + 1, m - 1)
        self.up_begin = np.where(by_left, left[self.begin], self.begin)
        self.up_end = np.where(by_left, right[self.begin], right[after]) - 1

    def nodes(self) -> Iterator[dict[str, np.ndarray]]:
        """Columns of the nodes of all depths, some rows at a time."""
        m, runs = len(self.ids), self._runs()
        count = self.high - self.low
        upto = np.append(0, np.cumsum(count))
        for a in range(0, int(upto[-1]), ROWS):
            row = np.arange(a, min(a + ROWS, int(upto[-1])))
            edge = np.searchsorted(upto, row, side="right") - 1
            depth = self.low[edge] + 1 + row - upto[edge]
            i, r, top = self.begin[edge], self.end[edge], depth == self.low[edge] + 1
            p, q = np.where(top, self.up_begin[edge], i), np.where(top, self.up_end[edge], r)
            p, q = (np.where(depth > 0, x, y) for x, y in ((p, i), (q, r)))
            n, before = r - i + 1, self.first_words(i, np.maximum(depth - 1, 0))
            distinct = self.fresh[r + 1] - self.fresh[i + 1] + self.total[i + 1] - self.total[i] - before
            yield {
                "pos": i, "depth": depth, "up": p, "right": r == m - 1, "up_edge": (p == 0) | (q == m - 1), "n": n, "conv": self.least(i, r), "up_conv": self.least(p, q),
                "kids": np.where(depth == self.high[edge], self.kids[edge], 1), "leaves": self.leaf[r + 1] - self.leaf[i],
                "saved": self.total[r + 1] - self.total[i] - n * before - distinct, "before": before,
                "ends": np.array([runs.get(x) if y == z else _NOTHING for x, y, z in zip(i.tolist(), depth.tolist(), self.lengths[i].tolist(), strict=True)], object),
            }

    def _bounds(self) -> list[tuple[int, int]]:
        """Begin and end (exclusive) of runs of equal conversations."""
        copy = (self.shared == self.lengths) & (np.append(-1, self.lengths[:-1]) == self.lengths)
        begin = np.flatnonzero(~copy)
        return list(zip(begin.tolist(), [*begin[1:].tolist(), len(copy)], strict=True))

    def _runs(self) -> dict[int, str]:
        """The digest of each run's ids by its begin, of runs that can't go on in another block."""
        ids = self.ids.tolist()
        return {a: hashlib.sha256(",".join(map(str, ids[a:b])).encode()).hexdigest() for a, b in self._bounds() if a and b < len(ids)}

    def open_runs(self) -> Iterator[tuple[int, int, str]]:
        """Begin, place and joined ids of the pieces of the others."""
        ids, bounds = self.ids.tolist(), self._bounds()
        for a, b in sorted({bounds[0], bounds[-1]}):
            for c in range(a, b, JOINED):
                yield a, c, ",".join(map(str, ids[c : min(b, c + JOINED)]))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted block (conv_id, key, words) to rows of its nodes (kind 0), open runs (1) and bounds (2)."""
    ids, lengths, shared, words = [], [], [], []
    first = last = None
    for batch in batches:
        ids.append(batch.column(0).to_numpy())
        words.append(batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64))
        for key in batch.column(1).to_pylist():
            shared.append(-1 if last is None else common(last, key))
            lengths.append(len(key) // MARK)
            last, first = key, key if first is None else first
    if last is None:
        return
    number = TaskContext.get().partitionId()

    def table(kind: int, **columns) -> pa.RecordBatch:
        size = len(columns["depth"])
        own = {"kind": np.full(size, kind), "block": np.full(size, number)} | columns
        return pa.RecordBatch.from_arrays([pa.array(own[f.name], f.type) if f.name in own else pa.nulls(size, f.type) for f in _ARROW], schema=_ARROW)

    flat = np.concatenate(words)
    block = Block(np.concatenate(ids), np.array(lengths, np.int64), flat, np.array(shared, np.int64))
    for columns in block.nodes():
        yield table(0, **columns)
    for a, place, joined in block.open_runs():
        yield table(1, pos=[a], depth=[lengths[a]], n=[place], ends=[joined])
    low = min(shared[1:], default=(1 << 31) - 1)
    yield table(2, depth=[low], kids=[lengths[-1]], first=[first], last=[last], words=[flat[: lengths[0]].astype("<i8").tobytes()])


class Borders:
    """What blocks share: for each the prefix in common with the block before and its words, and the smallest entry."""

    def __init__(self, bounds: DataFrame):
        spark = bounds.sparkSession
        # a row of a few numbers for each task of the sort
        rows = sorted(bounds.select("block", "depth", "kids").collect())
        self.blocks = np.array([r.block for r in rows], np.int64)
        pairs = [(int(b), int(a)) for a, b in zip(self.blocks[:-1], self.blocks[1:], strict=True)]
        found = {}
        if pairs:
            beside = spark.createDataFrame(pairs, "block int, before int")
            met = bounds.select("block", "first", "words").join(beside, "block").join(bounds.select(F.col("block").alias("before"), "last"), "before")

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    n = [common(x, y) for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                    w = [int(np.frombuffer(x, "<i8")[:k].sum()) for x, k in zip(batch.column(3).to_pylist(), n, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(w, pa.int64())], names=["block", "shared", "words"])

            found = {r.block: r for r in met.select("block", "last", "first", "words").mapInArrow(run, "block int, shared int, words long").collect()}
        self.shared = np.array([found[r.block].shared if r.block in found else -1 for r in rows], np.int64)
        self.words = np.array([found[r.block].words if r.block in found else 0 for r in rows], np.int64)
        self.least = np.minimum(self.shared, [r.depth for r in rows])
        self.smaller = nearest_smaller(self.least)[0]
        #: Whether the last conversation of a block is a leaf.
        self.leaf = np.append(self.shared[1:], -1) < [r.kids for r in rows]

    def owner(self, place: int, depth: int) -> int:
        """The nearest block before whose smallest entry is below the depth."""
        at = place - 1
        while self.least[at] >= depth:
            at = int(self.smaller[at])
        return at

    def settled(self, edges: DataFrame) -> DataFrame:
        """Edge nodes with the block they belong to (``owner``), counting what other blocks don't."""
        own = [*edges.columns, "owner"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                c = {n: batch.column(k).to_numpy(zero_copy_only=False).copy() for k, n in enumerate(own[:-1]) if n != "ends"}
                place = np.searchsorted(self.blocks, c["block"])
                moved = (c["pos"] == 0) & (c["depth"] <= self.shared[place])
                c["kids"] -= moved & (c["depth"] < self.shared[place])  # the child is the owner's too
                c["saved"] += np.where(moved, self.words[place] - c["before"], 0)  # and so are the nodes that are shared
                c["leaves"] += c["right"] & self.leaf[place]
                owner = [self.blocks[self.owner(p, d)] if m else self.blocks[p] for p, d, m in zip(place.tolist(), c["depth"].tolist(), moved.tolist(), strict=True)]
                c["owner"] = np.array(owner, np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(k) if n == "ends" else pa.array(c[n]) for k, n in enumerate(own)], names=own)

        return edges.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in edges.schema) + ", owner int")


def _joined_ends(pieces: DataFrame) -> DataFrame:
    """owner, at, depth, sha: the digest of each node's pieces in order, read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int64()), pa.array([now[2]], pa.int32()), pa.array([sha.hexdigest()])], names=["owner", "at", "depth", "sha"])

        now, sha = None, None
        for batch in batches:
            for *node, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if node == now:
                    sha.update(b",")
                else:
                    if now:
                        yield row()
                    now, sha = node, hashlib.sha256()
                sha.update(text.encode())
        if now:
            yield row()

    keys = ["owner", "at", "depth"]
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "block", "n").select(*keys, "ends").mapInArrow(run, "owner int, at long, depth int, sha string")


def trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of ``sequences``: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Written to the shared folder; all else that was written goes."""
    spark = seqs.sparkSession
    ordered = seqs.select("conv_id", "key", "words").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    with store.Scratch(spark) as tables:
        solved = tables.put("solved", ordered.mapInArrow(_solved, _SCHEMA))
        borders = Borders(solved.where("kind = 2"))
        if not len(borders.blocks):
            return store.written(spark.createDataFrame([], TRIE), "trie")
        nodes = solved.where("kind = 0").select(*_NODE)
        edges = tables.put("edges", borders.settled(nodes.where("pos = 0 or right")))
        own = F.col("owner") == F.col("block")
        # a node that goes on from other blocks begins where its owner's last conversations do
        begins = edges.where("right").select(F.col("block").alias("owner"), "depth", F.col("pos").alias("owner_pos"))
        placed = edges.where(own).withColumn("at", F.col("pos")).unionByName(edges.where(~own).join(begins, ["owner", "depth"]).withColumn("at", F.col("owner_pos")).drop("owner_pos"))
        placed = tables.put("placed", placed)
        key = ["owner", "at", "depth"]
        pieces = solved.where("kind = 1").select("block", "pos", "depth", "n", "ends").join(placed.select("block", "pos", "depth", "owner", "at"), ["block", "pos", "depth"])
        whole = placed.groupBy(*key).agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("kids", "leaves", "saved")))
        whole = tables.put("whole", whole.join(_joined_ends(pieces), key, "left"))
        # the same by every block's own name of a node
        known = placed.select("block", "pos", "depth", *key[:2]).join(whole.select(*key, "conv"), key).select("block", F.col("pos").alias("up"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("known"))
        above = placed.where(own & (F.col("at") == F.col("pos"))).select(*key, "block", "up", "ends")
        edge = whole.join(above, key).withColumns({"ends": F.coalesce("sha", "ends"), "up_edge": F.lit(True), "up_conv": F.lit(None).cast("long")})
        columns = ["block", "depth", "up", "up_edge", "n", "conv", "up_conv", "kids", "leaves", "saved", "ends"]
        every = nodes.where("pos <> 0 and not right").select(*columns).unionByName(edge.select(*columns))
        below = every.where("up_edge").join(known, ["block", "up", "depth"], "left").withColumn("up_conv", F.col("known")).select(*columns)
        out = every.where("not up_edge").unionByName(below)
        named = {"conv": "conv_id", "depth": "depth", "up_conv": "parent_conv_id", "n": "n_convs", "kids": "n_children", "leaves": "n_leaves", "saved": "saved_tokens"}
        return store.written(out.select(*(F.col(c).cast("long").alias(n) for c, n in named.items()), F.col("ends").alias("ends_sha256")), "trie")
