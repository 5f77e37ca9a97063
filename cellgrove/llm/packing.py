"""Packing of tokenised documents into fixed windows by minimum bin slack.

Documents longer than a window are cut into whole windows and a rest. Rests and short documents are
packed by length: for each new sequence the longest remaining length is taken, and a subset-sum
dynamic programme over the remaining-length multiset (one bit per reachable fill, an integer used as
the bit set) finds the multiset that fills the window closest to capacity; backtracking gives the
count of each length, and the same multiset is taken as often as the remaining counts allow.

Packing runs in buckets of bounded size, dealt by a hash of the piece, so no task grows with the
input. Sequences a bucket could not fill are opened again and packed in a second round with those of
many other buckets. Bucket numbers and local numbers make the sequence ids; they depend on the data
alone, so a task that is run again gives the same ids.

Defined results: null or empty text is the end token alone; repeated rows are packed each on its own;
an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store, tokens

CAPACITY = 4096
END_ID = 2
#: Pieces of one bucket, on average; the second round deals out sequences, not pieces.
BUCKET_ROWS = 4000
#: A sequence with less slack than this is closed in the first round.
GOOD_SLACK = 8
TOKENIZER = "word_bpe_49k.json"


def best_multiset(counts: dict[int, int], capacity: int) -> Counter:
    """The multiset of lengths (within ``counts``) whose sum is the largest not above ``capacity``.

    Bit s of ``reached`` says that sum s can be made. Lengths enter from the largest down, a count c as
    1, 2, 4, ... copies at once; the programme ends as soon as the capacity itself is reached.
    """
    reached, steps, within = 1, [], (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, lot = min(counts[length], capacity // length), 1
        while left:
            lot = min(lot, left)
            steps.append((reached, length, lot))
            reached = (reached | reached << length * lot) & within
            left -= lot
            lot *= 2
        if reached >> capacity:
            break
    total, chosen = reached.bit_length() - 1, Counter()
    for before, length, lot in reversed(steps):
        if not before >> total & 1:  # only reachable with this lot
            chosen[length] += lot
            total -= length * lot
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    """Minimum bin slack over a whole multiset: (lengths of a sequence, number of such sequences)."""
    counts, out = {k: v for k, v in counts.items() if v > 0}, []
    while counts:
        seed = max(counts)
        rest = dict(counts)
        rest[seed] -= 1
        if not rest[seed]:
            del rest[seed]
        chosen = best_multiset(rest, capacity - seed)
        chosen[seed] += 1
        times = min(counts[k] // n for k, n in chosen.items())
        out.append((chosen, times))
        for k, n in chosen.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return out


def pieces(docs: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each document's ids cut at multiples of the capacity: key, start, length, ids_crc32, doc_tokens."""
    path = tokenizer or tokens.default_path(TOKENIZER)
    kind = docs.schema[key].dataType
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import chunks, utf8

        bpe = tokens.word_bpe(path)
        for batch in batches:
            texts = utf8(batch.column(1))
            row, start, length, crc, total = [], [], [], [], []
            for a, b in chunks(texts):
                for i, ids in enumerate(bpe.encode(texts[a:b]), a):
                    packed = ids.tobytes() + end
                    n = len(packed) // 4
                    for s in range(0, n, capacity):
                        row.append(i)
                        start.append(s)
                        length.append(min(capacity, n - s))
                        crc.append(zlib.crc32(packed[4 * s : 4 * (s + capacity)]))
                        total.append(n)
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int32())), *numbers], names=["key", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long")


def _pack_bucket(bucket: int, lengths: list[int], capacity: int, good: int, last: bool) -> tuple[list[int], list[int], list[bool]]:
    """Sequence id, offset and closed for each of a bucket's pieces, which come in a fixed order."""
    by_length: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(lengths):
        by_length[n].append(i)
    sequence, offset, closed = [0] * len(lengths), [0] * len(lengths), [False] * len(lengths)
    number = 0
    for chosen, times in plan({n: len(x) for n, x in by_length.items()}, capacity):
        full = last or sum(n * c for n, c in chosen.items()) >= capacity - good
        for _ in range(times):
            at = 0
            for n in sorted(chosen, reverse=True):
                for _ in range(chosen[n]):
                    i = by_length[n].pop()
                    sequence[i], offset[i], closed[i] = bucket << 32 | number, at, full
                    at += n
            number += 1
    return sequence, offset, closed


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS, good_slack: int = GOOD_SLACK) -> DataFrame:
    """``pieces`` (with ``length``, all at most the capacity) with sequence_id and offset.

    ``pieces`` must be a stored table (it is read again); the packing is stored in the shared folder.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name in names)
    schema = f"{kinds}, sequence_id long, offset long, closed boolean"

    def packer(last: bool):
        def run(group: pa.Table) -> pa.Table:
            bucket = group.column("bucket")[0].as_py()
            group = group.select(names).sort_by([(c, "ascending") for c in names])
            found = _pack_bucket(2 * bucket + last, group.column("length").to_pylist(), capacity, good_slack, last)
            for name, values, kind in zip(("sequence_id", "offset", "closed"), found, (pa.int64(), pa.int64(), pa.bool_()), strict=True):
                group = group.append_column(name, pa.array(values, kind))
            return group

        return run

    def dealt(df: DataFrame, rows: int) -> DataFrame:
        # the running number parts repeated rows; it is the same whenever a stored file is read again
        return df.withColumn("bucket", F.pmod(F.xxhash64(*names, F.monotonically_increasing_id()), F.lit(max(1, -(-rows // bucket_rows)))))

    first = store.written(dealt(pieces, pieces.count()).groupBy("bucket").applyInArrow(packer(last=False), schema), "packed")
    opened = first.where("not closed").select(*names)
    second = dealt(opened, opened.count()).groupBy("bucket").applyInArrow(packer(last=True), schema)
    return first.where("closed").unionByName(second).drop("closed")


def pack_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise, cut and pack: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = store.written(pieces(docs, key=key, text=text, tokenizer=tokenizer, capacity=capacity, end_id=end_id), "pieces")
    return pack(cut, capacity=capacity).withColumnRenamed("key", key)
