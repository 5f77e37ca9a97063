"""Exact dedup on a cuckoo-filter index of live content digests.

Texts are equal when their normalised forms are; the SHA-256 of that form is the key. The index is
dealt into shards by digest. A shard is a cuckoo filter (four 16-bit fingerprints a bucket) whose slots
point at the stored keys of the bucket: a look-up that hits is verified against those keys, so a false
hit of the filter never joins two texts. Insertion moves fingerprints between their two buckets; if no
place is found, the filter is built anew at twice the size from the stored keys. Deletion frees the
slot of a live digest.

A group of copies is pre-aggregated (in each map task and per salt) before it reaches its shard, so
even a third of all rows arrives as a few partial rows. The number of shards follows the number of digests at
every change, so shards keep their size however often the index grows. An index is opened again by its folder; a
change counts once its version is listed there, so one that failed half-way leaves the index as it was.

Defined results: null counts as empty, and all empty texts are one group; of a group the row with the
most code points, then the smallest key (null first) stays; of rows repeated with the same key and
length exactly one stays; an empty table gives no rows; extra columns stay (deduplicate) or are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .words import utf8

#: Digests of one shard, on average, and the salts that a hot digest is spread over before it.
SHARD_ROWS, SALTS = 100_000, 16
#: Deleted by normalisation: [\x20\x09-\x0D]
WHITE = bytes([0x20, *range(0x09, 0x0E)])


class CuckooIndex:
    """A cuckoo filter over stored keys (digests of 16 bytes or more)."""

    SLOTS, KICKS = 4, 400

    def __init__(self, keys: Iterable[bytes] = (), buckets: int = 64):
        self.keys: list[bytes | None] = []
        self.row_of_free: list[int] = []
        self.live = self.resizes = 0
        self._empty(buckets)
        for k in keys:
            self.insert(k)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = array("H", bytes(2 * self.SLOTS * buckets))
        self.rows = array("q", bytes(8 * self.SLOTS * buckets))

    def _place(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:2], "little") or 1
        one = int.from_bytes(key[8:16], "little") & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 >> 7 & self.mask)

    def _slot(self, key: bytes) -> int:
        """The slot that holds the key, verified against the stored key; -1 if there is none."""
        mark, one, two = self._place(key)
        for bucket in (one, two):
            for slot in range(self.SLOTS * bucket, self.SLOTS * bucket + self.SLOTS):
                if self.prints[slot] == mark and self.keys[self.rows[slot]] == key:
                    return slot
        return -1

    def maybe(self, key: bytes) -> bool:
        """The filter's own answer: no false negatives, a few false positives."""
        mark, one, two = self._place(key)
        s = self.SLOTS
        return mark in self.prints[s * one : s * one + s] or mark in self.prints[s * two : s * two + s]

    def find(self, key: bytes) -> int:
        """The row of a live key, -1 if it isn't live."""
        if not self.maybe(key) or (slot := self._slot(key)) < 0:
            return -1
        return self.rows[slot]

    def insert(self, key: bytes) -> int:
        """Add a key that is not live; its row."""
        row = self.row_of_free.pop() if self.row_of_free else len(self.keys)
        if row == len(self.keys):
            self.keys.append(key)
        else:
            self.keys[row] = key
        self.live += 1
        if not self._seat(key, row):
            self._resize()
        return row

    def _seat(self, key: bytes, row: int) -> bool:
        mark, bucket, two = self._place(key)
        for kick in range(self.KICKS):
            for b in (bucket, two) if not kick else (bucket,):
                for slot in range(self.SLOTS * b, self.SLOTS * b + self.SLOTS):
                    if not self.prints[slot]:
                        self.prints[slot], self.rows[slot] = mark, row
                        return True
            slot = self.SLOTS * bucket + kick % self.SLOTS
            self.prints[slot], mark = mark, self.prints[slot]
            self.rows[slot], row = row, self.rows[slot]
            bucket = self._other(bucket, mark)
        return False

    def _resize(self) -> None:
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.resizes += 1
            self._empty(buckets)
            if all(self._seat(k, row) for row, k in enumerate(self.keys) if k is not None):
                return

    def delete(self, key: bytes) -> bool:
        """Take out a live key; false if it isn't live."""
        slot = self._slot(key)
        if slot < 0:
            return False
        row = self.rows[slot]
        self.prints[slot] = 0
        self.keys[row] = None
        self.row_of_free.append(row)
        self.live -= 1
        return True


def digests(docs: DataFrame, *, key: str, text: str, carry: list[Column] | None = None) -> DataFrame:
    """key, chars (code points of the original text), digest (32 bytes), and the carried columns."""
    rows = docs.select(F.col(key).alias("key"), F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("chars"), F.col(text).alias("text"), *(carry or []))
    extra = [f for f in rows.schema.fields if f.name not in ("key", "chars", "text")]
    names = ["key", "chars", "digest", *(f.name for f in extra)]
    kinds = ", ".join([f"key {rows.schema['key'].dataType.simpleString()}, chars long, digest binary", *(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashlib.sha256(t.translate(None, WHITE)).digest() for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("chars"), pa.array(found, pa.binary()), *(batch.column(f.name) for f in extra)], names=names)

    return rows.mapInArrow(run, kinds)


class DedupIndex:
    """The index as tables of the shared folder, a new version for each change; the one before stays, older ones
    go. What insert and delete return is to be used before the next change but one."""

    def __init__(self, spark: SparkSession, folder: str | None = None, shard_rows: int = SHARD_ROWS):
        self.spark, self.shard_rows = spark, shard_rows
        self.folder = folder or store.new_path(spark, "dedup-index")
        self.version, self.live = 0, 0
        if store.exists(spark, self._listed):
            self.version, self.live = spark.read.schema("version long, live long").parquet(self._listed).orderBy(F.desc("version")).first()

    @property
    def _listed(self) -> str:
        return f"{self.folder}/versions"

    def _at(self, version: int) -> str:
        return f"{self.folder}/v{version}"

    def _schema(self, kind: str) -> str:
        return f"shard long, digest binary, chars long, key {kind}, row long, batch long, n long, live boolean"

    def _stored(self, kind: str) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], self._schema(kind))
        return self.spark.read.schema(self._schema(kind)).parquet(self._at(self.version)).where("live").withColumn("shard", self._shard())

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards))

    def _change(self, incoming: DataFrame, kind: str, remove: bool) -> DataFrame:
        """Runs each shard's filter over its stored keys and the incoming partial groups; the new
        version's rows. Rows that are not live any more are marked."""
        names = ["shard", "digest", "chars", "key", "row", "batch", "n", "live"]
        target = self.spark.createDataFrame([], self._schema(kind)).schema

        def better(a: tuple, b: tuple) -> tuple:
            """Most code points, then the smallest key (null first), then the first row."""
            order = lambda x: (-x[0], x[1] is not None, x[1] if x[1] is not None else 0, x[3], x[2])
            return min(a, b, key=order)

        def run(stored: pa.Table, new: pa.Table) -> pa.Table:
            shard = (stored if stored.num_rows else new).column("shard")[0].as_py()
            index, best, count = CuckooIndex(buckets=1 << max(6, (stored.num_rows // 3).bit_length())), [], []
            gone: list[tuple] = []
            for d, *x, n in zip(*(stored.column(c).to_pylist() for c in ("digest", "chars", "key", "row", "batch", "n")), strict=True):
                index.insert(d)
                best.append(tuple(x))
                count.append(n)
            for d, *x, n in zip(*(new.column(c).to_pylist() for c in ("digest", "chars", "key", "row", "batch", "n")), strict=True):
                row = index.find(d)
                if remove:
                    if row >= 0 and index.delete(d):
                        gone.append((d, *best[row], count[row], False))
                elif row >= 0:
                    best[row], count[row] = better(best[row], tuple(x)), count[row] + n
                else:
                    index.insert(d)
                    best.append(tuple(x))
                    count.append(n)
            rows = [(d, *best[i], count[i], True) for i, d in enumerate(index.keys) if d is not None] + gone
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = new.schema.field("key").type
            return pa.table([pa.array([shard] * len(rows), pa.int64()), *(pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), kinds, pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True))], names=names)

        out = self._stored(kind).groupBy("shard").cogroup(incoming.groupBy("shard")).applyInArrow(run, target)
        version = self.version + 1
        out.write.mode("overwrite").parquet(self._at(version))  # what a failed change may have left goes
        changed = self.spark.read.schema(target).parquet(self._at(version))
        self.live = changed.where("live").count()
        self.spark.createDataFrame([(version, self.live)], "version long, live long").coalesce(1).write.mode("append").parquet(self._listed)
        if self.version > 1:
            store.discard(self.spark, self._at(self.version - 1))
        self.version = version
        return changed

    def _partial(self, rows: DataFrame) -> DataFrame:
        """One row per digest and salt, with its shard."""
        salt = F.pmod(F.xxhash64("key", "row"), F.lit(SALTS))
        first = F.min(F.struct((-F.col("chars")).alias("less"), "key", "row"))
        partial = rows.groupBy("digest", salt.alias("salt")).agg(first.alias("best"), F.count("*").alias("n"))
        return partial.select(self._shard().alias("shard"), "digest", (-F.col("best.less")).alias("chars"), "best.key", "best.row", F.lit(self.version + 1).cast("long").alias("batch"), "n")

    def _rows(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        rows = store.written(digests(docs, key=key, text=text).withColumn("row", F.monotonically_increasing_id()), "digests")
        self.shards = max(1, -(-(self.live + rows.count()) // self.shard_rows))
        return rows

    def insert(self, docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Add the documents; per document: key, chars, digest, row (its number here), keep_key, keep_row (null if
        an earlier insertion's row stays), group_size (live copies, earlier insertions included)."""
        rows = self._rows(docs, key, text)
        groups = self._change(self._partial(rows), rows.schema["key"].dataType.simpleString(), remove=False).where("live")
        kept = groups.select("digest", F.col("key").alias("keep_key"), F.when(F.col("batch") == self.version, F.col("row")).alias("keep_row"), F.col("n").alias("group_size"))
        return rows.join(kept, "digest")

    def delete(self, docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Take the digests of these texts out of the index; the digests that were live, with their size."""
        rows = self._rows(docs, key, text)
        return self._change(self._partial(rows), rows.schema["key"].dataType.simpleString(), remove=True).where("not live").select("digest", "n")


def report(docs: DataFrame, *, index: DedupIndex | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, keep_id, group_size, kept, text_sha256 for every row."""
    found = (index or DedupIndex(docs.sparkSession)).insert(docs, key=key, text=text)
    return found.select(F.col("key").alias(key), F.col("keep_key").alias("keep_id"), "group_size", F.col("row").eqNullSafe(F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the one row of each group that stays; all columns stay."""
    found = DedupIndex(docs.sparkSession).insert(docs, key=key, text=text)
    # joined and made unique by the same columns: the texts are dealt out once
    by = lambda name: F.xxhash64(name)
    kept = found.where("row = keep_row").select(by("key").alias("__j"), F.col("key").alias("__k"), F.col("digest").alias("__d"), F.col("chars").alias("__c"))
    tagged = digests(docs, key=key, text=text, carry=[F.struct(*(F.col(c) for c in docs.columns)).alias("__doc")]).withColumn("by", by("key"))
    same = (F.col("by") == F.col("__j")) & (F.col("digest") == F.col("__d")) & (F.col("chars") == F.col("__c")) & F.col("key").eqNullSafe(F.col("__k"))
    return tagged.join(kept, same, "left_semi").dropDuplicates(["by", "digest", "chars"]).select("__doc.*")
