"""SentencePiece encoding and decoding by a merge-type prefix table.

A byte-pair model gives every prefix of a text exactly one last token: token t ends a prefix if it matches there and
is compatible with the last token of the prefix before it, where two tokens are compatible if merging their joined
characters gives just the two again. So one pass over the matches of an automaton fills a table of last tokens, and
the ids are read backwards from its end, in time that grows with the text alone.

No piece holds a space mark behind another character, and none a line feed, so no merge crosses such a place (both
are checked when a model is loaded). The table is filled between those places, and units seen before are taken from
a bounded table of each worker: 64-bit hash to ids, as in ``tokens``.

Defined results: null and empty texts have no ids and decode to the empty text; characters without a piece become
the byte pieces of their UTF-8; special strings inside texts are ordinary text; a space mark (U+2581) in a text reads
as a space, as the library has it; repeated rows are each encoded; very long texts are never cut; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .words import chunks, range_hashes, utf8

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Pair tests that a worker keeps.
PAIRS = 1_000_000


class PieceBpe:
    """A SentencePiece model of kind BPE with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if sp.normalize(" ﬁ\t  x ") != f"{MARK}{MARK}ﬁ\t{MARK}{MARK}x{MARK}":
            raise ValueError("only models with a dummy prefix and no other normalisation are read")
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        if any(MARK in self.pieces[i].lstrip(MARK) or "\n" in self.pieces[i] for i in text):
            raise ValueError("a piece crosses a space mark or a line feed")
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        #: Merges take the best score first, of equal ones the leftmost.
        self.rank = {self.pieces[i]: -sp.get_score(i) for i in text}
        self.spines = {c: [(c, -1.0)] for p in self.rank for c in p}, {c: [(c, -1.0)] for p in self.rank for c in p}
        self.automaton = ahocorasick.Automaton()
        for i in sorted(text, key=lambda i: self.rank[self.pieces[i]]):
            if self._grown(self.pieces[i]):
                self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), i))
        # a character within pieces only: merges need it, its own ids are bytes
        self.inner: dict[int, str] = dict(enumerate(sorted({c for i in text for c in self.pieces[i]} - set(self.rank)), n))
        for i, c in self.inner.items():
            self.automaton.add_word(c, (1, i))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.known = tokens._Table()
        plain = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.plain, self.digits = _Flat(plain), _Flat([b"%d," % i for i in range(n)])
        self.odd = np.array([sp.is_control(i) or sp.is_unknown(i) for i in range(n)])
        self.spaced = np.array([p.startswith(MARK) for p in self.pieces])

    def _merged(self, text: str, cut: int = 0) -> list[str]:
        """What is left when nothing merges any more, but for the last merge; ends early at one that crosses ``cut``."""
        rank, parts = self.rank, list(text)
        while len(parts) > 2:
            found = [(rank[x], k) for k in range(len(parts) - 1) if (x := parts[k] + parts[k + 1]) in rank]
            if not found:
                break
            k = min(found)[1]
            if cut and sum(map(len, parts[: k + 1])) == cut:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _grown(self, piece: str) -> bool:
        """Whether the characters of a piece merge to it at all. If its parts all have better ranks than the wholes they
        make, its left and right spines are noted: its first and its last part, their own, and so on, with the ranks
        at which they are made."""
        if len(piece) > 1:
            parts = self._merged(piece)
            if len(parts) > 2:
                return False
            left, right = self.spines
            before, after, rank = left.get(parts[0]), right.get(parts[1]), self.rank[piece]
            # both parts need both spines: each then has merged in the order of ranks throughout
            if before and after and parts[0] in right and parts[1] in left and before[0][1] < rank > after[0][1]:
                left[piece], right[piece] = [(piece, rank), *before], [(piece, rank), *after]
        return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the characters of both tokens gives the two again."""
        one, two = (self.pieces[i] if i < len(self.pieces) else self.inner[i] for i in (a, b))
        left, right = self.spines[1].get(one), self.spines[0].get(two)
        rank, end = self.rank, float("inf")
        if left is None or right is None:
            parts = self._merged(one + two, len(one))
            return len(parts) == 2 and len(parts[0]) == len(one) and one + two not in rank
        # the parts beside the place between the tokens, from single characters on, in the order of merges
        i, j = len(left) - 1, len(right) - 1
        while True:
            until = left[i - 1][1] if i else end, right[j - 1][1] if j else end
            across = rank.get(left[i][0] + right[j][0])
            if across is not None and across < until[0] and across <= until[1]:
                return False
            if until[0] <= until[1]:  # of equal merges the left one comes first
                if not i:
                    return True
                i -= 1
            else:
                j -= 1

    def unit(self, text: str) -> list[int]:
        """Ids of a text that is already normalised."""
        # last[p]: the last token of the first p characters; a character without any piece is the token -1
        last, lengths, at, fits = [-1] * (len(text) + 1), [1] * (len(text) + 1), 0, self.fits
        for end, (length, token) in self.automaton.iter(text):
            end += 1
            if end == at:
                continue  # found already: a prefix has one last token
            begin = end - length
            if begin and (before := last[begin]) >= 0:
                pair = (before, token)
                ok = fits.get(pair)
                if ok is None:
                    if len(fits) >= PAIRS:
                        fits.clear()
                    ok = fits[pair] = self.compatible(before, token)
                if not ok:
                    continue
            last[end], lengths[end], at = token, length, end
        out, p = [], len(text)
        while p:
            token, begin = last[p], p - lengths[p]
            if 0 <= token < len(self.pieces):
                out.append(token)
            else:
                out += [self.bytes[b] for b in reversed(text[begin:p].encode())]
            p = begin
        return out[::-1]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids (little-endian 32 bits) of each whole text."""
        out: list[np.ndarray] = []
        for a, b in chunks(texts):
            part = [b" " + t.replace(MARK.encode(), b" ") if t else b"" for t in texts[a:b]]
            data = np.frombuffer(b"".join(part), np.uint8)
            offsets = np.append(0, np.cumsum([len(t) for t in part]))
            starts, ends = _units(data, offsets)

            def learn(hashes: np.ndarray, at: np.ndarray, data: np.ndarray = data, starts: np.ndarray = starts, ends: np.ndarray = ends) -> None:
                found = [self.unit(data[s:e].tobytes().decode().replace(" ", MARK)) for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                self.known.add(hashes, [len(x) for x in found], np.fromiter((i for x in found for i in x), "<u4"))

            rows = self.known.look_up(range_hashes(data, starts, ends), learn)
            lengths = self.known.length[rows]
            upto = np.append(0, np.cumsum(lengths))
            ids = self.known.ids[np.repeat(self.known.begin[rows] - upto[:-1], lengths) + np.arange(upto[-1])]
            cuts = upto[np.searchsorted(starts, offsets)]
            out += [ids[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, as UTF-8. Ids that give no text of their own, or no whole characters, go to the library."""
        if not len(ids):
            return b""
        out = self.plain.joined(ids)
        try:
            out.decode()
            whole = not self.odd[ids].any()
        except UnicodeDecodeError:
            whole = False
        if not whole:
            return self.library.decode(ids.tolist()).encode()
        return out[1:] if self.spaced[ids[0]] else out

    def decimal(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return self.digits.joined(ids)[:-1]


class _Flat:
    """Byte strings by number, joined in any order without a loop."""

    def __init__(self, values: list[bytes]):
        self.data = np.frombuffer(b"".join(values), np.uint8)
        self.length = np.array([len(v) for v in values], np.int64)
        self.begin = np.cumsum(self.length) - self.length

    def joined(self, at: np.ndarray) -> bytes:
        out = []
        for k in range(0, len(at), 1 << 18):
            i = at[k : k + (1 << 18)]
            n = self.length[i]
            upto = np.cumsum(n)
            out.append(self.data[np.repeat(self.begin[i] - upto + n, n) + np.arange(upto[-1])].tobytes())
        return b"".join(out)


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of what is merged on its own: texts part before a space that follows something else, and on
    both sides of a line feed."""
    space, feed = data == 0x20, data == 0x0A
    begin = np.zeros(len(data), bool)
    begin[1:] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begin)
    return starts, np.append(starts[1:], len(data)) if len(starts) else starts


@cache
def piece_bpe(path: str) -> PieceBpe:
    """One per worker process, kept over tasks."""
    return PieceBpe(path)


def encode(docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """key, ids (array of int) of every row."""
    path, kind = model or tokens.default_path(MODEL), docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(path)
        for batch in batches:
            ids = bpe.encode(utf8(batch.column(1)))
            flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32)
            offsets = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["key", "ids"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, *, key: str = "doc_id", ids: str = "ids", model: str | None = None) -> DataFrame:
    """key, text of every row of ids; null ids are none."""
    path, kind = model or tokens.default_path(MODEL), encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(path)
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], "<u4")).decode() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    return encoded.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """key, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the text decoded from the
    ids), without moving ids between processes."""
    path, kind = model or tokens.default_path(MODEL), docs.schema[key].dataType.simpleString()
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(path)
        for batch in batches:
            n, coded, decoded = [], [], []
            texts = utf8(batch.column(1))
            for a, b in chunks(texts):
                for ids in bpe.encode(texts[a:b]):
                    n.append(len(ids))
                    coded.append(sha(bpe.decimal(ids)))
                    decoded.append(sha(bpe.decode(ids)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)
