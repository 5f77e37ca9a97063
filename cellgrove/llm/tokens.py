"""Token ids and token counts of whole texts, word by word through a bounded cache.

Both vocabularies split a text at white space before any merge, so the ids of a text are those of its
space-separated pieces in order. Pieces recur, so each worker keeps a bounded table of them (by 64-bit
hash, numpy) and only encodes what it has not seen. Byte-pair merging itself is done by tiktoken on ranks read from the
tokenizer's own JSON file; texts outside the plain case (see ``_plain``) go to the tokenizers library
whole. Tests hold both paths against the library.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from .words import Words, chunks, mix

#: Entries a worker's dictionary may hold, and how many of the oldest (most frequent) ones stay then.
CACHE_ROWS, CACHE_KEPT = 600_000, 300_000


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def file_digest(path: str) -> str:
    """Identifies the tokenizer's version: SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


@cache
def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


#: Pieces end at a blank or a line feed.
_PIECE = np.ones(256, bool)
_PIECE[[0x20, 0x0A]] = False


class _Table:
    """What is known of pieces, by 64-bit hash: a run of ids, or a number. Bounded: beyond CACHE_ROWS
    only the first CACHE_KEPT, which are the frequent ones, stay."""

    def __init__(self) -> None:
        self._reset(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.ids = np.zeros(0, "<u4")

    def _reset(self, hashes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
        self.order = np.argsort(hashes)
        self.sorted, self.hashes, self.begin, self.length = hashes[self.order], hashes, begin, length

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where there is none."""
        if not len(self.sorted):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[place] == hashes, self.order[place], -1)

    def add(self, hashes: np.ndarray, lengths: list[int], ids: np.ndarray | None = None) -> None:
        length = np.array(lengths, np.int64)
        begin = len(self.ids) + np.cumsum(length) - length
        if ids is not None:
            self.ids = np.concatenate([self.ids, ids])
        self._reset(np.concatenate([self.hashes, hashes]), np.concatenate([self.begin, begin]), np.concatenate([self.length, length]))

    def trim(self) -> None:
        if (n := CACHE_KEPT) and len(self.hashes) > CACHE_ROWS:
            self.ids = self.ids[: self.begin[n]]
            self._reset(self.hashes[:n], self.begin[:n], self.length[:n])

    def look_up(self, hashes: np.ndarray, learn) -> np.ndarray:
        """Rows of all hashes; ``learn(positions of the first occurrence of unknown ones)`` adds those."""
        self.trim()
        each, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        new = self.slots(each) < 0
        if new.any():
            learn(each[new], first[new])
        return self.slots(each)[back]


class WordBpe:
    """Ids under a lower-casing word-end BPE vocabulary. Packed little-endian 32-bit ids per text."""

    _WORD_END = "</w>"
    #: Characters for which lower-casing and letter classes agree in Python and in the library and that
    #: no normalisation changes: printable ASCII, Latin letters.
    _EASY = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u01c3\n]*")
    #: The file's own split pattern over those characters; a line feed parts one piece from the next.
    _SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u01c3]+|[0-9]|[^\na-z0-9\u00df-\u00f6\u00f8-\u01c3]+|\n")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = _byte_alphabet()
        ranks: dict[bytes, int] = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in self.special:  # a blank, which no word holds, takes the place of the word-end mark
                ranks[bytes(letters[c] for c in token.removesuffix(self._WORD_END)) + b" " * token.endswith(self._WORD_END)] = i
        self.bpe = tiktoken.Encoding("word_end", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.gap = ranks[b"\n "]
        self.known = _Table()

    def _exact(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _encode(self, pieces: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        easy = []
        for i, p in enumerate(pieces):
            if self._EASY.fullmatch(p) and not ("<|" in p and any(s in p for s in self.special)):
                easy.append(i)
            else:
                out[i] = self._exact(p)
        # every piece, then a line feed: its id marks where the piece's ids end
        words = self._SPLIT.findall("\n".join([*(pieces[i] for i in easy), ""]).lower())
        ids = np.array(self.bpe.encode_ordinary(" ".join([*words, ""])), "<u4")
        a = 0
        for i, b in zip(easy, np.flatnonzero(ids == self.gap).tolist(), strict=True):
            out[i] = ids[a:b]
            a = b + 1
        return out

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids (little-endian 32 bits) of each whole text."""
        out: list[np.ndarray] = []
        for begin, end in chunks(texts):
            w = Words(texts[begin:end], _PIECE, lower=False)

            def learn(hashes: np.ndarray, at: np.ndarray, w: Words = w) -> None:
                data = w.data
                found = self._encode([data[s:e].tobytes().decode() for s, e in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)])
                self.known.add(hashes, [len(x) for x in found], np.concatenate(found))

            rows = self.known.look_up(w.hashes, learn)
            lengths = self.known.length[rows]
            upto = np.append(0, np.cumsum(lengths))
            ids = self.known.ids[np.repeat(self.known.begin[rows] - upto[:-1], lengths) + np.arange(upto[-1])]
            cuts = upto[w.first]
            out += [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return out


class ByteBpeCounter:
    """Numbers of tokens under a byte-level BPE vocabulary that splits before a word's leading blank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = _byte_alphabet()
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        import public_tokenizers

        self.bpe = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known = _Table()

    def _plain(self, text: str) -> bool:
        """Every run of white space is one blank or one line feed, inside the text: then a piece with
        the white space before it is merged on its own."""
        return " ".join(text.split()) == text.replace("\n", " ") and not ("<|" in text and any(s in text for s in self.special))

    def count(self, texts: list[bytes]) -> list[int]:
        """Number of tokens of each whole text."""
        out: list[int] = []
        for begin, end in chunks(texts):
            part = texts[begin:end]
            odd = {i: t for i, b in enumerate(part) if not self._plain(t := b.decode())}
            w = Words([b"" if i in odd else t for i, t in enumerate(part)], _PIECE, lower=False)
            before = w.data[w.starts - 1].astype(np.uint64)  # the blank or line feed merged with a piece
            before[w.first[:-1][np.diff(w.first) > 0]] = 0  # the first piece of a text has none

            def learn(hashes: np.ndarray, at: np.ndarray, w: Words = w, before: np.ndarray = before) -> None:
                data, encode = w.data, self.bpe.encode_ordinary
                self.known.add(hashes, [len(encode(data[s - (x > 0) : e].tobytes().decode())) for s, e, x in zip(w.starts[at].tolist(), w.ends[at].tolist(), before[at].tolist(), strict=True)])

            rows = self.known.look_up(mix(w.hashes + before), learn)
            upto = np.append(0, np.cumsum(self.known.length[rows]))
            counts = np.diff(upto[w.first]).tolist()
            for i, t in odd.items():
                counts[i] = len(self.library.encode(t, add_special_tokens=False).ids)
            out += counts
        return out


@cache
def word_bpe(path: str) -> WordBpe:
    """One per worker process, kept over tasks."""
    return WordBpe(path)


@cache
def byte_bpe_counter(path: str) -> ByteBpeCounter:
    return ByteBpeCounter(path)
