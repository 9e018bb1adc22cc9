"""Byte-level BPE with a contiguous array of ranks, and the way back to text.

A word is held as part boundaries and, beside them, the rank of each adjacent pair.
The smallest rank is looked for, the boundary between its two parts is deleted, and the
ranks on either side are refreshed, until no pair is in the merge list. Scanning a short
array beats any cleverer structure; words beyond ``SHORT`` bytes use a heap instead, since
the scan is quadratic. Both give the library's ids (smallest rank first, leftmost on ties).

Texts are cut at single blanks between two non-blank characters, where the published
pattern always begins a token, and the ids of each piece are remembered, so that the
pattern and the merges run once for a frequent piece. The memory is emptied when full:
it bounds a worker's memory and never changes a result.

Cases: a null or empty text has no ids and decodes to ''; a special token's string inside a
text is that token, as the library does by default; any text comes back unchanged; columns
named like the new ones are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from panelwatch.llm.common import append_arrow

#: Fixed value: the published pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Marks that are a token of their own after a letter and at the end of a text.
MARKS = frozenset(".,;:!?")
SHORT = 96
PIECES = 120_000
NO_PAIR = 1 << 40


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Codec:
    """The vocabulary file of the tokenizers library, and the two directions."""

    #: Pieces, and words, remembered in each generation.
    room = PIECES

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        as_bytes = lambda s: bytes(of_letter[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token = {i: as_bytes(s) for s, i in vocab.items() if s not in self.specials}
        self.token |= {i: s.encode() for s, i in self.specials.items()}
        self.byte_id = [vocab[c] for c in byte_letters()]
        self.pairs, self.merged = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault(vocab[a] << 20 | vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.pattern = regex.compile(PATTERN)
        names = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.words = Memory(self._packed_word, self.room)
        self.inner = Memory(self._inner_piece, self.room)

    def word_ids(self, word: bytes) -> list[int]:
        ids = [self.byte_id[b] for b in word]
        return self._scan(ids) if len(ids) <= SHORT else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        pair = self.pairs.get
        bounds = list(range(len(ids) + 1))
        ranks = [pair(a << 20 | b, NO_PAIR) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NO_PAIR:
            i = ranks.index(least)
            ids[i] = self.merged[least]
            del bounds[i + 1], ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = pair(ids[i - 1] << 20 | ids[i], NO_PAIR)
            if i < len(ranks):
                ranks[i] = pair(ids[i] << 20 | ids[i + 1], NO_PAIR)
        assert len(bounds) == len(ids) + 1
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        n, pair = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (r, i, ids[i], ids[i + 1])
            for i in range(n - 1)
            if (r := pair(ids[i] << 20 | ids[i + 1], NO_PAIR)) < NO_PAIR
        ]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merged[rank], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n:
                    r = pair(ids[left] << 20 | ids[right], NO_PAIR)
                    if r < NO_PAIR:
                        heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [t for t in ids if t >= 0]

    def plain_ids(self, text: str) -> bytes:
        """Ids of a text without special tokens, packed."""
        return b"".join([self.words[w] for w in self.pattern.findall(text)])

    def _packed_word(self, word: str) -> bytes:
        ids = self.word_ids(word.encode())
        return pack(f"<{len(ids)}I", *ids)

    def _inner_piece(self, piece: str) -> bytes:
        """Ids of a piece after a blank between two other characters."""
        # Letters alone, or before one mark, need no pattern: it finds just these tokens.
        if piece.isalpha():
            return self.words[" " + piece]
        if piece[-1:] in MARKS and piece[:-1].isalpha():
            return self.words[" " + piece[:-1]] + self.words[piece[-1]]
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Blank
        return self.piece_ids(" " + piece)

    def piece_ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special is None or not self.special.search(text):
            return self.plain_ids(text)
        return b"".join(
            self.specials[x].to_bytes(4, "little") if x in self.specials else self.plain_ids(x)
            for x in self.special.split(text)
            if x
        )

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after another."""
        head, *rest = text.split(" ")
        try:
            if rest and (not head or head[-1].isspace()):
                raise _Blank
            return self.piece_ids(head) + b"".join(map(self.inner.__getitem__, rest))
        except _Blank:
            return self.piece_ids(text)

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; ids outside the vocabulary stand for nothing, as in the library."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        try:
            raw = b"".join(map(self.token.__getitem__, numbers))
        except KeyError:
            raw = b"".join(self.token.get(i, b"") for i in numbers)
        return raw.decode("utf-8", "replace")


class _Blank(Exception):
    """A piece is empty or has white space at an end: the text is cut by the pattern alone."""


class Memory(dict):
    """What ``make`` gives for a key, remembered in two generations of at most ``room`` each.

    When the young one is full it becomes the old one; keys in use come back from there.
    """

    def __init__(self, make: Callable[[str], bytes], room: int):
        super().__init__()
        self.make, self.room, self.old = make, room, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


@cache
def codec(path: str) -> Codec:
    """One per Python worker; workers are reused by later tasks."""
    return Codec(path)


def _unpacked(packed: list[bytes]) -> pa.Array:
    flat = np.frombuffer(b"".join(packed), "<u4").astype("i4")
    ends = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype="i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encode(df: DataFrame, vocabulary: str, text: str = "text", packed: bool = False) -> DataFrame:
    """``df`` with ``ids`` (array of int, or the packed bytes) and ``n_tokens`` (long)."""

    def ids_of(batch: pa.RecordBatch) -> list[pa.Array]:
        own = codec(vocabulary)
        ids = [own.encode(x or "") for x in batch.column(text).to_pylist()]
        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        return [pa.array(ids, pa.binary()) if packed else _unpacked(ids), counts]

    kind = "binary" if packed else "array<int>"
    return append_arrow(df, ids_of, f"ids {kind}, n_tokens bigint")


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` (array of int or packed bytes); null ids give ''."""

    def text_of(batch: pa.RecordBatch) -> list[pa.Array]:
        own, column = codec(vocabulary), batch.column(ids)
        packed = (
            (x or b"" for x in column.to_pylist())
            if pa.types.is_binary(column.type)
            else (np.array([i for i in x or [] if i is not None and i >= 0], "<u4").tobytes() for x in column.to_pylist())
        )
        return [pa.array([own.decode(x) for x in packed], pa.string())]

    return append_arrow(df, text_of, f"{name} string")
