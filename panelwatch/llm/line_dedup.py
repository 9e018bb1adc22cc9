"""Removal of lines that many documents share, by sharded minimal perfect hashing.

A line's key is the line without white space at its ends and with A-Z as a-z. Keys of at least
``LEAST_CHARS`` code points that ``LEAST_DOCS`` documents hold lose their lines everywhere but in
the document with the largest id.

1. Documents are dealt into blocks of about ``BLOCK_BYTES``. A block sends each shard the distinct
   96-bit hashes of its keys once, with how many of its documents hold them and the largest id.
2. A shard adds these up and builds its index: a minimal perfect hash over the distinct hashes
   (levels of bit arrays; a key that is alone in its cell of a level is numbered by the ones
   before it, the others go on to the next level) and, in its order, an array of fingerprints
   and one of counts; largest ids are kept for the keys to be removed only. Indexes are rows of a
   stored table, one for each shard, and can be probed by other documents as well.
3. Blocks probe the arrays of the shards: hashes in, one bit for each back, and the largest id
   where the bit is set. Lines are never rows of a join, and a line that is in every document
   is one entry for each block.

Shards grow in number with the corpus, not in size. Two keys are taken for one with a chance of
about n squared over 2^97 within the corpus; a key that isn't in the index passes for one that
is with a chance of one in 2^32 (documents that were indexed have no such keys).

Cases: a null or empty text is one empty line; every row is a document of its own, so that
repeated rows count as often as they stand there; a null id is smaller than any other, and rows
that share the largest id all keep the line; other columns are left out; an empty table gives
an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import _ship, arrow_type, mixed, stored

LEAST_CHARS, LEAST_DOCS = 20, 3
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 32 << 20
#: Cells for each key of a level, and the number of levels before keys are listed as they are.
SPREAD, LEVELS = 2, 48
#: Stands for a null id: smaller than any other.
NO_ID = -(1 << 63)
SENT = "block int, shard int, entries binary"
INDEX = "shard int, n_keys bigint, sizes array<int>, bits binary, ones binary, rest binary, prints binary, counts binary, last binary"
ANSWER = "block int, shard int, bits binary, last binary"
RESULT = "doc_id bigint, n_lines bigint, n_dropped bigint, kept string"
_ENTRY = np.dtype([("a", "<u8"), ("b", "<u4"), ("n", "<u4"), ("last", "<i8")])
_HASH = np.dtype([("lo", "<u8"), ("hi", "<u8")])
_WORD_BITS = 64


class PerfectHash:
    """A minimal perfect hash: each key of the set has a number of its own below their count."""

    def __init__(self, sizes: list[int], bits: np.ndarray, ones: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.ones, self.rest = sizes, bits, ones, rest

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct 64-bit keys."""
        sizes, levels, left = [], [], keys
        while len(left) and len(sizes) < LEVELS:
            size = -(-SPREAD * len(left) // _WORD_BITS) * _WORD_BITS
            cell = cls._cells(left, size, len(sizes))
            alone = np.bincount(cell, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            left = left[~alone[cell]]
        bits = np.concatenate([np.empty(0, "u1"), *levels])
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits.view("<u8")), dtype="u4")])
        return cls(sizes, bits, ones.astype("<u4"), np.sort(left))

    @staticmethod
    def _cells(keys: np.ndarray, size: int, level: int) -> np.ndarray:
        return ((mixed(keys, level + 1) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype("i8")

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 or that of another key if it isn't of the set."""
        out, left, base = np.full(len(keys), -1, "i8"), np.arange(len(keys)), 0
        words = self.bits.view("<u8")
        for level, size in enumerate(self.sizes):
            cell = base + self._cells(keys[left], size, level)
            hit = (self.bits[cell >> 3] >> (cell & 7).astype("u1") & 1).astype(bool)
            at = cell[hit]
            below = (np.uint64(1) << (at & 63).astype("u8")) - np.uint64(1)
            out[left[hit]] = self.ones[at >> 6].astype("i8") + np.bitwise_count(words[at >> 6] & below)
            left, base = left[~hit], base + size
        if len(left) and len(self.rest):
            place = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            found = self.rest[place] == keys[left]
            out[left[found]] = int(self.ones[-1]) + place[found]
        return out


class ShardIndex:
    """Fingerprints, counts and largest ids of a shard's keys, in the order of its perfect hash."""

    def __init__(self, hashed: PerfectHash, prints: np.ndarray, counts: np.ndarray, last: np.ndarray):
        self.hashed, self.prints, self.counts, self.last = hashed, prints, counts, last

    @staticmethod
    def key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a ^ mixed(b.astype("u8"), 5)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, n: np.ndarray, last: np.ndarray, least: int) -> ShardIndex:
        """Of distinct (a, b) with the number of documents and the largest id of each."""
        keys = cls.key(a, b)
        # Two hashes may be one key (odds as for the hash itself): the later is numbered the same.
        distinct, first = np.unique(keys, return_index=True)
        hashed = PerfectHash.build(distinct)
        at = hashed.numbers(distinct)
        prints, counts, ids = np.empty(len(at), "<u4"), np.empty(len(at), "u1"), np.empty(len(at), "<i8")
        prints[at], counts[at], ids[at] = b[first], np.minimum(n[first], 255), last[first]
        return cls(hashed, prints, counts, ids[counts >= least])

    def row(self, shard: int) -> dict:
        h = self.hashed
        arrays = {"bits": h.bits, "ones": h.ones, "rest": h.rest, "prints": self.prints, "counts": self.counts, "last": self.last}
        return {"shard": shard, "n_keys": len(self.counts), "sizes": h.sizes} | {k: x.tobytes() for k, x in arrays.items()}

    @classmethod
    def of(cls, row: dict) -> ShardIndex:
        read = lambda name, kind: np.frombuffer(row[name], kind)
        hashed = PerfectHash(row["sizes"], read("bits", "u1"), read("ones", "<u4"), read("rest", "<u8"))
        return cls(hashed, read("prints", "<u4"), read("counts", "u1"), read("last", "<i8"))

    def probe(self, a: np.ndarray, b: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes at least ``least`` documents hold, and the largest ids of these."""
        if not len(self.counts):
            return np.zeros(len(a), bool), np.empty(0, "<i8")
        many = self.counts >= least
        place = np.cumsum(many) - 1
        at = self.hashed.numbers(self.key(a, b))
        found = (at >= 0) & (self.prints[at] == b) & many[at]
        return found, self.last[place[at[found]]]


def line_key(line: bytes) -> bytes:
    """Key of an encoded line; b'' if it is too short to count."""
    key = line.strip()
    if len(key) < LEAST_CHARS:
        return b""
    if len(key) < 4 * LEAST_CHARS and not key.isascii() and len(key.decode()) < LEAST_CHARS:
        return b""
    return key


class Lines:
    """The lines of the documents of a block, and the hashes of the keys that count."""

    def __init__(self, texts: list[str | None]):
        self.lines = [(t or "").split("\n") for t in texts]
        doc, line, digests = [], [], []
        for i, text in enumerate(texts):
            for j, part in enumerate((text or "").encode().lower().split(b"\n")):
                if len(part) >= LEAST_CHARS and (key := line_key(part)):
                    doc.append(i)
                    line.append(j)
                    digests.append(xxhash.xxh3_128_digest(key))
        self.doc, self.line = np.array(doc, "i8"), np.array(line, "i8")
        raw = np.frombuffer(b"".join(digests), _HASH)
        a, b = raw["lo"], (raw["hi"] >> np.uint64(32)).astype("<u4")
        order = np.lexsort((self.doc, b, a))
        a, b = a[order], b[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        number = np.cumsum(first) - 1
        #: Place of each line's hash among the distinct ones, which are in order.
        self.place = np.empty(len(a), "i8")
        self.place[order] = number
        self.a, self.b = a[first], b[first]
        new_doc = first.copy()
        new_doc[1:] |= self.doc[order][1:] != self.doc[order][:-1]
        self.n_docs = np.bincount(number[new_doc], minlength=len(self.a)).astype("<u4")

    def largest(self, ids: np.ndarray) -> np.ndarray:
        """The largest id that holds each distinct hash."""
        out = np.full(len(self.a), NO_ID, "<i8")
        np.maximum.at(out, self.place, ids[self.doc])
        return out

    def shards(self, n: int) -> list[tuple[int, int, int]]:
        """shard, start, end: the distinct hashes are in order, so that a shard is a slice of them."""
        shard = ((self.a >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype("i8")
        found, start = np.unique(shard, return_index=True)
        return list(zip(found.tolist(), start.tolist(), [*start[1:].tolist(), len(shard)]))


def _ids(docs: pa.Table) -> np.ndarray:
    return docs.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)


def merged(entries: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct a, b with the sum of n and the largest id."""
    entries = entries[np.lexsort((entries["b"], entries["a"]))]
    a, b = entries["a"], entries["b"]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    start = np.flatnonzero(first)
    if not len(start):
        return a, b, entries["n"], entries["last"]
    return a[start], b[start], np.add.reduceat(entries["n"], start), np.maximum.reduceat(entries["last"], start)


def _dealt(df: DataFrame, key: str, text: str, blocks: int) -> DataFrame:
    """Rows in blocks by their number in the table, so that equal rows don't meet in one."""
    return df.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"),
    )


def _sent(dealt: DataFrame, shards: int) -> DataFrame:
    types = arrow_type(SENT)

    def send(docs: pa.Table) -> pa.Table:
        found = Lines(docs.column("text").to_pylist())
        entries = np.empty(len(found.a), _ENTRY)
        entries["a"], entries["b"], entries["n"], entries["last"] = found.a, found.b, found.n_docs, found.largest(_ids(docs))
        cut = found.shards(shards)
        data = {
            "block": [docs.column("block")[0].as_py()] * len(cut),
            "shard": [s for s, _, _ in cut],
            "entries": [entries[x:y].tobytes() for _, x, y in cut],
        }
        return pa.Table.from_pydict(data, schema=types)

    return dealt.groupBy("block").applyInArrow(send, SENT)


def _indexed(sent: DataFrame, least: int) -> DataFrame:
    types = arrow_type(INDEX)

    def build(messages: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(messages.column("entries").to_pylist()), _ENTRY)
        index = ShardIndex.build(*merged(entries), least)
        return pa.Table.from_pylist([index.row(messages.column("shard")[0].as_py())], schema=types)

    return sent.groupBy("shard").applyInArrow(build, INDEX)


def _applied(dealt: DataFrame, sent: DataFrame, index: DataFrame, shards: int, least: int) -> DataFrame:
    """The documents after the probes of all shards."""
    answer, result = arrow_type(ANSWER), arrow_type(RESULT)

    def probe(messages: pa.Table, indexes: pa.Table) -> pa.Table:
        if not messages.num_rows:
            return answer.empty_table()
        own = ShardIndex.of(indexes.to_pylist()[0]) if indexes.num_rows else None
        bits, last = [], []
        for raw in messages.column("entries").to_pylist():
            entries = np.frombuffer(raw, _ENTRY)
            found, ids = own.probe(entries["a"], entries["b"], least) if own else (np.zeros(len(entries), bool), np.empty(0, "<i8"))
            bits.append(np.packbits(found).tobytes())
            last.append(ids.tobytes())
        kept = messages.select(["block", "shard"])
        return pa.Table.from_arrays([*kept.columns, pa.array(bits, pa.binary()), pa.array(last, pa.binary())], schema=answer)

    def apply(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return result.empty_table()
        found = Lines(docs.column("text").to_pylist())
        shared, last = np.zeros(len(found.a), bool), np.full(len(found.a), NO_ID, "i8")
        replies = {r["shard"]: r for r in answers.to_pylist()}
        for shard, x, y in found.shards(shards):
            reply = replies[shard]
            hit = np.unpackbits(np.frombuffer(reply["bits"], "u1"), count=y - x).astype(bool)
            shared[x:y] = hit
            last[x:y][hit] = np.frombuffer(reply["last"], "<i8")
        gone = shared[found.place] & (last[found.place] != _ids(docs)[found.doc])
        n_dropped, kept = np.bincount(found.doc[gone], minlength=docs.num_rows), [*map("\n".join, found.lines)]
        at = np.flatnonzero(gone)
        cut = np.flatnonzero(n_dropped)
        ends = np.searchsorted(found.doc[at], [cut, cut + 1])
        for i, x, y in zip(cut.tolist(), *ends.tolist()):
            out = set(found.line[at[x:y]].tolist())
            kept[i] = "\n".join(line for j, line in enumerate(found.lines[i]) if j not in out)
        columns = [docs.column("doc_id").combine_chunks(), [*map(len, found.lines)], n_dropped, kept]
        return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, result)], schema=result)

    answers = sent.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, ANSWER)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, RESULT)


def _size(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def drop_shared_lines(
    df: DataFrame, least: int = LEAST_DOCS, key: str = "doc_id", text: str = "text", shards: int | None = None
) -> DataFrame:
    """doc_id, n_lines (before), n_dropped, kept: the lines that stay, joined by newlines.

    ``df`` should be read from storage, or else be the same rows in the same order whenever it is
    computed again. ``shards`` defaults to one for each ``SHARD_BYTES`` of text.
    """
    _ship(df.sparkSession.sparkContext.applicationId)
    size = _size(df, text)
    shards = shards or 1 + size // SHARD_BYTES
    dealt = _dealt(df, key, text, 1 + size // BLOCK_BYTES)
    sent = _sent(dealt, shards)
    return _applied(dealt, sent, stored(_indexed(sent, least), "line-index"), shards, least)


def build_index(df: DataFrame, least: int = LEAST_DOCS, key: str = "doc_id", text: str = "text", shards: int | None = None) -> tuple[DataFrame, int]:
    """The stored index of the lines of ``df``, one row a shard, and the number of shards."""
    _ship(df.sparkSession.sparkContext.applicationId)
    size = _size(df, text)
    shards = shards or 1 + size // SHARD_BYTES
    return stored(_indexed(_sent(_dealt(df, key, text, 1 + size // BLOCK_BYTES), shards), least), "line-index"), shards


def drop_indexed_lines(df: DataFrame, index: DataFrame, shards: int, least: int = LEAST_DOCS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``drop_shared_lines``, by an index of other documents: a document that isn't among them
    loses every line that ``least`` of them hold."""
    _ship(df.sparkSession.sparkContext.applicationId)
    dealt = _dealt(df, key, text, 1 + _size(df, text) // BLOCK_BYTES)
    return _applied(dealt, _sent(dealt, shards), index, shards, least)
