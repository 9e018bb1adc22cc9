"""Token ids in files of wavelet matrices.

A shard is a run of whole documents in ascending document order, at least ``SHARD_TOKENS``
ids long where that many are left. Its ids are kept as bit planes, highest bit first: each
plane holds one bit of every id, and the next plane's ids are ordered by that bit, zeros
first and otherwise as they stood. With a count of ones every ``BLOCK`` bits, one compressed
file answers: the id at a place, how often an id occurs before a place, and where its k-th
occurrence stands, without unpacking the ids.

One row is one shard, and each task writes one compressed Parquet file of its shards, so any
store that Spark reaches will do. ``start`` of a document is the number of ids before it: each
writer counts within its own range of documents, and one row per writer is added up.

Cases: null and empty texts hold the end id alone; null document ids come first; repeated
document ids stay in the order of a hash of their texts; other columns are left out; an empty table
writes no shard and reads back empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwatch.llm.bpe import Codec, byte_letters
from panelwatch.llm.common import arrow_type, map_arrow, sliced

#: ASCII characters that are neither letters, digits nor white space.
TAIL_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
SHARD_TOKENS = 1 << 20
BLOCK = 512
SHARD = (
    "writer int, shard int, start bigint, n_tokens bigint, doc_ids array<bigint>, "
    "ends array<int>, zeros array<int>, planes array<binary>, ones array<binary>"
)


class LibraryCodec(Codec):
    """Pieces are remembered as in ``bpe``; the tokenizers library merges each new word."""

    room = 600_000  # one worker a task; ``bpe`` has two

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(path)
        self.model = Tokenizer.from_file(path).model
        self.letters = byte_letters()
        self.blank = self.letters[ord(" ")]
        self.pieces, self.old_pieces = {}, {}
        # Letters and the marks after them hold no special token if each begins otherwise and has a letter.
        self.tails = TAIL_MARKS if all(not s[0].isalpha() and any(map(str.isalpha, s)) for s in self.specials) else ""

    def word_ids(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize("".join([self.letters[b] for b in word]))]

    def encode(self, text: str) -> bytes:
        """As in ``bpe``; new pieces, one in ten, are met in one loop instead of a call for each."""
        head, *rest = text.split(" ")
        if rest and (not head or head[-1].isspace()):
            return self.piece_ids(text)
        found = [*map(self.pieces.get, rest)]
        if None in found:
            pieces, old, tokenize, blank = self.pieces, self.old_pieces, self.model.tokenize, self.blank
            i = -1
            for _ in range(found.count(None)):
                i = found.index(None, i + 1)
                piece = rest[i]
                value = pieces.get(piece) or old.get(piece)
                if value is None:
                    if piece.isascii() and piece.isalpha():
                        # ASCII letters stand for themselves; only the blank before them has another letter.
                        ids = [t.id for t in tokenize(blank + piece)]
                        value = pack(f"<{len(ids)}I", *ids)
                    elif not piece or piece[0].isspace() or piece[-1].isspace():
                        return self.piece_ids(text)
                    else:
                        value = self._new_piece(piece)
                        if "\n" in piece:
                            # Two words across a line end rarely meet again; both are remembered alone.
                            found[i] = value
                            continue
                found[i] = pieces[piece] = value
            if len(pieces) >= self.room:
                self.old_pieces, self.pieces = pieces, {}
        return self.piece_ids(head) + b"".join(found)

    def _blank_word(self, word: str) -> bytes:
        """Ids of letters after a blank."""
        known = self.pieces.get(word) or self.old_pieces.get(word)
        if known is None:
            known = self._packed_word(f" {word}")
            self.pieces[word] = known
        return known

    def _new_piece(self, piece: str) -> bytes:
        """Ids of a piece without white space at its ends, after a blank."""
        if piece.isalpha():
            return self._blank_word(piece)
        word = piece.rstrip(self.tails)
        if word.isalpha():
            # Marks after letters, up to the end, are one token of the pattern.
            return self._blank_word(word) + self.words[piece[len(word) :]]
        before, line, after = piece.partition("\n")
        # A single newline between two other characters is a token, and one begins after it.
        if line and after.isalpha() and not before[-1].isspace():
            return self._new_piece(before) + self.words[line] + self.words[after]
        return self.piece_ids(f" {piece}")


@cache
def library(path: str) -> LibraryCodec:
    return LibraryCodec(path)


class WaveletMatrix:
    """Bit planes of a sequence of ids with counts of ones by block."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes], ones: list[bytes]):
        self.n, self.zeros = n, zeros
        self.planes = [np.frombuffer(p, "u1") for p in planes]
        self.ones = [np.frombuffer(c, "<u4") for c in ones]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n, high = len(ids), int(ids.max(initial=0))
        rest = ids.astype("u2" if high < 1 << 16 else "u4")
        zeros, planes, ones = [], [], []
        for level in reversed(range(max(1, high.bit_length()))):
            bit = (rest & (1 << level)) != 0
            plane = np.packbits(bit, bitorder="little")
            padded = np.zeros(-(-n // BLOCK) * BLOCK // 8, "u1")
            padded[: len(plane)] = np.bitwise_count(plane)
            by_block = padded.reshape(-1, BLOCK // 8).sum(axis=1, dtype="u4")
            planes.append(plane.tobytes())
            ones.append(np.concatenate([[0], np.cumsum(by_block)]).astype("<u4").tobytes())
            zeros.append(n - int(np.count_nonzero(bit)))
            # Places first: several times as fast as selecting by a mask.
            rest = np.concatenate([rest[np.flatnonzero(~bit)], rest[np.flatnonzero(bit)]])
        return cls(n, zeros, planes, ones)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // BLOCK
        start = block * BLOCK // 8
        bits = self.planes[level][start : i // 8]
        count = int(self.ones[level][block]) + int(np.bitwise_count(bits).sum())
        return count + (int(self.planes[level][i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else count

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) bit of that value."""
        before = self.ones[level].astype("i8")
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK, self.n) - before
        block = int(np.searchsorted(before, k, "right")) - 1
        raw = self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8]
        bits = np.unpackbits(raw, bitorder="little")[: self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = int(self.planes[level][i // 8]) >> (i % 8) & 1
            ones = self._rank1(level, i)
            value, i = value << 1 | bit, (zeros + ones if bit else i - ones)
        return value

    def _path(self, value: int, i: int) -> tuple[int, int]:
        """The interval of the last plane where the occurrences before ``i`` stand."""
        low, high = 0, i
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, low), self._rank1(level, high)
            if value >> (len(self.zeros) - 1 - level) & 1:
                low, high = zeros + a, zeros + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, value: int, i: int) -> int:
        """Occurrences of an id among the first ``i`` ids."""
        if value < 0 or value >> len(self.zeros) or not i:
            return 0
        low, high = self._path(value, i)
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence, -1 if there are fewer."""
        if not 0 <= k < self.count(value):
            return -1
        i = self._path(value, self.n)[0] + k
        for level in reversed(range(len(self.zeros))):
            bit = value >> (len(self.zeros) - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids, from the last plane up: each plane says whose turn it is, zeros or ones."""
        below = np.zeros(self.n, "u4")
        for level in reversed(range(len(self.zeros))):
            plane = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            zeros, here = self.zeros[level], np.empty(self.n, "u4")
            here[np.flatnonzero(~plane)] = below[:zeros]
            here[np.flatnonzero(plane)] = below[zeros:] | np.uint32(1 << (len(self.zeros) - 1 - level))
            below = here
        return below


def _shards(vocabulary: str, end_id: int, shard_tokens: int):
    end, types = end_id.to_bytes(4, "little"), arrow_type(SHARD)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, writer = library(vocabulary), TaskContext.get().partitionId()
        ids, ends, parts, held, start, shard = [], [], [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            m = WaveletMatrix.build(np.frombuffer(b"".join(parts), "<u4"))
            row = {
                "writer": writer, "shard": shard, "start": start, "n_tokens": m.n, "doc_ids": ids,
                "ends": ends, "zeros": m.zeros, "planes": [p.tobytes() for p in m.planes],
                "ones": [c.tobytes() for c in m.ones],
            }
            return pa.RecordBatch.from_pylist([row], schema=types)

        for batch in sliced(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts.append(own.encode(text or "") + end)
                held += len(parts[-1]) // 4
                ids.append(doc_id)
                ends.append(held)
                if held >= shard_tokens:
                    yield closed()
                    start, shard, held = start + held, shard + 1, 0
                    ids, ends, parts = [], [], []
        if ids:
            yield closed()

    return step


def write(
    df: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encodes and writes the texts in ascending order of ``key``, one file per task."""
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    # Rows of one id are split between tasks like others.
    ordered = rows.repartitionByRange("key", "hash").sortWithinPartitions("key", "hash", "text")
    shards = map_arrow(ordered, _shards(vocabulary, end_id, shard_tokens), SHARD)
    shards.write.option("compression", "zstd").mode("errorifexists").parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ones"])


def _bases(rows: DataFrame) -> DataFrame:
    """Ids before each writer's first one. One row per file: bounded by the number of tasks."""
    sizes = rows.groupBy("writer").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("writer").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("writer", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (packed little-endian unsigned 32-bit), read from the files."""
    ddl = "writer int, doc_id bigint, local bigint, n_tokens bigint, ids binary"
    types = arrow_type(ddl)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                flat = matrix(row).ids().astype("<u4").tobytes()
                ends = np.array(row["ends"], "i8")
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["writer"]] * len(ends), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["start"], pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array([flat[4 * a : 4 * b] for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    schema=types,
                )

    rows = shards(spark, path)
    docs = map_arrow(rows, step, ddl)
    return docs.join(F.broadcast(_bases(rows)), "writer").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids"
    )


def counts(spark: SparkSession, path: str, token: int) -> DataFrame:
    """writer, shard, n: occurrences of one id by shard, from the planes alone."""
    ddl = "writer int, shard int, n bigint"
    types = arrow_type(ddl)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                {"writer": r["writer"], "shard": r["shard"], "n": matrix(r).count(token)}
                for i in range(batch.num_rows)
                for r in batch.slice(i, 1).to_pylist()
            ]
            yield pa.RecordBatch.from_pylist(found, schema=types)

    return map_arrow(shards(spark, path), step, ddl)


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """doc_id, position in its document, of each occurrence of one id (by select)."""
    ddl = "doc_id bigint, position bigint"
    types = arrow_type(ddl)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                m, ends = matrix(row), np.array(row["ends"], "i8")
                at = np.array([m.select(token, k) for k in range(m.count(token))], "i8")
                doc = np.searchsorted(ends, at, "right")
                ids = [row["doc_ids"][j] for j in doc]
                starts = np.concatenate([[0], ends])[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(at - starts, pa.int64())], schema=types
                )

    return map_arrow(shards(spark, path), step, ddl)

