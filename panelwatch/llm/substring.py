"""Removal of passages that stand anywhere else, found by a count-min prefilter.

A window is ``WINDOW`` consecutive words. Documents are dealt into blocks of about ``BLOCK_BYTES``
by row number, and the hashes of windows into segments of about ``SEGMENT_BYTES`` of text, both in
proportion to the corpus, so that memory stays bounded whatever its size.

1. Every block makes a sketch of its windows for each segment: the cells of ``DEPTH`` rows of
   counters that are not zero (each counted up to two). The sketches of a segment are merged by
   adding; a window whose smallest counter is two or more is *estimated* repeated. Counters are
   shared by other windows, so an estimate is never too low and no repeated window is lost.
   Blocks get back one bit for each cell that they sent.
2. Blocks send the hashes (96 bits) of estimated windows only, each distinct one once with
   whether it occurs twice within the block; these are grouped exactly, and again one bit for
   each comes back.
3. Blocks remove the words of repeated windows.

What a block sends for a window is one entry, however often the window occurs in it: a passage in
a third of all documents makes no hot group. The texts are shuffled once, for all three steps.
Two different windows are taken for one with a chance of about n squared over 2^97.

Cases: null and empty texts have no words and nothing is removed; fewer words than a window
leave a document as it is; repeated rows are documents of their own, so that both lose what they
share; null ids are allowed; other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import _ship, arrow_type, hashes_of, mixed, run_hashes

WINDOW, DEPTH, CELL_BITS = 35, 2, 24
BLOCK_BYTES, SEGMENT_BYTES = 6 << 20, 13 << 20
ASK = "block int, segment int, row int, cells binary"
ANSWER = "block int, segment int, row int, bits binary"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
EXACT = -1
#: Fewer cells than this are sent as they are: smaller than the counts of all high bits.
FEW_CELLS = 2 << CELL_BITS - 16
_FEW = 1 << 31
_ENTRY = np.dtype([("a", "<u8"), ("b", "<u4")])


class Windows:
    """The windows of the documents of a block, with the segments of their hashes."""

    def __init__(self, texts: list[str | None], window: int, segments: int):
        self.words = [(t or "").encode().split() for t in texts]
        hashes = [hashes_of(w) for w in self.words]
        self.counts = [max(0, len(h) - window + 1) for h in hashes]
        join = lambda seed: np.concatenate([np.empty(0, "u8"), *(run_hashes(h, window, seed) for h in hashes)])
        a, b = join(1), join(2)
        segment = ((a >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype("i4")
        self.order = np.argsort(segment, kind="stable")
        self.a, self.b, segment = a[self.order], b[self.order], segment[self.order]
        self.segments, start = np.unique(segment, return_index=True)
        self.slices = list(zip(start, [*start[1:], len(segment)]))

    def cells(self, low: int, high: int, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = (mixed(self.a[low:high], row + 1) >> np.uint64(64 - CELL_BITS)).astype("u4")
        return np.unique(cell, return_inverse=True, return_counts=True)

    def estimated(self, answers: dict) -> np.ndarray:
        """Of the ordered windows, those whose counters are all two or more."""
        out = np.zeros(len(self.a), bool)
        for segment, (low, high) in zip(self.segments, self.slices):
            found = np.ones(high - low, bool)
            for row in range(DEPTH):
                distinct, at, _ = self.cells(low, high, row)
                found &= _bits(answers[segment, row], len(distinct))[at]
            out[low:high] = found
        return out

    def distinct(self, low: int, high: int, chosen: np.ndarray):
        """Distinct chosen windows in order, the place of each chosen one among them, counts."""
        at = np.flatnonzero(chosen[low:high]) + low
        a, b = self.a[at], (self.b[at] >> np.uint64(32)).astype("u4")
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        number = np.cumsum(first) - 1
        place = np.empty(len(a), "i8")
        place[order] = number
        entries = np.empty(int(first.sum()), _ENTRY)
        entries["a"], entries["b"] = a[first], b[first]
        return at, entries, place, np.bincount(number, minlength=len(entries))


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, "u1"), count=n).astype(bool)


def _pack_cells(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted cells with a flag: low 16 bits of each, counted by their high bits; a few as they are,
    so that what a block sends grows with its windows and not with the number of segments."""
    if len(cells) < FEW_CELLS:
        return (len(cells) | _FEW).to_bytes(4, "little") + cells.astype("<u4").tobytes() + np.packbits(twice).tobytes()
    high = np.bincount(cells >> 16, minlength=1 << CELL_BITS - 16).astype("<u4")
    head = len(cells).to_bytes(4, "little")
    return head + high.tobytes() + (cells & 0xFFFF).astype("<u2").tobytes() + np.packbits(twice).tobytes()


def _unpack_cells(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, at = int.from_bytes(raw[:4], "little"), 4 + 4 * (1 << CELL_BITS - 16)
    if n & _FEW:
        n ^= _FEW
        return np.frombuffer(raw, "<u4", n, 4), _bits(raw[4 + 4 * n :], n)
    high = np.repeat(np.arange(1 << CELL_BITS - 16, dtype="u4"), np.frombuffer(raw[4:at], "<u4"))
    low = np.frombuffer(raw[at : at + 2 * n], "<u2")
    return high << np.uint32(16) | low, _bits(raw[at + 2 * n :], n)


def _answers(table: pa.Table) -> dict:
    columns = (table.column(c).to_pylist() for c in ("segment", "row", "bits"))
    return {(s, r): bits for s, r, bits in zip(*columns)}


def merge_sketches(table: pa.Table, answer: pa.Schema) -> pa.Table:
    """One segment: counters are added up, and each block learns which of its cells have two."""
    block, segment, row, cells = (table.column(c).to_pylist() for c in ("block", "segment", "row", "cells"))
    out = [None] * len(block)
    for r in set(row):
        counters = np.zeros(1 << CELL_BITS, "u1")
        of_row = [(i, *_unpack_cells(cells[i])) for i in range(len(row)) if row[i] == r]
        for _, distinct, twice in of_row:
            counters[distinct] = np.minimum(counters[distinct] + 1 + twice, 2)
        for i, distinct, _ in of_row:
            out[i] = np.packbits(counters[distinct] > 1).tobytes()
    return pa.Table.from_pydict(
        {"block": block, "segment": segment, "row": row, "bits": out}, schema=answer
    )


def group_exactly(table: pa.Table, answer: pa.Schema) -> pa.Table:
    """One segment: windows of all blocks are grouped, and each block learns which are repeated."""
    block, segment, cells = (table.column(c).to_pylist() for c in ("block", "segment", "cells"))
    n = [int.from_bytes(x[:4], "little") for x in cells]
    entries = np.concatenate([np.frombuffer(x, _ENTRY, k, 4) for x, k in zip(cells, n)])
    twice = np.concatenate([_bits(x[4 + _ENTRY.itemsize * k :], k) for x, k in zip(cells, n)])
    order = np.lexsort((entries["b"], entries["a"]))
    a, b = entries["a"][order], entries["b"][order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.cumsum(first) - 1
    count = np.bincount(number, weights=1 + twice[order])
    repeated = np.empty(len(a), bool)
    repeated[order] = count[number] > 1
    ends = np.cumsum(n)
    bits = [np.packbits(repeated[e - k : e]).tobytes() for e, k in zip(ends, n)]
    return pa.Table.from_pydict(
        {"block": block, "segment": segment, "row": [EXACT] * len(n), "bits": bits},
        schema=answer,
    )


def _steps(window: int, segments: int):
    """The functions that run on a block, for one window length and number of segments."""
    ask, answer, result = arrow_type(ASK), arrow_type(ANSWER), arrow_type(RESULT)

    def windows(docs: pa.Table) -> Windows:
        return Windows(docs.column("text").to_pylist(), window, segments)

    def asked(block: int, rows: list[tuple[int, int, bytes]]) -> pa.Table:
        columns = list(zip(*rows)) or [[], [], []]
        data = {"block": [block] * len(rows)} | dict(zip(("segment", "row", "cells"), map(list, columns)))
        return pa.Table.from_pydict(data, schema=ask)

    def sketch(docs: pa.Table) -> pa.Table:
        w, rows = windows(docs), []
        for segment, (low, high) in zip(w.segments.tolist(), w.slices):
            for row in range(DEPTH):
                distinct, _, count = w.cells(low, high, row)
                rows.append((segment, row, _pack_cells(distinct, count > 1)))
        return asked(docs.column("block")[0].as_py(), rows)

    def estimated(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return asked(0, [])
        w, rows = windows(docs), []
        chosen = w.estimated(_answers(answers))
        for segment, (low, high) in zip(w.segments.tolist(), w.slices):
            _, entries, _, count = w.distinct(low, high, chosen)
            if len(entries):
                head = len(entries).to_bytes(4, "little")
                rows.append((segment, EXACT, head + entries.tobytes() + np.packbits(count > 1).tobytes()))
        return asked(docs.column("block")[0].as_py(), rows)

    def removed(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return result.empty_table()
        w, known = windows(docs), _answers(answers)
        chosen, repeated = w.estimated(known), np.zeros(len(w.a), bool)
        for segment, (low, high) in zip(w.segments.tolist(), w.slices):
            at, entries, place, _ = w.distinct(low, high, chosen)
            if len(entries):
                repeated[w.order[at]] = _bits(known[segment, EXACT], len(entries))[place]
        n_words, n_removed, kept, start = [], [], [], 0
        for words, count in zip(w.words, w.counts):
            found, start = np.flatnonzero(repeated[start : start + count]), start + count
            n_words.append(len(words))
            if len(found):
                edges = np.zeros(len(words) + 1, "i4")
                edges[found] += 1
                edges[found + window] -= 1
                stays = (np.cumsum(edges[:-1]) == 0).tolist()
                words = [x for x, s in zip(words, stays) if s]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode())
        columns = [docs.column("doc_id").combine_chunks(), n_words, n_removed, kept]
        return pa.Table.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, result)], schema=result)

    def merged(asked: pa.Table) -> pa.Table:
        return merge_sketches(asked, answer)

    def grouped(asked: pa.Table) -> pa.Table:
        return group_exactly(asked, answer)

    return sketch, merged, estimated, grouped, removed


def remove_repeats(
    df: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words that stay, joined by one blank.

    ``df`` should be read from storage, or else be the same rows in the same order whenever it is
    computed again: rows are dealt out by their number, so that equal rows don't meet in one block.
    """
    _ship(df.sparkSession.sparkContext.applicationId)
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks, segments = 1 + size // BLOCK_BYTES, 1 + size // SEGMENT_BYTES
    sketch, merged, estimated, grouped, removed = _steps(window, segments)
    docs = df.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"),
    )
    by_block = docs.groupBy("block")
    sketches = by_block.applyInArrow(sketch, ASK)
    counted = sketches.groupBy("segment").applyInArrow(merged, ANSWER)
    asked = by_block.cogroup(counted.groupBy("block")).applyInArrow(estimated, ASK)
    exact = asked.groupBy("segment").applyInArrow(grouped, ANSWER)
    answers = counted.unionByName(exact)
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(removed, RESULT)
