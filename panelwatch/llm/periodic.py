"""Periodic runs of words, found in a Re-Pair grammar.

A run is a stretch of words with smallest period q, at least ``LEAST_WORDS`` words and two periods
long, that no neighbouring word extends keeping the period.

1. The word ids of a batch of documents are compressed by Re-Pair: the most frequent pairs of
   neighbours give way to a nonterminal, until no pair stands twice. A round replaces all
   occurrences that no more frequent pair overlaps, so that a round is a few array operations.
2. Wherever a run stands, some node of the grammar is the lowest that holds all of it, so that it
   crosses the border between the two parts of that node. For each nonterminal the runs that
   cross its border are computed once, in one of its expansions; for the symbols that are left
   in the end, in their documents.
3. The runs of a nonterminal are translated to all its places, and those that are part of a longer
   one of the same period (a nonterminal that begins or ends within a run) are merged into it.

Runs that cross a border: of a run with period q, at least max(12 - q, q) words in a row equal the
word q later, and some of these stand at the border. So a short piece at the border stands again
q words before or after. Such pieces are looked up by hashes of 6, 12, 24, ... words, the longer
ones for longer periods, so that a piece has few places within reach unless it is periodic itself
(then its multiples are passed over, since they aren't smallest periods). Each pair of places is
extended to both sides by comparing hashes, and what is found is compared word by word.

Cases: null and empty texts have no words and no runs; rows are treated one by one, so repeated
rows have equal runs; ids don't matter; columns named like the new ones are replaced; an empty
table gives an empty table.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import WORD, append_arrow, mixed

LEAST_WORDS = 12
#: Words of the shortest piece that is looked up: a run repeats at least so many in a row.
PIECE = LEAST_WORDS // 2
#: Text that shares a grammar: the arrays of so much fit a processor's cache.
BATCH_BYTES = 1 << 20
#: Pairs of places extended at a time.
AT_ONCE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


class Grammar:
    """Re-Pair over the words of several documents; no nonterminal spans two of them.

    ``rules`` has, for each nonterminal long enough to hold a run, start, border and end of one
    expansion; ``places`` the nonterminal and start of every expansion; ``borders`` the borders
    between the symbols that are left.
    """

    def __init__(self, ids: np.ndarray, doc: np.ndarray):
        n = len(ids)
        self.symbols, start, own = ids.astype("i8"), np.arange(n + 1), doc
        rules, places, self.n_rules = [], [], 0
        live = np.ones(n, bool)
        symbol, number = int(ids.max(initial=-1)) + 1, 0
        while True:
            priority, pair, waits = self._priorities(own, live, number)
            number += 1
            left, right = np.concatenate([[0], priority[:-1]]), np.concatenate([priority[1:], [0]])
            at = np.flatnonzero((priority > left) & (priority > right))
            names, of, count = np.unique(pair[at], return_inverse=True, return_counts=True)
            at, of = at[count[of] > 1], of[count[of] > 1]
            if not len(at):
                break
            names, of, count = np.unique(of, return_inverse=True, return_counts=True)
            first = np.empty(len(names), "i8")
            first[of[::-1]] = at[::-1]
            ends = start[np.minimum(first + 2, len(start) - 1)]
            long = ends - start[first] >= LEAST_WORDS
            renamed = np.cumsum(long) - 1 + self.n_rules
            rules.append(np.stack([start[first], start[first + 1], ends], axis=1)[long])
            places.append(np.stack([renamed[of], start[at]], axis=1)[long[of]])
            self.n_rules += int(long.sum())
            # The pairs replaced, and those beside them, are new; any other that stands once does so for good.
            live = (priority > 0) | waits
            fresh = np.zeros(len(live), bool)
            fresh[at] = True
            self.symbols[at] = symbol + of
            symbol += len(names)
            stays = np.ones(len(live), bool)
            stays[at + 1] = False
            self.symbols, own, live, fresh = self.symbols[stays], own[stays], live[stays], fresh[stays]
            start = np.concatenate([start[:-1][stays], [n]])
            live |= fresh
            live[:-1] |= fresh[1:]
        join = lambda parts, width: np.concatenate([np.empty((0, width), "i8"), *parts])
        self.rules, self.places = join(rules, 3), join(places, 2)
        same = own[1:] == own[:-1]
        self.borders = start[1:-1][same] if n else start[:0]

    def _priorities(self, own: np.ndarray, live: np.ndarray, number: int) -> tuple[np.ndarray, ...]:
        """For each symbol, how early its pair with the next is replaced (0: never), the pair, and
        whether it waits for an equal pair that overlaps it."""
        n = len(self.symbols)
        priority, pair = np.zeros(n, "i8"), np.zeros(n, "i8")
        if n < 2:
            return priority, pair, np.zeros(n, bool)
        pair[:-1] = self.symbols[:-1] << 31 | self.symbols[1:]
        live = live.copy()
        live[-1] = False
        live[:-1] &= own[1:] == own[:-1]
        # In a row of equal symbols every second pair counts, since the others overlap them.
        again = np.zeros(n, bool)
        again[1:] = (pair[1:] == pair[:-1]) & (own[1:] == own[:-1])
        again[-1] = False
        places = np.arange(n)
        begun = np.maximum.accumulate(np.where(again, 0, places))
        odd = (places - begun) % 2 == 1
        at = np.flatnonzero(live & ~odd)
        names, of, count = np.unique(pair[at], return_inverse=True, return_counts=True)
        # Ties are broken by chance, else a long copy would be replaced from one end only.
        rank = np.minimum(count, (1 << 23) - 1) << 40 | (mixed(names.view("u8"), number) >> np.uint64(24)).astype("i8")
        priority[at] = np.where(count > 1, rank, 0)[of]
        return priority, pair, live & odd


class Hashes:
    """Hash of any stretch of a sequence of ids, by sums of powers modulo 2^64."""

    def __init__(self, ids: np.ndarray):
        with np.errstate(over="ignore"):
            step = lambda base: np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(len(ids), base, "u8")]))
            power, self.back = step(np.uint64(_BASE)), step(np.uint64(pow(_BASE, -1, 1 << 64)))
            self.sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(mixed(ids.astype("u8"), 9) * power[:-1])])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[start + length] - self.sums[start]) * self.back[start]

    def shared(self, a: np.ndarray, b: np.ndarray, room: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words from a and from b on (or before both) are equal, ``room`` at most."""
        low, high = np.zeros(len(a), "i8"), room.astype("i8")
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            x, y = (a, b) if ahead else (a - middle, b - middle)
            same = self.of(x, middle) == self.of(y, middle)
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
        return low


class Pieces:
    """Where the pieces of a length that stand more than once in a document stand."""

    def __init__(self, hashes: Hashes, doc: np.ndarray, length: int, at: np.ndarray, n: int):
        key = hashes.of(at, length) ^ mixed(doc[at].astype("u8"), 13)
        order = np.argsort(key)
        key, at = key[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        rank = np.cumsum(new) - 1
        many = np.bincount(rank, minlength=1)[rank] > 1 if len(at) else np.zeros(0, bool)
        #: Number of the piece that begins at each word; -1 if it stands once.
        self.rank = np.full(n, -1, "i8")
        self.rank[at[many]] = rank[many]
        self.sorted = np.sort(rank[many] << 32 | at[many])
        self.at = np.sort(at[many])

    def within(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of ``sorted`` with the places of each anchor's piece from low to before high."""
        base = self.rank[anchor] << 32
        return np.searchsorted(self.sorted, base | np.maximum(low, 0)), np.searchsorted(self.sorted, base | np.maximum(high, 0))


def _extended(ids, hashes: Hashes, a, q, low, high, owner) -> np.ndarray:
    """start, end, period, owner of the runs that hold the words at a and a + q, within low to high."""
    ahead = hashes.shared(a, a + q, high - a - q, True)
    before = hashes.shared(a, a + q, a - low, False)
    start, end = a - before, a + q + ahead
    good = end - start >= np.maximum(LEAST_WORDS, 2 * q)
    found, first = np.unique(np.stack([start, end, q, low, high], axis=1)[good], axis=0, return_index=True)
    out = []
    for (s, e, p, lo, hi), x, own in zip(found.tolist(), a[good][first].tolist(), owner[good][first].tolist()):
        fits = np.array_equal(ids[s : e - p], ids[s + p : e])
        if not (fits and (s == lo or ids[s - 1] != ids[s + p - 1]) and (e == hi or ids[e] != ids[e - p])):
            # Hashes were equal by chance: word by word.
            differ = np.flatnonzero(ids[lo : hi - p] != ids[lo + p : hi]) + lo
            i = np.searchsorted(differ, x)
            s, e = int(differ[i - 1]) + 1 if i else lo, (int(differ[i]) if i < len(differ) else hi - p) + p
            if e - s < max(LEAST_WORDS, 2 * p):
                continue
        out.append((s, e, p, own))
    return np.array(out, "i8").reshape(-1, 4)


def crossing_runs(
    ids: np.ndarray, doc: np.ndarray, borders: np.ndarray, low: np.ndarray, high: np.ndarray, owner: np.ndarray
) -> np.ndarray:
    """start, end, period, owner of all runs that cross a border, as far as they reach within its
    low to high, and of some that stand beside it; each with its smallest period."""
    n, found = len(ids), []
    hashes = Hashes(ids)
    ends = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, n)
    end_of = np.repeat(ends, np.diff(ends, prepend=0))
    alive, length = np.arange(n), PIECE
    # For each word, of the runs found with shorter periods the one that reaches furthest.
    reach, period = np.zeros(n, "i8"), np.ones(n, "i8")
    least, most = 1, 4 * PIECE
    while 2 * least <= int((high - low).max(initial=0)):
        alive = alive[alive + length <= end_of[alive]]
        pieces = Pieces(hashes, doc, length, alive, n)
        alive = pieces.at
        if length == PIECE:
            # A border where no piece stands again is crossed by no run of any period.
            so_far = np.concatenate([[0], np.cumsum(pieces.rank >= 0)])
            near = (high - low >= LEAST_WORDS) & (so_far[np.minimum(borders + 1, n)] > so_far[np.maximum(borders - PIECE, 0)])
            borders, low, high, owner = borders[near], low[near], high[near], owner[near]
            anchors = borders[:, None] + np.arange(-PIECE, 1)
        else:
            anchors = -(-(borders[:, None] - 2 * length) // length) * length + np.arange(4) * length
        inside = (anchors >= low[:, None]) & (anchors + length <= high[:, None])
        of, k = np.nonzero(inside & (pieces.rank[np.clip(anchors, 0, n - 1)] >= 0))
        anchor = anchors[of, k]
        level = [np.empty((0, 4), "i8")]
        for x, y in ((anchor + least, anchor + most), (anchor - most + 1, anchor - least + 1)):
            first, last = pieces.within(anchor, np.maximum(x, low[of]), np.minimum(y, high[of] - length + 1))
            count = np.maximum(last - first, 0)
            cuts = np.searchsorted(np.cumsum(count), np.arange(AT_ONCE, int(count.sum()), AT_ONCE))
            for part in np.split(np.arange(len(count)), cuts):
                c = count[part]
                row = np.repeat(part, c)
                place = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)
                other = pieces.sorted[place] & 0xFFFFFFFF
                a, b = np.minimum(anchor[row], other), np.maximum(anchor[row], other)
                multiple = (reach[a] >= b + length) & (period[a] <= length) & ((b - a) % period[a] == 0) & (period[a] < b - a)
                own, a, b = of[row][~multiple], a[~multiple], b[~multiple]
                once = np.unique(np.stack([low[own], high[own], owner[own], a, b - a], axis=1), axis=0)
                lo, hi, own, a, q = once.T
                level.append(_extended(ids, hashes, a, q, lo, hi, own))
        runs = np.concatenate(level)
        found.append(runs)
        whole = np.unique(runs[:, :3], axis=0)
        for s, e, p in whole[np.argsort(whole[:, 1])].tolist():
            longer = reach[s:e] < e
            reach[s:e][longer], period[s:e][longer] = e, p
        length, least, most = most // 2, most, 2 * most
    runs = np.unique(np.concatenate([np.empty((0, 4), "i8"), *found]), axis=0)
    # In order of start, end and period: the first of a stretch has its smallest period.
    begins = np.ones(len(runs), bool)
    begins[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    lead = np.maximum.accumulate(np.where(begins, np.arange(len(runs)), 0))
    return runs[runs[:, 2] == runs[lead, 2]]


def merged(runs: np.ndarray) -> np.ndarray:
    """start, end, period in order of start and period, without those within another of the same period."""
    start, end, period = runs[np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2]))].T
    new = np.ones(len(start), bool)
    if len(start):
        group = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]])) * (int(end.max()) + 1)
        furthest = np.maximum.accumulate(end + group)
        new[1:] = (end + group)[1:] > furthest[:-1]
    kept = np.stack([start, end, period], axis=1)[new]
    return kept[np.lexsort((kept[:, 2], kept[:, 0]))]


def find_runs(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """start, end, period of every run of a batch; ids and documents (in order) of all its words."""
    grammar = Grammar(ids, doc)
    p, border, q = grammar.rules.T
    first = np.searchsorted(doc, np.arange(doc[-1] + 2 if len(doc) else 1))
    low, high = first[doc[grammar.borders]], first[doc[grammar.borders] + 1]
    runs = crossing_runs(
        ids,
        doc,
        np.concatenate([border, grammar.borders]),
        np.concatenate([p, low]),
        np.concatenate([q, high]),
        np.concatenate([np.arange(len(p)), np.full(len(low), -1)]),
    )
    at_top, inner = runs[runs[:, 3] < 0, :3], runs[runs[:, 3] >= 0]
    # Every run of a nonterminal at every place of the nonterminal.
    places = grammar.places[np.argsort(grammar.places[:, 0], kind="stable")]
    first, last = (np.searchsorted(places[:, 0], inner[:, 3], side) for side in ("left", "right"))
    row = np.repeat(np.arange(len(inner)), last - first)
    place = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
    shift = places[place, 1] - p[inner[row, 3]]
    everywhere = np.stack([inner[row, 0] + shift, inner[row, 1] + shift, inner[row, 2]], axis=1)
    return merged(np.concatenate([at_top, everywhere]))


def runs_of(texts: list[str | None]) -> tuple[list[list[dict]], list[str]]:
    """The runs of each text, and its words without the repeated part of runs, joined by one blank."""
    words = [(t or "").encode().split() for t in texts]
    numbers = Numbers()
    n_words = np.array([len(w) for w in words], "i8")
    first = np.concatenate([[0], np.cumsum(n_words)])
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), "i8", int(first[-1]))
    doc = np.repeat(np.arange(len(words)), n_words)
    start, end, period = find_runs(ids, doc).T
    change = np.zeros(len(ids) + 1, "i8")
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    dropped = np.cumsum(change[:-1]) > 0
    own = doc[start]
    cut = np.searchsorted(own, np.arange(len(words) + 1))
    runs, kept = [], []
    for i, w in enumerate(words):
        mine = slice(cut[i], cut[i + 1])
        columns = (start[mine] - first[i]).tolist(), (end - start)[mine].tolist(), period[mine].tolist()
        runs.append([dict(zip(("start", "length", "period"), r)) for r in zip(*columns)])
        if columns[0]:
            w = [x for x, gone in zip(w, dropped[first[i] : first[i + 1]].tolist()) if not gone]
        kept.append(b" ".join(w).decode())
    return runs, kept


def with_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``runs`` (start, length, period, in order of start and period) and ``collapsed``."""

    def of(batch: pa.RecordBatch) -> list[pa.Array]:
        runs, kept = runs_of(batch.column(text).to_pylist())
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        return [pa.array(runs, kind), pa.array(kept, pa.string())]

    return append_arrow(df, of, f"runs {RUNS}, collapsed string", BATCH_BYTES)


def longest(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period); null if there is none."""
    order = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(order)
    return F.when(
        best.isNotNull(),
        F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")),
    )


def listed(runs: Column) -> Column:
    """start,length,period and a newline of every run."""
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.when(F.size(runs) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))


def with_planted_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with a periodic ending in the texts of a tenth of the ids, by a checksum of the id.

    With h the crc32 of the decimal id, g = floor(h / 10) and n words: if 10 divides h, each word
    from a = g % n on is the word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)). Texts
    without words, and those of null ids, stay.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.expr("h__ div 10")
    a, n = F.col("a__"), F.size("words__")
    period = 1 + F.expr("cast(floor((size(words__) - a__) / (3 + g__ % 8)) as int)")
    tail = F.transform(F.sequence(a, n - 1), lambda i: F.get("words__", a + (i - a) % period))
    planted = F.array_join(F.concat(F.slice("words__", F.lit(1), a), tail), " ")
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    names = df.columns
    return (
        df.withColumn("h__", h)
        .withColumn("g__", g)
        .withColumn("words__", F.when(F.expr("h__ % 10 = 0"), words))
        .withColumn("a__", F.when(n > 0, (F.col("g__") % n).cast("int")))
        .withColumn(text, F.when(n > 0, planted).otherwise(F.col(text)))
        .select(*names)
    )
