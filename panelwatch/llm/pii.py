"""Personal data: fixed patterns, and contexts learnt from what they find.

The fixed kinds are found by one regular expression each, leftmost and without overlap; a match
that fails its check is dropped. Splitting a text by an expression and extracting its matches walk
the same matches, so the lengths of gaps and matches give every position.

Contextual identifiers are bootstrapped. Every word is an instance, in the lexical pattern of the
two words before it, whatever these hold; their digits all read as 0. A fixed span is an instance
as a whole, and a seed. A pattern scores, for each kind, the mean score of its distinct instances,
if their scores reach ``SUPPORT``; an instance scores one minus the product of one minus the scores
of its patterns of at least ``CONFIDENCE``. Scores only rise; they are computed anew until none
does. The instances of the patterns found that no fixed kind covers are new spans, of kind
``near_`` and the kind.

Only patterns that can reach ``SUPPORT`` and ``CONFIDENCE`` are counted, but these over all their
instances: the texts are read for the instances of such patterns, and for the patterns of the
instances that these reach, until nothing new is reached. Frequent patterns are mostly found to
have too many instances in a part of the texts (see ``_possible``; exact, nothing is lost). Where
no pattern has enough seeds, the texts aren't read again.
DataFrame functions only.

Cases: a null text is empty; rows are treated one by one, so repeated rows have equal spans
(though instances count once, however often they are repeated); an instance in an overlap of two
kinds counts for each; other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import WORD, stored

#: Ends of the listed expressions, written so that a failed attempt isn't repeated
#: from every later letter of the same run. They find the same matches.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: Up to this many words with the white space before each; a text is cut into such pieces.
PIECE_WORDS = 256
PIECE = rf"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){{1,{PIECE_WORDS}}}+"
#: The last two words of a piece, read backwards.
LAST_TWO = r"^[^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++"
SUPPORT, CONFIDENCE = 5, 0.7
#: Items of an array dealt with at a time where each costs a copy.
BLOCK_ITEMS = 64
#: One text of so many is read at first for patterns that have too many instances, then one of so many.
SLICES = (64, 8)
#: Code points of the pieces from which a text is put together again.
CHUNK = 4096
#: Places of a score; below, a rise isn't one.
PLACES = 6


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 0, digit * 2).otherwise(digit)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    length = F.length(digits)
    # The sum is only made of strings of the right length.
    at = F.sequence(F.lit(1), F.when(length.between(13, 19), length).otherwise(F.lit(1)))
    return length.between(13, 19) & (F.aggregate(at, F.lit(0), add) % 10 == 0)


class Kind(NamedTuple):
    name: str
    pattern: str
    holds: Callable[[Column], Column]
    letter: str | None  # any match has it, so that texts without it aren't searched


KINDS = (
    Kind("email", EMAIL, lambda m: F.lit(True), "@"),
    Kind("ip", IP, lambda m: m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"), None),
    Kind("card", CARD, _luhn, None),
    Kind("phone", PHONE, lambda m: F.length(_digits(m)).between(9, 15), "+"),
)
_SPAN = "array<struct<start:int,end:int,match:string>>"
_BASE = "array<struct<kind:string,start:int,end:int,match:string>>"
_PIECE = f"array<struct<at:int,before:string,piece:string,base:{_BASE}>>"


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _in_blocks(items: Column) -> Column:
    """``items`` in arrays of ``BLOCK_ITEMS`` each."""
    n = F.ceil(F.size(items) / BLOCK_ITEMS).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda b: F.slice(items, b * BLOCK_ITEMS + 1, F.lit(BLOCK_ITEMS)))


def running(items: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Total so far at each of an array of int, from 0 on; appending to short lists only, since
    each append copies a list."""

    def totals(values: Column, start: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            total = add(state["total"], x)
            return F.struct(total.alias("total"), F.array_append(state["found"], total).alias("found"))

        begun = F.struct(start.alias("total"), F.array().cast("array<int>").alias("found"))
        return F.aggregate(values, begun, step, lambda state: state["found"])

    def joined(blocks: Column) -> Column:
        whole = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), add))
        before = F.concat(F.array(F.lit(0)), totals(whole, F.lit(0)))
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), totals))

    return _let(items, lambda own: _let(_in_blocks(own), joined))


def spans(text: Column, pattern: str, letter: str | None = None) -> Column:
    """start, end (code points, end exclusive), match of every match."""
    searched = text if letter is None else F.when(F.contains(text, F.lit(letter)), text).otherwise(F.lit(""))
    matches = F.regexp_extract_all(searched, F.lit(pattern), F.lit(0))
    between = F.split(searched, pattern, -1)

    def placed(found: Column) -> Column:
        before = F.slice(found["between"], F.lit(1), F.size(found["matches"]))
        steps = F.zip_with(before, found["matches"], lambda g, m: F.length(g) + F.length(m))
        span = lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"))
        return F.zip_with(running(steps, lambda x, y: x + y), found["matches"], span).cast(_SPAN)

    return _let(F.struct(matches.alias("matches"), between.alias("between")), placed)


def base_spans(text: Column) -> Column:
    """kind, start, end, match of the fixed kinds, by kind as listed and then by start."""
    parts = []
    for kind in KINDS:
        held = F.filter(spans(text, kind.pattern, kind.letter), lambda s: kind.holds(s["match"]))  # noqa: B023
        name = F.lit(kind.name)
        parts.append(F.transform(held, lambda s: F.struct(name.alias("kind"), s["start"], s["end"], s["match"])))  # noqa: B023
    return F.concat(*parts).cast(_BASE)


def _meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (a["end"] > b["start"])


def pieces(text: Column, base: Column) -> Column:
    """at, before, piece, base: up to ``PIECE_WORDS`` words each, in order.

    ``before`` is the last two words of the piece before, null in the first; ``base`` are the
    fixed spans that touch the piece, so that no word is compared with all spans of a long text.
    """

    blocks = F.transform(
        _in_blocks(base),
        lambda b: F.struct(
            F.array_min(F.transform(b, lambda s: s["start"])).alias("start"),
            F.array_max(F.transform(b, lambda s: s["end"])).alias("end"),
            b.alias("spans"),
        ),
    )

    def step(state: Column, piece: Column, held: Column) -> Column:
        end = state["at"] + F.length(piece)
        near = lambda b: (b["start"] < end) & (b["end"] > state["at"])
        touching = F.filter(F.flatten(F.transform(F.filter(held, near), lambda b: b["spans"])), near)
        row = F.struct(state["at"].alias("at"), state["before"].alias("before"), piece.alias("piece"), touching.alias("base"))
        last = F.reverse(F.regexp_extract(F.reverse(piece), LAST_TWO, 0))
        return F.struct(end.alias("at"), last.alias("before"), F.array_append(state["found"], row).alias("found"))

    start = F.struct(
        F.lit(0).alias("at"), F.lit(None).cast("string").alias("before"), F.array().cast(_PIECE).alias("found")
    )
    cut = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return _let(blocks, lambda held: F.aggregate(cut, start, lambda state, piece: step(state, piece, held), lambda s: s["found"]))


def words(known: DataFrame, placed: bool = False) -> DataFrame:
    """row, base, start, word, before_2, before_1 of every word of the texts of (row, text, base).

    The words before are the two that stand there, whatever they hold, lower-cased and with every
    digit as 0; before the first word of a text they are empty. ``start`` is null where no fixed
    span is near, unless ``placed``.
    """
    cut = known.select("row", F.inline(pieces(F.col("text"), F.col("base"))))
    found = F.regexp_extract_all("piece", F.lit(WORD), F.lit(0))
    masked = F.lower(F.translate(F.concat_ws(" ", "before", "piece"), "123456789", "000000000"))
    plain = F.regexp_extract_all(masked, F.lit(WORD), F.lit(0))
    first = F.array(F.lit(""), F.lit(""))
    at = F.transform(spans(F.col("piece"), WORD), lambda s: s["start"] + F.col("at"))
    none = F.array().cast("array<int>")
    rows = cut.select(
        "row",
        "base",
        found.alias("word"),
        F.when(F.col("before").isNull(), F.concat(first, plain)).otherwise(plain).alias("context"),
        (at if placed else F.when(F.size("base") > 0, at).otherwise(none)).alias("start"),
    )
    n = F.size("word")
    zipped = F.arrays_zip(
        F.col("start"),
        F.col("word"),
        F.slice("context", F.lit(1), n).alias("before_2"),
        F.slice("context", F.lit(2), n).alias("before_1"),
    )
    return rows.select("row", "base", F.inline(zipped).alias("start", "word", "before_2", "before_1"))


def instances(found: DataFrame) -> DataFrame:
    """row, start, end, token, pattern, kinds from ``words``.

    A fixed span counts once, where it begins and as a whole, with the kinds of those that overlap
    it at its first word; its later words are no instances. A word that none touches has no kinds;
    marks that end it aren't part of its token.
    """
    start, word = F.col("start"), F.col("word")
    token = F.regexp_replace(word, r"[^\p{L}\p{M}\p{N}]++$", "")
    touching = F.filter("base", lambda b: (b["start"] < start + F.length(word)) & (b["end"] > start))
    one = "array<struct<start:int,end:int,token:string,kinds:array<string>>>"

    def apart(kept: Column, b: Column) -> Column:
        return F.when(F.exists(kept, lambda k: _meets(k, b)), kept).otherwise(F.array_append(kept, b))

    def seed(b: Column) -> Column:
        kinds = F.transform(F.filter("touching", lambda t: _meets(t, b)), lambda t: t["kind"])
        return F.struct(b["start"], b["end"], b["match"].alias("token"), F.array_distinct(kinds).alias("kinds"))

    begun = F.filter("touching", lambda b: b["start"] >= start)
    seeds = F.transform(F.aggregate(begun, F.array().cast(_BASE), apart), seed)
    end = start + F.length("token")
    plain = F.array(F.struct(start, end.alias("end"), "token", F.array().cast("array<string>").alias("kinds")))
    items = F.when(F.size("touching") > 0, seeds.cast(one)).when(F.col("token") != "", plain.cast(one))
    pattern = F.concat_ws(" ", "before_2", "before_1").alias("pattern")
    near = F.when(F.size("base") > 0, touching).otherwise(F.array().cast(_BASE)).alias("touching")
    return found.select("row", start, pattern, token.alias("token"), near).select("row", "pattern", F.inline(items))


def _edges(occurrences: DataFrame) -> DataFrame:
    """Distinct pattern, token (hashed)."""
    return occurrences.select("pattern", F.xxhash64("token").alias("token")).distinct()


def score_patterns(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """pattern, kind, score at the fixed point, from all instances (pattern, token) of patterns."""
    sizes = stored(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "sizes")
    certain = seeds.withColumn("score", F.lit(1.0))
    scores, before = certain, None
    while True:
        sums = (
            edges.join(scores, "token")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("total"))
            .where(F.col("total") >= SUPPORT)
        )
        patterns = stored(
            sums.join(sizes, "pattern")
            .select("pattern", "kind", F.round(F.col("total") / F.col("n"), PLACES).alias("score"))
            .where(F.col("score") >= CONFIDENCE),
            "patterns",
        )
        total = F.sum(F.col("score").cast(f"decimal(18,{PLACES})"))
        state = tuple(patterns.agg(F.count(F.lit(1)), total).first())
        if state == before:
            return patterns
        before = state
        # A product over patterns as a sum of logarithms; seeds stay certain.
        reached = (
            edges.join(patterns, "pattern")
            .groupBy("token", "kind")
            .agg(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))).alias("log_miss"))
            .select("token", "kind", F.round(1 - F.exp("log_miss"), 9).alias("score"))
        )
        scores = certain.unionByName(reached.join(seeds, ["token", "kind"], "left_anti"))


def _possible(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """Of patterns with ``n`` reached instances, those that these may lift to ``CONFIDENCE``.

    A reached instance scores one at most, so that a pattern with more than n / ``CONFIDENCE``
    distinct instances can't be learnt now (once more are reached, it is looked at again). A part
    of the texts shows that of the frequent ones; what it doesn't show stays, and nothing is lost.
    """
    for share in SLICES:
        if wanted.isEmpty():
            break
        part = known.where(F.pmod(F.xxhash64("row"), F.lit(share)) == 0)
        seen = _edges(instances(words(part)).join(wanted.select("pattern"), "pattern", "left_semi"))
        sizes = seen.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
        good = F.col("size").isNull() | (F.col("n") >= CONFIDENCE * F.col("size"))
        wanted = stored(wanted.join(sizes, "pattern", "left").where(good).select("pattern", "n"), "possible")
    return wanted


def learnt_patterns(known: DataFrame) -> DataFrame | None:
    """pattern, kind, score of the patterns learnt from the texts of ``known``; none if there are none."""
    # A seed of one word, wherever it stands, has a digit or an @.
    marks = instances(words(known).where(F.col("word").rlike("[0-9@]")))
    marks = stored(
        marks.groupBy("pattern", F.xxhash64("token").alias("token")).agg(F.flatten(F.collect_set("kinds")).alias("kinds")),
        "pattern-instances",
    )
    seeds = stored(marks.select("token", F.explode("kinds").alias("kind")).distinct(), "seeds")
    reached = seeds
    occurrences = marks.select("pattern", "token").join(seeds, "token", "left_semi")
    edges = patterns = None
    while True:
        wanted = (
            occurrences.join(reached, "token").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("pattern").agg(F.max("n").alias("n")).where(F.col("n") >= SUPPORT)
        )
        if edges is not None:
            wanted = wanted.join(edges.select("pattern").distinct(), "pattern", "left_anti")
        wanted = _possible(stored(wanted, "wanted"), known).select("pattern")
        if wanted.isEmpty():
            return patterns
        found = stored(_edges(instances(words(known)).join(wanted, "pattern", "left_semi")), "edges")
        edges = found if edges is None else edges.unionByName(found)
        patterns = score_patterns(edges, seeds)
        fresh = edges.join(patterns, "pattern").select("token", "kind").distinct()
        fresh = stored(fresh.join(reached, ["token", "kind"], "left_anti"), "reached")
        if fresh.isEmpty():
            return patterns
        new = fresh.select("token").distinct().join(reached, "token", "left_anti")
        reached = reached.unionByName(fresh)
        hashed = instances(words(known)).select("pattern", F.xxhash64("token").alias("token"))
        found = stored(hashed.join(new, "token", "left_semi").distinct(), "occurrences")
        occurrences = occurrences.unionByName(found)


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, base, spans: arrays of kind, start, end for each row of ``df``."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        value.alias("text"),
        base_spans(value).alias("base"),
    )
    known = stored(rows.withColumn("row", F.monotonically_increasing_id()), "personal")
    base = F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"]))
    patterns = learnt_patterns(known)
    if patterns is None:
        return known.select("doc_id", "text_hash", base.alias("base"), base.alias("spans"))
    fresh = (
        instances(words(known, placed=True))
        .where(F.size("kinds") == 0)
        .join(patterns, "pattern")
        .groupBy("row", "start", "end")
        .agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("near_"), "kind").alias("kind"), "start", "end"))).alias("fresh"))
    )
    found = known.join(fresh, "row", "left").select("doc_id", "text_hash", base.alias("base"), "fresh")
    everything = F.when(F.col("fresh").isNull(), F.col("base")).otherwise(F.concat("base", "fresh"))
    return found.select("doc_id", "text_hash", "base", everything.alias("spans"))


def listed(found: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, found: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def part(held: Column, start: Column, length: Column) -> Column:
        first = F.floor(start / CHUNK).cast("int")
        near = F.slice(held, first + 1, F.floor((start + length) / CHUNK).cast("int") - first + 1)
        return F.when(length > 0, F.substr(F.array_join(near, ""), start - first * CHUNK + 1, length)).otherwise("")

    def joined(x: Column) -> Column:
        upto = running(F.transform(x["spans"], lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        before = F.concat(F.array(F.lit(0)), upto)

        def piece(s: Column, at: Column) -> Column:
            mark = F.when(s["start"] >= at, F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
            return F.concat(part(x["chunks"], at, s["start"] - at), mark)

        pieces = lambda at: F.zip_with(x["spans"], F.slice(at, F.lit(1), F.size(x["spans"])), piece)
        rest = lambda at: part(x["chunks"], F.element_at(at, -1), F.length(text) - F.element_at(at, -1))
        return _let(before, lambda at: F.concat(F.array_join(pieces(at), ""), rest(at)))

    return _let(F.struct(ordered.alias("spans"), chunks.alias("chunks")), joined)
