"""Cheapest repair of the structure of conversations, by a suffix-shared automaton.

Role initials of a conversation should read ``(s?(ua)+)?``. Rows are kept (0), given another role
(1), deleted (2; blank and repeated rows must be) or preceded by an inserted empty turn (5); a row
that ends without a mark and isn't deleted adds 5. Of the cheapest repairs the one with the least
string of edits (D, I, K, R) is taken.

1. Every row gives a letter of role and fault. Rows are dealt out by ranges of conversation and
   place, last row first, and cut into blocks of at most ``BLOCK_ROWS`` rows, whose letters are a
   *signature*: a conversation of any length is then spread over rows and tasks.
2. The distinct signatures of all conversations are sorted from their ends, so that neighbours
   share suffixes. Each distinct suffix is one node of an acyclic automaton, and for each node and
   state of the grammar the cost to go and the best edits are computed once, from the node after it.
   As each edit leads each state to one other, the least letter that reaches the least cost is
   also the least string.
3. What follows a block counts only by the costs to go of the four states, less the least of
   them; ``terminals`` lists all that can occur. Blocks that others follow are solved for each of
   them, and one pass over the blocks of a conversation from its end, and one back, pick the right
   solution. Conversations of one block take theirs at once.
4. Texts are shuffled once, to be hashed beside the decisions on them.

Cases: null roles and texts are one space; a null turn comes first and doesn't count as a gap; rows
of one turn are in the order of role and md5 of the text, so repeated rows are neighbours and all
but one of them duplicates; null ids are one conversation; other columns are left out; an empty
table gives an empty table. Two texts are taken for one if their md5 is equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import arrow_type, digest, map_arrow, sliced, stored

BLOCK_ROWS = 256
BLANK = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. Where an inserted or rerolled turn leads, and its role.
NEXT, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Letters: a role that starts with s, u, a or otherwise, in capitals if truncated; must be deleted.
LETTERS = "suaoSUAOx"
END = (0, 2 * INSERT, INSERT, 0)
END_AUDITS = ("", "II", "I", "")

Costs = tuple[int, int, int, int]


@cache
def edits(after: Costs, letter: str) -> tuple[Costs, tuple[tuple[str, int], ...]]:
    """Costs to go from each state before a row, and its edits with the state after it."""
    extra = TRUNCATED if letter.isupper() else 0
    options = []
    for state in range(4):
        found = {"D": (DELETE + after[state], state)}
        if letter != "x":
            if (to := KEPT[state].get(letter.lower())) is not None:
                found["K"] = (extra + after[to], to)
            found["R"] = (REROLE + extra + after[NEXT[state]], NEXT[state])
        options.append(found)
    plain = [min(c for c, _ in found.values()) for found in options]
    # Two insertions reach every state that any number of them reaches.
    once = [min(plain[s], INSERT + plain[NEXT[s]]) for s in range(4)]
    costs = tuple(min(plain[s], INSERT + once[NEXT[s]]) for s in range(4))

    def best(state: int) -> tuple[str, int]:
        least = min(
            (e for e in "DIKR" if (INSERT + costs[NEXT[state]] if e == "I" else options[state].get(e, (1 << 60, 0))[0]) == costs[state])
        )
        if least == "I":
            rest, to = best(NEXT[state])
            return least + rest, to
        return least, options[state][least][1]

    return costs, tuple(map(best, range(4)))


def settled(costs: Costs) -> tuple[Costs, int]:
    """Costs less the least of them, and that one."""
    least = min(costs)
    return tuple(c - least for c in costs), least


@cache
def terminals() -> tuple[Costs, ...]:
    """All costs to go, less the least of them, that any conversation can have."""
    known, new = {END}, [END]
    while new:
        new = [c for c in {settled(edits(after, x)[0])[0] for after in new for x in LETTERS} if c not in known]
        known.update(new)
    return tuple(sorted(known))


class Node:
    """A suffix: costs to go, edits and last state, for each state of the grammar."""

    __slots__ = ("costs", "audits", "exits")

    def __init__(self, costs: Costs, audits: tuple[str, ...], exits: tuple[int, ...]):
        self.costs, self.audits, self.exits = costs, audits, exits

    def before(self, letter: str) -> Node:
        """The node of the suffix with one more letter in front."""
        costs, moves = edits(self.costs, letter)
        return Node(costs, tuple(e + self.audits[to] for e, to in moves), tuple(self.exits[to] for _, to in moves))


def last_node(terminal: Costs) -> Node:
    return Node(terminal, END_AUDITS if terminal == END else ("",) * 4, (0, 1, 2, 3))


def solved(signatures: Iterator[tuple[Costs, str]]) -> Iterator[Node]:
    """The node of each signature. Those in order of terminal and reversed signature share the
    nodes of their common suffixes; only the nodes on the way to the last signature are held."""
    path, known, terminal = [], "", None
    for own, signature in signatures:
        back, shared = signature[::-1], 0
        if own == terminal:
            most = min(len(back), len(known))
            while shared < most and back[shared] == known[shared]:
                shared += 1
            del path[shared + 1 :]
        else:
            path = [last_node(own)]
        for letter in back[shared:]:
            path.append(path[-1].before(letter))
        known, terminal = back, own
        yield path[-1]


def _null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on columns of which the first may be null; the columns of ``left`` stay."""
    renamed = right.withColumnsRenamed({n: f"{n}__r" for n in names})
    on = [left[n].eqNullSafe(renamed[f"{n}__r"]) for n in names]
    return left.join(renamed, on, how).drop(*(f"{n}__r" for n in names))


def _read(conversations: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.md5(text)).alias("md5"),
    )


PLACE = ["conv_id", "turn", "role", "md5"]


def faults(rows: DataFrame) -> DataFrame:
    """One row for each of ``rows`` without its text: conv_id, turn, role, md5, copy, fault, letter."""
    ending = F.rtrim("text", F.lit(BLANK))
    place = rows.select(*PLACE, (ending == "").alias("blank"), (~F.substring(ending, -1, 1).isin(".", "!", "?")).alias("truncated"))
    places = place.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("n"), F.any_value("blank").alias("blank"), F.any_value("truncated").alias("truncated"))
    said = places.groupBy("conv_id", "role", "md5").agg(F.min(F.struct("turn")).alias("first"))
    first = _null_safe(places, said, ["conv_id", "role", "md5"], "inner").withColumn("begins", F.col("turn").eqNullSafe(F.col("first.turn")))
    copies = first.select(*PLACE, "blank", "truncated", "begins", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))
    fault = (
        F.when(F.col("blank"), "blank").when(~F.col("begins") | (F.col("copy") > 1), "duplicate").when(F.col("truncated"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    )
    return copies.withColumn("fault", fault).select(*PLACE, "copy", "fault", letter.alias("letter"), role.alias("initial"))


BLOCK = (
    "conv_id bigint, part int, block bigint, signature string, initials string, "
    "turns array<bigint>, roles array<string>, md5s array<binary>"
)


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of ``faults`` in blocks, those of a conversation numbered from its end by part and
    block; within a block in order."""
    types = arrow_type(BLOCK)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, conv, number = TaskContext.get().partitionId(), [], None, 0

        def closed() -> dict:
            held.reverse()
            columns = {name: [r[name] for r in held] for name in ("letter", "initial", "turn", "role", "md5")}
            return {
                "conv_id": conv, "part": part, "block": number, "signature": "".join(columns["letter"]),
                "initials": "".join(columns["initial"]), "turns": columns["turn"], "roles": columns["role"], "md5s": columns["md5"],
            }

        for batch in sliced(batches):
            done = []
            for row in batch.to_pylist():
                if held and (row["conv_id"] != conv or len(held) == block_rows):
                    done.append(closed())
                    number, held = (number + 1 if row["conv_id"] == conv else 0), []
                conv = row["conv_id"]
                held.append(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=types)
        if held:
            yield pa.RecordBatch.from_pylist([closed()], schema=types)

    backwards = [F.col("conv_id").asc(), *(F.col(c).desc() for c in ("turn", "role", "md5", "copy"))]
    ordered = rows.select(*PLACE, "copy", "letter", "initial").repartitionByRange(*backwards).sortWithinPartitions(*backwards)
    return map_arrow(ordered, step, BLOCK)


SOLVED = "terminal array<bigint>, signature string, costs array<bigint>, audits array<string>, exits array<int>"


def solutions(signatures: DataFrame) -> DataFrame:
    """Costs, edits and last state from each state, for distinct (terminal, signature)."""
    types = arrow_type(SOLVED)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def asked() -> Iterator[tuple[Costs, str]]:
            for batch in batches:
                for row in batch.to_pylist():
                    held.append(row)
                    yield tuple(row["terminal"]), row["signature"]

        found = []
        for node in solved(asked()):
            found.append(held.pop() | {"costs": node.costs, "audits": node.audits, "exits": node.exits})
            if len(found) == 1000:
                yield pa.RecordBatch.from_pylist(found, schema=types)
                found = []
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=types)

    key = [F.col("terminal"), F.reverse("signature")]
    return map_arrow(signatures.select("terminal", "signature").repartitionByRange(*key).sortWithinPartitions(*key), step, SOLVED)


def _scanned(df: DataFrame, order: list[Column], ddl: str, begin: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """A row for each row, conversation by conversation: ``begin`` gives the function for one."""
    types = arrow_type(ddl)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, of = object(), None
        for batch in sliced(batches):
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != conv or of is None:
                    conv, of = row["conv_id"], begin()
                out.append(of(row))
            yield pa.RecordBatch.from_pylist(out, schema=types)

    return map_arrow(df.repartition("conv_id").sortWithinPartitions("conv_id", *order), step, ddl)


def _with_solution(cut: DataFrame) -> DataFrame:
    """``cut`` (conv_id, part, block, signature, initials) with start (state), audit and cost."""
    sizes = cut.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_blocks"), F.min(F.struct("part", "block")).alias("last"))
    known = _null_safe(cut, sizes, ["conv_id"], "inner")
    is_last = F.struct("part", "block") == F.col("last")
    end = F.array(*map(F.lit, END)).cast("array<bigint>")
    every = F.array(*(F.array(*map(F.lit, t)) for t in terminals())).cast("array<array<bigint>>")
    known = known.withColumn("needs", F.when(is_last, F.array(end)).otherwise(every)).drop("last")
    needed = known.select(F.explode("needs").alias("terminal"), "signature").distinct()
    found = stored(solutions(needed), "repairs")
    alone = known.where("n_blocks = 1").join(found.where(F.col("terminal") == end), "signature")
    alone = alone.select("conv_id", "part", "block", "initials", F.lit(0).alias("start"), F.get("audits", F.lit(0)).alias("audit"), F.get("costs", F.lit(0)).alias("cost"))
    return alone.unionByName(_chained(known.where("n_blocks > 1").drop("needs", "n_blocks"), found))


def _chained(cut: DataFrame, found: DataFrame) -> DataFrame:
    """The same for conversations of several blocks."""
    # At most one entry for each of ``terminals``.
    moves = found.groupBy("signature").agg(F.collect_list(F.struct("terminal", "costs")).alias("moves"))

    def from_the_end() -> Callable[[dict], dict]:
        at = list(END)

        def of(row: dict) -> dict:
            nonlocal at
            costs = next(m["costs"] for m in row["moves"] if m["terminal"] == at)
            out = {k: row[k] for k in ("conv_id", "part", "block", "signature", "initials")} | {"terminal": at, "least": min(costs)}
            at = [c - min(costs) for c in costs]
            return out

        return of

    ddl = "conv_id bigint, part int, block bigint, signature string, initials string, terminal array<bigint>, least bigint"
    first = _scanned(cut.join(moves, "signature"), [F.col("part"), F.col("block")], ddl, from_the_end)
    picked = stored(first, "repair-chains").join(found, ["terminal", "signature"])

    def from_the_start() -> Callable[[dict], dict]:
        state, before = 0, None

        def of(row: dict) -> dict:
            nonlocal state, before
            out = {k: row[k] for k in ("conv_id", "part", "block")} | {"start": state, "audit": row["audits"][state]}
            # What a block adds to the least cost; the first block also what its state costs beyond it.
            out["cost"] = row["least"] + (row["costs"][0] - row["least"] if before is None else 0)
            out["initials"] = (before or "") + row["initials"]
            state, before = row["exits"][state], row["initials"][-1]
            return out

        return of

    ddl = "conv_id bigint, part int, block bigint, initials string, start int, audit string, cost bigint"
    return _scanned(picked, [F.col("part").desc(), F.col("block").desc()], ddl, from_the_start)


def _by_row(audit: str) -> tuple[list[str], str]:
    """Edits of each row, its insertions first, and the insertions after the last row."""
    rows, start = [], 0
    for i, e in enumerate(audit):
        if e != "I":
            rows.append(audit[start : i + 1])
            start = i + 1
    return rows, audit[start:]


DECISION = "conv_id bigint, at_end boolean, turn bigint, role string, md5 binary, inserted array<string>, becomes string"


def decisions(known: DataFrame) -> DataFrame:
    """One row for each row that stays: the roles inserted before it and its own; and one for
    insertions at the end of a conversation (``at_end``). From blocks with start and audit."""
    types = arrow_type(DECISION)

    def of(block: dict) -> Iterator[dict]:
        state, (rows, rest) = block["start"], _by_row(block["audit"])

        def inserted(edits: str) -> list[str]:
            nonlocal state
            out = []
            for _ in range(edits.count("I")):
                out.append(ROLE[state])
                state = NEXT[state]
            return out

        for edits_, initial, turn, role, md5 in zip(rows, block["initials"], block["turns"], block["roles"], block["md5s"]):
            if edits_[-1] == "D":
                continue
            row = {"conv_id": block["conv_id"], "at_end": False, "turn": turn, "role": role, "md5": md5, "inserted": inserted(edits_)}
            if edits_[-1] == "K":
                row["becomes"], state = role, KEPT[state][initial]
            else:
                row["becomes"], state = ROLE[state], NEXT[state]
            yield row
        if rest:
            yield {"conv_id": block["conv_id"], "at_end": True, "inserted": inserted(rest)}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_pylist([d for block in batch.to_pylist() for d in of(block)], schema=types)

    return map_arrow(known, step, DECISION)


def repaired(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id, number, role, text of the rows after repair, in order; ``decisions`` and texts meet
    in one shuffle by conversation."""
    return _merged(rows, chosen, "conv_id bigint, number bigint, role string, text string", None)


def _merged(rows: DataFrame, chosen: DataFrame, ddl: str, finish: str | None) -> DataFrame:
    types = arrow_type(ddl)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, number, waiting = None, False, 0, None
        state = hashlib.sha256()
        for batch in sliced(batches):
            out = []

            def say(role: str, text: str) -> None:
                nonlocal number
                if finish:
                    state.update((f"\n{role}:{text}" if number else f"{role}:{text}").encode())
                else:
                    out.append({"conv_id": conv, "number": number, "role": role, "text": text})  # noqa: B023
                number += 1

            for row in batch.to_pylist():
                if not begun or row["conv_id"] != conv:
                    if begun and finish:
                        out.append({"conv_id": conv, finish: state.hexdigest()})
                    begun, conv, number, waiting, state = True, row["conv_id"], 0, None, hashlib.sha256()
                place = (row["turn"], row["role"], row["md5"])
                if row["inserted"] is not None:
                    for role in row["inserted"]:
                        say(role, "")
                    waiting = None if row["at_end"] else (*place, row["becomes"])
                elif waiting and waiting[:3] == place:
                    say(waiting[3], row["text"])
                    waiting = None
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=types)
        if begun and finish:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, finish: state.hexdigest()}], schema=types)

    texts = rows.withColumns({"at_end": F.lit(False), "inserted": F.lit(None).cast("array<string>"), "becomes": F.lit(None).cast("string")})
    both = texts.unionByName(chosen, allowMissingColumns=True)
    order = ["conv_id", "at_end", "turn", "role", "md5", F.col("inserted").isNull()]
    names = ["conv_id", "at_end", "turn", "role", "md5", "text", "inserted", "becomes"]
    return map_arrow(both.select(*names).repartition("conv_id").sortWithinPartitions(*order), step, ddl)


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Report (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), the texts read and
    the decisions on them, for ``repaired`` or ``report_with_digest``."""
    rows = _read(conversations)
    known = stored(faults(rows), "conversation-faults")
    cut = stored(blocks(known, block_rows), "conversation-blocks")
    pieces = stored(_with_solution(cut.drop("turns", "roles", "md5s")), "conversation-repairs")
    place = ["conv_id", "part", "block"]
    chosen = decisions(_null_safe(cut, pieces.drop("initials", "cost"), place, "inner"))
    count = lambda name: F.count_if(F.col("fault") == name).alias(name)
    turn = F.col("turn")
    counted = known.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("bigint").alias("gaps"),
        *map(count, ("blank", "duplicate", "truncated")),
    )
    pair = lambda i: F.substr("initials", i, F.lit(2))
    at = F.sequence(F.lit(1), F.length("initials") - 1)
    wrong = F.when(F.length("initials") > 1, F.size(F.filter(at, lambda i: ~pair(i).isin("su", "ua", "au")))).otherwise(0)
    # One entry for each block of a conversation: its edits are a string of its length in any case.
    order = F.struct((-F.col("part")).alias("part"), (-F.col("block")).alias("block"), "audit")
    summed = pieces.groupBy("conv_id").agg(
        F.sum(wrong).alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["audit"]), "").alias("audit"),
    )
    return _null_safe(counted, summed, ["conv_id"], "inner"), rows, chosen


def report_with_digest(conversations: DataFrame, everyone: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The report with repaired_sha256 (of ``role:text`` of the repaired rows, newline-joined) for
    each conv_id of ``everyone``; conversations without rows have nothing to repair."""
    report, rows, chosen = repair(conversations, block_rows)
    hashed = _merged(rows, chosen, "conv_id bigint, repaired_sha256 string", "repaired_sha256")
    ids = everyone.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    out = _null_safe(_null_safe(ids, report, ["conv_id"], "left"), hashed, ["conv_id"], "left")
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", digest(F.lit("").cast("binary"))).alias("repaired_sha256")
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults planted by a checksum of conversation and turn, % 20:
    0 drops a row, 1 empties its text, 2 takes its marks, 3 repeats it, 4 makes it the user's."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies
    ).drop("copy")
