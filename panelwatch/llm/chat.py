"""Chat formatting by rendering successive prefixes of a conversation.

A template is any function from a list of (role, text) to a string; nothing of it is known.
The first k turns are rendered for k = 1, 2, ...; what an output adds to the one before is the
span of turn k. If an output doesn't begin with the one before, the template rewrites history:
``rewrites`` is set, and spans are taken from the place where the outputs part. Within its span
a text is found by rendering the same prefix with a probe in its place.

Rendering every prefix is quadratic in the turns rendered together. A template that states a
``lookback`` of 0 (a turn's output depends on no earlier turn, as in the marked template) is
rendered in blocks of at most ``BLOCK_TURNS`` rows, counted in order, whatever their numbers; a
conversation of any length is then spread over many rows and tasks. Blocks only stand for a
template without lookback (0), which is tried where two blocks of one task meet; other templates
leave it unset, and their conversations are rendered as a whole.

Cases: null text and role are empty strings; turns are ordered by number (null first), then
role and a hash of the text (the text where rendered as a whole), so repeated rows are repeated
turns; null conversation ids form one
conversation; other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import arrow_type, map_arrow, sliced

Turn = tuple[str, str]

#: The marks of this template, and marks of other templates that texts may hold.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]")
BLOCK_TURNS = 256
PROBE = "probe0text1probe"
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPE = re.compile(r"\\(\\?)")
_MARKED = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)

SPAN = "turn bigint, start bigint, end bigint, text_start bigint, text_end bigint, loss boolean"
BLOCK = f"conv_id bigint, block bigint, piece string, rewrites boolean, spans array<struct<{SPAN.replace(' bigint', ':bigint').replace(' boolean', ':boolean')}>>"


def escape(text: str) -> str:
    """Backslashes are doubled, and one is put after the first letter of a control string."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def marked(turns: list[Turn]) -> str:
    """The template of this module."""
    return "".join(f"{TURN}{escape(role)}{TEXT}{escape(text)}{END}" for role, text in turns)


marked.lookback = 0


def parse(formatted: str) -> list[Turn]:
    """Turns read back from the output of ``marked``."""
    return [(unescape(role), unescape(text)) for role, text in _MARKED.findall(formatted)]


def _shared(a: str, b: str) -> int:
    """Length of the common beginning of two strings, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def locate(turns: list[Turn], render: Callable[[list[Turn]], str]) -> tuple[str, list[tuple[int, int, int, int]], bool]:
    """Output for all turns, (start, end, text start, text end) of each, and whether the template
    rewrites history."""
    out, rewrites, spans = "", False, []
    for k in range(len(turns)):
        now, probed = render(turns[: k + 1]), render([*turns[:k], (turns[k][0], PROBE)])
        start = len(out)
        if not now.startswith(out):
            rewrites, start = True, _shared(out, now)
            spans = [tuple(min(x, start) for x in s) for s in spans]
        at = probed.rfind(PROBE)
        tail = len(probed) - at - len(PROBE)
        if at < 0:  # the text isn't rendered
            at, tail = len(now), 0
        spans.append((start, len(now), at, len(now) - tail))
        out = now
    return out, spans, rewrites


def render_conversations(
    conversations: DataFrame,
    render: Callable[[list[Turn]], str] = marked,
    loss_roles: tuple[str, ...] = ("assistant",),
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """conv_id, block, piece, rewrites, spans: the output of each block of turns, in order.

    The pieces of a conversation, joined by block, are its formatted text. ``spans`` has the
    places of each turn and of its text within the piece; ``loss`` marks trained texts.
    """
    if getattr(render, "lookback", None) not in (None, 0):
        raise ValueError("blocks are cut for templates without lookback; leave it unset otherwise")
    whole = getattr(render, "lookback", None) is None
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    types = arrow_type(BLOCK)

    def block_of(turns: list[dict], number: int, before: dict | None) -> dict:
        said = [(t["role"], t["text"]) for t in turns]
        piece, spans, rewrites = locate(said, render)
        if before is not None:
            # A template that says it looks at no earlier turn is taken at its word only here.
            last = (before["role"], before["text"])
            rewrites |= render([last, said[0]]) != render([last]) + render(said[:1])
        names = ("turn", "start", "end", "text_start", "text_end", "loss")
        marks = [dict(zip(names, (t["turn"], *s, t["role"] in loss_roles))) for t, s in zip(turns, spans)]
        return {"conv_id": turns[0]["conv_id"], "block": number, "piece": piece, "rewrites": rewrites, "spans": marks}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        held, number, before = [], 0, None
        for batch in sliced(batches):
            found = []
            for row in batch.to_pylist():
                same = bool(held) and row["conv_id"] == held[0]["conv_id"]
                if held and (not same or (len(held) == block_turns and not whole)):
                    found.append(block_of(held, first + number, before))
                    number, before, held = (number + 1, held[-1], []) if same else (0, None, [])
                held.append(row)
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=types)
        if held:
            yield pa.RecordBatch.from_pylist([block_of(held, first + number, before)], schema=types)

    if whole:
        ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    else:
        # Ranges of rows, not of conversations: a long one, or many equal rows, are several tasks' work.
        key = ["conv_id", "turn", "role", F.xxhash64("text"), F.monotonically_increasing_id()]
        names = ["k0", "k1", "k2", "k3", "k4"]
        keyed = rows.withColumns(dict(zip(names, [F.col(k) if isinstance(k, str) else k for k in key])))
        ordered = keyed.repartitionByRange(*names).sortWithinPartitions(*names[:4]).select(*rows.columns)
    return map_arrow(ordered, step, BLOCK)


def read_back(blocks: DataFrame) -> DataFrame:
    """conv_id, block, n_turns, said, loss, formatted_chars, rewrites: what the output itself holds.

    ``said`` is role, newline, text, newline of each turn; ``loss`` all text under the mask;
    both unescaped.
    """
    ddl = "conv_id bigint, block bigint, n_turns bigint, said string, loss string, formatted_chars bigint, rewrites boolean"
    types = arrow_type(ddl)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = []
            for row in batch.to_pylist():
                piece, turns = row["piece"], parse(row["piece"])
                under = [piece[s["text_start"] : s["text_end"]] for s in row["spans"] if s["loss"]]
                found.append(
                    {
                        "conv_id": row["conv_id"],
                        "block": row["block"],
                        "n_turns": len(turns),
                        "said": "".join(f"{role}\n{text}\n" for role, text in turns),
                        "loss": "".join(map(unescape, under)),
                        "formatted_chars": len(piece),
                        "rewrites": row["rewrites"],
                    }
                )
            yield pa.RecordBatch.from_pylist(found, schema=types)

    return map_arrow(blocks, step, ddl)


def digests(read: DataFrame) -> DataFrame:
    """One row per conversation, hashed block by block in order; no conversation is held whole."""
    ddl = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, rewrites boolean"
    )
    types = arrow_type(ddl)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv_id = False, None
        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in names}
                if not begun or row["conv_id"] != conv_id:
                    if begun:
                        done.append(result())
                    begun, conv_id = True, row["conv_id"]
                    said, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = formatted_chars = 0
                    rewrites = False
                said.update(row["said"].encode())
                loss.update(row["loss"].encode())
                n_turns += row["n_turns"]
                loss_chars += len(row["loss"])
                formatted_chars += row["formatted_chars"]
                rewrites |= row["rewrites"]
                result = lambda: (conv_id, n_turns, said.hexdigest(), loss_chars, loss.hexdigest(), formatted_chars, rewrites)
            if done:
                yield _batch(done, types)
        if begun:
            yield _batch([result()], types)

    names = ["conv_id", "block", "n_turns", "said", "loss", "formatted_chars", "rewrites"]
    ordered = read.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return map_arrow(ordered, step, ddl)


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(types.names, r)) for r in rows], schema=types)
