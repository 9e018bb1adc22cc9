"""Repair of conversations of odd rows and of several blocks, against trying all edits."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from panelwatch.llm import conversation_repair as repair  # noqa: E402

DDL = "conv_id long, turn long, role string, text string"


def expected(rows, everyone):
    turns = {r[0]: [] for r in everyone}
    for conv_id, turn, role, text in rows:
        turns[conv_id].append((turn, " " if role is None else role, " " if text is None else text))
    return {k: brute.repair(v) for k, v in turns.items()}


def found(spark, rows, everyone, **options):
    df = repair.report_with_digest(spark.createDataFrame(rows, DDL), spark.createDataFrame(everyone, DDL), **options)
    out = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in out}) == len(out)
    return {r[0]: r[1:] for r in out}


def made_up(rng, conv_id, n):
    roles = rng.choice([["user", "assistant"], ["user", "assistant", "system", "tool", "", None, "aide", "Süd"]])
    texts = ["Yes.", "no", "Why?", "", "  \n", None, "end.  ", "x" * 30, "日本。", "ok!"]
    own = texts if rng.random() < 0.5 else [f"{i}." for i in range(40)]
    return [
        (conv_id, rng.choice([i, i, i, i // 2, None]), roles[i % 2] if rng.random() < 0.7 else rng.choice(roles), rng.choice(own))
        for i in range(n)
    ]


@pytest.mark.parametrize("block_rows", [1, 3, 256])
def test_same_as_trying_all_edits(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [r for k in [*range(60), None] for r in made_up(rng, k, rng.choice([0, 1, 2, 3, 7, 12, 30]))]
    everyone = [*rows, (1000, 1, "user", "gone"), (None, 1, "user", "x")]
    assert found(spark, rows, everyone, block_rows=block_rows) == expected(rows, everyone)


def test_one_turn_and_copies(spark):
    """Many rows of one turn, and of one text, are still cut into blocks."""
    rows = [(None, 0, "user", "same.")] * 300 + [(None, 0, "assistant", f"{i}.") for i in range(300)]
    assert found(spark, rows, rows, block_rows=16) == expected(rows, rows)
    cut = repair.blocks(repair.faults(repair._read(spark.createDataFrame(rows, DDL))), 16).collect()
    assert sum(len(b.signature) for b in cut) == 600 and max(len(b.signature) for b in cut) == 16


def test_empty_tables_and_other_columns(spark):
    assert found(spark, [], []) == {}
    nothing = (0, 0, 0, 0, 0, 0, "", brute.sha(""))
    assert found(spark, [], [(3, 0, "user", "x"), (None, 0, "user", "x")]) == {3: nothing, None: nothing}
    odd = spark.createDataFrame([(1, 0, "user", "Hi.", 1, "x")], f"{DDL}, fault int, letter string")
    out = repair.report_with_digest(odd, odd).collect()
    assert [(r.conv_id, r.cost, r.audit) for r in out] == [(1, 2, "D")]


def test_rows_after_repair(spark):
    rows = [(1, 0, "system", "Be nice."), (1, 1, "assistant", "Hello."), (1, 2, "tool", "Fine."), (1, 3, "user", "Bye."), (2, 0, "user", "A."), (2, 1, "assistant", "B.")]
    _, texts, chosen = repair.repair(spark.createDataFrame(rows, DDL))
    left = sorted(tuple(r) for r in repair.repaired(texts, chosen).collect())
    assert left == [
        (1, 0, "user", "Be nice."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Fine."), (1, 3, "assistant", "Bye."),
        (2, 0, "user", "A."), (2, 1, "assistant", "B."),
    ]
    assert all(brute.cheapest([(r[2], r[3], "") for r in left if r[0] == k])[0] == 0 for k in (1, 2))


def test_suffixes_are_shared():
    """Sorted from their ends, signatures make one node for each distinct suffix."""
    made = []
    before = repair.Node.before
    rng = random.Random(1)
    signatures = sorted({"".join(rng.choice("suax") for _ in range(rng.randint(1, 6))) for _ in range(300)}, key=lambda s: s[::-1])
    suffixes = {s[i:] for s in signatures for i in range(len(s))}
    repair.Node.before = lambda self, letter: made.append(letter) or before(self, letter)
    try:
        nodes = list(repair.solved((repair.END, s) for s in signatures))
    finally:
        repair.Node.before = before
    assert len(made) == len(suffixes)
    for s, node in zip(signatures, nodes):
        rows = [({"s": "system", "u": "user", "a": "assistant", "x": "user"}[c], f"{i}.", "blank" if c == "x" else "") for i, c in enumerate(s)]
        assert (node.costs[0], node.audits[0]) == brute.cheapest(rows)[:2]


def test_costs_to_go_are_few():
    assert repair.END in repair.terminals() and len(repair.terminals()) < 40


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! {t}") for c in range(30) for t in range(8)]
    rows += [(None, 1, None, None), (5, None, "user", None), (5, None, "user", "a.b")]
    out = repair.damaged(spark.createDataFrame([(*r, 1) for r in rows], f"{DDL}, kind int")).collect()
    key = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r)
    assert sorted((tuple(r) for r in out), key=key) == sorted(brute.damaged(rows), key=key)
