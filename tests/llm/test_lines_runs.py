"""Shared lines and periodic runs on odd and made-up texts, against plain versions."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from panelwatch.llm import line_dedup, periodic  # noqa: E402


def frame(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("n", [0, 1, 63, 5_000])
def test_perfect_hash_numbers_each_key(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype="u8"))
    hashed = line_dedup.PerfectHash.build(keys)
    assert sorted(hashed.numbers(keys).tolist()) == list(range(len(keys)))
    assert len(hashed.bits) <= 8 * len(keys) + 64
    assert len(hashed.numbers(np.arange(5, dtype="u8"))) == 5


def test_keys_beyond_the_last_level_are_listed(monkeypatch):
    monkeypatch.setattr(line_dedup, "LEVELS", 1)
    keys = np.arange(1000, dtype="u8")
    hashed = line_dedup.PerfectHash.build(keys)
    assert len(hashed.rest) and sorted(hashed.numbers(keys).tolist()) == list(range(1000))


def test_line_keys():
    assert line_dedup.line_key(b"  " + b"x" * 20 + b"\t\r") == b"x" * 20
    assert line_dedup.line_key(b"x" * 19) == b""
    assert line_dedup.line_key(("é" * 19).encode()) == b""
    assert line_dedup.line_key(("é" * 20).encode()) == ("é" * 20).encode()
    assert line_dedup.line_key(" ".encode() + b"y" * 19) == " ".encode() + b"y" * 19


LONG = "a line that is long enough"
LINES = [
    (1, f"{LONG}\nshort\n  A LINE that is long enough \r\n\nown line of the first document"),
    (2, f"own line of the second document\n{LONG}"),
    (3, LONG),
    (4, f"{LONG}\n{LONG}"),
    (5, None),
    (6, ""),
    (7, "\n"),
    (8, "Ärger mit den Zeilen der Datei"),
    (9, "Ärger mit den zeilen der datei"),
    (10, "ärger mit den zeilen der datei"),
    (None, LONG),
    (None, f"x\n{LONG}"),
]


def test_shared_lines(spark):
    for rows in (LINES, LINES + LINES[:4], [(None, LONG)] * 5, [(7, f"{LONG}\nx")] * 40, LINES * 3):
        for shards in (None, 7):
            found = line_dedup.drop_shared_lines(frame(spark, rows), shards=shards)
            key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
            assert sorted(map(tuple, found.collect()), key=key) == sorted(brute.shared_lines(rows), key=key)


def test_shared_lines_of_empty_tables_and_other_columns(spark):
    odd = "doc_id long, text string, block string, kept int, n_lines int"
    assert line_dedup.drop_shared_lines(frame(spark, [], odd)).collect() == []
    found = line_dedup.drop_shared_lines(frame(spark, [(1, LONG, "b", 1, 2)], odd))
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert tuple(found.first()) == (1, 1, 0, LONG)


def test_an_index_serves_other_documents(spark):
    index, shards = line_dedup.build_index(frame(spark, [(i, f"{LONG}\nline number {i} of the table") for i in range(9)]), shards=3)
    other = frame(spark, [(100, f"{LONG}\na line that no document has\nline number 3 of the table"), (8, LONG), (101, None)])
    found = {r.doc_id: r.kept for r in line_dedup.drop_indexed_lines(other, index, shards).collect()}
    assert found == {100: "a line that no document has\nline number 3 of the table", 8: LONG, 101: ""}


def words_of(kind, n, rng):
    if kind == "fibonacci":
        a, b = ["x"], ["x", "y"]
        while len(b) < n:
            a, b = b, b + a
        return b
    if kind == "thue-morse":
        return [f"t{i.bit_count() % 2}" for i in range(n)]
    if kind == "lines":
        lines = [[f"l{rng.randrange(20)}" for _ in range(rng.randint(1, 9))] for _ in range(4)]
        return [x for _ in range(n // 6) for x in rng.choice(lines)]
    words = [f"w{rng.randrange(int(kind))}" for _ in range(n)]
    a = rng.randrange(n) if n else 0
    return words[:a] + (words[a:] * 5)[: rng.randint(0, 3 * n)]


def test_runs():
    rng = random.Random(13)
    for _ in range(150):
        docs = [
            words_of(rng.choice(["fibonacci", "thue-morse", "lines", "1", "2", "3", "50"]), rng.choice([0, 1, 11, 12, 13, 60, 300]), rng)
            for _ in range(rng.randint(1, 5))
        ]
        docs += docs[: rng.randint(0, 2)]
        runs, kept = periodic.runs_of([" ".join(w) for w in docs])
        for w, found, left in zip(docs, runs, kept):
            assert ([(r["start"], r["length"], r["period"]) for r in found], left) == brute.runs(w)


def test_runs_without_trust_in_hashes(monkeypatch):
    """Where hashes of different stretches are equal, words decide."""
    monkeypatch.setattr(periodic.Hashes, "of", lambda self, start, length: self.sums[start] * np.uint64(0))
    text = "a b c d e f g " * 3 + "x " * 14 + "y"
    runs, _ = periodic.runs_of([text])
    assert {(r["start"], r["length"], r["period"]) for r in runs[0]} <= set(brute.runs(text.split())[0])


def test_pairs_are_extended_part_by_part(monkeypatch):
    text = " ".join(words_of("lines", 900, random.Random(3)))
    whole = periodic.runs_of([text])
    monkeypatch.setattr(periodic, "AT_ONCE", 50)
    assert periodic.runs_of([text]) == whole


def test_grammar_shares_copies():
    ids = np.tile(np.arange(500), 8)
    doc = np.repeat(np.arange(8), 500)
    grammar = periodic.Grammar(ids, doc)
    assert len(grammar.symbols) == 8 and not len(grammar.borders)
    assert all(np.bincount(grammar.places[:, 0]) > 1)


def test_runs_of_odd_rows(spark):
    odd = "doc_id long, text string, runs int, collapsed int"
    assert periodic.with_runs(frame(spark, [], odd)).collect() == []
    rows = [(1, None, 1, 1), (None, "a " * 30, 2, 2), (2, "", 3, 3), (2, "", 3, 3), (3, "  " * 12, 4, 4)]
    df = periodic.with_runs(frame(spark, rows, odd))
    assert df.columns == ["doc_id", "text", "runs", "collapsed"]
    found = df.select("doc_id", periodic.longest(df.runs).alias("best"), periodic.listed(df.runs).alias("listed"), "collapsed").collect()
    listed = {(r.doc_id, r.best and tuple(r.best), r.listed, r.collapsed) for r in found}
    assert listed == {
        (1, None, "", ""), (None, (0, 30, 1), "0,30,1\n", "a"), (2, None, "", ""), (3, (0, 12, 1), "0,12,1\n", " "),
    }


def test_planted_endings(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 40))) for i in range(200)] + [(None, "a b"), (30, None)]
    df = periodic.with_planted_runs(frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, a__ int"))
    assert df.columns == ["doc_id", "text", "a__"]
    found = sorted((r.doc_id or -1, (r.text or "").split()) for r in df.collect())
    assert found == sorted((k or -1, brute.planted(k, t)) for k, t in rows)
    assert any(w != t.split() for (_, w), (_, t) in zip(found[2:], rows[1:200]))
