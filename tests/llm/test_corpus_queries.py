"""Every corpus query on the smallest tables against its plain version."""

import sys
from collections import defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from compare import compare, duck  # noqa: E402
from panelwatch.llm import bpe, mixing, pii, quality, urls  # noqa: E402
from panelwatch.llm.common import available  # noqa: E402


@pytest.fixture(scope="module")
def rows(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in docs]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(available("byte_bpe_50k.json"))


def got(spark, tiny, name, key="doc_id"):
    found = queries()[name](spark, tiny).collect()
    out = {r[key]: r for r in found}
    assert len(out) == len(found)
    return out


def test_registered():
    names = sorted(queries())
    assert all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 14))
    assert "pipeline" in names


def test_op1(spark, tiny, rows, tokenizer):
    found = got(spark, tiny, "op1_bpe")
    assert {k: tuple(r)[1:] for k, r in found.items()} == {k: brute.bpe(tokenizer, t) for k, t in rows}


def test_op2(spark, tiny, rows):
    found = got(spark, tiny, "op2_personal")
    for k, text in rows:
        spans, r = brute.personal(text), found[k]
        counts = [sum(s[0] == kind for s in spans) for kind, _ in brute.KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert r.base_sha256 == brute.sha(brute.listed(spans))
        assert r.spans.startswith(brute.listed(spans))


def test_op3(spark, tiny, rows):
    found = got(spark, tiny, "op3_repeats")
    for k, n_words, n_removed, kept in brute.repeats(rows, 35):
        assert tuple(found[k])[1:] == (n_words, n_removed, brute.sha(kept))


def test_op4(spark, tiny):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{tiny}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text))
    said = "</s>[INST] ok [/INST]"
    turns[-1] = [(0, "user", said), (1, "assistant", said)]
    found = got(spark, tiny, "op4_chat", "conv_id")
    assert {k: tuple(r)[1:5] for k, r in found.items()} == {k: brute.chat(sorted(v)) for k, v in turns.items()}


def test_op5(spark, tiny, rows, tokenizer):
    found = got(spark, tiny, "op5_token_files")
    assert {k: tuple(r)[1:] for k, r in found.items()} == brute.token_files(tokenizer, rows)


def test_op6(spark, tiny, rows):
    found = got(spark, tiny, "op6_minhash")
    expected = brute.near(rows)
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == expected
    assert all(r.kept == (k == r.component_id) for k, r in found.items())


def test_op7(spark, tiny):
    text, good = compare(spark, duck(tiny), queries()["op7_mixing"], oracle_sql()["op7_mixing"], tiny)
    assert good, text


def test_op8(spark, tiny, rows):
    found = got(spark, tiny, "op8_fingerprints")
    assert {k: (r.n_chars, r.edited_sha256) for k, r in found.items()} == brute.edited(rows)
    texts = dict(rows)
    same = defaultdict(set)
    for k, r in found.items():
        same[texts[k]].add(r.fingerprint)
    assert all(len(x) == 1 for x in same.values())
    long = [r for r in found.values() if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def test_op9(spark, tiny, rows):
    found = got(spark, tiny, "op9_quality")
    for k, text in rows:
        r = found[k]
        assert tuple(r)[1:7] == brute.quality(text)
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}
    judged = [(labels[k], r.kept) for k, r in found.items() if k in labels and not r.base_failed]
    assert sum(bool(q) == kept for q, kept in judged) >= 0.97 * len(judged)


def test_op10(spark, tiny):
    """The default labels share no word with the planted hosts; how well the model does on them."""
    found = got(spark, tiny, "op10_urls", "page_id")
    bad = ("ads-track", "adult-x", "casino-win", "free-bets", "cheap-pills")
    words = {w for host in urls.BAD_WORDS for w in host.split("-")}
    assert not words & {w for host in bad for w in host.split("-") if len(w) > 3}
    right = judged = 0
    for r in spark.read.parquet(f"{tiny}/pages.parquet").collect():
        host, path, rule, verdict = brute.url(r.url)
        g = found[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule)
        assert g.verdict == verdict if rule else g.verdict in ("allow", "block")
        if rule is None and "spam-farm" not in host:
            right, judged = right + ((g.verdict == "block") == any(b in host for b in bad)), judged + 1
    assert right >= 0.95 * judged


def test_op11(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns = {r[0]: [] for r in rows}
    for conv_id, *turn in brute.damaged(rows):
        turns[conv_id].append(turn)
    found = got(spark, tiny, "op11_repair", "conv_id")
    assert {k: tuple(r)[1:] for k, r in found.items()} == {k: brute.repair(v) for k, v in turns.items()}


def test_op12(spark, tiny, rows):
    found = got(spark, tiny, "op12_lines")
    for k, n_lines, n_dropped, kept in brute.shared_lines(rows):
        assert tuple(found[k])[1:] == (n_lines, n_dropped, brute.sha(kept))


def test_op13(spark, tiny, rows):
    found = got(spark, tiny, "op13_runs")
    for k, text in rows:
        runs, kept = brute.runs(brute.planted(k, text))
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert tuple(found[k])[1:] == (len(runs), *top, brute.sha(listed), brute.sha(kept))


def test_pipeline(spark, tiny, rows, tokenizer):
    """The stages one after the other, from the plain versions and the operators' own verdicts."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    voted = quality.with_votes(quality.features(docs))
    good = {r.doc_id for r in quality.judged(voted, quality.fit(voted)).where("kept").collect()}
    assert good <= {k for k, t in rows if not brute.quality(t)[-1]}
    left = [(k, t) for k, t in rows if k in good]
    left = [(k, t) for k, t in left if brute.near(left, 5)[k][1] == k] if len(left) < 2 else [
        (k, t) for groups in [brute.near(left, 5)] for k, t in left if groups[k][1] == k
    ]
    clean = {}
    for k, text in left:
        for kind, a, b in sorted(brute.personal(text), key=lambda s: -s[1]):
            text = f"{text[:a]}[{kind}]{text[b:]}"
        clean[k] = text
    frame = docs.drop("text").join(spark.createDataFrame(list(clean.items()), "doc_id long, text string"), "doc_id")
    chosen = mixing.choose(frame, corpus_pipeline.MIX, corpus_pipeline.MIX_SHARE, 1, corpus_pipeline.MIX_SEED)
    kept = sorted(r.doc_id for r in chosen.collect())
    found = corpus_pipeline.run(spark, tiny).collect()
    assert sorted(r.doc_id for r in found) == kept and len(kept) > 50
    for r in found:
        assert r.text == clean[r.doc_id] and r.n_chars == len(r.text)
        assert r.ids == tokenizer.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_stages_keep_columns(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").limit(30)
    odd = docs.withColumns({"n_words": docs.doc_id, "kept": docs.doc_id > 3})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, tiny).columns == odd.columns, name
        assert stage(spark, odd.limit(0), tiny).count() == 0, name
    assert bpe.encode(odd.limit(0), available("byte_bpe_50k.json")).count() == 0
    assert pii.find(odd.limit(0)).count() == 0
