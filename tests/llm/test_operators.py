"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from panelwatch.llm import bpe, chat, components, minhash, mixing, order_minhash, pii, quality, substring, token_files, urls  # noqa: E402
from panelwatch.llm.common import available, scratch  # noqa: E402

VOCABULARY = "byte_bpe_50k.json"
ODD = [
    "", " ", "  a  b\n", "a ", " a", "a b.", "x\x00y", "don't I'll 'S", "1,234.5 !? ..", "\n\n\n", "日本語 テキスト 😀😀",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "é" * 700, "ab" * 2000, " " * 300 + "x", "z\x85y \x1c w", "a\u00a0 b", "end. \r\n\r\n",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(available(VOCABULARY))


def frame(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)


def numbered(spark, texts):
    return frame(spark, list(enumerate(texts)))


@pytest.mark.parametrize("kind", [bpe.Codec, token_files.LibraryCodec])
def test_codec_is_the_library(tokenizer, kind):
    own = kind(available(VOCABULARY))
    for text in ODD * 2:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
        assert own.decode(own.encode(text)) == text == tokenizer.decode(ids, skip_special_tokens=False)
    partial = tokenizer.encode("é日", add_special_tokens=False).ids[:1]
    assert own.decode(brute.packed(partial)) == tokenizer.decode(partial, skip_special_tokens=False)


def test_scan_and_heap_agree(monkeypatch):
    own = bpe.Codec(available(VOCABULARY))
    words = [b"tionthere" * 9, b"aaaaaaaaaaaaaaaa", bytes(range(256)), b"x", b"  !!  "]
    scanned = [own._scan([own.byte_id[b] for b in w]) for w in words]
    assert scanned == [own._heap([own.byte_id[b] for b in w]) for w in words]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe.Codec, "room", 10)
    own = bpe.Codec(available(VOCABULARY))
    text = " ".join(f"word{i % 37}" for i in range(500))
    assert own.decode(own.encode(text)) == text
    assert len(own.inner) <= 10 and len(own.inner.old) <= 10


def test_encode_keeps_other_columns(spark):
    df = frame(spark, [(1, "a b", "x", 9), (1, "a b", "x", 9), (None, None, None, None)], "doc_id long, text string, ids string, n_tokens int")
    out = bpe.decode(bpe.encode(df, available(VOCABULARY)), available(VOCABULARY))
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    rows = sorted(out.collect(), key=lambda r: r.n_tokens)
    assert [(r.doc_id, r.n_tokens, r.decoded) for r in rows] == [(None, 0, ""), (1, 2, "a b"), (1, 2, "a b")]
    packed = bpe.decode(bpe.encode(df, available(VOCABULARY), packed=True), available(VOCABULARY))
    assert {r.decoded for r in packed.collect()} == {"", "a b"}


def test_wavelet_matrix():
    ids = np.random.default_rng(5).integers(0, 900, 3000).astype("u4")
    m = token_files.WaveletMatrix.build(ids)
    assert m.ids().tolist() == ids.tolist()
    assert [m.access(i) for i in range(0, 3000, 61)] == ids[::61].tolist()
    for value in (0, 3, 899, 900, 70_000, -1):
        at = np.flatnonzero(ids == np.uint32(value)) if value >= 0 else []
        assert m.count(value) == len(at) and m.rank(value, 1234) == sum(x < 1234 for x in at)
        assert [m.select(value, k) for k in range(len(at))] == list(at)
        assert m.select(value, len(at)) == m.select(value, -1) == -1
    for few in ([], [0], [0, 0], [70_000, 1]):
        m = token_files.WaveletMatrix.build(np.array(few, "u4"))
        assert m.ids().tolist() == few


def test_token_files_answer_from_one_file(spark, tokenizer):
    rows = [(3, "the cat"), (1, "the the"), (2, None), (None, "the"), (3, "a cat")]
    path = scratch(spark, "tokens")
    token_files.write(frame(spark, rows), path, available(VOCABULARY), shard_tokens=3)
    the = tokenizer.encode("the", add_special_tokens=False).ids[0]
    found = token_files.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 3]
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    assert token_files.counts(spark, path, the).agg(F.sum("n")).first()[0] == 3
    places = {(r.doc_id, r.position) for r in token_files.occurrences(spark, path, the).collect()}
    assert places == {(None, 0), (1, 0), (3, 0)}
    empty = scratch(spark, "tokens")
    token_files.write(frame(spark, []), empty, available(VOCABULARY))
    assert token_files.read(spark, empty).count() == 0


def test_personal_spans(spark):
    texts = [
        "", "a@b.co_x@y.zz", "x@y@z.com a@b..c", "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.255", "4111 1111 1111 1111 4111-1111-1111-1112",
        "+1 (578) 555-6437 491818712 +49 30 1234567", "😀 a.b@c.de 😀 +1 202 555 0100😀", "9" * 50, "a@" + "b." * 800 + "c", "x" * 5000 + "@y.z",
    ]
    found = pii.find(numbered(spark, [*texts, None]).withColumn("spans", F.lit(1))).collect()
    for r in found:
        text = [*texts, None][r.doc_id]
        assert [tuple(s) for s in r.base] == brute.personal(text)
    assert pii.find(frame(spark, [])).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    known = [f"Please call my number +1 202 555 01{i:02d} today." for i in range(12)]
    texts = [*known, "Please call my number K55-0199-AZ today.", "It was in the year 2019-20 then."]
    found = {r.doc_id: r for r in pii.find(numbered(spark, [*texts, texts[12]])).collect()}
    token = texts[12].index("K55")
    expected = [("near_phone", token, token + len("K55-0199-AZ"))]
    assert [tuple(s) for s in found[12].spans] == [tuple(s) for s in found[14].spans] == expected
    assert not found[13].spans
    text = numbered(spark, texts).where("doc_id = 12").select("text").first().text
    spans = pii.find(numbered(spark, texts)).where("doc_id = 12").withColumn("text", F.lit(text))
    assert spans.select(pii.redacted(F.col("text"), F.col("spans")).alias("x")).first().x == "Please call my number [near_phone] today."


def test_contexts_are_the_words_before(spark):
    long, far = "x" * 90, [f"w{i}" for i in range(254)]
    for before in ("no 7 code", f"a {long} {long}", "A1-22 B3-44", " ".join([*far, "its code"])):
        texts = [f"see {before} +1 202 555 01{i:02d} now" for i in range(8)] + [f"see {before} X12-34, now"]
        found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(numbered(spark, texts)).collect()}
        at = texts[8].index("X12")
        assert found[8] == [("near_phone", at, at + 6)], before


def test_any_word_is_found_over_any_number_of_rounds(spark):
    mails = [f"{c * 3}.smith@example.org" for c in "abcdefgh"]
    texts = [f"please write to {m} soon" for m in mails] + ["please write to user at host", "she went home"]
    # Each step's pattern has the names of the step before, and two that the next one has too.
    steps = 4
    names = [[f"{chr(97 + k)}{c}login" for c in "qrstuvw"] for k in range(steps)]
    texts += [f"please write to {n}" for n in names[0][:2]]
    for k in range(steps):
        known = mails if k == 0 else names[k - 1]
        texts += [f"and step{chr(97 + k)} of {x}" for x in [*known, *names[k][:2]]]
        texts += [f"then {chr(97 + k)}tep on {x}" for x in [*known, *names[k][2:4]]]
        texts += [f"last {chr(97 + k)}ound by {x}" for x in [*known, *names[k][4:]]]
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(numbered(spark, texts)).collect()}
    assert found[0] == [("email", 16, 16 + len(mails[0]))]
    assert found[8] == [("near_email", 16, 20)] and found[9] == []
    for i, text in enumerate(texts[10:], 10):
        assert len(found[i]) == 1, text


def test_redaction_joins_overlaps(spark):
    row = frame(spark, [(1, "ab 1234567890 cd")]).withColumn(
        "s", F.expr("array(struct('card' AS kind, 3 AS start, 10 AS end), struct('phone' AS kind, 5 AS start, 13 AS end))")
    )
    assert row.select(pii.redacted(F.col("text"), F.col("s")).alias("x")).first().x == "ab [card] cd"


@pytest.mark.parametrize("small", [False, True])
def test_repeats(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(substring, "BLOCK_BYTES", 300)
        monkeypatch.setattr(substring, "SEGMENT_BYTES", 200)
    shared = "one two three four five"
    texts = [f"a b {shared} c", f"{shared} d e", "a a a a a a a a", shared, shared, "", None, "one two", " ".join(map(str, range(300)))]
    rows = [*enumerate(texts), (3, shared), (None, f"q {shared}")]
    df = frame(spark, rows).withColumns({"kept": F.lit(1), "block": F.lit("x")})
    found = substring.remove_repeats(df, window=4).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    assert sorted(map(tuple, found), key=key) == sorted(brute.repeats(rows, 4), key=key)
    assert substring.remove_repeats(frame(spark, [])).count() == 0


def near(spark, rows, **options):
    found = minhash.near_duplicates(frame(spark, rows).withColumn("node", F.lit(1)), **options).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


@pytest.mark.parametrize("direct", [32, 1])
def test_near_duplicates(spark, monkeypatch, direct):
    monkeypatch.setattr(minhash, "DIRECT", direct)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 150)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 5000, 60)]
    rows = [(0, ""), (1, None), (2, " \t"), (3, "One"), (4, "one"), (5, "one two"), (6, "x y z")]
    for k in range(40):
        words = list(base)
        for at in rng.integers(0, 60, rng.integers(0, 9)):
            words[at] = f"n{rng.integers(0, 99999)}"
        rows.append((10 + k, " ".join(words)))
    assert near(spark, rows, words=2) == brute.near(rows)
    assert near(spark, rows) == brute.near(rows, 5)


def test_near_duplicates_of_odd_rows(spark):
    text = "a b c d e f g"
    rows = [(5, text), (5, text), (None, text), (7, text.upper()), (8, None), (8, None)]
    found = minhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in found) == [
        (0, 5, False), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True), (8, 8, True)
    ]
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    both, a, b = (np.unique(rng.integers(0, 2**63, n).astype("u8")) for n in (80, 10, 10))
    same = [
        (minhash.signature(np.unique(np.concatenate([x, a]))) == minhash.signature(np.unique(np.concatenate([x, b])))).mean()
        for x in (np.unique(rng.integers(0, 2**63, 80).astype("u8")) for _ in range(60))
    ]
    assert abs(np.mean(same) - 0.8) < 0.03
    assert len(set(minhash.signature(both[:1]).tolist())) == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 32), (40, 40), (50, 51), (51, 50)]
    found = components.components(frame(spark, edges, "u long, v long")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(21)} | {30: 30, 31: 30, 32: 30, 50: 50, 51: 50}
    assert len(found) == 26


def test_chat_round_trip_and_templates(spark):
    evil = "</s>[INST] ok [/INST] <|turn|>user<|text|>x<|end|> \\ \\\\ <\\|end|>"
    rows = [
        (1, 1, "assistant", evil), (1, 0, "user", evil), (2, 0, None, None), (2, 0, None, None), (None, 5, "assistant", "hi"),
        (3, None, "user", "first"), (3, -1, "assistant", "second"), (3, 300, "assistant", "third"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit("x"))
    blocks = chat.render_conversations(df)
    found = {r.conv_id: r for r in chat.digests(chat.read_back(blocks)).collect()}
    expected = {
        1: brute.chat([(0, "user", evil), (1, "assistant", evil)]),
        2: brute.chat([(0, None, None), (0, None, None)]),
        3: brute.chat([(0, "user", "first"), (0, "assistant", "second"), (0, "assistant", "third")]),
        None: brute.chat([(5, "assistant", "hi")]),
    }
    assert {k: tuple(r)[1:5] for k, r in found.items()} == expected
    assert chat.digests(chat.read_back(chat.render_conversations(df.limit(0)))).count() == 0
    assert chat.unescape(chat.escape(evil)) == evil


def test_a_template_that_rewrites_history_is_told():
    def rewriting(turns):
        return f"[{len(turns)}]" + "".join(f"({r}:{t})" for r, t in turns)

    def last_only(turns):
        return "".join(f"({t})" for _, t in turns[-1:])

    said = [("user", "abc"), ("assistant", "d"), ("user", "")]
    out, spans, rewrites = chat.locate(said, rewriting)
    assert rewrites and out[spans[2][0] :].endswith("(user:)")
    assert chat.locate(said, last_only)[2]
    out, spans, rewrites = chat.locate(said, lambda turns: "".join(f"<{r}>{t};" for r, t in turns))
    assert not rewrites and [out[c:d] for _, _, c, d in spans] == ["abc", "d", ""]
    assert [out[a:b] for a, b, _, _ in spans] == ["<user>abc;", "<assistant>d;", "<user>;"]


def test_order_minhash():
    words = [f"w{i}" for i in range(120)]
    text = " ".join(words)
    own = order_minhash.sketch(text)
    assert (order_minhash.sketch(text) == own).all()
    swapped = order_minhash.sketch(" ".join(words[60:] + words[:60]))
    changed = order_minhash.sketch(" ".join([*words[:118], "x", "y"]))
    assert order_minhash.likeness(own, changed) > order_minhash.likeness(own, swapped) > 0
    assert order_minhash.likeness(own, order_minhash.sketch("other words entirely " * 9)) == 0
    assert order_minhash.occurrences(np.array([7, 3, 7, 7, 3], "u8")).tolist() == [0, 0, 1, 2, 1]
    assert (order_minhash.sketch("") == order_minhash.sketch(" \n")).all()
    assert (order_minhash.sketch("a b") == order_minhash.sketch("a b")).all()


def test_compared_with_next(spark):
    rows = [(k, t) for k, t in enumerate(["abcd efgh", None, "", "x" * 50, "😀😀😀😀 é", *["same text here"] * 3])]
    found = {r.doc_id: r for r in order_minhash.compared_with_next(frame(spark, rows)).collect()}
    assert {k: (r.n_chars, r.edited_sha256) for k, r in found.items()} == brute.edited(rows)
    assert found[5].near_next == 1 and found[5].fingerprint == found[6].fingerprint
    one = order_minhash.compared_with_next(frame(spark, [(4, "abcd")])).first()
    assert one.edited_sha256 == brute.sha("abca") and one.near_next == 1
    assert order_minhash.compared_with_next(frame(spark, [])).count() == 0
    df = order_minhash.fingerprints(frame(spark, rows)).withColumn("other", F.col("fingerprint"))
    assert df.select(order_minhash.likeness_of("fingerprint", "other").alias("x")).distinct().first().x == 1


def test_quality_measures_and_model(spark):
    texts = ["", None, "a b c a b c", "one\ntwo\none\n \n", "#*$%&|<> x", "word " * 60, "A" * 30_000, "x\ty\x0bz"]
    found = {r.doc_id: r for r in quality.features(numbered(spark, texts).withColumn("n_words", F.lit("z"))).collect()}
    for k, text in enumerate(texts):
        r = found[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(text)[:5]
    voted = quality.with_votes(quality.features(frame(spark, [])))
    model = quality.fit(voted)
    assert set(model.accuracies) == {quality.START} and quality.judged(voted, model).count() == 0


def test_accuracies_are_estimated():
    rng = np.random.default_rng(2)
    n_rules = len(quality.rules())
    truth = np.where(rng.random(20_000) < 0.6, 1, -1)
    exact = np.linspace(0.65, 0.95, n_rules)
    votes = np.where(rng.random((20_000, n_rules)) < exact, truth[:, None], -truth[:, None])
    votes = np.where(rng.random(votes.shape) < 0.3, 0, votes)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(patterns.astype("f8"), counts.astype("f8"))
    assert np.abs(np.array(model.accuracies) - exact).max() < 0.05




def test_mixing(spark):
    rows = [(i, "a b c d", "en", "src0") for i in range(60)] + [(100 + i, "a b", "de", "src1") for i in range(10)]
    rows += [(200, None, None, None), (201, "", "en", "src0"), (None, "x", "fr", "src2"), (7, "a b c d", "en", "src0")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("epoch", F.lit("z"))
    total = 61 * 4 + 20 + 1
    out = mixing.choose(df, {"domain": {"web": 1, "books": 1, "?": 0}}, 0.5, 1, 3)
    sums = {r.source: r.n for r in out.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    # books has 20 words of the 66 it should give: web gives the rest, forum (weight 1) all it has.
    assert sums["src1"] == 20 and sums["src2"] == 1
    assert 0 <= total * 500 // 1000 - 21 - sums["src0"] < 4
    again = mixing.choose(df, {"domain": {"web": 1, "books": 1, "?": 0}}, 0.5, 1, 3)
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    everything = mixing.choose(df, {}, 5.0, 2, 3)
    assert everything.count() == 2 * len(rows)
    assert mixing.choose(df.limit(0), {}).count() == 0


def test_mixing_buckets_change_nothing(spark, monkeypatch):
    rows = [(i, "a b " * (i % 5 + 1), "en", "src0") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    whole = sorted(map(str, mixing.choose(df, {}, 0.4, 1, 5).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    assert sorted(map(str, mixing.choose(df, {}, 0.4, 1, 5).collect())) == whole


def test_urls(spark):
    values = [
        None, "", "no scheme", "http://", "https://A.B.ORG/x", "http://x.org", "http://x.org?u=/", "http://example.org/en/12", "http://sub.example.org/es/", "http://notexample.org/es/",
        "ftp://x.com/fr/a://b", "http://x.com/de/#/fr/", "http://x.com:80/fr/", "x://y://z.org/", "\nhttp://a.org/", "http://İ.org/", "http://casino.net/" + "a" * 3000,
    ]
    pages = frame(spark, [*enumerate(values), (1, "")], "page_id long, url string").withColumn("verdict", F.lit("z"))
    model = urls.fit(spark.createDataFrame(urls.seeds(), "url string, block double"))
    for r in urls.judged(pages, model).collect():
        host, path, rule, verdict = brute.url(values[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.p_block >= 0.5 else "allow"))
    nothing = urls.fit(spark.createDataFrame([], "url string, block double"))
    assert nothing is None
    assert {r.verdict for r in urls.judged(pages.limit(1), None).collect()} == {"allow"}
    assert urls.judged(pages.limit(0), model).count() == 0


def test_urls_on_held_out_seeds(spark):
    rows = urls.seeds()
    test, train = rows[::4], [r for i, r in enumerate(rows) if i % 4]
    model = urls.fit(spark.createDataFrame(train, "url string, block double"))
    judged = urls.judged(spark.createDataFrame(test, "url string, block double"), model, rules=()).collect()
    assert sum((r.verdict == "block") == (r.block == 1) for r in judged) >= 0.9 * len(judged)


def test_digests_hold_no_conversation_whole(spark):
    import hashlib

    rows = [(c, t, "assistant" if t % 2 else "user", f"{c} é {t}") for c in (1, None, 2) for t in range(23)]
    blocks = chat.render_conversations(frame(spark, rows, "conv_id long, turn long, role string, text string"), block_turns=4)
    found = chat.digests(chat.read_back(blocks))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in found.collect():
        own = [x for x in rows if x[0] == r.conv_id]
        loss = "".join(x[3] for x in own if x[2] == "assistant")
        said = "".join(f"{x[2]}\n{x[3]}\n" for x in own)
        assert tuple(r)[1:5] == (23, sha(said), len(loss), sha(loss))
    assert found.count() == 3
    read = spark.createDataFrame([], "conv_id long, block long, n_turns long, said string, loss string, formatted_chars long, rewrites boolean")
    assert "collect_list" not in chat.digests(read)._jdf.queryExecution().optimizedPlan().toString()


def test_many_spans_in_one_text(spark):
    """Positions, pieces and the redacted text of thousands of spans, in linear time."""
    import time

    def run(n):
        text = "é " + " ".join(f"x{i} user{i}@ex.org, +49 30 12{i:05d}" for i in range(n))
        df = frame(spark, [(1, text)])
        found = df.select(pii.base_spans(F.col("text")).alias("spans"))
        start = time.perf_counter()
        spans = found.first().spans
        out = df.select(pii.redacted(F.col("text"), pii.base_spans(F.col("text"))).alias("t")).first().t
        took = time.perf_counter() - start
        expected = brute.personal(text)
        assert [(s.kind, s.start, s.end) for s in spans] == expected
        for kind, a, b in sorted(expected, key=lambda s: -s[1]):
            text = f"{text[:a]}[{kind}]{text[b:]}"
        assert out == text
        return took

    run(100)
    assert run(8000) < 8 * max(run(2000), 0.5)


def test_frequent_patterns_are_passed_over_early(spark):
    """A pattern with enough seeds but far more other words goes after a part of the texts."""
    rows = [(i, f"write to user{i}@ex.org now") for i in range(8)]
    rows += [(100 + i, f"write to person{chr(97 + i % 26)}{chr(97 + i // 26)} now") for i in range(600)]
    rows += [(1000 + i, f"account name: q{i}@ex.org") for i in range(6)] + [(2000, "account name: zebra")]
    known = frame(spark, rows).select(F.col("doc_id").alias("row"), "text", pii.base_spans(F.col("text")).alias("base"))
    wanted = frame(spark, [("write to", 8), ("account name:", 6)], "pattern string, n long")
    assert {r.pattern for r in pii._possible(wanted, known).collect()} == {"account name:"}
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(frame(spark, rows)).collect()}
    assert found[2000] == [("near_email", 14, 19)] and found[100] == []


def test_null_ids_are_linked(spark):
    text = [f"w{i}" for i in range(200)]
    near = [*text[:100], "other", *text[101:]]
    for ids in ((1, 2), (None, 2), (2, None)):
        df = frame(spark, [(ids[0], " ".join(text)), (ids[1], " ".join(near)), (9, "far away from all of it")])
        found = minhash.near_duplicates(df).collect()
        assert {r.component_id for r in found} == {min(i for i in ids if i), 9}
        assert sum(r.kept for r in found) == 2


def test_repeated_rows_are_one_node(spark, monkeypatch):
    text = [f"w{i}" for i in range(200)]
    near = [*text[:100], "other", *text[101:]]
    counted = []
    confirmed = minhash._confirmed
    def counting(pairs, sets, percent):
        out = confirmed(pairs, sets, percent)
        counted.append((sets.count(), out.count()))
        return out
    monkeypatch.setattr(minhash, "_confirmed", counting)
    df = frame(spark, [(1, " ".join(text))] * 300 + [(2, " ".join(near))] * 300)
    found = minhash.near_duplicates(df).collect()
    assert len(found) == 600 and {r.component_id for r in found} == {1}
    assert sum(r.kept for r in found) == 300
    assert all(sets == 2 and links <= 2 for sets, links in counted)


def test_rows_of_one_turn_are_cut_into_blocks(spark):
    """Blocks are counted by rows: many rows of one turn cost what as many turns cost."""
    import time

    ddl = "conv_id long, turn long, role string, text string"

    def run(n):
        rows = [(None, i % 4, "user" if i % 3 else "assistant", f"text {i % 50}") for i in range(n)]
        blocks = chat.render_conversations(frame(spark, rows, ddl))
        assert max(len(r.spans) for r in blocks.select("spans").collect()) <= chat.BLOCK_TURNS
        start = time.perf_counter()
        found = chat.digests(chat.read_back(blocks)).collect()
        assert [(r.conv_id, r.n_turns, r.rewrites) for r in found] == [(None, n, False)]
        return time.perf_counter() - start

    run(500)
    assert run(8000) < 8 * max(run(2000), 0.5)


def test_templates_that_look_back_are_found_at_block_borders(spark):
    def numbered_turns(turns):
        return "".join(f"<{i}:{role}>{text}" for i, (role, text) in enumerate(turns))

    numbered_turns.lookback = 0
    rows = [(1, t, "user", f"text {t}") for t in range(10)]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string").coalesce(1)
    found = chat.render_conversations(df, numbered_turns, block_turns=4).collect()
    assert len(found) > 1 and any(r.rewrites for r in found)
    assert not any(r.rewrites for r in chat.render_conversations(df, block_turns=4).collect())


def test_short_texts_have_a_likeness():
    """A short text is more like its edited self than like another one."""
    rng = np.random.default_rng(8)
    near, far = [], []
    for n in range(4, 40):
        for _ in range(6):
            a, b = (" ".join(f"w{i}" for i in rng.integers(0, 5000, n)) for _ in range(2))
            one, changed, other = (order_minhash.sketch(x) for x in (a, order_minhash.edited(a, b), b))
            near.append(order_minhash.likeness(one, changed))
            far.append(order_minhash.likeness(one, other))
    assert np.mean(np.array(near) > np.array(far)) > 0.95 and max(far) < 0.2
    assert order_minhash.likeness(order_minhash.sketch("a b c"), order_minhash.sketch("a b c")) == 1


@pytest.mark.parametrize("n", [0, 1, 5, 511, 512, 5000])
def test_cells_are_packed_and_read(n):
    rng = np.random.default_rng(n)
    cells = np.unique(rng.integers(0, 1 << substring.CELL_BITS, n).astype("u4"))
    twice = rng.random(len(cells)) < 0.5
    packed = substring._pack_cells(cells, twice)
    back, flags = substring._unpack_cells(packed)
    assert back.tolist() == cells.tolist() and flags.tolist() == twice.tolist()
    assert len(packed) <= 4 + 4 * len(cells) + len(cells) // 8 + 1


def test_equal_rows_are_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 20_000)
    text = " ".join(f"w{i}" for i in range(60))
    df = frame(spark, [(None, text)] * 800 + [(1, "a b c")])
    found = substring.remove_repeats(df).collect()
    assert sorted((r.n_words, r.n_removed) for r in found) == [(3, 0), *[(60, 60)] * 800]
