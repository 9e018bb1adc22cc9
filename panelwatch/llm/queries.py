"""One query per corpus operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm import bpe, chat, conversation_repair, line_dedup, minhash, mixing, order_minhash, periodic, pii, quality, substring, token_files, urls
from panelwatch.llm.common import available, digest, documents, scratch, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", "text")


@query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = available(VOCABULARY)
    encoded = bpe.encode(texts(spark, folder), vocabulary, packed=True).drop("text")
    return bpe.decode(encoded, vocabulary).select(
        "doc_id",
        "n_tokens",
        digest("ids").alias("ids_sha256"),
        digest("decoded").alias("decoded_sha256"),
    )


@query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write(texts(spark, folder), path, available(VOCABULARY), end_id=0)
    found = token_files.read(spark, path)
    # Spark's own crc32 of the bytes is that of zlib.
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = documents(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.read_back(chat.render_conversations(rows.unionByName(extra))))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    measured = stored(quality.features(texts(spark, folder)).drop("text"), "quality")
    voted = quality.with_votes(measured)
    return quality.judged(voted, quality.fit(voted)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "p_good",
    )


@query
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.compared_with_next(texts(spark, folder))


@query
def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = documents(spark, folder, "pages").select("page_id", "url")
    model = urls.fit(spark.createDataFrame(urls.seeds(), "url string, block double"))
    return urls.judged(pages, model).select("page_id", "host", "path", "rule", "verdict", "p_block")


@query
def op3_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.remove_repeats(texts(spark, folder))
    return found.select("doc_id", "n_words", "n_removed", digest("kept").alias("kept_sha256"))


@query
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(texts(spark, folder), words=2).drop("text_hash")


@query
def op2_personal(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(texts(spark, folder))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *(count(k.name).alias(f"n_{k.name}") for k in pii.KINDS),
        digest(pii.listed(F.col("base"))).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.report_with_digest(conversation_repair.damaged(rows), rows)


@query
def op12_lines(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.drop_shared_lines(texts(spark, folder))
    return found.select("doc_id", "n_lines", "n_dropped", digest("kept").alias("kept_sha256"))


@query
def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.with_runs(periodic.with_planted_runs(texts(spark, folder)))
    best = periodic.longest(F.col("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *(best[name].alias(name) for name in ("start", "length", "period")),
        F.expr("1000 * length div period").alias("exponent_milli"),
        digest(periodic.listed(F.col("runs"))).alias("runs_sha256"),
        digest("collapsed").alias("collapsed_sha256"),
    )


#: Production weights of the mix.
MIX = {
    "domain": {"web": 5, "books": 3, "forum": 1},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 3},
    "source": {"src0": 2, "src1": 3},
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.7, 2, 17


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang", "source")
    return mixing.choose(docs, MIX, MIX_SHARE, MIX_EPOCHS, MIX_SEED).drop("text_hash")


ORACLES["op7_mixing"] = mixing.oracle(MIX, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
