"""The corpus pipeline: documents in, encoded training rows out.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again as
the next stage's documents. All but the last return the columns of their input. Rows are matched
with decisions on them by id and text, so that repeated ids do no harm; rows that agree in both
are one document from the second stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm import bpe, minhash, mixing, pii, quality
from panelwatch.llm.common import available, stored
from panelwatch.llm.queries import MIX, MIX_SEED, MIX_SHARE, VOCABULARY

HASH = "text_hash__"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose votes say bad, go."""
    packed = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    voted = quality.with_votes(quality.features(packed))
    model = quality.fit(voted)
    return quality.judged(voted, model).where("kept").select("doc.*")


def _matched(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """``docs``, one row for each id and text, joined with decisions on doc_id and text_hash."""
    rows = docs.withColumn(HASH, F.xxhash64("text"))
    on = rows["doc_id"].eqNullSafe(decisions["decided_id"]) & (rows[HASH] == decisions["decided_hash"])
    return rows.join(decisions, on, how)


def _decided(found: DataFrame, *columns: str) -> DataFrame:
    return found.select(
        F.col("doc_id").alias("decided_id"), F.col("text_hash").alias("decided_hash"), *columns
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    kept = _decided(minhash.near_duplicates(docs).where("kept")).distinct()
    return _matched(docs, kept, "left_semi").dropDuplicates(["doc_id", HASH]).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind in brackets."""
    found = pii.find(docs).where(F.size("spans") > 0)
    spans = _decided(found, F.col("spans").alias("spans__")).dropDuplicates(["decided_id", "decided_hash"])
    text = F.when(F.col("spans__").isNull(), F.col("text")).otherwise(pii.redacted(F.col("text"), F.col("spans__")))
    out = _matched(docs, spans, "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = F.col("spans__").isNotNull()
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the target weights, each once at most."""
    chosen = mixing.choose(docs, MIX, MIX_SHARE, epochs=1, seed=MIX_SEED)
    takes = chosen.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).cast("int").alias("takes__"))
    rows = _matched(docs, _decided(takes, "takes__"), "inner").dropDuplicates(["doc_id", HASH])
    return rows.withColumn("take__", F.explode(F.sequence(F.lit(1), "takes__"))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    return bpe.encode(docs, available(VOCABULARY))


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]
#: The stages' models and tokenizer can't be said in SQL; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
