"""Mixing sources to target weights by hierarchical budgets.

Documents hang on leaves of a tree of domain, language and source. A token budget runs down the
tree: at every node it is shared among the children by their weights, and no child gets more than
its subtree can give (its tokens times ``epochs``). What a child can't use goes to its siblings by
their weights; only what all siblings together can't use is missing at their parent, where it was
already shared among the parent's siblings. The shares are those of water-filling: children are
taken by capacity per weight, and all that come before the first that isn't full are full. Shares
are whole tokens, rounded down (less than one token a child is left over).

A leaf takes whole epochs of its documents, and of the next epoch the longest prefix that fits,
in an order of its own for every epoch: by md5 of seed, epoch and id. A leaf's running sums are
made in buckets of that order, with about ``BUCKET_ROWS`` rows each, so that a leaf with a third
of all rows is summed by many tasks. DataFrame functions only.

Cases: null domain, language and source are the name ``?``; null and empty texts have no
tokens and come with any prefix; children not named in the weights have weight 1, and weight 0
takes nothing; repeated rows are documents of their own, and rows with one id are ordered by tokens
and text; a budget beyond all epochs takes everything; other columns are left out; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.llm.common import WORD, stored

LEVELS = ("domain", "lang", "source")
BUCKET_ROWS = 20_000
Weights = Mapping[str, Mapping[str, int]]


def domain_of_source() -> Column:
    """The domain of these tables: the number at the end of the source, by threes."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int") % 3
    return F.when(number == 0, "web").when(number == 1, "books").when(number == 2, "forum")


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _weight(level: str, weights: Weights) -> Column:
    weight = F.lit(1)
    for name, value in sorted(weights.get(level, {}).items()):
        weight = F.when(F.col(level) == name, value).otherwise(weight)
    return weight.cast("bigint")


def share_out(nodes: DataFrame, level: int, weights: Weights) -> DataFrame:
    """``nodes`` (columns of ``LEVELS`` up to ``level``, capacity, given: the parent's budget) with
    budget, their own."""
    parent, name = list(LEVELS[:level]), LEVELS[level]
    rows = nodes.withColumn("w", _weight(name, weights)).where("w > 0")
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("w"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "rest": F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0)),
            "w_rest": F.sum("w").over(after),
        }
    )
    open_ = F.col("capacity") * F.col("w_rest") > F.col("rest") * F.col("w")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.min_by(
        F.when(open_, F.struct("rest", "w_rest")), F.when(open_, F.struct(F.col("capacity") / F.col("w"), name))
    ).over(so_far)
    rows = rows.withColumn("opened", opened)
    part = F.expr("(opened.rest * w) div opened.w_rest")
    budget = F.when(F.col("opened").isNull(), F.col("capacity")).otherwise(F.least(part, "capacity"))
    return rows.withColumn("budget", budget).drop("w", "rest", "w_rest", "opened")


def budgets(leaves: DataFrame, weights: Weights, budget: Column, epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens, n_docs) with the budget of each leaf."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)
    given = leaves.agg(budget.cast("bigint").alias("given"))
    nodes = None
    for level in range(len(LEVELS)):
        names = list(LEVELS[: level + 1])
        own = leaves.groupBy(*names).agg(F.sum("capacity").alias("capacity"))
        if nodes is None:
            own = own.withColumn("given", given.scalar())
        else:
            own = own.join(nodes.select(*names[:-1], F.col("budget").alias("given")), names[:-1])
        nodes = share_out(own, level, weights)
    return leaves.join(nodes.select(*LEVELS, "budget"), list(LEVELS))


def choose(
    df: DataFrame,
    weights: Weights,
    share: float = 0.5,
    epochs: int = 1,
    seed: int = 0,
    domain: Column | None = None,
    tokens: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, text_hash, domain, lang, source, n_tokens, epoch: a row for each time a document is
    taken. The budget is ``share`` of all tokens, in whole thousandths."""
    name = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    docs = stored(
        df.select(
            F.col(key).cast("bigint").alias("doc_id"),
            F.xxhash64(text).alias("text_hash"),
            name(domain_of_source() if domain is None else domain).alias("domain"),
            name(F.col("lang")).alias("lang"),
            name(F.col("source")).alias("source"),
            (word_count(text) if tokens is None else tokens).alias("n_tokens"),
        ),
        "mixing",
    )
    leaves = docs.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
    budget = F.expr(f"sum(tokens) * {round(share * 1000)} div 1000")
    plan = budgets(leaves, weights, budget, epochs)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(epochs)
    plan = stored(
        plan.withColumn("whole", whole).select(
            *LEVELS,
            "whole",
            (F.col("budget") - F.col("whole") * F.col("tokens")).alias("part"),
            (1 + F.expr(f"n_docs div {BUCKET_ROWS}")).alias("n_buckets"),
        ),
        "budgets",
    )
    place = F.md5(F.concat_ws(":", F.lit(seed), "whole", "doc_id"))
    cut = F.conv(F.substring("place", 1, 7), 16, 10).cast("bigint") * F.col("n_buckets")
    rows = docs.join(plan, list(LEVELS)).withColumn("place", place)
    rows = rows.withColumn("bucket", F.shiftright(cut, 28))
    sums = rows.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*LEVELS, "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    order = Window.partitionBy(*LEVELS, "bucket").orderBy("place", "doc_id", "n_tokens", "text_hash")
    running = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = rows.withColumn("running", running).join(offsets, [*LEVELS, "bucket"])
    last = F.when(F.col("offset") + F.col("running") <= F.col("part"), 1).otherwise(0)
    copies = F.least(F.col("whole") + last, F.lit(epochs)).cast("int")
    return (
        taken.withColumn("copies", copies)
        .where("copies > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .select("doc_id", "text_hash", *LEVELS, "n_tokens", "epoch")
    )


def oracle(weights: Weights, share: float, epochs: int, seed: int) -> str:
    """The same choice in SQL, for ``domain_of_source`` and ``word_count``."""

    def weight(level: str) -> str:
        cases = " ".join(f"WHEN {level} = '{n}' THEN {v}" for n, v in sorted(weights.get(level, {}).items()))
        return f"CAST(CASE {cases} ELSE 1 END AS BIGINT)" if cases else "CAST(1 AS BIGINT)"

    steps, given = [], f"(SELECT CAST(sum(tokens) * {round(share * 1000)} AS BIGINT) // 1000 FROM leaves)"
    for i, level in enumerate(LEVELS):
        names, parent = ", ".join(LEVELS[: i + 1]), ", ".join(LEVELS[:i])
        over = f"PARTITION BY {parent} " if parent else ""
        source = f"SELECT {names}, sum(tokens * {epochs})::BIGINT AS capacity FROM leaves GROUP BY {names}"
        joined = f"SELECT o.*, b{i - 1}.budget AS given FROM ({source}) o JOIN b{i - 1} USING ({parent})" if i else (
            f"SELECT o.*, {given} AS given FROM ({source}) o"
        )
        steps.append(f"""n{i} AS (SELECT *, {weight(level)} AS w FROM ({joined}) x),
r{i} AS (SELECT *, given - coalesce(sum(capacity) OVER (f{i} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
  (sum(w) OVER (f{i} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS w_rest
  FROM n{i} WHERE w > 0 WINDOW f{i} AS ({over}ORDER BY capacity / w, {level})),
o{i} AS (SELECT *, first_value(CASE WHEN capacity * w_rest > rest * w THEN rest END IGNORE NULLS) OVER g{i} AS o_rest,
  first_value(CASE WHEN capacity * w_rest > rest * w THEN w_rest END IGNORE NULLS) OVER g{i} AS o_w
  FROM r{i} WINDOW g{i} AS ({over}ORDER BY capacity / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b{i} AS (SELECT {names}, CASE WHEN o_rest IS NULL THEN capacity ELSE least((o_rest * w) // o_w, capacity) END AS budget FROM o{i})""")
    tree = ",\n".join(steps)
    return f"""WITH docs AS (SELECT doc_id, coalesce(CASE TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 3
  WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'forum' END, '?') AS domain, coalesce(lang, '?') AS lang,
  coalesce(source, '?') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY domain, lang, source),
{tree},
plan AS (SELECT *, budget - whole * tokens AS part FROM (SELECT domain, lang, source, tokens, budget,
  CASE WHEN tokens > 0 THEN budget // tokens ELSE {epochs} END AS whole FROM leaves JOIN b2 USING (domain, lang, source)) p),
taken AS (SELECT doc_id, domain, lang, source, n_tokens, least(whole + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lang, source
  ORDER BY md5(concat_ws(':', {seed}, whole, doc_id)), doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= part
  THEN 1 ELSE 0 END, {epochs}) AS copies FROM docs JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, CAST(unnest(range(copies::BIGINT)) AS INT) AS epoch FROM taken WHERE copies > 0"""
