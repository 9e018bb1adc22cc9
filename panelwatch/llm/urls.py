"""URL filters: path rules, and a logistic regression on hashed character n-grams beyond them.

Host and path are cut from the url by one pattern. A rule fits its host and all subdomains if
the path starts with the rule's; the longest fitting rule decides. Where none fits, the
probability of a regression on hashed n-grams of host and path decides. The regression is fitted
on a small labelled table of urls (the caller's, or ``seeds``; one partition, so that a fit can be
repeated to the bit: some hundred thousand urls at most); scoring is one pass over the pages. DataFrame functions and Spark ML only.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged
by the intercept; an empty labelled table allows everything without a rule; repeated urls are
judged alike; columns named like the new ones are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


#: The rules to judge by.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Fixed value: host and path of a url.
PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
SIZES = (3, 4)
BUCKETS = 1 << 12
#: Words of the hosts of the default labelled table, general ones of either kind.
BAD_WORDS = (
    "adserver adclick adbanner banner-ad popup-ad popunder trackers clicktracking tracking-pixel affiliate-offers "
    "gambling slotmachine jackpot roulette blackjack poker sportsbet betting bet-now onlinebets lucky-spins casinos "
    "porn xxx-video sexcams nude-chat escorts adults-only adultvideo hookup viagra pharmacy-discount "
    "diet-pill pillstore payday-loans instant-loan win-prize warez crackz keygen torrentz spam-offers"
).split()
GOOD_WORDS = (
    "library museum school university research science journal news daily-post weather garden "
    "history music theatre travel cooking recipes sports health hospital physics chemistry "
    "mathematics language dictionary encyclopedia archive maps railway city-hall gallery books "
    "publisher software compiler database astronomy biology geology economics forum blog shop site "
    "community studio market village reader writer photo video games radio club "
    "nation station education information action section question position tradition collection "
    "thing nothing something thinking other another mother brother together weather-report whether "
    "north south earth health-care truth youth faith thread thanks author method theory theme thesis "
    "health-center that-place there then they thirty thousand throne thunder "
    "morning evening building meeting reading writing learning engineering training "
    "family friendly daily early weekly monthly table cable noble able possible visible "
    "river winter summer letter paper number order water center interest street forest "
    "island ireland england finland land hand stand garden-house home house horse shed shelter"
).split()
FORMS = (("", "example.com"), ("www.", "example.net"), ("blog.", "example.org"), ("m.", "example.com"))
LANGUAGES = ("en", "de", "fr", "es")
_ADDED = ("host", "path", "rule", "verdict", "p_block")


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    part = lambda i: F.coalesce(F.regexp_extract(url, PARTS, i), F.lit(""))
    host = F.translate(part(1), ascii_uppercase, ascii_lowercase)
    return df.drop(*_ADDED).withColumns({"host": host, "path": part(2)})


def fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
    return host & F.col("path").startswith(rule.path)


def with_rule(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` (with host and path) and the longest fitting rule, its verdict; null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(str(r))):
        rule = F.when(fits(r), str(r)).otherwise(rule)
        verdict = F.when(fits(r), r.verdict).otherwise(verdict)
    return df.withColumns({"rule": rule, "verdict": verdict})


def grams(name: str, size: int) -> Column:
    """Character n-grams of a column between its ends, marked with the column they come from."""
    text = F.concat(F.lit("^"), F.col(name), F.lit("$"))
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - (size - 1), F.lit(1)))
    return F.transform(at, lambda i: F.concat(F.lit(name[0] + ":"), F.substr(text, i, F.lit(size))))


def with_grams(df: DataFrame) -> DataFrame:
    parts = [grams(name, size) for name in ("host", "path") for size in SIZES]
    tf = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="_grams", outputCol="_features")
    return tf.transform(df.withColumn("_grams", F.concat(*parts)))


def seeds() -> list[tuple[str, float]]:
    """The default labelled table: url and block (0 or 1), made by rule from two word lists."""
    rows = []
    for label, words in ((1.0, BAD_WORDS), (0.0, GOOD_WORDS)):
        for i, word in enumerate(words):
            for k, (lead, tail) in enumerate(FORMS):
                language = LANGUAGES[(i + k) % len(LANGUAGES)]
                rows.append((f"https://{lead}{word}.{tail}/{language}/{1000 + 37 * i + k}", label))
    return rows


def fit(labelled: DataFrame) -> LogisticRegressionModel | None:
    """Regression on a small table of url and block (0 or 1); None if it is empty."""
    rows = with_parts(labelled.where("block IS NOT NULL")).coalesce(1).sortWithinPartitions("url")
    sizes = {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}
    if not sizes:
        return None
    # Both labels weigh the same, however many urls the table has of either.
    weight = F.lit(1.0)
    for label, n in sorted(sizes.items()):
        weight = F.when(F.col("block") == label, 1.0 / n).otherwise(weight)
    regression = LogisticRegression(
        featuresCol="_features", labelCol="block", weightCol="_weight", maxIter=60, regParam=0.01, standardization=False
    )
    return regression.fit(with_grams(rows).withColumn("_weight", weight).select("_features", "block", "_weight"))


def judged(
    pages: DataFrame,
    model: LogisticRegressionModel | None,
    rules: tuple[Rule, ...] = RULES,
    least: float = 0.5,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and p_block, the regression's probability."""
    ruled = with_rule(with_parts(pages), rules)
    if model is None:
        scored = ruled.withColumn("p_block", F.lit(0.0))
    else:
        from pyspark.ml.functions import vector_to_array

        out = model.transform(with_grams(ruled)).withColumn("p_block", F.get(vector_to_array("probability"), F.lit(1)))
        scored = out.drop("_grams", "_features", "rawPrediction", "probability", "prediction")
    guess = F.when(F.col("p_block") >= least, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("verdict", guess))
