"""Quality by weak supervision: rules vote good or bad or abstain, and expectation-maximisation
finds how far each rule can be trusted.

The votes of all documents are counted by pattern (at most 3 to the number of rules patterns,
whatever the corpus); the counts are all that the estimate needs. Each rule has one accuracy:
the chance that it is right when it votes. Rules are taken as independent given the class.
Accuracies start at ``START`` and carry the weight of ``PRIOR`` imagined votes at that value, and
stay above one half, so that classes can't change places, even in a corpus of one class only.

Cases: a null text is empty and has no words; an empty table gives an empty table and leaves
accuracies at their start; columns named like the new ones are replaced; every row is judged
by itself, so repeated rows get one verdict.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import append_arrow, hashes_of, run_hashes

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50

START, PRIOR, SURE = 0.85, 200.0, 0.99
#: Share of good documents before any vote. It is given, not estimated: rules that never vote
#: on the same document leave it undetermined, and it would drift to the larger class.
GOOD = 0.5
ROUNDS, SETTLED = 200, 1e-9
FEATURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_lines bigint, n_distinct_words bigint, n_upper bigint, "
    "n_lower bigint, n_shouts bigint, n_stops bigint"
)
COLUMNS = [x.split()[0] for x in FEATURES.split(", ")]
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER, _LOWER = range(65, 91), range(97, 123)


def measures(text: str) -> tuple[int, ...]:
    """The columns of ``FEATURES`` of one whole text."""
    raw = text.encode()
    words = raw.split()
    of = np.bincount(np.frombuffer(raw, "u1"), minlength=256)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    hashes = hashes_of(words)
    repeated = 0
    if len(words) >= 4:
        _, at, count = np.unique(run_hashes(hashes, 3), return_inverse=True, return_counts=True)
        found = count[at] > 1
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[k : k + len(found)] |= found
        repeated = int(covered.sum())
    total = lambda letters: int(of[list(letters)].sum())
    return (
        len(words),
        len(text) - total(_SPACE),
        total(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(np.unique(hashes)),
        total(_UPPER),
        total(_LOWER),
        total(b"!?"),
        total(b".,;:"),
    )


def features(df: DataFrame, text: str = "text") -> DataFrame:
    def of(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [measures(x or "") for x in batch.column(text).to_pylist()]
        return [pa.array(c, pa.int64()) for c in zip(*rows)]

    return append_arrow(df, of, FEATURES)


def _share(part: Column, whole: str) -> Column:
    return part / F.greatest(F.col(whole), F.lit(1))


def base_failed() -> Column:
    many = 100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | many


def rules() -> dict[str, Column]:
    """-1 bad, 1 good, 0 abstains.

    Most rules know one defect and abstain where they don't see it: that a text isn't in
    capitals says little for it. Only rules that look at several sides at once vote good.
    """
    c = F.col
    length = _share(c("word_chars"), "n_words")
    repeats, shouts = _share(c("n_repeat_words"), "n_words"), _share(c("n_shouts"), "n_words")
    lines, symbols = _share(c("n_dup_lines"), "n_lines"), _share(c("n_symbols"), "n_words")
    capitals = c("n_upper") / F.greatest(c("n_upper") + c("n_lower"), F.lit(1))
    stops, distinct = _share(c("n_stops"), "n_words"), _share(c("n_distinct_words"), "n_words")
    even = (symbols < 0.03) & (shouts < 0.1) & (capitals < 0.3) & (repeats < 0.2)
    bad = lambda defect: F.when(defect, -1).otherwise(0)
    good = lambda merit: F.when(merit, 1).otherwise(0)
    return {
        "few_words": bad(c("n_words") < MIN_WORDS),
        "word_length": bad((length < 2.5) | (length > 14)),
        "repeats": bad(repeats > 0.35),
        "lines": bad(lines > 0.35),
        "symbols": bad(symbols > 0.1),
        "shouts": bad(shouts > 0.2),
        "capitals": bad(capitals > 0.6),
        "no_stops": bad((stops < 0.005) & (c("n_words") >= 2 * MIN_WORDS)),
        "prose": good(even & (stops > 0.02) & (stops < 0.5)),
        "varied": good(even & (distinct > 0.2) & (lines < 0.2)),
    }


def with_votes(df: DataFrame) -> DataFrame:
    """``df`` with base_failed and ``votes``, one of -1, 0, 1 for each rule in order."""
    votes = F.array(*(v.cast("int") for v in rules().values()))
    return df.withColumns({"base_failed": base_failed(), "votes": votes})


@dataclass(frozen=True)
class Model:
    accuracies: tuple[float, ...]
    good: float

    def posterior(self) -> Column:
        """Chance that a document is good, from its ``votes``."""
        odds = [math.log(a / (1 - a)) for a in self.accuracies]
        terms = [F.get("votes", F.lit(i)) * F.lit(w) for i, w in enumerate(odds)]
        total = sum(terms, F.lit(math.log(self.good / (1 - self.good))))
        return 1 / (1 + F.exp(-total))


def estimate(votes: np.ndarray, counts: np.ndarray) -> Model:
    """Expectation-maximisation over counted vote patterns (rows of -1, 0, 1)."""
    accuracy = np.full(votes.shape[1], START)
    voted = (votes != 0) * counts[:, None]
    for _ in range(ROUNDS if len(votes) else 0):
        odds = np.log(GOOD / (1 - GOOD)) + votes @ np.log(accuracy / (1 - accuracy))
        p = 1 / (1 + np.exp(-odds))
        right = np.where(votes > 0, p[:, None], np.where(votes < 0, 1 - p[:, None], 0))
        new = ((right * counts[:, None]).sum(0) + PRIOR * START) / (voted.sum(0) + PRIOR)
        new = np.clip(new, 0.55, SURE)
        moved, accuracy = np.abs(new - accuracy).max(), new
        if moved < SETTLED:
            break
    return Model(tuple(map(float, accuracy)), GOOD)


def fit(voted: DataFrame) -> Model:
    """Estimated from the votes of all rows; the driver sees one row per vote pattern."""
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    votes = np.array([r.votes for r in patterns], "f8").reshape(len(patterns), len(rules()))
    return estimate(votes, np.array([r.n for r in patterns], "f8"))


def judged(voted: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``voted`` with ``p_good`` and ``kept``."""
    df = voted.withColumn("p_good", model.posterior())
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
