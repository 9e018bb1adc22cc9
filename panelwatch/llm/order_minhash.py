"""Document fingerprints by order min-hash.

The words of a text give k-mers of ``WORDS`` words, each numbered by its occurrence, so that a
repeated k-mer is several elements. For each of ``SKETCHES`` orders the ``KEPT`` smallest elements
are taken, put back in text order and hashed as a tuple. Two texts agree on a sketch if they
share the smallest elements and hold them in the same order, so that the share of equal
sketches falls with the edit distance and not only with the shared vocabulary. Of texts under
``SHORT_WORDS`` words single words are elements as well, as an edit touches most of their k-mers.

Cases: a null text is empty; a text without words has one fixed fingerprint; fewer words than
a k-mer are one k-mer; equal texts have equal fingerprints, whatever their rows; columns named
like the new ones are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.llm.common import append_arrow, arrow_type, hashes_of, map_arrow, mixed, run_hashes, sliced, stored

WORDS, SKETCHES, KEPT = 5, 32, 2
#: Shorter texts have few k-mers that an edit leaves alone; their words are elements too.
SHORT_WORDS = 32
CELLS = 1 << 20
_FACTORS = mixed(np.arange(SKETCHES, dtype="u8"), 7) | np.uint64(1)
_PLACES = mixed(np.arange(KEPT, dtype="u8"), 11) | np.uint64(1)


def occurrences(keys: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for the first, second, third place of each key."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    first = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
    out = np.empty(len(keys), "u8")
    out[order] = np.arange(len(keys)) - start
    return out


def sketch(text: str) -> np.ndarray:
    """``SKETCHES`` unsigned 32-bit values."""
    words = hashes_of(text.encode().split())
    kmers = run_hashes(words, min(WORDS, len(words)) or 1)
    if not len(kmers):
        return np.zeros(SKETCHES, "u4")
    if len(words) < SHORT_WORDS:
        # Single words beside the k-mers, each before the k-mer that begins with it.
        order = np.argsort(np.concatenate([2 * np.arange(len(words)), 2 * np.arange(len(kmers)) + 1]), kind="stable")
        kmers = np.concatenate([mixed(words, 5), kmers])[order]
    with np.errstate(over="ignore"):
        elements = mixed(kmers ^ mixed(occurrences(kmers)))
        kept, rows = min(KEPT, len(elements)), max(1, CELLS // len(elements))
        out = []
        for factors in (_FACTORS[i : i + rows] for i in range(0, SKETCHES, rows)):
            order = elements[None, :] * factors[:, None]
            if len(elements) > kept:
                at = np.sort(np.argpartition(order, kept - 1, axis=1)[:, :kept], axis=1)
            else:
                at = np.broadcast_to(np.arange(kept), (len(factors), kept))
            tuples = (elements[at] * _PLACES[None, :kept]).sum(axis=1, dtype="u8")
            out.append(mixed(tuples ^ factors) >> np.uint64(32))
    return np.concatenate(out).astype("u4")


def fingerprint(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal sketches, 0 to 1."""
    return float((a == b).mean())


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``fingerprint``: eight hexadecimal digits for each sketch."""
    of = lambda batch: [pa.array([fingerprint(sketch(x or "")) for x in batch.column(text).to_pylist()], pa.string())]
    return append_arrow(df, of, "fingerprint string")


def likeness_of(a: str, b: str) -> F.Column:
    """Share of equal sketches of two fingerprint columns, without Python."""
    same = F.filter(
        F.sequence(F.lit(0), F.lit(SKETCHES - 1)),
        lambda i: F.substr(a, i * 8 + 1, F.lit(8)) == F.substr(b, i * 8 + 1, F.lit(8)),
    )
    return F.size(same) / F.lit(float(SKETCHES))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points gives way to the first as many of another text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
#: Rows of the ends of a writer's range of documents also carry the text.
ENDS = f"{RESULT}, writer int, place string, text string"


def _result(doc_id: int | None, text: str, own: np.ndarray, following: str, next_own: np.ndarray) -> dict:
    changed = edited(text, following)
    values = sketch(changed)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
        "fingerprint": fingerprint(own),
        "edited_fingerprint": fingerprint(values),
        "near_edited": likeness(own, values),
        "near_next": likeness(own, next_own),
    }


def compared_with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside its edited text and the next document, in ascending order of ``key``.

    The texts are dealt out by ranges of the key and sorted, so that the next text is the next
    row. Only the last document of a range needs the first of the next range: these two rows of
    each task carry their texts to a second, small step. After the last document comes the first.
    """
    types, ends = arrow_type(RESULT), arrow_type(ENDS)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer, held = TaskContext.get().partitionId(), None
        for batch in sliced(batches):
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now = (doc_id, value or "", sketch(value or ""))
                if held is None:
                    rows.append({"doc_id": doc_id, "writer": writer, "place": "first", "text": now[1]})
                else:
                    rows.append(_result(*held, *now[1:]))
                held = now
            yield pa.RecordBatch.from_pylist(rows, schema=ends)
        if held:
            last = {"doc_id": held[0], "writer": writer, "place": "last", "text": held[1]}
            yield pa.RecordBatch.from_pylist([last], schema=ends)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                _result(r["doc_id"], r["text"], sketch(r["text"]), r["following"], sketch(r["following"]))
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=types)

    # Rows of one id are in the order of a hash of their texts and are split between tasks like others.
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    ordered = rows.repartitionByRange("key", "hash").sortWithinPartitions("key", "hash", "text")
    walked = stored(map_arrow(ordered, walk, ENDS), "order-minhash")
    edge = walked.where(F.col("place").isNotNull()).select("doc_id", "writer", "place", "text")
    firsts = edge.where("place = 'first'").select("writer", F.col("text").alias("following"))
    # Two rows for each task, whatever the corpus: ranges are numbered in one window.
    number = F.row_number().over(Window.orderBy("writer")) - 1
    lasts = edge.where("place = 'last'").withColumn("n", number)
    total = firsts.agg(F.count(F.lit(1))).scalar()
    heads = firsts.withColumn("n", F.pmod(F.row_number().over(Window.orderBy("writer")) - 2, total))
    pairs = lasts.join(heads, "n").select("doc_id", lasts.text, "following")
    closed = map_arrow(pairs, close, RESULT)
    names = [f.name for f in types]
    return walked.where(F.col("place").isNull()).select(*names).unionByName(closed)
