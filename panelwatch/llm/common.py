"""What the corpus operators share: tables, Arrow steps, scratch tables, word hashes."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from panelwatch.session import scratch_folder as scratch

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
KNOWN_WORDS = 400_000


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@cache
def _ship(application: str) -> None:
    """Sends the package's sources to the workers, as ``--py-files`` would.

    The archive is made on the driver, and Spark's file server hands it to every executor.
    """
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="panelwatch-py-")) / "panelwatch_py.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(Path(root.name) / file.relative_to(root)))
    SparkSession.active().sparkContext.addPyFile(str(target))


def map_arrow(
    df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    _ship(df.sparkSession.sparkContext.applicationId)
    return df.mapInArrow(step, schema)


def arrow_type(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(_parse_datatype_string(ddl))


def sliced(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes, so that long texts don't add up."""
    for batch in batches:
        if batch.num_rows:
            rows = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows)


def append_arrow(
    df: DataFrame, columns_of: Callable[[pa.RecordBatch], list[pa.Array]], ddl: str, limit: int = 8 << 20
) -> DataFrame:
    """``df`` with the columns that ``columns_of`` makes of each batch; same names are replaced."""
    added = _parse_datatype_string(ddl)
    kept = [f for f in df.schema.fields if f.name.lower() not in {a.name.lower() for a in added}]
    schema = StructType([*kept, *added.fields])
    names, source = [f.name for f in kept], list(df.columns)
    types = arrow_type(ddl)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, limit):
            new = [a.cast(f.type) for a, f in zip(columns_of(batch), types)]
            old = [batch.column(source.index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*old, *new], names=[*names, *types.names])

    _ship(df.sparkSession.sparkContext.applicationId)
    return df.mapInArrow(step, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def digest(column: Column | str) -> Column:
    return F.sha2(column, 256)


class WordHashes(dict):
    """64-bit hash of each word (bytes), remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


@cache
def word_hashes() -> WordHashes:
    return WordHashes()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(word_hashes().__getitem__, words), "u8", len(words))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-spread 64-bit function of 64-bit values (finaliser of a public mixer)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def run_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``length`` consecutive word hashes, in order."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, "u8")
    base = np.uint64(0x2545F4914F6CDD1D + 2 * seed * 0x5851F42D4C957F2D & (2**64 - 1) | 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, "u8")
        for k in range(length):
            total *= base
            total += words[k : k + n]
    return mixed(total, seed)


def available(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
