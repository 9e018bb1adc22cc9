"""Incremental forms of scoring and of the log counts, on file sources.

Neither adds semantics: ``stream_score`` is the weekly scoring applied to files as
they land, ``stream_band_counts`` the dashboard's daily counts over the growing log.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.functions.risk import band
from panelwatch.plans.models import Fitted
from panelwatch.session import scratch_folder
from panelwatch.sources.sinks import predictions


def file_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int = 1000):
    """Parquet files of a folder as a stream; the schema is taken from what is there."""
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def _run(stream: DataFrame, into, mode: str, checkpoint: str) -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(into)
        .start()
    )
    query.awaitTermination()


def stream_score(fitted: Fitted, cells: DataFrame, out: str, checkpoint: str) -> None:
    """Scores every batch of panel rows that has landed and stores the published rows.

    Each batch overwrites its own folder, so a batch repeated after a failure does not
    count twice.
    """

    def into(batch: DataFrame, number: int) -> None:
        rows = predictions(fitted.score(batch), F.current_timestamp())
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    _run(cells, into, "append", checkpoint)


def stream_band_counts(
    log: DataFrame, out: str, checkpoint: str, late: str = "1 day", time: str = "ts", p: str = "p"
) -> None:
    """Counts per day and band of a growing log; late entries are accepted for a day.

    Changed counts are stored per batch; ``current_counts`` keeps the newest of each.
    """
    counts = (
        log.withWatermark(time, late)
        .groupBy(F.window(time, "1 day").alias("_w"), band(F.col(p)).alias("nivel_riesgo"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date(F.col("_w.start")).alias("dia"), "nivel_riesgo", "n")
    )

    def into(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    _run(counts, into, "update", checkpoint)


def current_counts(spark: SparkSession, out: str) -> DataFrame:
    return (
        spark.read.parquet(out)
        .groupBy("dia", "nivel_riesgo")
        .agg(F.max_by("n", "batch").alias("n"))
    )


def run_folder(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh (output, checkpoint) folders in the shared place."""
    base = scratch_folder(spark, name)
    return f"{base}/out", f"{base}/checkpoint"
