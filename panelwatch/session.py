"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # call sites cost planning time
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def local_session(cpus: int = 8, app: str = "panelwatch") -> SparkSession:
    """Session for tests and the benchmark; on a cluster the submitter provides it."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_fallback(application: str) -> str:
    return tempfile.mkdtemp(prefix="panelwatch-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only where the setting is absent and the session is local (tests, laptops) is a
    temporary folder used instead: on a cluster such a folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_fallback(spark.sparkContext.applicationId)


_folders: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder in the shared folder; it is deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    paths = _folders.setdefault(spark.sparkContext.applicationId, [])
    if not paths:
        atexit.register(_delete, spark, paths)
    paths.append(path)
    return path


def _delete(spark: SparkSession, paths: list[str]) -> None:
    context = spark.sparkContext
    if context._jsc is None:
        return
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
