"""Landed files to typed frames: readers, cleaning, caps and resumption."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.functions.columns import pick_column, to_double, to_timestamp
from panelwatch.functions.text import fold, has_keyword, matches_keyword
from panelwatch.settings import HYDRO_KEYWORDS

STATION_SCHEMA = T.StructType(
    [
        T.StructField("departamento", T.StringType()),
        T.StructField("fechaobservacion", T.StringType()),
        T.StructField("valorobservado", T.StringType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("fecha", T.StringType()),
        T.StructField("departamento", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("evento", T.StringType()),
    ]
)
SIGNAL_SCHEMA = T.StructType(
    [T.StructField("fecha", T.DateType()), T.StructField("precip_mm", T.DoubleType())]
)

#: Writers of one day at most.
DAY_WRITERS = 4


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema nothing is inferred; without one all columns are text."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_json_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All landed pages of a feed: one JSON array or object per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def whole_feed(*pages: DataFrame) -> DataFrame:
    """All records of all landed pages, dated or not; a record on two pages is kept once."""
    return reduce(DataFrame.unionByName, pages).distinct()


def monthly_extracts(readings: DataFrame, day: str, where: Column | None = None) -> DataFrame:
    """All readings with the month of their extract, ``mes_inicio``; null where undated."""
    chosen = readings if where is None else readings.where(where)
    return chosen.withColumn("mes_inicio", F.trunc(day, "month"))


def bbox_daily_mean(
    raster: DataFrame,
    lat: tuple[float, float],
    lon: tuple[float, float],
    first: Column,
    last: Column,
    missing: str = "zero",
) -> DataFrame:
    """Mean of the valid cells in a box for every day from first to last.

    Masked and negative cells do not count. A day without any valid cell is 0.0 as
    in the published series, or null with ``missing='null'``.
    """
    valid = raster.where(
        F.col("lat").between(*lat) & F.col("lon").between(*lon) & (F.col("value") >= 0)
    )
    means = valid.groupBy("fecha").agg(F.avg("value").alias("precip_mm"))
    filled = F.col("precip_mm") if missing == "null" else F.coalesce("precip_mm", F.lit(0.0))
    return calendar_days(raster.sparkSession, first, last).join(means, "fecha", "left").select(
        "fecha", filled.alias("precip_mm")
    )


def spatial_daily_mean(raster: DataFrame) -> DataFrame:
    """Mean over all cells of each day, null where none is valid (soil moisture)."""
    return raster.groupBy("fecha").agg(
        F.avg(F.nanvl("value", F.lit(None))).alias("soil_moisture_m3m3")
    )


def calendar_days(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    days = F.sequence(first, last, F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("fecha"))


def missing_days(landed: DataFrame, first: Column, last: Column, day: str = "fecha") -> DataFrame:
    """Days of the period not landed yet: what a resumed job still has to fetch."""
    have = landed.select(F.to_date(day).alias("fecha")).distinct()
    return calendar_days(landed.sparkSession, first, last).join(have, "fecha", "left_anti")


def land_days(fetched: DataFrame, path: str, day: str = "fecha") -> None:
    """Adds fetched days to a folder with one partition a day, without reading or rewriting others.

    A day that is there already is replaced: repeating a job after a failure leaves the same files.
    """
    days = fetched.repartition(day, F.pmod(F.hash(*fetched.columns), F.lit(DAY_WRITERS)))
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def landed_days(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def append_days(landed: DataFrame, fetched: DataFrame) -> DataFrame:
    return landed.unionByName(fetched).orderBy("fecha")


def clean_stations(raw: DataFrame, low: float = 0, high: float = 500) -> DataFrame:
    """Typed station readings within physical range; unreadable rows are dropped."""
    day = to_timestamp(F.col(pick_column(raw, "fecha")))
    value = to_double(F.col(pick_column(raw, "valor")))
    place = pick_column(raw, "depart", required=False)
    typed = raw.select(
        *[c for c in raw.columns if c == "id"],
        day.alias("fecha"),
        value.alias("precip_mm"),
        (fold(F.col(place)) if place else F.lit("desconocido")).alias("departamento"),
    )
    return typed.where(
        F.col("fecha").isNotNull() & F.col("precip_mm").between(low, high)
    ).select("*", *_calendar_columns())


def _calendar_columns() -> list[Column]:
    return [
        F.year("fecha").alias("anio"),
        F.month("fecha").alias("mes"),
        F.date_format("fecha", "yyyy-MM").alias("anio_mes"),
    ]


def clean_events(raw: DataFrame, keywords: Sequence[str] = HYDRO_KEYWORDS) -> DataFrame:
    """Events whose type contains a keyword once accents are folded, with readable dates."""
    kind = pick_column(raw, "evento", "tipo", required=False)
    place = pick_column(raw, "depart", required=False)
    rows = raw.where(has_keyword(F.col(kind), tuple(keywords))) if kind else raw
    return (
        rows.select(
            to_timestamp(F.col(pick_column(raw, "fecha"))).alias("fecha"),
            (fold(F.col(place)) if place else F.lit("desconocido")).alias("departamento"),
            (F.col(kind) if kind else F.lit("desconocido")).alias("evento"),
        )
        .where(F.col("fecha").isNotNull())
        .select("*", *_calendar_columns())
    )


def regional_events(
    raw: DataFrame,
    department: str,
    keywords: Sequence[str],
    first_year: int,
    last_year: int,
    kind: str = "evento",
    place: str = "departamento",
    day: str = "fecha",
) -> DataFrame:
    """The events of one department, by pattern on the lower-cased type, and of given years."""
    dated = raw.where(
        (F.upper(F.col(place)) == department.upper()) & matches_keyword(F.col(kind), tuple(keywords))
    ).withColumn(day, to_timestamp(F.col(day)))
    return dated.where(F.year(day).between(first_year, last_year))


def daily_stations(readings: DataFrame) -> DataFrame:
    return readings.groupBy(F.to_date("fecha").alias("fecha")).agg(
        F.sum("precip_mm").alias("precip_diaria"), F.count("precip_mm").alias("n_estaciones")
    )


# Fixed values. Request rules: column, smallest allowed, whether that value itself is allowed, largest.
INPUT_RULES = (
    ("precip_acum_14d", 0.0, True, None),
    ("precip_acum_7d", 0.0, True, None),
    ("precip_acum_3d", 0.0, True, None),
    ("precip_max_diario_14d", 0.0, True, None),
    ("precip_dias_lluvia_14d", 0.0, True, None),
    ("sub_area", 0.0, False, None),
    ("up_area", 0.0, False, None),
    ("dist_main", 0.0, True, None),
    ("ord", 1.0, True, None),
    ("semana_sin", -1.0, True, 1.0),
    ("semana_cos", -1.0, True, 1.0),
    ("mes_sin", -1.0, True, 1.0),
    ("mes_cos", -1.0, True, 1.0),
)


def with_violations(rows: DataFrame, rules=INPUT_RULES) -> DataFrame:
    """Adds ``violaciones``: the columns of a row that are missing or out of range."""
    found = []
    for name, low, inclusive, high in rules:
        c = F.col(name)
        ok = (c >= low) if inclusive else (c > low)
        if high is not None:
            ok = ok & (c <= high)
        found.append(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)))
    return rows.withColumn("violaciones", F.array_compact(F.array(*found)))


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined with reasons)."""
    checked = with_violations(rows)
    good = F.size("violaciones") == 0
    return checked.where(good).drop("violaciones"), checked.where(~good)
