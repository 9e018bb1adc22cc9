"""The logical inputs of the job, derived from the tables at hand.

Each function returns a lazy frame over whole tables. Filters on columns are
written as plain ranges so that they reach the parquet scan.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelwatch.operators.ordering import shuffle_partitions
from panelwatch.operators.panel import panel_grid
from panelwatch.operators.timeseries import weekly_rain_features
from panelwatch.functions.calendar import week_start


@cache
def _schema(application: str, path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by name. Its footer is read once per application, not at every mention."""
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark.sparkContext.applicationId, path)).parquet(path)


def daily_signal(spark: SparkSession, folder: str) -> DataFrame:
    """One regional series: fecha, precip_mm."""
    lines = table(spark, folder, "lineitem")
    return lines.groupBy(F.to_date("l_shipdate").alias("fecha")).agg(
        F.sum("l_quantity").alias("precip_mm")
    )


def gapped_signal(spark: SparkSession, folder: str) -> DataFrame:
    """The regional series without the days that have fewer readings than the average day:
    fecha, soil_moisture_m3m3. All readings are counted; the series has real gaps at any scale."""
    daily = table(spark, folder, "lineitem").groupBy(F.to_date("l_shipdate").alias("fecha")).agg(
        F.sum("l_quantity").alias("soil_moisture_m3m3"), F.count(F.lit(1)).alias("_n")
    )
    known = daily.where(F.col("fecha").isNotNull())
    enough = F.col("_n") * known.agg(F.count(F.lit(1))).scalar() >= known.agg(F.sum("_n")).scalar()
    return known.where(enough).drop("_n")


def readings_by_unit(spark: SparkSession, folder: str) -> DataFrame:
    """Raw readings of every unit: unit_id, fecha, precip_mm (several per day)."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("unit_id"),
        F.to_date("l_shipdate").alias("fecha"),
        F.col("l_quantity").alias("precip_mm"),
    )


def units(spark: SparkSession, folder: str) -> DataFrame:
    """Static attributes of the units."""
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.alias("unit_id"),
        F.col("s_acctbal").alias("up_area"),
        (100 + key % 400).cast("double").alias("sub_area"),
        (key % 90).cast("double").alias("dist_main"),
        (1 + key % 6).cast("int").alias("ord"),
    )


def hazards(spark: SparkSession, folder: str) -> DataFrame:
    """Event log placed in units, with consequence counts: every returned line is an event."""
    lines = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return lines.select(
        F.to_date("l_shipdate").alias("fecha"),
        F.col("l_suppkey").alias("unit_id"),
        (F.col("l_linenumber") % 3).cast("double").alias("fallecidos"),
        (F.col("l_quantity") % 5).alias("heridos"),
        F.lit(0.0).alias("desaparecidos"),
        F.col("l_quantity").alias("personas"),
        F.lit(0.0).alias("familias"),
        (F.col("l_partkey") % 4).cast("double").alias("viviendas_destruidas"),
        (F.col("l_suppkey") % 6).cast("double").alias("viviendas_averiadas"),
    )


def raw_hazards(spark: SparkSession, folder: str) -> DataFrame:
    """The event log as published: text columns under their own names, some unreadable."""
    text = lambda c: F.col(c).cast("bigint").cast("string")
    events = hazards(spark, folder)
    return events.select(
        F.date_format("fecha", "yyyy-MM-dd").alias("Fecha"),
        F.concat(F.lit("unidad "), F.col("unit_id")).alias("Municipio"),
        text("fallecidos").alias("Total_Muertos"),
        F.when(F.col("heridos") == 4, "s/d").otherwise(text("heridos")).alias("Lesionados"),
        text("personas").alias("Damnificadas"),
        text("viviendas_destruidas").alias("Viv_Destruidas"),
        text("viviendas_averiadas").alias("Viv_Averiadas"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Station readings as published: everything text, some dates and values unreadable."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = table(spark, folder, "region").select("r_regionkey", "r_name")
    mm = F.floor(F.col("o_totalprice") / 1000)
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderkey") % 17 == 0, "n/a")
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
            .alias("fechaobservacion"),
            F.when(F.col("o_orderkey") % 19 == 0, (-mm - 1).cast("string"))
            .otherwise(mm.cast("string"))
            .alias("valorobservado"),
            F.col("n_name").alias("municipio"),
            F.col("r_name").alias("departamento"),
            F.col("o_orderpriority").alias("evento"),
        )
    )


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Gazetteer of place keys with coordinates and population; some places are missing."""
    nations = table(spark, folder, "nation")
    people = (
        table(spark, folder, "customer")
        .groupBy("c_nationkey")
        .agg((F.count(F.lit(1)) * 1000).alias("pop"))
    )
    n = F.col("n_nationkey")
    return (
        nations.where(n % 9 != 8)
        .join(people, n == F.col("c_nationkey"), "left")
        .select(
            F.concat(F.lit("nacion"), n).alias("place"),
            (-0.35 + 0.1 * (n % 8) + 0.01).alias("lon"),
            (-0.35 + 0.1 * F.floor(n / 8) + 0.01).alias("lat"),
            F.coalesce("pop", F.lit(0)).alias("pop"),
        )
    )


def reported_places(spark: SparkSession, folder: str) -> DataFrame:
    """Events that carry only a place name, written with accent, blank and hyphen."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(" Nación-"), F.col("c_nationkey")).alias("municipio"),
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    vector = F.col("embedding")
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.get(vector, F.lit(0)).cast("double").alias("lon"),
        F.get(vector, F.lit(1)).cast("double").alias("lat"),
        "label",
    )


def diamonds(spark: SparkSession, folder: str) -> DataFrame:
    """A diamond-shaped unit with a closed ring for each supplier, on a square lattice.

    The lattice is moved a little, so that no place lies on an edge.
    """
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("unit_id"))
    side = suppliers.agg(F.ceil(F.sqrt(F.count(F.lit(1))))).scalar()
    half, n = F.lit(0.4) / side, F.col("unit_id") - 1
    x, y = F.lit(-0.40177) + half * (2 * (n % side) + 1), F.lit(-0.39713) + half * (2 * F.floor(n / side) + 1)
    corner = lambda dx, dy: F.struct((x + dx * half).alias("x"), (y + dy * half).alias("y"))
    ring = [(1, 0), (0, 1), (-1, 0), (0, -1), (1, 0)]
    return suppliers.select("unit_id", F.array(*[corner(*c) for c in ring]).alias("ring"))


def basins(spark: SparkSession, folder: str) -> DataFrame:
    """A unit of two parts, one with a hole, for each supplier; sizes differ by four orders.

    A diamond of radius r around a place of the lattice with a hole of radius r / 2, and three
    radii to the east a second one of radius r / 2. Units overlap.
    """
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("unit_id"))
    side = suppliers.agg(F.ceil(F.sqrt(F.count(F.lit(1))))).scalar()
    # Keys of few bytes lie in one file split; their shapes are the work of many tasks.
    suppliers = suppliers.repartition(shuffle_partitions(suppliers), "unit_id")
    n, size = F.col("unit_id") - 1, F.col("unit_id") % 20
    x, y = F.lit(-0.40177) + 0.8 * (n % side) / side, F.lit(-0.39713) + 0.8 * F.floor(n / side) / side
    r = F.when(size == 0, 0.3).when(size < 4, 0.03).when(size < 9, 0.003).when(size < 19, 0.0003).otherwise(0.00003)
    corners = [(1, 0), (0, 1), (-1, 0), (0, -1), (1, 0)]

    def diamond(cx, half):
        return F.array(*[F.struct((cx + dx * half).alias("x"), (F.col("y") + dy * half).alias("y")) for dx, dy in corners])

    placed = suppliers.select("unit_id", x.alias("x"), y.alias("y"), r.alias("r"))
    first = F.array(diamond(F.col("x"), F.col("r")), diamond(F.col("x"), F.col("r") / 2))
    second = F.array(diamond(F.col("x") + 3 * F.col("r"), F.col("r") / 2))
    return placed.select("unit_id", F.array(first, second).alias("parts"))


def raster(spark: SparkSession, folder: str) -> DataFrame:
    """Long form of daily rasters: fecha, lat, lon, value; masked cells are -9999."""
    user = F.col("user_id")
    return table(spark, folder, "events").select(
        F.to_date("ts").alias("fecha"),
        F.floor(user / 15).cast("double").alias("lat"),
        (user % 15).cast("double").alias("lon"),
        F.when(F.col("event_type") == "error", -9999.0).otherwise(F.col("value")).alias("value"),
    )


def week_span(spark: SparkSession, folder: str) -> tuple:
    """First and last week of the raw readings, as scalar subqueries."""
    bounds = table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    return (
        bounds.agg(week_start(F.min("d"))).scalar(),
        bounds.agg(week_start(F.max("d"))).scalar(),
    )


def grid(spark: SparkSession, folder: str) -> DataFrame:
    first, last = week_span(spark, folder)
    return panel_grid(units(spark, folder), hazards(spark, folder), first, last)


def weekly_rain(spark: SparkSession, folder: str) -> DataFrame:
    return weekly_rain_features(daily_signal(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled panel with a deterministic score: week_start, unit_id, y, p."""
    rain = weekly_rain(spark, folder).select("week_start", "precip_acum_14d")
    cells = grid(spark, folder).join(F.broadcast(rain), "week_start", "left")
    raw = F.coalesce("precip_acum_14d", F.lit(0.0)) + F.col("unit_id") % 10
    # The largest value needs no pass over the panel: rain has one row per week.
    top = (
        rain.agg(F.max(F.coalesce("precip_acum_14d", F.lit(0.0)))).scalar()
        + units(spark, folder).agg(F.max(F.col("unit_id") % 10)).scalar()
    )
    return cells.select(
        "week_start",
        "unit_id",
        F.col("deslizamiento").alias("y"),
        (raw / top).alias("p"),
        "precip_acum_14d",
    )


def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """Served predictions: ts, unit, probability, feature map (one feature may be null)."""
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        F.col("user_id").alias("hybas_id"),
        F.least(F.col("value") / 500, F.lit(1.0)).alias("p"),
        F.create_map(
            F.lit("hybas_id"),
            F.col("user_id").cast("double"),
            F.lit("k"),
            F.get_json_object("props", "$.k").try_cast("double"),
            F.lit("signal"),
            F.when(F.col("event_type") != "error", F.col("value")),
        ).alias("features"),
    )
