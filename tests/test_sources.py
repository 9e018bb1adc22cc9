import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.session import cut_lineage, shared_dir
from panelwatch.sources import landing as la
from panelwatch.sources import sinks as si


def test_csv_is_read_as_declared_and_cleaned(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_text(
        "departamento,fechaobservacion,valorobservado\n"
        "Bogotá,2021-01-04T10:00:00.000,1.5\nX,n/a,1\nX,2021-01-05,abc\nX,2021-01-05,-1\nX,2021-01-05,501\n"
        "X,2021-01-05,500\n",
        encoding="utf-8",
    )
    got = la.clean_stations(la.read_csv(spark, str(path), la.STATION_SCHEMA)).orderBy("fecha").collect()
    assert [(r.departamento, r.precip_mm, r.anio_mes) for r in got] == [
        ("bogota", 1.5, "2021-01"), ("x", 500.0, "2021-01")
    ]


def test_json_pages_are_concatenated(spark, tmp_path):
    for page in range(3):
        rows = [{"fecha": f"2021-01-0{page + 1}", "evento": "Inundación", "municipio": "m"}] * 2
        (tmp_path / f"page{page}.json").write_text(json.dumps(rows), encoding="utf-8")
    got = la.clean_events(la.read_json_pages(spark, str(tmp_path), la.EVENT_SCHEMA))
    assert got.count() == 6
    assert la.clean_events(la.read_json_pages(spark, str(tmp_path), la.EVENT_SCHEMA), ["sismo"]).isEmpty()


def test_column_names_are_sniffed(spark):
    df = spark.createDataFrame([("derrumbe", "2021-02-03")], "Tipo_x string, FechaReporte string")
    row = la.clean_events(df).first()
    assert (row.evento, row.mes, row.departamento) == ("derrumbe", 2, "desconocido")
    with pytest.raises(ValueError):
        la.clean_events(df.select("Tipo_x"))


def test_a_feed_is_read_whole(spark):
    df = spark.createDataFrame([(1, None), (2, date(2021, 1, 5)), (3, date(2021, 1, 4))], "id int, d date")
    got = la.whole_feed(df.where("id < 3"), df.where("id > 1"))
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_monthly_extracts_keep_every_reading(spark):
    df = spark.range(90).select(
        "id", F.date_add(F.lit("2021-01-01").cast("date"), F.col("id").cast("int")).alias("d")
    )
    got = la.monthly_extracts(df, "d", F.col("id") > 0).toPandas()
    assert got.groupby("mes_inicio").id.min().tolist() == [1, 31, 59] and len(got) == 89


def test_raster_days_without_valid_cells(spark):
    rows = [(date(2021, 1, 1), 1.0, 1.0, 4.0), (date(2021, 1, 1), 1.0, 9.0, 100.0), (date(2021, 1, 3), 1.0, 1.0, -9999.0)]
    df = spark.createDataFrame(rows, "fecha date, lat double, lon double, value double")
    ends = F.lit("2021-01-01").cast("date"), F.lit("2021-01-03").cast("date")
    zero = la.bbox_daily_mean(df, (0, 2), (0, 2), *ends).orderBy("fecha").collect()
    assert [r.precip_mm for r in zero] == [4.0, 0.0, 0.0]
    null = la.bbox_daily_mean(df, (0, 2), (0, 2), *ends, missing="null").orderBy("fecha").collect()
    assert [r.precip_mm for r in null] == [4.0, None, None]


def test_resume(spark):
    have = spark.createDataFrame([(date(2021, 1, 2), 1.0)], la.SIGNAL_SCHEMA)
    ends = F.lit("2021-01-01").cast("date"), F.lit("2021-01-03").cast("date")
    todo = la.missing_days(have, *ends)
    assert sorted(r.fecha.day for r in todo.collect()) == [1, 3]
    whole = la.append_days(have, todo.withColumn("precip_mm", F.lit(0.0)))
    assert [r.fecha.day for r in whole.collect()] == [1, 2, 3]
    assert la.missing_days(whole, *ends).isEmpty()


def test_rules_quarantine_with_reasons(spark):
    names = [r[0] for r in la.INPUT_RULES]
    good = {n: 1.0 for n in names}
    rows = [good, {**good, "up_area": 0.0, "mes_sin": 1.5}, {**good, "precip_acum_7d": None}]
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    ok, bad = la.split_valid(spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema))
    assert ok.count() == 1
    assert sorted(tuple(r.violaciones) for r in bad.collect()) == [("precip_acum_7d",), ("up_area", "mes_sin")]


def published(spark, units=7):
    rows = [(date(2021, 1, 4), u, u / 10 + 0.00005) for u in range(units)]
    df = spark.createDataFrame(rows, "week_start date, unit_id long, p double")
    return si.predictions(df, F.lit("2021-01-11").cast("timestamp"))


def test_document(spark):
    lines = {r.unit_id: json.loads(r.documento) for r in si.week_documents(published(spark), ["x", "y"]).collect()}
    week = lines.pop(None)
    assert week["semana"] == "2021-01-04/2021-01-10" and week["n_cuencas"] == 7
    assert week["resumen"] == {"alto": 1, "medio": 3, "bajo": 3} and week["features_usadas"] == ["x", "y"]
    assert [u for u, r in lines.items() if r["alto_riesgo"]] == [6]
    assert sorted(r["hybas_id"] for r in lines.values()) == list(range(7))


def test_document_has_one_form_at_any_size(spark):
    lines = si.week_documents(published(spark, 30_000), []).groupBy(F.col("unit_id").isNull().alias("week")).count()
    assert {r.week: r["count"] for r in lines.collect()} == {False: 30_000, True: 1}


def test_a_week_is_written_by_several_tasks(spark, tmp_path):
    rows = [(date(2021, 1, 4), u, 0) for u in range(200)]
    df = spark.createDataFrame(rows, "week_start date, unit_id long, deslizamiento int")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # 200 rows would be merged again for their size
    try:
        si.write_panel(df, str(tmp_path / "w"))
    finally:
        spark.conf.set(merging, "true")
    assert len(list((tmp_path / "w").rglob("*.parquet"))) > 1
    assert la.read_panel(spark, str(tmp_path / "w")).count() == 200


def test_log_drops_nulls_and_the_id_and_appends(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "2021-01-01 00:00:00", 0.12345678, {"hybas_id": 1.0, "a": None, "b": 2.0})],
        "hybas_id long, ts string, p double, features map<string,double>",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    row = si.log_entries(df).first()
    assert row.features == {"b": 2.0} and row.probabilidad == 0.123457 and row.nivel_riesgo == "Bajo"
    for _ in range(2):
        si.append_log(si.log_entries(df), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_geojson(spark):
    df = spark.createDataFrame(
        [(1, [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)], 5.0)],
        "unit_id long, ring array<struct<x:double,y:double>>, up_area double",
    )
    got = json.loads(si.geojson_features(df, ["unit_id", "up_area"]).first().feature)
    assert got["type"] == "Feature" and got["properties"] == {"unit_id": 1, "up_area": 5.0}
    assert got["geometry"]["coordinates"][0][1] == [1.0, 0.0]


def test_panel_round_trip_prunes_years(spark, tmp_path):
    rows = [(date(2020, 12, 28), 1, 0), (date(2021, 1, 4), 1, 1)]
    df = spark.createDataFrame(rows, "week_start date, unit_id long, deslizamiento int")
    si.write_panel(df, str(tmp_path / "p"))
    back = la.read_panel(spark, str(tmp_path / "p"))
    assert back.where("year = 2021").first().anio_semana == "2021-01-04/2021-01-10"
    plan = back.where("year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "year#" in plan.split("PartitionFilters")[1].split("]")[0]
    si.write_csv(df, str(tmp_path / "c"))
    assert la.read_csv(spark, str(tmp_path / "c")).count() == 2


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class Session:
    """The two things ``shared_dir`` asks a session for."""

    def __init__(self, folder, master):
        self.conf = Conf(folder)
        self.sparkContext = type("C", (), {"master": master, "applicationId": "app"})


def test_the_clusters_folder_is_used_and_never_a_local_one():
    assert shared_dir(Session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        shared_dir(Session(None, "yarn"))
    assert shared_dir(Session(None, "local[2]")) == shared_dir(Session(None, "local[2]"))


def test_checkpoints_are_reliable_files(spark):
    from pathlib import Path

    def stored():
        return set(Path(shared_dir(spark).removeprefix("file:")).rglob("part-*"))

    before = stored()
    assert cut_lineage(spark.range(3)).count() == 3
    assert stored() > before


def test_resumed_days_touch_new_days_only(spark, tmp_path):
    """Two resumed runs leave equal files, and files of days already there keep their times."""
    from pathlib import Path

    path = str(tmp_path / "days")
    first, last = (F.lit(d).cast("date") for d in ("2020-01-01", "2020-01-20"))
    landed = spark.createDataFrame([(f"2020-01-{d:02d}", float(d)) for d in (2, 3, 9)], "fecha string, precip_mm double")
    la.land_days(landed.withColumn("fecha", F.to_date("fecha")), path)

    def files():
        return {f.relative_to(path): (f.stat().st_mtime_ns, f.read_bytes()) for f in Path(path).rglob("*.parquet")}

    def resume():
        have = la.landed_days(spark, path, "precip_mm double, fecha date")
        fetched = la.missing_days(have, first, last).withColumn("precip_mm", F.lit(0.0))
        la.land_days(fetched, path)
        return files()

    before, once = files(), resume()
    assert before.items() <= once.items() and resume() == once
    rows = la.landed_days(spark, path, "precip_mm double, fecha date").collect()
    assert len(rows) == 20 and sum(r.precip_mm for r in rows) == 14
    la.land_days(landed.withColumn("fecha", F.to_date("fecha")), path)
    again = la.landed_days(spark, path, "precip_mm double, fecha date").collect()
    assert sorted(again) == sorted(rows)
