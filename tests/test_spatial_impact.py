import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch.functions import geometry
from panelwatch.operators import impact as im
from panelwatch.operators import spatial as sp
from panelwatch.settings import CONSEQUENCES, Economics

RING = "unit_id long, ring array<struct<x:double,y:double>>"
SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
LSHAPE = [(0.0, 0.0), (3.0, 0.0), (3.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0), (0.0, 0.0)]


def placed(spark, polygons, points, tile=0.5):
    polys = spark.createDataFrame(polygons, RING)
    pts = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id long, lon double, lat double")
    return {(r.id, r.unit_id) for r in sp.point_in_polygon(pts, polys, tile).collect()}


def test_border_points_are_outside_and_overlaps_double(spark):
    points = [(0.5, 0.5), (0.0, 0.5), (1.0, 1.0), (0.5, 0.0), (2.0, 2.0), (0.5, 2.5), (2.5, 0.5)]
    got = placed(spark, [(1, SQUARE), (2, LSHAPE)], points)
    assert got == {(0, 1), (0, 2), (5, 2), (6, 2), (3, 2)} - {(3, 2)}


@pytest.mark.parametrize("tile", [0.13, 1.0, 7.0])
def test_any_tile_size_and_crowding(spark, tile):
    rng = np.random.default_rng(2)
    pts = [(0.5, 0.5)] * 100 + [tuple(map(float, rng.uniform(-1, 4, 2))) for _ in range(200)]
    inside_l = lambda x, y: (0 < x < 3 and 0 < y < 1) or (0 < x < 1 and 0 < y < 3)
    want = {(i, 2) for i, (x, y) in enumerate(pts) if inside_l(x, y)}
    assert placed(spark, [(2, LSHAPE)], pts, tile) == want


PARTS = "unit_id long, parts array<array<array<struct<x:double,y:double>>>>"


def box(x, y, half):
    return [(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half)]


def test_parts_and_holes(spark):
    """A part with a hole that holds an island, and a second part; borders are outside everywhere."""
    shape = [[box(0.0, 0.0, 4.0), box(0.0, 0.0, 2.0)], [box(0.0, 0.0, 1.0)], [box(10.0, 0.0, 1.0)]]
    points = [(3.0, 0.0), (1.5, 0.0), (0.0, 0.0), (10.5, 0.5), (7.0, 0.0), (2.0, 0.0), (1.0, 0.5), (4.0, 4.0), (None, 1.0)]
    pts = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id long, lon double, lat double")
    for tile in (None, 0.25, 64.0):
        got = sp.point_in_polygon(pts, spark.createDataFrame([(7, shape)], PARTS), tile)
        assert sorted((r.id, r.unit_id) for r in got.collect()) == [(0, 7), (2, 7), (3, 7)]


def test_tiles_of_several_sizes(spark):
    """Shapes over many orders of size have four tiles at most, and each point meets each once."""
    shapes = [(i, [[box(0.37 * i % 1, 0.61 * i % 1, 10.0 ** -(i % 8))]]) for i in range(1, 60)]
    polygons = spark.createDataFrame([*shapes, (99, [[box(0.0, 0.0, 0.0)]])], PARTS)
    tiles = sp.quad_tiles(polygons).groupBy("unit_id").count().collect()
    assert {r.unit_id for r in tiles} == {i for i, _ in shapes} and max(r["count"] for r in tiles) <= 4
    rng = np.random.default_rng(3)
    pts = [tuple(map(float, p)) for p in rng.uniform(-1, 2, (300, 2))] + [(0.37, 0.61), (0.0, 0.0)]
    want = sorted(
        (k, i) for k, (x, y) in enumerate(pts) for i, _ in shapes
        if max(abs(x - 0.37 * i % 1), abs(y - 0.61 * i % 1)) < 10.0 ** -(i % 8)
    )
    frame = spark.createDataFrame([(k, *p) for k, p in enumerate(pts)], "id long, lon double, lat double")
    assert sorted((r.id, r.unit_id) for r in sp.point_in_polygon(frame, polygons).collect()) == want


def test_clipping(spark):
    boundary = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    shapes = [(1, [[box(0.0, 0.0, 1.0)]]), (2, [[box(1.0, 1.0, 1.0), box(1.0, 1.0, 0.5)]]), (3, [[box(9.0, 9.0, 1.0)]]),
              (4, [[box(2.0, 1.0, 0.5)], [box(0.0, 1.0, 0.25)]]), (5, [[LSHAPE]]), (6, [[box(1.0, 1.0, 9.0), box(1.0, 1.0, 0.5)]])]
    got = {r.unit_id: r.area for r in sp.clipped(spark.createDataFrame(shapes, PARTS), boundary).collect()}
    assert got == pytest.approx({1: 1.0, 2: 3.0, 4: 0.5 + 0.125, 5: 3.0, 6: 3.0})


def test_grid_coordinates_to_degrees(spark):
    """Published control points of a national grid, and the grid's own origin."""
    osgb = geometry.TransverseMercator(-2.0, 49.0, 0.9996012717, 400000.0, -100000.0, 6377563.396, 1 / 299.3249646)
    lon, lat = osgb.to_degrees(F.col("x"), F.col("y"))
    rows = spark.createDataFrame([(651409.903, 313177.270), (400000.0, -100000.0)], "x double, y double")
    got = rows.select(lon.alias("lon"), lat.alias("lat")).collect()
    assert [got[0].lon, got[0].lat] == pytest.approx([1 + 43 / 60 + 4.5177 / 3600, 52 + 39 / 60 + 27.2531 / 3600], abs=1e-7)
    assert [got[1].lon, got[1].lat] == pytest.approx([-2.0, 49.0], abs=1e-9)


def test_bbox_prune(spark):
    far = [(x + 10, y) for x, y in SQUARE]
    polys = spark.createDataFrame([(1, SQUARE), (2, far)], RING)
    got = sp.bbox_prune(polys, F.lit(1.0), F.lit(5.0), F.lit(-1.0), F.lit(0.0))
    assert [r.unit_id for r in got.collect()] == [1]


def test_geocode_folds_names_fans_out_and_counts_misses(spark):
    events = spark.createDataFrame(
        [(1, "San José"), (2, "  SAN-JOSE "), (3, "Nowhere"), (4, None)], "id long, municipio string"
    )
    places = spark.createDataFrame([("sanjose", 1.0), ("sanjose", 2.0)], "place string, lon double")
    got = sp.geocode(events, places, "municipio").collect()
    assert sorted((r.id, r.lon) for r in got) == [(1, 1.0), (1, 2.0), (2, 1.0), (2, 2.0)]
    rate = sp.geocode_rate(events, places, "municipio").first()
    assert (rate.n_eventos, rate.n_con_coord, rate.n_sin_coord, rate.tasa) == (4, 2, 2, 0.5)


def test_bad_coordinates(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, None), (1.0, 2.0)], "lon double, lat double")
    assert sp.drop_bad_coordinates(df).count() == 1


def test_population_and_fallback(spark):
    units = spark.createDataFrame([(1, 10.0), (2, 0.5)], "unit_id long, sub_area double")
    polys = spark.createDataFrame([(1, SQUARE)], RING)
    places = spark.createDataFrame([("a", 0.5, 0.5, 30), ("b", 0.6, 0.6, 12)], "place string, lon double, lat double, pop long")
    got = {r.unit_id: r.poblacion_estimada for r in sp.unit_population(units, polys, places).collect()}
    assert got == {1: 42.0, 2: 60.0}
    zero = sp.unit_population(units, polys, places, fallback=False).where("unit_id = 2").first()
    assert zero.poblacion_estimada == 0.0


def hazards(spark):
    rows = [(1, 2020, 1.0, 0.0), (1, 2020, 0.0, 2.0), (2, 2021, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "unit_id long, anio int, fallecidos double, heridos double")
    df = df.withColumn("fecha", F.make_date("anio", F.lit(1), F.lit(1))).drop("anio")
    for c in CONSEQUENCES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0))
    return df


def test_costs(spark):
    row = im.impact_totals(hazards(spark)).first()
    assert row.costo_cop == 760e6 + 2 * 87.5e6 and row.n_eventos == 3
    assert row.costo_por_evento == pytest.approx(row.costo_cop / 3)
    units = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0)], "unit_id long, sub_area double")
    got = {r.unit_id: (r.n_eventos, r.costo_m_cop) for r in im.impact_by_unit(hazards(spark), units).collect()}
    assert got == {1: (2, 935.0), 2: (1, 0.0), 3: (0, 0.0)}


def test_synonyms(spark):
    raw = spark.createDataFrame([("2", "x", 7)], "Total_Muertos string, LESIONADOS string, afectadas int")
    row = im.standard_consequences(raw).first()
    assert (row.fallecidos, row.heridos, row.personas, row.familias) == (2.0, 0.0, 7.0, 0.0)


def scored(spark, n=400):
    rng = np.random.default_rng(5)
    rows = [(int(i % 4), int(i), int(rng.random() < 0.1), float(np.round(rng.random(), 2))) for i in range(n)]
    return spark.createDataFrame(rows, "week_start int, unit_id long, y int, p double"), rows


def test_sweep_equals_a_scan_per_threshold(spark):
    df, rows = scored(spark)
    got = im.threshold_sweep(df, im.impact_totals(hazards(spark))).orderBy("umbral").collect()
    assert len(got) == 19
    for r in got:
        tp = sum(y for _, _, y, p in rows if p >= r.umbral)
        fp = sum(1 - y for _, _, y, p in rows if p >= r.umbral)
        assert (r.tp, r.fp) == (tp, fp) and r.recall == pytest.approx(tp / sum(y for *_, y, _ in rows))


def test_published_scenario(spark):
    """Recall 0.9731 and precision 0.006 over 945 events: counts and ratios as published."""
    rates = spark.createDataFrame([(0.9731, 0.006)], "recall double, precision double")
    totals = spark.createDataFrame(
        [(945, 210_400e6, 210_400e6 / 945)], "n_eventos long, costo_cop double, costo_por_evento double"
    )
    got = im.bcr_scenarios(rates, totals).orderBy("factor_reduccion").collect()
    assert (got[0].tp, got[0].fn, got[0].fp) == (920.0, 25.0, 152413.0)
    want = [-0.892, -0.866, -0.839, -0.812, -0.785, -0.758]
    assert [r.bcr for r in got] == pytest.approx(want, abs=2e-3)


def test_top_n_alerts(spark):
    df, rows = scored(spark)
    money = Economics(alert_sizes=(1, 5, 500))
    got = {r.n_alertas: (r.aciertos, r.falsas_alarmas) for r in im.top_n_alerts(df, im.impact_totals(hazards(spark)), money).collect()}
    for n in (1, 5, 500):
        alerted = []
        for w in range(4):
            week = sorted((r for r in rows if r[0] == w), key=lambda r: (-r[3], r[1]))
            alerted += week[:n]
        assert got[n] == (sum(r[2] for r in alerted), sum(1 - r[2] for r in alerted))


def test_priority(spark):
    impact = spark.createDataFrame(
        [(1, 5, 1.0, 2.0, 10.0, 0.4), (2, 0, 0.0, 0.0, 10.0, 0.2)],
        "unit_id long, n_eventos long, fallecidos double, costo_m_cop double, poblacion_estimada double, indice_riesgo double",
    )
    pred = spark.createDataFrame([(1, 0.5, "Medio"), (2, 0.9, "Alto"), (3, 0.1, "Bajo")], "unit_id long, p double, nivel_riesgo string")
    got = {r.unit_id: r.score for r in im.priority(pred, impact).collect()}
    assert got == pytest.approx({1: 0.5 * 1.4, 2: 0.9 * 1.2, 3: 0.1})  # maximum below 1 counts as 1
    assert [r.unit_id for r in im.priority(pred, impact, only_with_events=True).collect()] == [1]
    ranked = im.priority_export(im.priority(pred, impact)).orderBy("rank").collect()
    assert [(r["rank"], r.unit_id, r.prob_pct, r.score) for r in ranked] == [
        (1, 2, "90.0", "1.080"), (2, 1, "50.0", "0.700"), (3, 3, "10.0", "0.100")
    ]


def test_a_crowded_tile_is_the_work_of_several_tasks(spark):
    x = F.lit(0.25) + F.col("id") / 10000
    corner = lambda dx, dy: F.struct((x + dx * 0.2).alias("x"), (x + dy * 0.2).alias("y"))
    ring = F.array(*[corner(*c) for c in ((1, 0), (0, 1), (-1, 0), (0, -1), (1, 0))])
    polygons = spark.range(0, 60, 1, 1).select(F.col("id").alias("unit_id"), ring.alias("ring"))
    points = spark.range(0, 40, 1, 1).select("id", (F.lit(0.25) + F.col("id") / 1000).alias("lon"), (F.lit(0.25) + F.col("id") / 100000).alias("lat"))
    found = sp.point_in_polygon(points, polygons).withColumn("task", F.spark_partition_id())
    assert found.dropDuplicates(["id", "unit_id"]).count() == found.count() == 60 * 40
    assert found.select("task").distinct().count() > 1


def test_polygons_of_one_file_are_tiled_by_several_tasks(spark):
    corner = lambda dx, dy: F.struct((F.col("id") + F.lit(dx)).cast("double").alias("x"), F.lit(float(dy)).alias("y"))
    ring = F.array(*[corner(*c) for c in ((1, 0), (0, 1), (-1, 0), (0, -1), (1, 0))])
    tiles = sp.quad_tiles(spark.range(0, 60, 1, 1).select(F.col("id").alias("unit_id"), ring.alias("ring")))
    assert tiles.select(F.spark_partition_id()).distinct().count() > 1
    # Nothing is computed from the shapes before they are spread.
    assert "array_min" not in tiles._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert {r.unit_id for r in tiles.select("unit_id").distinct().collect()} == set(range(60))
