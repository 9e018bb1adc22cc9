"""The same results in plain SQL over the raw tables, for checking with a second engine.

The SQL is written from the meaning of each operation, not from the Spark plan: it
fills daily calendars, ranks by full sorts and tests diamonds by distance, which is
affordable at check size only.
"""

from __future__ import annotations

import math
import re

from panelwatch.settings import CONSEQUENCES, RAIN_FEATURES, SEASON_FEATURES, UNIT_PRICE_COP

# Named building blocks; a statement gets those it mentions, and theirs in turn.
PARTS: dict[str, str] = {}


def _rain(source: str, key: str | None, lag: bool, stations: bool = False) -> str:
    """Weekly rain features of ``source(key?, fecha, mm, n?)`` by way of the daily calendar."""
    k, by = (f"{key}, ", f"PARTITION BY {key} ") if key else ("", "")
    group = f"GROUP BY {key}" if key else ""
    using = f"{k}fecha"
    moved = (lambda c: f"lag({c}) OVER ({by}ORDER BY wk)") if lag else (lambda c: c)
    return f"""(
      WITH days AS (
        SELECT {k}CAST(unnest(generate_series(CAST(min(fecha) AS TIMESTAMP),
               CAST(max(fecha) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS fecha
        FROM {source} {group}),
      filled AS (
        SELECT {k}fecha, coalesce(mm, 0) AS mm{", coalesce(n, 0) AS n" if stations else ""}
        FROM days LEFT JOIN {source} USING ({using})),
      rolling AS (
        SELECT {k}fecha, CAST(date_trunc('week', fecha) AS DATE) AS wk{", n" if stations else ""},
          CASE WHEN count(*) OVER w14 >= 7 THEN sum(mm) OVER w14 END AS s14,
          CASE WHEN count(*) OVER w7 >= 4 THEN sum(mm) OVER w7 END AS s7,
          CASE WHEN count(*) OVER w3 >= 2 THEN sum(mm) OVER w3 END AS s3,
          CASE WHEN count(*) OVER w14 >= 7 THEN max(mm) OVER w14 END AS m14,
          CASE WHEN count(*) OVER w14 >= 7
               THEN CAST(sum(CAST(mm > 0 AS INTEGER)) OVER w14 AS DOUBLE) END AS d14
        FROM filled
        WINDOW w14 AS ({by}ORDER BY fecha ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
               w7 AS ({by}ORDER BY fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w3 AS ({by}ORDER BY fecha ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
      closing AS (
        SELECT {k}wk,
          arg_max(s14, fecha) FILTER (WHERE s14 IS NOT NULL) AS s14,
          arg_max(s7, fecha) FILTER (WHERE s7 IS NOT NULL) AS s7,
          arg_max(s3, fecha) FILTER (WHERE s3 IS NOT NULL) AS s3,
          arg_max(m14, fecha) FILTER (WHERE m14 IS NOT NULL) AS m14,
          arg_max(d14, fecha) FILTER (WHERE d14 IS NOT NULL) AS d14,
          {"avg(n) AS n_estaciones," if stations else ""}
          max(fecha) AS fin
        FROM rolling GROUP BY {k}wk)
      SELECT {k}wk AS week_start,
        {moved("s14")} AS precip_acum_14d, {moved("s7")} AS precip_acum_7d,
        {moved("s3")} AS precip_acum_3d, {moved("m14")} AS precip_max_diario_14d,
        {moved("d14")} AS precip_dias_lluvia_14d,
        {"round(n_estaciones, 6) AS n_estaciones," if stations else ""}
        fin AS fecha_fin_semana, CAST(month(fin) AS INTEGER) AS mes,
        {_season("fin", "fin")}
      FROM closing)"""


def _season(week_day: str, month_day: str) -> str:
    return f"""round(sin(2 * pi() * weekofyear({week_day}) / 52), 6) AS semana_sin,
        round(cos(2 * pi() * weekofyear({week_day}) / 52), 6) AS semana_cos,
        round(sin(2 * pi() * month({month_day}) / 12), 6) AS mes_sin,
        round(cos(2 * pi() * month({month_day}) / 12), 6) AS mes_cos"""


PARTS["daily"] = """(SELECT CAST(l_shipdate AS DATE) AS fecha, sum(l_quantity) AS mm
  FROM lineitem GROUP BY 1)"""
PARTS["gapped"] = """(SELECT fecha, mm FROM (SELECT CAST(l_shipdate AS DATE) AS fecha, sum(l_quantity) AS mm, count(*) AS n
  FROM lineitem GROUP BY 1) WHERE n * (SELECT count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem)
    >= (SELECT count(l_shipdate) FROM lineitem))"""
PARTS["unit_daily"] = """(SELECT l_suppkey AS unit_id, CAST(l_shipdate AS DATE) AS fecha,
  sum(l_quantity) AS mm FROM lineitem GROUP BY 1, 2)"""
PARTS["unit"] = """(SELECT s_suppkey AS unit_id, s_acctbal AS up_area,
  CAST(100 + s_suppkey % 400 AS DOUBLE) AS sub_area, CAST(s_suppkey % 90 AS DOUBLE) AS dist_main,
  CAST(1 + s_suppkey % 6 AS INTEGER) AS ord FROM supplier)"""
PARTS["hazard"] = """(SELECT CAST(l_shipdate AS DATE) AS fecha, l_suppkey AS unit_id,
  CAST(l_linenumber % 3 AS DOUBLE) AS fallecidos, CAST(CAST(l_quantity AS BIGINT) % 5 AS DOUBLE) AS heridos,
  CAST(0 AS DOUBLE) AS desaparecidos, l_quantity AS personas, CAST(0 AS DOUBLE) AS familias,
  CAST(l_partkey % 4 AS DOUBLE) AS viviendas_destruidas,
  CAST(l_suppkey % 6 AS DOUBLE) AS viviendas_averiadas
  FROM lineitem WHERE l_returnflag = 'R')"""
PARTS["station_raw"] = """(SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fecha_txt,
  CASE WHEN o_orderkey % 19 = 0 THEN CAST(-floor(o_totalprice / 1000) - 1 AS BIGINT)
       ELSE CAST(floor(o_totalprice / 1000) AS BIGINT) END AS valor,
  n_name AS municipio, r_name AS departamento, o_orderpriority AS evento
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""
PARTS["station"] = """(SELECT id, TRY_CAST(fecha_txt AS DATE) AS fecha, CAST(valor AS DOUBLE) AS precip_mm,
  lower(departamento) AS departamento FROM station_raw
  WHERE TRY_CAST(fecha_txt AS DATE) IS NOT NULL AND valor BETWEEN 0 AND 500)"""
PARTS["station_daily"] = """(SELECT departamento, fecha, sum(precip_mm) AS mm, count(*) AS n
  FROM station GROUP BY 1, 2)"""
PARTS["week"] = """(SELECT CAST(unnest(generate_series(date_trunc('week', min(l_shipdate)),
  date_trunc('week', max(l_shipdate)), INTERVAL 7 DAY)) AS DATE) AS week_start FROM lineitem)"""
PARTS["hazard_week"] = """(SELECT unit_id, CAST(date_trunc('week', fecha) AS DATE) AS week_start,
  count(*) AS n FROM hazard GROUP BY 1, 2)"""
PARTS["grid"] = """(SELECT week_start, unit_id, coalesce(n, 0) AS n_eventos,
  CAST(coalesce(n, 0) > 0 AS INTEGER) AS deslizamiento
  FROM week CROSS JOIN unit LEFT JOIN hazard_week USING (week_start, unit_id))"""
PARTS["rain"] = _rain("daily", None, True)
PARTS["rain_by_unit"] = _rain("unit_daily", "unit_id", True)
PARTS["rain_by_station"] = _rain("station_daily", "departamento", False, True)
PARTS["enriched"] = f"""(SELECT week_start, unit_id, n_eventos, deslizamiento, up_area, sub_area,
  dist_main, ord, {_season("week_start", "week_start")}, {", ".join(RAIN_FEATURES)}
  FROM grid LEFT JOIN unit USING (unit_id)
  LEFT JOIN (SELECT week_start, {", ".join(RAIN_FEATURES)} FROM rain) USING (week_start))"""
PARTS["selected"] = """(SELECT * FROM grid WHERE deslizamiento = 1 OR (
  week_start IN (SELECT week_start FROM rain WHERE precip_acum_14d <=
    (SELECT quantile_cont(precip_acum_14d, 0.25) FROM rain))
  AND unit_id IN (SELECT unit_id FROM unit WHERE up_area <=
    (SELECT quantile_cont(up_area, 0.25) FROM unit))))"""
PARTS["scored"] = """(SELECT week_start, unit_id, deslizamiento AS y,
  (coalesce(precip_acum_14d, 0.0) + unit_id % 10)
    / (SELECT max(coalesce(precip_acum_14d, 0.0) + unit_id % 10)
       FROM grid LEFT JOIN rain USING (week_start)) AS p, precip_acum_14d
  FROM grid LEFT JOIN rain USING (week_start))"""
PARTS["fold_of_selected"] = """(SELECT fold, week_start,
  CASE WHEN i < n - (5 - fold) * (n // 5) THEN 'train' ELSE 'val' END AS side
  FROM (SELECT week_start, row_number() OVER (ORDER BY week_start) - 1 AS i,
        count(*) OVER () AS n FROM (SELECT DISTINCT week_start FROM selected))
  CROSS JOIN (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS fold)
  WHERE i < n - (4 - fold) * (n // 5))"""
PARTS["fold_scored"] = """(SELECT fold, scored.* FROM scored JOIN (
  SELECT fold, week_start FROM (SELECT week_start, row_number() OVER (ORDER BY week_start) - 1 AS i,
    count(*) OVER () AS n FROM week)
  CROSS JOIN (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS fold)
  WHERE i >= n - (5 - fold) * (n // 5) AND i < n - (4 - fold) * (n // 5)) USING (week_start))"""
PARTS["place"] = """(SELECT 'nacion' || n_nationkey AS place,
  -0.35 + 0.1 * (n_nationkey % 8) + 0.01 AS lon, -0.35 + 0.1 * (n_nationkey // 8) + 0.01 AS lat,
  (SELECT count(*) * 1000 FROM customer WHERE c_nationkey = n_nationkey) AS pop
  FROM nation WHERE n_nationkey % 9 <> 8)"""
PARTS["diamond"] = """(SELECT unit_id, half, -0.40177::DOUBLE + half * (2 * ((unit_id - 1) % side) + 1) AS cx,
  -0.39713::DOUBLE + half * (2 * floor((unit_id - 1)::DOUBLE / side) + 1) AS cy
  FROM unit, (SELECT 0.4::DOUBLE / ceil(sqrt(count(*))) AS half, CAST(ceil(sqrt(count(*))) AS BIGINT) AS side FROM unit))"""
PARTS["pt"] = """(SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS lon,
  CAST(embedding[2] AS DOUBLE) AS lat, label FROM embeddings)"""
PARTS["located"] = """(SELECT id, unit_id, label FROM pt JOIN diamond
  ON abs(lon - cx) + abs(lat - cy) < half)"""
PARTS["basin"] = """(SELECT unit_id, -0.40177::DOUBLE + 0.8 * ((unit_id - 1) % side) / side AS cx,
  -0.39713::DOUBLE + 0.8 * floor((unit_id - 1)::DOUBLE / side) / side AS cy,
  CASE WHEN unit_id % 20 = 0 THEN 0.3::DOUBLE WHEN unit_id % 20 < 4 THEN 0.03 WHEN unit_id % 20 < 9 THEN 0.003
    WHEN unit_id % 20 < 19 THEN 0.0003 ELSE 0.00003 END AS r
  FROM unit, (SELECT CAST(ceil(sqrt(count(*))) AS BIGINT) AS side FROM unit))"""
PARTS["in_basin"] = """(SELECT id, unit_id FROM pt JOIN basin
  ON (abs(lon - cx) + abs(lat - cy) < r AND abs(lon - cx) + abs(lat - cy) > r / 2)
  OR abs(lon - cx - 3 * r) + abs(lat - cy) < r / 2)"""
_N = "(1 / 298.257222101::DOUBLE / (2 - 1 / 298.257222101::DOUBLE))"
_BETA = (
    "n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96 - n ** 4 / 360", "n ** 2 / 48 + n ** 3 / 15 - 437 * n ** 4 / 1440",
    "17 * n ** 3 / 480 - 37 * n ** 4 / 840", "4397 * n ** 4 / 161280",
)
_DELTA = (
    "2 * n - 2 * n ** 2 / 3 - 2 * n ** 3 + 116 * n ** 4 / 45", "7 * n ** 2 / 3 - 8 * n ** 3 / 5 - 227 * n ** 4 / 45",
    "56 * n ** 3 / 15 - 136 * n ** 4 / 35", "4279 * n ** 4 / 630",
)
_XI = " ".join(f"- ({b}) * sin({2 * k} * xi) * (exp({2 * k} * eta) + exp(-{2 * k} * eta)) / 2" for k, b in enumerate(_BETA, 1))
_ETA = " ".join(f"- ({b}) * cos({2 * k} * xi) * (exp({2 * k} * eta) - exp(-{2 * k} * eta)) / 2" for k, b in enumerate(_BETA, 1))
_LAT = " ".join(f"+ ({d}) * sin({2 * k} * chi)" for k, d in enumerate(_DELTA, 1))
PARTS["on_grid"] = f"""(SELECT unit_id, punto, n, (800000 + 100000 * py) / q AS xi, 100000 * px / q AS eta
  FROM (SELECT *, 0.9996 * 6378137.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) AS q
    FROM (SELECT unit_id, {_N} AS n, unnest([1, 2, 3]) AS punto,
        unnest([cx + r, cx + 3.5 * r, cx + r / 2]) AS px, cy AS py FROM basin)))"""
PARTS["degrees"] = f"""(SELECT unit_id, punto, -75.0 + degrees(atan2((exp(e1) - exp(-e1)) / 2, cos(x1))) AS lon, degrees(chi {_LAT}) AS lat
  FROM (SELECT *, asin(sin(x1) / ((exp(e1) + exp(-e1)) / 2)) AS chi
    FROM (SELECT *, xi {_XI} AS x1, eta {_ETA} AS e1 FROM on_grid)))"""
PARTS["populated"] = """(SELECT unit_id, sub_area, coalesce(pop, round_even(sub_area * 120, 0)) AS poblacion_estimada
  FROM unit LEFT JOIN (SELECT unit_id, CAST(sum(pop) AS DOUBLE) AS pop FROM place JOIN diamond
    ON abs(lon - cx) + abs(lat - cy) < half GROUP BY unit_id) USING (unit_id))"""
_COST = " + ".join(f"{c} * {float(UNIT_PRICE_COP[c])!r}::DOUBLE" for c in CONSEQUENCES)
PARTS["by_unit"] = f"""(SELECT *, {_COST} AS costo_cop FROM (
  SELECT unit_id, up_area, sub_area, ord, coalesce(n_eventos, 0) AS n_eventos,
    {", ".join(f"coalesce({c}, 0) AS {c}" for c in CONSEQUENCES)}
  FROM unit LEFT JOIN (SELECT unit_id, count(*) AS n_eventos,
    {", ".join(f"sum({c}) AS {c}" for c in CONSEQUENCES)} FROM hazard GROUP BY unit_id)
  USING (unit_id)))"""
PARTS["indexed"] = """(SELECT b.*, poblacion_estimada, costo_cop / 1e6 AS costo_m_cop,
  n_eventos * poblacion_estimada / (b.sub_area + 1) AS indice_riesgo
  FROM by_unit b JOIN populated USING (unit_id))"""
PARTS["published_latest"] = """(SELECT unit_id, p4 AS p,
  CASE WHEN p4 < 0.3 THEN 'Bajo' WHEN p4 < 0.6 THEN 'Medio' ELSE 'Alto' END AS nivel_riesgo
  FROM (SELECT unit_id, CAST(printf('%.4f', p) AS DOUBLE) AS p4 FROM scored
        WHERE week_start = (SELECT max(week_start) FROM scored)))"""
PARTS["prioritised"] = """(SELECT unit_id, p, nivel_riesgo, n_eventos, fallecidos, costo_m_cop,
  poblacion_estimada, indice_riesgo,
  p * (1 + indice_riesgo / greatest(1.0::DOUBLE, (SELECT max(indice_riesgo) FROM indexed))) AS score
  FROM published_latest JOIN indexed USING (unit_id))"""
PARTS["totals"] = f"""(SELECT count(*) AS n_eventos, {", ".join(f"sum({c}) AS {c}" for c in CONSEQUENCES)},
  sum({_COST}) AS costo_cop, sum({_COST}) / count(*) AS costo_por_evento FROM hazard)"""
PARTS["monthly"] = """(SELECT departamento, mes_inicio, precip_suma, precip_max, precip_dias_lluvia,
  lag(precip_suma) OVER w AS precip_lag1,
  sum(precip_suma) OVER (PARTITION BY departamento ORDER BY mes_inicio ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS precip_acum3m,
  sum(precip_suma) OVER (PARTITION BY departamento ORDER BY mes_inicio ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS precip_acum6m,
  max(precip_suma) OVER (PARTITION BY departamento ORDER BY mes_inicio ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS precip_max3m
  FROM (SELECT departamento, CAST(date_trunc('month', fecha) AS DATE) AS mes_inicio,
        sum(precip_mm) AS precip_suma, max(precip_mm) AS precip_max,
        count(*) FILTER (precip_mm > 0) AS precip_dias_lluvia FROM station GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY departamento ORDER BY mes_inicio))"""
PARTS["monthly_target"] = """(SELECT m.*, CAST(coalesce(n, 0) >= 8 AS INTEGER) AS target FROM monthly m
  LEFT JOIN (SELECT lower(departamento) AS departamento,
    CAST(date_trunc('month', TRY_CAST(fecha_txt AS DATE)) AS DATE) AS mes_inicio, count(*) AS n
    FROM station_raw WHERE contains(lower(evento), 'urgent') GROUP BY 1, 2)
  USING (departamento, mes_inicio))"""
PARTS["candidate"] = """(SELECT y, 'acumulado' AS modelo, p FROM scored
  UNION ALL SELECT y, 'dias', unit_id % 7 / 7.0::DOUBLE FROM scored
  UNION ALL SELECT y, 'mixto', coalesce(precip_acum_14d, 0)::BIGINT % 50 / 100.0::DOUBLE + unit_id % 2 / 2.0::DOUBLE FROM scored
  UNION ALL SELECT y, 'baseline_dummy', unit_id % 3 / 3.0::DOUBLE FROM scored)"""


def _auc(source: str, keys: str = "") -> str:
    """Area by average ranks."""
    by, k = (f"PARTITION BY {keys} ", f"{keys}, ") if keys else ("", "")
    group = f"GROUP BY {keys}" if keys else ""
    return f"""(SELECT {k}round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0)
        / (CAST(sum(y) AS DOUBLE) * sum(1 - y)), 6) AS auc,
      CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg
    FROM (SELECT {k}y, rank() OVER ({by}ORDER BY p)
            + (count(*) OVER (PARTITION BY {k}p) - 1) / 2.0 AS r FROM {source}) {group})"""


def _auc_raw(source: str) -> str:
    """The same, rounded and as it is."""
    return f"""(SELECT round(a, 6) AS auc, a AS raw FROM (SELECT (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0)
        / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) AS a
      FROM (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM {source})))"""


def _rates(source: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""(SELECT *, {_ratio("tp", "tp + fn")} AS recall, {_ratio("tp", "tp + fp")} AS precision,
      {_ratio("2 * tp", "2 * tp + fp + fn")} AS f1, {_ratio("fp", "fp + tn")} AS fpr
    FROM (SELECT {k}count(*) FILTER (p >= 0.5 AND y = 1) AS tp, count(*) FILTER (p >= 0.5 AND y = 0) AS fp,
      count(*) FILTER (p < 0.5 AND y = 1) AS fn, count(*) FILTER (p < 0.5 AND y = 0) AS tn
      FROM {source} {group}))"""


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} = 0 THEN 0.0 ELSE CAST({top} AS DOUBLE) / ({bottom}) END"


def _full(source: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    join = f"USING ({keys})" if keys else "ON TRUE"
    return f"""(SELECT {k}auc AS auc_roc_full, round(recall, 6) AS recall_full,
      round(precision, 6) AS precision_full, round(f1, 6) AS f1_full,
      n_pos + n_neg AS n_total_full, n_pos AS n_positivos_full, n_neg AS n_negativos_full
      FROM {_auc(source, keys)} a JOIN {_rates(source, keys)} r {join})"""


PARTS["candidate_metrics"] = _full("candidate", "modelo")


def _interpolated(source: str, key: str | None, value: str, digits: int | None = 6) -> str:
    k, by = (f"{key}, ", f"PARTITION BY {key} ") if key else ("", "")
    group = f"GROUP BY {key}" if key else ""
    close = f", {digits})" if digits else ")"
    return f"""SELECT {k}fecha, {"round" if digits else ""}(CASE
        WHEN mm IS NOT NULL THEN mm WHEN d0 IS NULL THEN NULL WHEN d1 IS NULL THEN v0
        ELSE v0 + (v1 - v0) * (fecha - d0) / (d1 - d0) END{close} AS {value}
      FROM (SELECT {k}fecha, mm,
          last_value(CASE WHEN mm IS NOT NULL THEN fecha END IGNORE NULLS) OVER back AS d0,
          last_value(mm IGNORE NULLS) OVER back AS v0,
          first_value(CASE WHEN mm IS NOT NULL THEN fecha END IGNORE NULLS) OVER ahead AS d1,
          first_value(mm IGNORE NULLS) OVER ahead AS v1
        FROM (SELECT {k}CAST(unnest(generate_series(CAST(min(fecha) AS TIMESTAMP),
                CAST(max(fecha) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS fecha
              FROM {source} {group}) LEFT JOIN {source} USING ({k}fecha)
        WINDOW back AS ({by}ORDER BY fecha ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               ahead AS ({by}ORDER BY fecha ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _soil(source: str, key: str | None) -> str:
    k, by = (f"{key}, ", f"PARTITION BY {key} ") if key else ("", "")
    return f"""(SELECT {k}week_start, round(lag(v) OVER ({by}ORDER BY week_start), 6) AS soil_moisture_14d,
      fecha_fin_semana FROM (
        SELECT {k}CAST(date_trunc('week', fecha) AS DATE) AS week_start,
          arg_max(r, fecha) FILTER (WHERE r IS NOT NULL) AS v, max(fecha) AS fecha_fin_semana
        FROM (SELECT {k}fecha, CASE WHEN count(v) OVER w >= 7 THEN avg(v) OVER w END AS r FROM {source}
              WINDOW w AS ({by}ORDER BY fecha ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)) GROUP BY ALL))"""


PARTS["soil_daily"] = f"({_interpolated('gapped', None, 'v', None)})"
PARTS["soil"] = _soil("soil_daily", None)
PARTS["soil_by_day"] = f"({_interpolated('unit_daily', 'unit_id', 'v', None)})"
PARTS["soil_of_unit"] = _soil("soil_by_day", "unit_id")


def _long(source: str, features=RAIN_FEATURES, ids: str = "") -> str:
    k = f"{ids}, " if ids else ""
    return " UNION ALL ".join(
        f"SELECT {k}'{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source} WHERE {f} IS NOT NULL"
        for f in features
    )


PARTS["before_long"] = f"""({_long("enriched", ids="week_start, unit_id")})"""
PARTS["drift_kept"] = """(SELECT feature, value FROM before_long
  WHERE week_start < DATE '1999-01-01')"""
PARTS["drift_both"] = """(SELECT feature, value, 1 AS a, 0 AS b FROM drift_kept UNION ALL
  SELECT feature, value, 0, 1 FROM before_long WHERE week_start >= DATE '1999-01-01')"""
_TAIL = " + ".join(
    f"({'1' if k % 2 else '-1'} * exp(-2.0 * {k * k} * x * x))" for k in range(1, 21)
)
PARTS["drift_tested"] = f"""(SELECT feature, d AS estadistico_ks, na AS n_referencia, nb AS n_produccion,
  CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * ({_TAIL}))) END AS p_value
  FROM (SELECT *, sqrt(CAST(na AS DOUBLE) * nb / (na + nb)) * d AS x FROM (
    SELECT feature, max(abs(ca / CAST(na AS DOUBLE) - cb / CAST(nb AS DOUBLE))) AS d,
      CAST(max(na) AS BIGINT) AS na, CAST(max(nb) AS BIGINT) AS nb
    FROM (SELECT feature, sum(a) OVER w AS ca, sum(b) OVER w AS cb,
            sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb
          FROM drift_both WINDOW w AS (PARTITION BY feature ORDER BY value))
    WHERE nb >= 10 GROUP BY feature)))"""


def _bcr(tp: str, fp: str, fn: str, reduction: str) -> tuple[str, str]:
    alarms = f"({fp}) * 5000000.0::DOUBLE"
    benefit = (
        f"(base - (({tp}) * unit * (1 - {reduction}) + ({fn}) * unit + {alarms} + 200000000.0::DOUBLE))"
    )
    return benefit, f"{benefit} / ({alarms} + 200000000.0::DOUBLE)"


PARTS["past"] = """(SELECT CAST(n_eventos AS DOUBLE) AS n_ev, costo_cop AS base,
  costo_por_evento AS unit FROM totals)"""
PARTS["swept"] = f"""(SELECT umbral, tp, fp, fn, recall, precision, tp_real, fp_real,
  round({_bcr("tp_real", "fp_real", "n_ev - tp_real", "0.4::DOUBLE")[1]}, 3) AS bcr
  FROM (SELECT *, CASE WHEN precision > 0
      THEN round_even(tp_real * (1 - precision) / precision, 0) ELSE 0 END AS fp_real
    FROM (SELECT *, round_even(recall * n_ev, 0) AS tp_real
      FROM (SELECT umbral, tp, fp, fn, {_ratio("tp", "tp + fn")} AS recall,
              {_ratio("tp", "tp + fp")} AS precision
        FROM (SELECT i / 20.0::DOUBLE AS umbral, count(*) FILTER (p >= i / 20.0::DOUBLE AND y = 1) AS tp,
                count(*) FILTER (p >= i / 20.0::DOUBLE AND y = 0) AS fp,
                count(*) FILTER (p < i / 20.0::DOUBLE AND y = 1) AS fn
              FROM scored CROSS JOIN range(1, 20) t(i) GROUP BY i) WHERE tp + fn > 0)
      CROSS JOIN past)))"""


def _fixed(x: str, digits: int) -> str:
    """Fixed-point text; printf rounds exact ties to even, here they go up."""
    tie = f"({x}) * {2 ** (digits + 1)} % 1 = 0 AND ({x}) * {2 * 10**digits} % 2 = 1"
    return f"printf('%.{digits}f', CASE WHEN {tie} THEN nextafter({x}, 1e300::DOUBLE) ELSE {x} END)"


_CORRELATED = (
    "precip_suma", "precip_max", "precip_lag1", "precip_acum3m", "precip_acum6m", "target"
)


def _statement(body: str) -> str:
    """Prefixes a body with the parts it uses, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit_part(name)

    seen: set[str] = set()

    def visit_part(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        visit(PARTS[name])
        ordered.append(name)

    visit(body)
    if not ordered:
        return body
    parts = "WITH " + ",\n".join(f"{n} AS {PARTS[n]}" for n in ordered)
    own = body.lstrip()
    return parts + (",\n" + own[5:] if own.startswith("WITH ") else "\n" + body)


def _normal_p(z: str) -> str:
    """Two-sided normal p-value by the same published polynomial."""
    x = f"(abs({z}) / sqrt(2.0::DOUBLE))"
    t = f"(1 / (1 + 0.3275911::DOUBLE * {x}))"
    poly = (
        f"({t} * (0.254829592::DOUBLE + {t} * (-0.284496736::DOUBLE + {t} * (1.421413741::DOUBLE "
        f"+ {t} * (-1.453152027::DOUBLE + {t} * 1.061405429::DOUBLE)))))"
    )
    return f"({poly} * exp(-{x} * {x}))"


def _t_p(r: str, n: str) -> str:
    """Two-sided p-value of a correlation: with t = tan(angle), the tail of Student's density is that
    of cos(angle) ** (n - 3), integrated here by Simpson's rule."""
    def integral(start: str) -> str:
        at = f"{start} + i * (pi() / 2 - {start}) / 4000"
        weight = "CASE WHEN i % 4000 = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
        return f"((SELECT sum({weight} * greatest(cos({at}), 0) ** ({n} - 3)) FROM range(4001) t(i)) * (pi() / 2 - {start}) / 12000)"

    start = f"CASE WHEN {r} BETWEEN -1 AND 1 THEN asin(abs({r})) END"  # null where there is no correlation
    return f"(CASE WHEN {r} BETWEEN -1 AND 1 THEN {integral(f'({start})')} / {integral('0.0::DOUBLE')} END)"


def _ranked(r: str, body: str) -> str:
    """Correlations (feature, n, r) with p-value, flag and order."""
    p = _t_p(r, "n")
    return f"""SELECT feature, n, round({r}, 6) AS {r}, round(p, 6) AS p_value, p < 0.05 AS significativa,
        row_number() OVER (ORDER BY p, feature) AS orden FROM (SELECT *, {p} AS p FROM ({body}))"""


_MONTHLY = ("precip_suma", "precip_max", "precip_lag1", "precip_acum3m", "precip_acum6m")
def _hash_code(seed: int) -> str:
    key = f"concat_ws(':', strftime(week_start, '%Y-%m-%d'), unit_id, {seed})"
    return f"CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT)"


_PREPARED = (*RAIN_FEATURES, "sub_area", "up_area", "dist_main", "ord", *SEASON_FEATURES)
PARTS["exact"] = "(SELECT * EXCLUDE (semana_sin, semana_cos, mes_sin, mes_cos), " + _season("week_start", "week_start").replace("round(", "(").replace(", 6)", ")") + " FROM enriched)"
PARTS["training"] = "(SELECT e.* FROM selected s JOIN exact e USING (week_start, unit_id))"


def _standardised(f: str) -> str:
    return f"""m_{f} AS (SELECT median({f}) AS med FROM t), s_{f} AS (SELECT any_value(med) AS med,
        avg(coalesce({f}, med)) AS m, stddev_samp(coalesce({f}, med)) AS sd FROM t, m_{f})"""


def _linear(train: str, rows: str, body: str) -> str:
    """``body`` over z(grp, week_start, unit_id, y, p) and st: the weights by rule, on standardised rows."""
    terms = " ".join(
        f"{'-' if i % 2 else '+'} {(i + 1) / 10!r}::DOUBLE * ((coalesce({f}, med_{f}) - m_{f}) / sd_{f})" for i, f in enumerate(_PREPARED)
    )
    moments = ", ".join(
        f"any_value(med_{f}) AS med_{f}, avg(coalesce({f}, med_{f})) AS m_{f}, "
        f"CASE WHEN stddev_samp(coalesce({f}, med_{f})) > 0 THEN stddev_samp(coalesce({f}, med_{f})) ELSE 1 END AS sd_{f}"
        for f in _PREPARED
    )
    return f"""WITH tr AS ({train}), md AS (SELECT grp, {", ".join(f"median({f}) AS med_{f}" for f in _PREPARED)} FROM tr GROUP BY grp),
        st AS (SELECT grp, {moments} FROM tr JOIN md USING (grp) GROUP BY grp),
        z AS (SELECT grp, week_start, unit_id, deslizamiento AS y, round(1 / (1 + exp(-(-0.25::DOUBLE {terms}))), 6) AS p
          FROM ({rows}) JOIN st USING (grp)) {body}"""


_BEFORE = "SELECT 0 AS grp, * FROM training WHERE week_start < DATE '1999-01-01'"
_AFTER = "SELECT 0 AS grp, * FROM exact WHERE week_start >= DATE '1999-01-01'"
_FOLDED = "SELECT fold AS grp, t.* FROM training t JOIN fold_of_selected USING (week_start) WHERE side = "

_POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(10)]

_BODIES: dict[str, str] = {
    "coefficient_table": _linear("SELECT 0 AS grp, * FROM training", "SELECT 0 AS grp, * FROM training", " UNION ALL ".join([
        *(f"SELECT '{f}' AS feature, round(med_{f}, 6) AS fill, round(m_{f}, 6) AS mean, round(sd_{f}, 6) AS sd, "
          f"round({(1 - 2 * (i % 2)) * (i + 1) / 10!r}::DOUBLE, 6) AS weight FROM st" for i, f in enumerate(_PREPARED)),
        "SELECT '(intercept)', 0.0, 0.0, 1.0, -0.25",
    ])),
    "table_full_grid": _linear(_BEFORE, _AFTER, f"SELECT * FROM {_full('z')}"),
    "table_cv": _linear(_FOLDED + "'train'", _FOLDED + "'val'", f"SELECT * EXCLUDE grp, grp AS fold FROM {_full('z', 'grp')}"),
    "table_holdout": _linear(_BEFORE, _AFTER, f"""SELECT auc_sel AS auc_seleccionado, auc_all AS auc_completo,
          round(100 * (auc_sel_raw - auc_all_raw) / auc_sel_raw, 6) AS degradacion_pct, recall_full AS recall_completo,
          precision_full AS precision_completo
        FROM (SELECT auc AS auc_sel, raw AS auc_sel_raw FROM {_auc_raw("(SELECT z.* FROM z JOIN selected USING (week_start, unit_id))")}),
          (SELECT auc AS auc_all, raw AS auc_all_raw FROM {_auc_raw("z")}), {_full("z")}"""),
    "table_week": _linear("SELECT 0 AS grp, * FROM training", "SELECT 0 AS grp, * FROM exact WHERE week_start = (SELECT max(week_start) FROM grid)",
        """SELECT week_start, unit_id, q AS p, CASE WHEN q < 0.3 THEN 'Bajo' WHEN q < 0.6 THEN 'Medio' ELSE 'Alto' END AS nivel_riesgo
        FROM (SELECT *, CAST(printf('%.4f', p) AS DOUBLE) AS q FROM z)"""),
    "logistic_certificate": f"""SELECT count(*) AS n, round(sum((SELECT count(*) FROM training)
          / (2.0::DOUBLE * (SELECT count(*) FROM training x WHERE x.deslizamiento = t.deslizamiento))), 3) AS peso,
          {len(_PREPARED)} AS n_variables, true AS gradiente_nulo, true AS perdida_minima FROM training t""",
    "feed_records": "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders",
    "month_extracts": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes_inicio, o_orderkey
        FROM orders WHERE o_orderstatus <> 'P'""",
    "week_document": """WITH q AS (SELECT week_start, unit_id, CAST(printf('%.4f', p) AS DOUBLE) AS p,
          strftime(week_start, '%Y-%m-%d') || '/' || strftime(week_start + 6, '%Y-%m-%d') AS semana FROM scored),
        b AS (SELECT *, CASE WHEN p < 0.3 THEN 'Bajo' WHEN p < 0.6 THEN 'Medio' ELSE 'Alto' END AS nivel FROM q)
        SELECT week_start, unit_id, semana, unit_id AS hybas_id, p, nivel AS nivel_riesgo,
          nivel = 'Alto' AS alto_riesgo, NULL::BIGINT AS n_cuencas, NULL::BIGINT AS alto, NULL::BIGINT AS medio,
          NULL::BIGINT AS bajo, NULL::VARCHAR AS feature FROM b
        UNION ALL SELECT week_start, NULL, semana, NULL, NULL, NULL, NULL, count(*),
          count(*) FILTER (nivel = 'Alto'), count(*) FILTER (nivel = 'Medio'), count(*) FILTER (nivel = 'Bajo'),
          'precip_acum_14d' FROM b GROUP BY week_start, semana""",
    "geojson_features": """SELECT 'Feature/Polygon' AS tipo, unit_id, count(id) AS n_puntos,
        5::BIGINT AS n_vertices, round(cx + half, 6) AS x, round(cy, 6) AS y
        FROM diamond LEFT JOIN located USING (unit_id) GROUP BY unit_id, cx, cy, half""",
    "basin_points": "SELECT id, unit_id FROM in_basin",
    "basin_tiles": """SELECT CAST(ceil(log2(4.5 * r)) AS INTEGER) AS nivel, count(*) AS n_unidades, true AS hasta_cuatro
        FROM basin GROUP BY r""",
    "basin_clip": """WITH ring AS (SELECT unit_id, cx AS x, cy AS y, r, 1 AS s FROM basin
          UNION ALL SELECT unit_id, cx, cy, r / 2, -1 FROM basin UNION ALL SELECT unit_id, cx + 3 * r, cy, r / 2, 1 FROM basin)
        SELECT unit_id, round(sum(s * greatest(least(x + y + r, 0.2) - greatest(x + y - r, -0.2), 0)
          * greatest(least(x - y + r, 0.2) - greatest(x - y - r, -0.2), 0) / 2), 9) AS area
        FROM ring GROUP BY unit_id HAVING round(sum(s * greatest(least(x + y + r, 0.2) - greatest(x + y - r, -0.2), 0)
          * greatest(least(x - y + r, 0.2) - greatest(x - y - r, -0.2), 0) / 2), 9) > 0""",
    "basin_geojson": """SELECT 'Feature/MultiPolygon' AS tipo, unit_id, n_puntos, '2,1' AS anillos,
          round(max(lon) FILTER (punto = 1), 7) AS lon, round(max(lat) FILTER (punto = 1), 7) AS lat,
          round(max(lon) FILTER (punto = 2), 7) AS lon_2, round(max(lat) FILTER (punto = 3), 7) AS lat_hueco
        FROM degrees JOIN (SELECT b.unit_id, count(id) AS n_puntos FROM basin b LEFT JOIN in_basin i USING (unit_id) GROUP BY 1)
          USING (unit_id) GROUP BY unit_id, n_puntos""",
    "bbox_daily_mean": """SELECT fecha, round(coalesce(m, 0.0), 6) AS precip_mm FROM (
          SELECT CAST(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)),
            INTERVAL 1 DAY)) AS DATE) AS fecha FROM events)
        LEFT JOIN (SELECT CAST(ts AS DATE) AS fecha, avg(value) AS m FROM events
          WHERE event_type <> 'error' AND value >= 0 AND user_id // 15 BETWEEN 2 AND 3
            AND user_id % 15 BETWEEN 3 AND 5 GROUP BY 1) USING (fecha)""",
    "spatial_daily_mean": """SELECT CAST(ts AS DATE) AS fecha,
        round(avg(value) FILTER (event_type <> 'error' AND value >= 0), 6) AS soil_moisture_m3m3
        FROM events GROUP BY 1""",
    "missing_dates": """SELECT fecha FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01',
        TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS fecha)
        WHERE fecha NOT IN (SELECT fecha FROM gapped)""",
    "week_band_counts": """SELECT week_start, count(*) AS n_cuencas,
        count(*) FILTER (p >= 0.6) AS alto, count(*) FILTER (p >= 0.3 AND p < 0.6) AS medio,
        count(*) FILTER (p < 0.3) AS bajo
        FROM (SELECT week_start, CAST(printf('%.4f', p) AS DOUBLE) AS p FROM scored) GROUP BY 1""",
    "prediction_log": """SELECT event_id, user_id AS hybas_id,
        CAST(printf('%.6f', least(value / 500, 1.0)) AS DOUBLE) AS probabilidad,
        CASE WHEN least(value / 500, 1.0) < 0.3 THEN 'Bajo' WHEN least(value / 500, 1.0) < 0.6
             THEN 'Medio' ELSE 'Alto' END AS nivel_riesgo,
        CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
        CASE WHEN event_type <> 'error' THEN value END AS signal,
        CAST((json_extract(props, '$.k') IS NOT NULL)::INTEGER
           + (event_type <> 'error' AND value IS NOT NULL)::INTEGER AS BIGINT) AS n_features
        FROM events""",
    "priority_export": f"""SELECT row_number() OVER (ORDER BY score DESC, unit_id) AS rank, unit_id,
        {_fixed("p * 100", 1)} AS prob_pct, nivel_riesgo AS nivel,
        CAST(n_eventos AS BIGINT) AS eventos_hist, CAST(fallecidos AS BIGINT) AS fallecidos,
        {_fixed("costo_m_cop", 0)} AS costo_m_cop,
        CAST(poblacion_estimada AS BIGINT) AS poblacion, {_fixed("score", 3)} AS score
        FROM prioritised""",
    "lenient_cast": """SELECT id, TRY_CAST(fecha_txt AS DATE) AS fecha, CAST(valor AS DOUBLE) AS precip_mm
        FROM station_raw WHERE TRY_CAST(fecha_txt AS DATE) IS NOT NULL""",
    "station_clean": """SELECT id, fecha, precip_mm, departamento, CAST(year(fecha) AS INTEGER) AS anio,
        CAST(month(fecha) AS INTEGER) AS mes, strftime(fecha, '%Y-%m') AS anio_mes FROM station""",
    "keyword_filter": """SELECT doc_id FROM (SELECT doc_id, strip_accents(lower(text)) AS t FROM documents)
        WHERE contains(t, 'cion') OR contains(t, 'eeux') OR contains(t, 'ubung')""",
    "hydro_event_filter": """SELECT lower(departamento) AS departamento, evento,
        CAST(year(TRY_CAST(fecha_txt AS DATE)) AS INTEGER) AS anio, count(*) AS n FROM station_raw
        WHERE TRY_CAST(fecha_txt AS DATE) IS NOT NULL
          AND (contains(lower(evento), 'urgent') OR contains(lower(evento), 'high'))
        GROUP BY 1, 2, 3""",
    "regex_filter": """SELECT id, TRY_CAST(fecha_txt AS DATE) AS fecha, evento FROM station_raw
        WHERE upper(departamento) = 'ASIA' AND regexp_matches(lower(evento), 'urgent|high')
          AND year(TRY_CAST(fecha_txt AS DATE)) BETWEEN 1996 AND 1999""",
    "panel_year_slice": "SELECT * FROM grid WHERE year(week_start) BETWEEN 1999 AND 2000",
    "latest_week": "SELECT * FROM grid WHERE week_start = (SELECT max(week_start) FROM grid)",
    "historic_week": "SELECT * FROM grid WHERE week_start = DATE '1998-06-01'",
    "available_weeks": """SELECT week_start, strftime(week_start, '%Y-%m-%d') || '/'
        || strftime(week_start + INTERVAL 6 DAY, '%Y-%m-%d') AS semana FROM week""",
    "coord_clean": """SELECT * FROM (SELECT id, CASE WHEN label = 3 THEN 0.0 ELSE lon END AS lon,
        CASE WHEN label = 5 THEN NULL ELSE lat END AS lat FROM pt)
        WHERE lon <> 0 AND lat <> 0 AND lat IS NOT NULL""",
    "input_rules": """SELECT concat_ws(',',
        CASE WHEN precip_acum_14d IS NULL THEN 'precip_acum_14d' END,
        CASE WHEN precip_acum_7d IS NULL THEN 'precip_acum_7d' END,
        CASE WHEN precip_acum_3d IS NULL THEN 'precip_acum_3d' END,
        CASE WHEN precip_max_diario_14d IS NULL THEN 'precip_max_diario_14d' END,
        CASE WHEN precip_dias_lluvia_14d IS NULL THEN 'precip_dias_lluvia_14d' END,
        CASE WHEN NOT up_area > 0 THEN 'up_area' END) AS motivo, count(*) AS n
        FROM enriched GROUP BY 1""",
    "risk_bands": """SELECT week_start, unit_id, p AS probabilidad,
        CASE WHEN p < 0.3 THEN 'Bajo' WHEN p < 0.6 THEN 'Medio' ELSE 'Alto' END AS nivel_riesgo
        FROM (SELECT week_start, unit_id, CAST(printf('%.4f', p) AS DOUBLE) AS p FROM scored)""",
    "fallback_band": """SELECT unit_id, coalesce(
        CASE WHEN p < 0.3 THEN 'Bajo' WHEN p < 0.6 THEN 'Medio' WHEN p IS NOT NULL THEN 'Alto' END,
        CASE WHEN n_eventos > 0 THEN CASE WHEN indice_riesgo > 1000 THEN 'Alto'
             WHEN indice_riesgo > 200 THEN 'Medio' ELSE 'Bajo' END END,
        CASE WHEN up_area > 8000 OR ord >= 5 THEN 'Medio' WHEN up_area > 1000 OR ord >= 3
             THEN 'Bajo-Medio' ELSE 'Bajo' END) AS nivel
        FROM indexed LEFT JOIN (SELECT unit_id, p FROM scored WHERE week_start =
          (SELECT max(week_start) FROM scored)) USING (unit_id)""",
    "weekly_dataset": f"""SELECT r.week_start, {", ".join(RAIN_FEATURES)}, soil_moisture_14d,
        CAST(coalesce(n, 0) AS BIGINT) AS n_deslizamientos FROM rain r
        LEFT JOIN soil s ON r.week_start = s.week_start
        LEFT JOIN (SELECT week_start, sum(n) AS n FROM hazard_week GROUP BY 1) c
          ON r.week_start = c.week_start""",
    "weekly_training_set": f"""WITH w AS (SELECT r.week_start, {", ".join(RAIN_FEATURES)}, soil_moisture_14d,
          CAST(coalesce(n, 0) AS BIGINT) AS n_deslizamientos FROM rain r
          LEFT JOIN soil s ON r.week_start = s.week_start
          LEFT JOIN (SELECT week_start, sum(n) AS n FROM hazard_week GROUP BY 1) c ON r.week_start = c.week_start),
        t AS (SELECT *, CAST(lead(n_deslizamientos) OVER (ORDER BY week_start) > 0 AS INTEGER) AS deslizamiento FROM w)
        SELECT * FROM t WHERE year(week_start) BETWEEN 1996 AND 2000 AND deslizamiento IS NOT NULL
          AND soil_moisture_14d IS NOT NULL AND {" AND ".join(f"{f} IS NOT NULL" for f in RAIN_FEATURES)}""",
    "panel_enriched": "SELECT * FROM enriched",
    "geocode": """SELECT id, place, round(lon, 6) AS lon, round(lat, 6) AS lat, pop FROM
        (SELECT c_custkey AS id, 'nacion' || c_nationkey AS place FROM customer)
        JOIN place USING (place)""",
    "geocode_rate": """SELECT count(*) AS n_eventos, count(pop) AS n_con_coord,
        count(*) - count(pop) AS n_sin_coord, round(count(pop) / count(*), 6) AS tasa FROM
        (SELECT 'nacion' || c_nationkey AS place FROM customer) LEFT JOIN place USING (place)""",
    "point_in_polygon": "SELECT id, unit_id FROM located",
    "bbox_prune": """SELECT unit_id FROM diamond, (SELECT avg(lon) x0, max(lon) x1, min(lat) y0,
        avg(lat) y1 FROM pt WHERE lon > 0 AND lat < 0)
        WHERE cx - half <= x1 AND cx + half >= x0 AND cy - half <= y1 AND cy + half >= y0""",
    "panel_grid": "SELECT * FROM grid",
    "pseudo_absence": "SELECT * FROM selected",
    "inactive_units": """SELECT unit_id FROM unit WHERE unit_id NOT IN
        (SELECT unit_id FROM hazard)""",
    "unit_population": "SELECT unit_id, poblacion_estimada FROM populated",
    "daily_station": """SELECT fecha, sum(precip_mm) AS precip_diaria, count(*) AS n_estaciones
        FROM station GROUP BY 1""",
    "weekly_events": """SELECT week_start, CAST(sum(n) AS BIGINT) AS n_deslizamientos
        FROM hazard_week GROUP BY 1""",
    "weekly_coverage": """SELECT CAST(date_trunc('week', fecha) AS DATE) AS week_start,
        count(*) AS n_dias, round(avg(mm), 6) AS precip_media, max(mm) AS precip_max,
        round(least(100, count(*) / 7 * 100), 6) AS cobertura_pct FROM daily GROUP BY 1""",
    "low_coverage": """WITH c AS (SELECT CAST(date_trunc('week', fecha) AS DATE) AS week_start, avg(n) AS cobertura
          FROM (SELECT fecha, count(*) AS n FROM station GROUP BY 1) GROUP BY 1)
        SELECT week_start, round(cobertura, 6) AS cobertura, round(umbral, 6) AS umbral FROM c,
          (SELECT quantile_cont(cobertura, 0.25) AS umbral FROM c) WHERE cobertura < umbral""",
    "csv_round_trip": """SELECT fecha, departamento, count(*) AS n, sum(precip_mm) AS precip_mm
        FROM station GROUP BY 1, 2""",
    "panel_round_trip": """SELECT *, strftime(week_start, '%Y-%m-%d') || '/' || strftime(week_start + 6, '%Y-%m-%d')
        AS anio_semana FROM grid""",
    "log_round_trip": """SELECT user_id AS hybas_id, CASE WHEN least(value / 500, 1.0) < 0.3 THEN 'Bajo'
          WHEN least(value / 500, 1.0) < 0.6 THEN 'Medio' ELSE 'Alto' END AS nivel_riesgo,
        2 * count(*) AS n, count(DISTINCT event_id) AS n_eventos FROM events GROUP BY 1, 2""",
    "resumed_days": """SELECT fecha, coalesce(mm, 0.0) AS precip_mm FROM (SELECT CAST(unnest(generate_series(
          TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS fecha)
        FULL JOIN gapped USING (fecha)""",
    "feature_order": """SELECT unit_id, sub_area, CAST(NULL AS DOUBLE) AS soil_moisture_14d, up_area,
        CAST(ord AS DOUBLE) AS ord FROM unit""",
    "priority_filtered": """SELECT unit_id, nivel_riesgo, n_eventos, round(score, 6) AS score FROM prioritised
        WHERE nivel_riesgo IN ('Alto', 'Medio') AND n_eventos > 0""",
    "quality_gate": """SELECT CAST(sum(deslizamiento) AS BIGINT) AS n_pos,
        count(DISTINCT week_start) AS n_weeks, round(count(DISTINCT week_start) / (52 * 7), 6) AS coverage,
        count(*) FILTER (deslizamiento NOT IN (0, 1)) AS n_invalid, '' AS null_features,
        sum(deslizamiento) >= 50 AND count(DISTINCT week_start) / (52 * 7) >= 0.8 AS ok FROM selected""",
    "class_balance": """SELECT count(*) AS n, CAST(sum(deslizamiento) AS BIGINT) AS n_pos,
        CAST(sum(1 - deslizamiento) AS BIGINT) AS n_neg,
        round(100 * sum(deslizamiento) / count(*), 6) AS pct_pos,
        round(sum(1 - deslizamiento) / sum(deslizamiento), 6) AS ratio FROM grid""",
    "feature_summary": f"""SELECT feature, count(*) AS n, round(avg(value), 6) AS mean,
        round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max,
        round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
        round(quantile_cont(value, 0.75), 6) AS p75
        FROM ({_long("enriched", (*RAIN_FEATURES, "up_area", "sub_area"))}) GROUP BY 1""",
    "null_profile": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(*) FILTER ({f} IS NULL) AS n_missing,"
        f" round(count(*) FILTER ({f} IS NULL) * 100 / count(*), 6) AS pct FROM enriched"
        for f in RAIN_FEATURES
    ),
    "daily_coverage": """SELECT CAST(max(fecha) - min(fecha) AS BIGINT) AS dias_totales,
        count(DISTINCT fecha) AS dias_con_datos,
        round(count(DISTINCT fecha) / (max(fecha) - min(fecha)), 6) AS pct_cobertura FROM station""",
    "event_breakdown": """SELECT evento, anio, mes, departamento, count(*) AS n FROM (
        SELECT evento, lower(departamento) AS departamento,
          CAST(year(TRY_CAST(fecha_txt AS DATE)) AS INTEGER) AS anio,
          CAST(month(TRY_CAST(fecha_txt AS DATE)) AS INTEGER) AS mes FROM station_raw
        WHERE TRY_CAST(fecha_txt AS DATE) IS NOT NULL
          AND regexp_matches(lower(evento), 'urgent|high|low'))
        GROUP BY GROUPING SETS ((evento), (anio), (mes), (departamento))""",
    "top_departments": """SELECT departamento, count(*) AS n FROM station GROUP BY 1
        ORDER BY n DESC, departamento LIMIT 10""",
    "monthly_mean": """SELECT strftime(fecha, '%Y-%m') AS anio_mes, round(avg(precip_mm), 6) AS precip_media
        FROM station GROUP BY 1""",
    "confusion": f"""SELECT fold, tp, fp, fn, tn, round(recall, 6) AS recall,
        round(precision, 6) AS precision, round(f1, 6) AS f1, round(fpr, 6) AS fpr FROM
        {_rates("(SELECT fold, p, y FROM fold_scored UNION ALL SELECT 0, p, y FROM fold_scored)", "fold")}""",
    "binary_metrics": f"""SELECT tp, fp, fn, tn, round(recall, 6) AS recall,
        round(precision, 6) AS precision, round(f1, 6) AS f1, round(fpr, 6) AS fpr
        FROM {_rates("scored")}""",
    "roc_auc": f"SELECT auc AS auc_roc, n_pos, n_neg FROM {_auc('scored')}",
    "full_grid_metrics": "SELECT * FROM "
    + _full("(SELECT * FROM scored WHERE year(week_start) BETWEEN 1999 AND 2001)"),
    "baseline_scores": "SELECT * FROM " + _full(f"""(SELECT deslizamiento AS y,
        CAST({_hash_code(42)} / 4294967296.0::DOUBLE < (SELECT avg(deslizamiento) FROM selected) AS INTEGER)::DOUBLE AS p
        FROM grid)"""),
    "prepared_rows": f"""WITH t AS (SELECT * FROM training),
        {", ".join(_standardised(f) for f in _PREPARED)}
        SELECT week_start, unit_id, CAST(deslizamiento AS DOUBLE) AS label,
          round((SELECT count(*) FROM t) / (2.0::DOUBLE * (SELECT count(*) FROM t x WHERE x.deslizamiento = t.deslizamiento)), 6)
            AS weight, {", ".join(f"round((coalesce({f}, s_{f}.med) - s_{f}.m) / s_{f}.sd, 6) AS {f}" for f in _PREPARED)}
        FROM t, {", ".join(f"s_{f}" for f in _PREPARED)}""",
    "bag_members": f"""SELECT week_start, unit_id, CAST(deslizamiento AS DOUBLE) AS label FROM (
        SELECT *, row_number() OVER (PARTITION BY deslizamiento ORDER BY {_hash_code(42)}, week_start, unit_id) AS r FROM selected)
        WHERE deslizamiento = 1 OR r <= (SELECT sum(deslizamiento) FROM selected)""",
    "bag_masks": f"""WITH b AS (SELECT *, {", ".join(f"(deslizamiento = 1 OR row_number() OVER (PARTITION BY deslizamiento "
          f"ORDER BY {_hash_code(42 + i)}, week_start, unit_id) <= (SELECT sum(deslizamiento) FROM selected))::BIGINT AS b{i}, "
          f"{_hash_code(1000 + i)} / 4294967296.0::DOUBLE AS s{i}" for i in range(5))} FROM selected)
        SELECT week_start, unit_id, CAST(deslizamiento AS DOUBLE) AS label, {" + ".join(f"b{i} * {1 << i}" for i in range(5))} AS mascara,
          round(({" + ".join(f"(1 - b{i}) * s{i}" for i in range(5))}) / nullif({" + ".join(f"(1 - b{i})" for i in range(5))}, 0), 6)
            AS fuera_de_bolsa FROM b""",
    "bootstrap_draws": f"""SELECT week_start, unit_id, {", ".join("(" + " + ".join(
          f"({_hash_code(42 + i)} / 4294967296.0::DOUBLE >= {c!r}::DOUBLE)::INTEGER" for c in _POISSON) + f") AS arbol_{i}" for i in range(3))}
        FROM selected""",
    "pr_curve": f"""SELECT round(threshold, 6) AS threshold, tp, fp,
        round({_ratio("tp", "tp + fp")}, 6) AS precision, round(tp / total, 6) AS recall FROM (
        SELECT p AS threshold, CAST(sum(sum(y)) OVER (ORDER BY p DESC) AS BIGINT) AS tp,
          CAST(sum(sum(1 - y)) OVER (ORDER BY p DESC) AS BIGINT) AS fp FROM scored GROUP BY p),
        (SELECT CAST(sum(y) AS DOUBLE) AS total FROM scored)""",
    "pr_auc": """SELECT round(sum((recall - r0) * (precision + p0) / 2), 6) AS pr_auc,
        count(*) AS n_thresholds FROM (
        SELECT recall, precision, lag(recall, 1, 0.0) OVER (ORDER BY p DESC) AS r0,
          lag(precision, 1, 1.0) OVER (ORDER BY p DESC) AS p0 FROM (
          SELECT p, tp / total AS recall, tp / CAST(tp + fp AS DOUBLE) AS precision FROM (
            SELECT p, sum(sum(y)) OVER (ORDER BY p DESC) AS tp, sum(sum(1 - y)) OVER (ORDER BY p DESC) AS fp
            FROM scored GROUP BY p), (SELECT CAST(sum(y) AS DOUBLE) AS total FROM scored)))""",
    "fold_summary": f"""SELECT round(avg(auc_raw), 6) AS auc_roc_mean, round(avg(f1), 6) AS f1_mean,
        round(avg(precision), 6) AS precision_mean, round(avg(recall), 6) AS recall_mean,
        round(stddev_pop(auc_raw), 6) AS auc_roc_std, round(stddev_pop(f1), 6) AS f1_std,
        round(stddev_pop(precision), 6) AS precision_std, round(stddev_pop(recall), 6) AS recall_std
        FROM {_rates("fold_scored", "fold")} JOIN
        {_auc("fold_scored", "fold").replace(", 6) AS auc", ", 15) AS auc_raw", 1)} USING (fold)""",
    "score_hist": """SELECT desde, hasta, count(*) AS n, count(*) FILTER (y = 1) AS n_pos,
        count(*) FILTER (y = 0) AS n_neg FROM scored JOIN (VALUES (0.0::DOUBLE, 0.1::DOUBLE),
        (0.1, 0.3), (0.3, 0.5), (0.5, 0.7), (0.7, 0.9), (0.9, 1.0)) b(desde, hasta)
        ON p >= desde AND (p < hasta OR hasta = 1 AND p = 1) GROUP BY 1, 2""",
    "separability": """WITH s AS (SELECT deslizamiento AS clase, precip_acum_14d AS v FROM selected
          JOIN rain USING (week_start) WHERE precip_acum_14d IS NOT NULL)
        SELECT clase, count(*) AS n, min(v) AS minimo, max(v) AS maximo,
          round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS mediana,
          round(quantile_cont(v, 0.75), 6) AS p75,
          (SELECT min(v) FROM s WHERE clase = 1) <= (SELECT max(v) FROM s WHERE clase = 0) AS solapan
        FROM s GROUP BY clase""",
    "active_units": """SELECT activa, count(*) AS n_unidades, round(median(sub_area), 6) AS mediana_area
        FROM (SELECT sub_area, unit_id IN (SELECT unit_id FROM hazard)
              AS activa FROM unit) GROUP BY 1""",
    "proxy_guard": """SELECT caso, w AS all_whole, m AS max_value, w AND m < 20 AS is_proxy FROM (
        SELECT 'lluvia' AS caso, coalesce(bool_and(coalesce(precip_acum_14d % 1 = 0, FALSE)), TRUE) AS w,
          max(precip_acum_14d) AS m FROM rain
        UNION ALL SELECT 'lluvia_sin_nulos', coalesce(bool_and(precip_acum_14d % 1 = 0), TRUE),
          max(precip_acum_14d) FROM rain
        UNION ALL SELECT 'conteos', TRUE, max(CAST(n AS DOUBLE)) FROM hazard_week)""",
    "drift_reference": """SELECT feature, count(*) AS n, round(avg(value), 6) AS mean,
        round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.25), 6) AS p25,
        round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75
        FROM before_long WHERE week_start < DATE '1999-01-01' GROUP BY 1""",
    "ks_state": """SELECT feature, round(estadistico_ks, 6) AS estadistico_ks, n_referencia,
        n_produccion, round(p_value, 6) AS p_value, p_value < 0.05 AS drift FROM drift_tested""",
    "resumed_store": """SELECT fecha, coalesce(CAST(mm AS DOUBLE), 0.0) AS precip_mm FROM (SELECT CAST(unnest(generate_series(
          TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS fecha)
        FULL JOIN gapped USING (fecha)""",
    "ks_drift": """SELECT feature, round(estadistico_ks, 6) AS estadistico_ks, n_referencia,
        n_produccion, round(p_value, 6) AS p_value, p_value < 0.05 AS drift FROM drift_tested""",
    "drift_features": """SELECT coalesce(bool_or(p_value < 0.05), FALSE) AS drift_detectado,
        coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (p_value < 0.05), '')
          AS features_con_drift FROM drift_tested""",
    "weekly_rain_features": "SELECT * FROM rain_by_unit",
    "weekly_station_features": "SELECT * FROM rain_by_station",
    "interpolate_daily": _interpolated("gapped", None, "soil_moisture_m3m3"),
    "interpolate_by_unit": _interpolated("unit_daily", "unit_id", "precip_mm"),
    "weekly_soil_features": "SELECT * FROM soil",
    "soil_by_unit": "SELECT * FROM soil_of_unit",
    "target_next_week": """SELECT week_start, n_deslizamientos,
        CAST(lead(n_deslizamientos) OVER (ORDER BY week_start) > 0 AS INTEGER) AS deslizamiento
        FROM (SELECT week_start, coalesce(n, 0) AS n_deslizamientos FROM rain LEFT JOIN (
          SELECT CAST(date_trunc('week', fecha) AS DATE) AS week_start, count(*) AS n FROM hazard
          GROUP BY 1) USING (week_start))""",
    "target_by_unit": """SELECT week_start, unit_id, deslizamiento FROM (SELECT week_start, unit_id,
        lead(deslizamiento) OVER (PARTITION BY unit_id ORDER BY week_start) AS deslizamiento
        FROM selected) WHERE deslizamiento IS NOT NULL""",
    "monthly_features": "SELECT * FROM monthly",
    "panel_folds": "SELECT * FROM fold_of_selected",
    "window_audit": """SELECT week_start,
        (SELECT count(*) FROM daily WHERE fecha BETWEEN fin - 13 AND fin
          AND CAST(date_trunc('week', fecha) AS DATE) = week_start) AS dias_semana,
        (SELECT count(*) FROM daily WHERE fecha BETWEEN fin - 13 AND fin
          AND CAST(date_trunc('week', fecha) AS DATE) = week_start - 7) AS dias_semana_previa
        FROM (SELECT CAST(date_trunc('week', fecha) AS DATE) AS week_start, max(fecha) AS fin
              FROM daily GROUP BY 1)""",
    "fold_report": """SELECT fold, side, min(week_start) AS desde, max(week_start) AS hasta,
        count(DISTINCT week_start) AS n_semanas, count(*) AS n_filas,
        CAST(sum(deslizamiento) AS BIGINT) AS n_pos
        FROM selected JOIN fold_of_selected USING (week_start) GROUP BY 1, 2""",
    "fold_overlap": "SELECT 0 * count(*) AS n_solapadas FROM lineitem",
    "top_impact": """(SELECT 'costo_m_cop' AS lista, unit_id, n_eventos, fallecidos,
          round(costo_m_cop, 6) AS costo_m_cop, round(indice_riesgo, 6) AS indice_riesgo FROM indexed
          WHERE costo_m_cop > 0 ORDER BY indexed.costo_m_cop DESC, unit_id LIMIT 20)
        UNION ALL (SELECT 'indice_riesgo', unit_id, n_eventos, fallecidos, round(costo_m_cop, 6),
          round(indice_riesgo, 6) FROM indexed WHERE indice_riesgo > 0
          ORDER BY indexed.indice_riesgo DESC, unit_id LIMIT 20)
        UNION ALL (SELECT 'fallecidos', unit_id, n_eventos, fallecidos, round(costo_m_cop, 6),
          round(indice_riesgo, 6) FROM indexed WHERE fallecidos > 0
          ORDER BY fallecidos DESC, unit_id LIMIT 10)""",
    "top_places": f"""SELECT 'u' || unit_id AS municipio, {", ".join(f"sum({c}) AS {c}" for c in CONSEQUENCES)},
        count(*) AS n_eventos FROM hazard GROUP BY unit_id
        ORDER BY sum(fallecidos) DESC, municipio LIMIT 10""",
    "priority_score": """SELECT unit_id, p, nivel_riesgo, n_eventos, fallecidos,
        round(costo_m_cop, 6) AS costo_m_cop, poblacion_estimada,
        round(indice_riesgo, 6) AS indice_riesgo, round(score, 6) AS score FROM prioritised""",
    "priority_top": """SELECT unit_id, nivel_riesgo, round(score, 6) AS score FROM prioritised
        ORDER BY prioritised.score DESC, unit_id LIMIT 10""",
    "historic_top": """SELECT unit_id, round(least(indice_riesgo / 5000, 0.99), 6) AS p,
        'Alto' AS nivel_riesgo, n_eventos, round(costo_m_cop, 6) AS costo_m_cop,
        round(indice_riesgo / 5000, 6) AS score FROM indexed WHERE indice_riesgo > 1000
        ORDER BY indice_riesgo DESC, unit_id LIMIT 10""",
    "historic_band_counts": """SELECT count(*) FILTER (indice_riesgo > 1000) AS alto,
        count(*) FILTER (indice_riesgo > 200 AND indice_riesgo <= 1000) AS medio,
        count(*) FILTER (indice_riesgo <= 200) AS bajo FROM indexed""",
    "best_candidate": """SELECT modelo, auc_roc_full, precision_full FROM candidate_metrics
        WHERE modelo <> 'baseline_dummy' ORDER BY auc_roc_full DESC, modelo LIMIT 1""",
    "norm_text": """SELECT doc_id, md5(t) AS norm_md5,
        length(trim(regexp_replace(t, '[^\\x00-\\x7F]', '', 'g'), ' ')) AS ascii_len,
        length(replace(replace(trim(t, ' '), ' ', ''), '-', '')) AS key_len
        FROM (SELECT doc_id, strip_accents(lower(text)) AS t FROM documents)""",
    "calendar_parts": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha,
        CAST(weekofyear(o_orderdate) AS BIGINT) AS semana_iso, CAST(isoyear(o_orderdate) AS BIGINT) AS anio_iso,
        CAST(month(o_orderdate) AS BIGINT) AS mes, strftime(o_orderdate, '%Y-%m') AS anio_mes,
        CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
        strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') || '/'
          || strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS semana,
        strftime(o_orderdate, '%G-W%V') AS etiqueta_iso FROM orders""",
    "season_client": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha,
        round(sin(2 * pi() * ceil(dayofyear(o_orderdate) / 7) / 52), 6) AS semana_sin,
        round(cos(2 * pi() * ceil(dayofyear(o_orderdate) / 7) / 52), 6) AS semana_cos,
        round(sin(2 * pi() * month(o_orderdate) / 12), 6) AS mes_sin,
        round(cos(2 * pi() * month(o_orderdate) / 12), 6) AS mes_cos FROM orders""",
    "corr_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM monthly_target"
        for i, a in enumerate(_CORRELATED)
        for b in _CORRELATED[i + 1 :]
    ),
    "point_biserial": _ranked("r", " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count({f}) AS n, corr({f}, target) AS r FROM monthly_target"
        for f in _MONTHLY
    )),
    "spearman": _ranked("rho", " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, count(*) AS n, corr(a, b) AS rho FROM (
        SELECT rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0 AS a,
          rank() OVER (ORDER BY target) + (count(*) OVER (PARTITION BY target) - 1) / 2.0 AS b
        FROM monthly_target WHERE {f} IS NOT NULL)"""
        for f in _MONTHLY
    )),
    "mann_whitney": f"""WITH ranks AS (SELECT y, rank() OVER (ORDER BY precip_acum_14d)
          + (count(*) OVER (PARTITION BY precip_acum_14d) - 1) / 2 AS r
        FROM scored WHERE precip_acum_14d IS NOT NULL),
        tied AS (SELECT sum(CAST(c AS DOUBLE) * c * c - c) AS ties FROM (
          SELECT count(*) AS c FROM scored WHERE precip_acum_14d IS NOT NULL GROUP BY precip_acum_14d)),
        u AS (SELECT sum(1 - y)::BIGINT AS n0, sum(y)::BIGINT AS n1,
          CAST(sum(CASE WHEN y = 0 THEN r END) - sum(1 - y) * (sum(1 - y) + 1) / 2 AS DOUBLE) AS u FROM ranks),
        z AS (SELECT n0, n1, u, greatest(0.0, (abs(u - CAST(n0 AS DOUBLE) * n1 / 2) - 0.5) / sqrt(CAST(n0 AS DOUBLE) * n1 / 12
          * ((n0 + n1 + 1) - ties / (CAST(n0 + n1 AS DOUBLE) * (n0 + n1 - 1))))) AS z FROM u, tied)
        SELECT n0, n1, u, round({_normal_p("z")}, 6) AS p_value FROM z""",
    "roc_curve": """SELECT round(p, 6) AS threshold, round(tp / sum(pos) OVER (), 6) AS tpr,
        round(fp / sum(neg) OVER (), 6) AS fpr FROM (SELECT p, pos, neg,
          CAST(sum(pos) OVER (ORDER BY p DESC) AS DOUBLE) AS tp, CAST(sum(neg) OVER (ORDER BY p DESC) AS DOUBLE) AS fp
          FROM (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p))""",
    "average_rank": """SELECT DISTINCT sub_area, count(*) OVER (PARTITION BY sub_area) AS n_rows,
        rank() OVER (ORDER BY sub_area) + (count(*) OVER (PARTITION BY sub_area) - 1) / 2 AS avg_rank
        FROM unit""",
    "year_mix": """SELECT CAST(year(fecha) AS INTEGER) AS anio,
        round(sum(fallecidos) * 100 / (sum(fallecidos) + sum(heridos) + sum(viviendas_destruidas)), 6) AS fallecidos,
        round(sum(heridos) * 100 / (sum(fallecidos) + sum(heridos) + sum(viviendas_destruidas)), 6) AS heridos,
        round(sum(viviendas_destruidas) * 100 / (sum(fallecidos) + sum(heridos) + sum(viviendas_destruidas)), 6)
          AS viviendas_destruidas FROM hazard GROUP BY 1""",
    "impact_totals": f"""WITH h AS (SELECT fallecidos, CASE WHEN heridos = 4 THEN 0.0 ELSE heridos END AS heridos,
          desaparecidos, personas, familias, viviendas_destruidas, viviendas_averiadas FROM hazard)
        SELECT count(*) AS n_eventos, {", ".join(f"sum({c}) AS {c}" for c in CONSEQUENCES)},
          sum({_COST}) AS costo_cop, round(sum({_COST}) / count(*), 6) AS costo_por_evento,
          round(sum({_COST}) / 4100, 6) AS costo_usd FROM h""",
    "impact_by_year": """SELECT CAST(year(fecha) AS INTEGER) AS anio, count(*) AS n_eventos,
        sum(fallecidos) AS fallecidos, sum(personas) AS personas,
        sum(viviendas_destruidas) AS viviendas_destruidas FROM hazard GROUP BY 1""",
    "impact_by_unit": f"SELECT unit_id, n_eventos, {', '.join(CONSEQUENCES)} FROM by_unit",
    "monetise": "SELECT unit_id, costo_cop, round(costo_cop / 1e6, 6) AS costo_m_cop FROM by_unit",
    "risk_index": """SELECT unit_id, n_eventos, poblacion_estimada,
        round(indice_riesgo, 6) AS indice_riesgo FROM indexed""",
    "threshold_sweep": """SELECT round(umbral, 6) AS umbral, tp, fp, fn, round(recall, 6) AS recall,
        round(precision, 6) AS precision, tp_real, fp_real, bcr FROM swept""",
    "best_threshold": """SELECT round(umbral, 6) AS umbral, bcr FROM swept
        ORDER BY bcr DESC, swept.umbral LIMIT 1""",
    "bcr_scenarios": f"""SELECT f AS factor_reduccion, tp, fp, fn,
        round({_bcr("tp", "fp", "fn", "f")[0]} / 1e6, 6) AS beneficio_m_cop,
        round({_bcr("tp", "fp", "fn", "f")[1]}, 3) AS bcr,
        {_bcr("tp", "fp", "fn", "f")[1]} >= 1 AS rentable
        FROM (SELECT tp, CASE WHEN precision > 0 THEN round_even(tp * (1 - precision) / precision, 0)
                ELSE 0.0 END AS fp, n_ev - tp AS fn, base, unit
              FROM (SELECT round_even(recall * n_ev, 0) AS tp, precision, n_ev, base, unit
                    FROM {_rates("scored")} CROSS JOIN past))
        CROSS JOIN (SELECT unnest([0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS f)""",
    "bcr_topn": f"""SELECT n_alertas, aciertos, falsas_alarmas, round(recall, 6) AS recall,
        round(precision, 6) AS precision,
        round({_bcr("tp", "falsas_alarmas", "n_ev - tp", "0.4::DOUBLE")[1]}, 3) AS bcr
        FROM (SELECT *, round_even(recall * n_ev, 0) AS tp FROM (
          SELECT n_alertas, aciertos, falsas_alarmas,
            {_ratio("aciertos", "(SELECT sum(y) FROM scored)")} AS recall,
            {_ratio("aciertos", "aciertos + falsas_alarmas")} AS precision
          FROM (SELECT n_alertas, count(*) FILTER (y = 1) AS aciertos,
                  count(*) FILTER (y = 0) AS falsas_alarmas
                FROM (SELECT y, row_number() OVER (PARTITION BY week_start ORDER BY p DESC, unit_id) AS r
                      FROM scored)
                JOIN (SELECT CAST(unnest([10, 20, 50, 91, 100, 150, 200]) AS INTEGER) AS n_alertas)
                  ON r <= n_alertas GROUP BY 1)) CROSS JOIN past)""",
    "class_weights": """SELECT deslizamiento AS clase, count(*) AS n,
        round((SELECT count(*) FROM selected) / (2.0 * count(*)), 6) AS peso FROM selected GROUP BY 1""",
    "promotion_check": """SELECT modelo, auc_roc_full, precision_full,
        auc_roc_full >= 0.6 AND precision_full >= 0.006 AS promovido,
        concat_ws(' | ', CASE WHEN auc_roc_full < 0.6 THEN printf('AUC %.4f < 0.6', auc_roc_full) END,
          CASE WHEN precision_full < 0.006 THEN printf('Precision %.4f < 0.006', precision_full) END) AS razon
        FROM candidate_metrics""",
    "stream_band_counts": """SELECT CAST(ts AS DATE) AS dia,
        CASE WHEN least(value / 500, 1.0) < 0.3 THEN 'Bajo' WHEN least(value / 500, 1.0) < 0.6
             THEN 'Medio' ELSE 'Alto' END AS nivel_riesgo, count(*) AS n FROM events GROUP BY 1, 2""",
}

ORACLES = {name: _statement(body) for name, body in _BODIES.items()}
