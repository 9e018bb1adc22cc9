from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from panelwatch.functions import risk
from panelwatch.functions.calendar import iso_label, parse_week, week_label, week_start, week_year
from panelwatch.functions.columns import ordered_features, pick_column, to_double
from panelwatch.functions.rounding import exact_round, to_fixed
from panelwatch.functions.text import ascii_fold, fold, has_keyword, matches_keyword, place_key


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    "day, week, start",
    [
        ("2018-12-31", 1, date(2018, 12, 31)),
        ("2019-01-01", 1, date(2018, 12, 31)),
        ("2020-12-31", 53, date(2020, 12, 28)),
        ("2021-01-03", 53, date(2020, 12, 28)),
    ],
)
def test_weeks_run_monday_to_sunday(spark, day, week, start):
    d = F.lit(day).cast("date")
    row = one(spark, F.weekofyear(d), week_start(d))
    assert tuple(row) == (week, start)


def test_four_years_have_209_weeks(spark):
    from panelwatch.operators.panel import week_list

    weeks = week_list(F.lit("2019-01-01").cast("date"), F.lit("2022-12-31").cast("date"))
    row = one(spark, F.size(weeks), weeks[0])
    assert tuple(row) == (209, date(2018, 12, 31))


def test_week_year_depends_on_anchor(spark):
    w = F.lit("2018-12-31").cast("date")
    assert tuple(one(spark, week_year(w), week_year(w, "end"))) == (2018, 2019)
    with pytest.raises(ValueError):
        week_year(w, "middle")


def test_labels_round_trip(spark):
    w = F.lit("2021-01-04").cast("date")
    text = one(spark, week_label(w))[0]
    assert text == "2021-01-04/2021-01-10"
    row = one(spark, parse_week(F.lit(text)), parse_week(F.lit("2021-01-07")), parse_week(F.lit("x")))
    assert tuple(row) == (date(2021, 1, 4), date(2021, 1, 4), None)
    assert one(spark, iso_label(F.lit("2021-01-03").cast("date")))[0] == "2020-W53"


def test_folding(spark):
    t = F.lit("  Nación-Ñandú ÀÉ ")
    row = one(spark, fold(t), place_key(t), ascii_fold(F.lit("Ação–x")), place_key(F.lit(None)))
    assert tuple(row) == ("  nacion-nandu ae ", "nacionnanduae", "acaox", "")


def test_decomposed_accents_are_folded_too(spark):
    assert one(spark, fold(F.lit("inundación")))[0] == "inundacion"


def test_keyword_filters_differ_on_accents_and_nulls(spark):
    c = F.lit("Inundación grave")
    row = one(
        spark,
        has_keyword(c, ["inundacion"]),
        matches_keyword(c, ["inundacion"]),
        has_keyword(F.lit(None), ["x"]),
        matches_keyword(F.lit(None).cast("string"), ["x"]),
    )
    assert tuple(row) == (True, False, False, False)


@pytest.mark.parametrize("p, level", [(0.2999, "Bajo"), (0.30, "Medio"), (0.5999, "Medio"), (0.6, "Alto")])
def test_bands(spark, p, level):
    assert one(spark, risk.band(F.lit(p)))[0] == level


def test_rounding_is_half_even(spark):
    row = one(spark, risk.published_probability(F.lit(0.30005)), F.round(F.lit(0.30005), 4))
    assert tuple(row) == (0.3, 0.3001)


def test_rounding_looks_at_the_binary_value(spark):
    import random

    rng = random.Random(1)
    values = [0.30005, 0.30025, 0.125, 0.5, 2.5, 80.05, 50.25, 11836.5, 1.005, 0.0, 0.99995]
    values += [rng.random() * 10 ** rng.randrange(0, 4) for _ in range(300)]
    values += [round(rng.random(), 5) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    v = F.col("v")
    for digits in (0, 1, 4, 6):
        got = df.select(v, exact_round(v, digits), to_fixed(v, digits), to_fixed(-v, digits)).collect()
        for x, rounded, text, negative in got:
            assert rounded == round(x, digits)
            up = Decimal(x).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
            assert text == str(up) and negative == (f"-{up}" if up else str(up))


def test_fallback_bands(spark):
    row = one(
        spark,
        risk.index_band(F.lit(1000.0)),
        risk.index_band(F.lit(None).cast("double")),
        risk.size_band(F.lit(9000.0), F.lit(1)),
        risk.size_band(F.lit(5.0), F.lit(3)),
        risk.size_band(F.lit(None).cast("double"), F.lit(None).cast("int")),
    )
    assert tuple(row) == ("Medio", None, "Medio", "Bajo-Medio", "Bajo")


def test_column_helpers(spark):
    df = spark.createDataFrame([("1.5", 2)], "Valor_Observado string, b int")
    assert pick_column(df, "fecha", "valor") == "Valor_Observado"
    assert pick_column(df, "zzz", required=False) is None
    with pytest.raises(ValueError):
        pick_column(df, "zzz")
    assert ordered_features(df, ["b", "missing"]).first().asDict() == {"b": 2.0, "missing": None}
    row = one(spark, to_double(F.lit("NaN")), to_double(F.lit("n/a")), to_double(F.lit("2")))
    assert tuple(row) == (None, None, 2.0)
