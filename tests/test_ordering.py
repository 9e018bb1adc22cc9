"""Ordered operators against brute force, with a third of all rows under one value or key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwatch.operators import ordering as o


@pytest.fixture(scope="module")
def rows(spark):
    hot = F.col("id") % 3 == 0
    df = spark.range(6_000).select(
        "id",
        F.when(hot, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(700)) / 7.0).alias("v"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("k"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) == 0).cast("int").alias("y"),
    )
    return df, df.toPandas()


@pytest.mark.parametrize("bits", [1, 3, 7])
def test_running_sums(rows, bits):
    df, p = rows
    got = o.cumulative_by_value(df, "v", ["y"], bits=bits).toPandas().sort_values("v")
    want = p.groupby("v").y.sum().sort_index()
    assert got.v.tolist() == want.index.tolist()
    assert got.y_cum.tolist() == want.cumsum().tolist()
    assert set(got.y_total) == {want.sum()}


def test_running_sums_by_key(rows):
    df, p = rows
    got = o.cumulative_by_value(df, "v", ["y"], ["k"]).toPandas().sort_values(["k", "v"])
    want = p.groupby(["k", "v"]).y.sum().groupby(level=0).cumsum()
    assert got.y_cum.tolist() == want.tolist()


def test_quantiles(rows):
    df, p = rows
    qs = {"a": 0.25, "b": 0.5, "c": 0.9, "lo": 0.0, "hi": 1.0}
    got = o.exact_quantiles(df, "v", qs, ["k"]).toPandas().set_index("k").sort_index()
    for name, q in qs.items():
        np.testing.assert_allclose(got[name], p.groupby("k").v.quantile(q).sort_index(), atol=1e-12)


def test_quantile_of_nothing_and_one(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert o.exact_quantiles(empty, "v", {"m": 0.5}).first()["m"] is None
    one = spark.createDataFrame([(4.0,), (None,)], "v double")
    assert o.exact_quantiles(one, "v", {"m": 0.25}).first()["m"] == 4.0


def test_average_ranks(rows):
    df, p = rows
    got = o.average_ranks(df, "v").toPandas().set_index("v").avg_rank.sort_index()
    want = p.v.rank().groupby(p.v).first().sort_index()
    np.testing.assert_allclose(got, want)


@pytest.mark.parametrize("descending", [True, False])
def test_global_rank(rows, descending):
    df, p = rows
    got = o.with_global_rank(df, "v", "id", descending).toPandas().sort_values("rank")
    want = p.sort_values(["v", "id"], ascending=[not descending, True])
    assert got["rank"].tolist() == list(range(1, len(p) + 1))
    assert got.id.tolist() == want.id.tolist()


def test_top_k_per_group(rows):
    df, p = rows
    got = o.top_k_per_group(df, ["k"], [F.desc("v"), F.asc("id")], 7, ["id"]).toPandas()
    want = p.sort_values(["v", "id"], ascending=[False, True]).groupby("k").head(7)
    assert set(got.id) == set(want.id)
    assert got.groupby("k")["rank"].max().eq(7).all()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_keeps_every_row_once(spark, rows, how):
    df, p = rows
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3)], "k string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = o.salted_join(df, lookup, ["k"], ["id"], how).toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = p.merge(pd.DataFrame({"k": ["hot", "k1", "k1"], "w": [1, 2, 3]}), on="k", how=how)
    assert len(got) == len(want)
    assert got.groupby("k").w.sum().to_dict() == want.groupby("k").w.sum().to_dict()


def test_salted_join_refuses_other_kinds(spark, rows):
    with pytest.raises(ValueError):
        o.salted_join(rows[0], rows[0], ["k"], ["id"], "full")
