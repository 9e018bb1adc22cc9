"""A cross-section of the registered queries against their SQL on the smallest tables.

``tests/compare.py`` does the same for all of them at any scale.
"""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, duck

CHECKED = (
    "feed_records month_extracts week_document geojson_features bbox_daily_mean prediction_log station_clean keyword_filter "
    "panel_enriched geocode point_in_polygon basin_points basin_tiles basin_clip basin_geojson pseudo_absence quality_gate confusion roc_auc "
    "score_hist weekly_rain_features interpolate_daily weekly_soil_features panel_folds "
    "priority_export norm_text monetise threshold_sweep bcr_topn ks_drift spearman"
).split()


@pytest.fixture(scope="module")
def con(tiny):
    return duck(tiny)


def test_every_statement_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) > 100


def test_entry(spark):
    df = entry(spark)
    assert {"week_start", "unit_id", "precip_acum_14d", "deslizamiento"} <= set(df.columns)
    assert df.count() == 10 * df.select("week_start").distinct().count()


@pytest.mark.parametrize("name", CHECKED)
def test_same_as_sql(spark, con, tiny, name):
    text, good = compare(spark, con, queries()[name], oracle_sql()[name], tiny)
    assert good, text
