"""Driver contract: entry() smoke check and Spark-vs-DuckDB agreement on the smallest tables."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
FAST = ["p3_batch_predict", "w13_rsi", "w21_all_indicators", "w9_feature_set", "w28_w30_targets",
        "v1_stock_contract", "a5_column_profile", "s6_bars_payload_roundtrip", "t1_t2_news_sentiment",
        "t3_a2_daily_sentiment", "a10_cross_asset_correlation", "a13_transition_matrix", "k4_ordered_split",
        "a16_regression_metrics", "w33_grouped_rolling", "j2_merge_first_close", "st1_windowed_bars",
        "m1_m2_m3_trees_of_one_split", "m4_m16_ridge_importance", "m18_card_of_ridges", "m13_kmeans_fixed_point", "f3_f6_f7_filters"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and "prediction" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", FAST)
def test_oracle_agreement(spark, con, name):
    ok, msg = compare(spark, con, E.queries(), E.oracle_sql(), name, SF)
    assert ok, msg
