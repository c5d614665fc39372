"""Registered queries against their SQL twins on the smallest tables.

QUERIES=all runs every one of them; by default a selection that touches each
operator family.  ``python -m suite.check`` does the same for any scale.
"""

import os

import pytest

import __spark_entry__ as entry
from suite.check import compare, connect

SF = "/root/testdata/sf0.001"
DEFAULT = [
    "scan_pipe_csv", "scan_rejects", "scan_ledger_mixed_headers", "load_years", "project_cast", "bounds_two_sided",
    "filter_funnel", "stage_sizes", "source_lookup_filter", "ledger_join", "label_policy_always_late", "near_constant",
    "top_values", "distinct_counts_by", "late_rate_levels", "histogram_bins", "correlation_matrix", "winsorize",
    "woe_fit_apply", "woe_large_table", "one_hot_discover", "one_hot_vector", "history_hot_accounts",
    "classifier_features", "backtest_features", "lateness_rows", "split_stratified", "gain_lift",
    "train_score_classifier", "classifier_thresholds", "classifier_gain_lift", "feature_importance",
    "multiclass_confusion", "multiclass_scores", "days_report",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("QUERIES") == "all" else DEFAULT

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, con, entry.oracle_sql()[name]) is None
    spark.catalog.clearCache()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
