"""Queries against their SQL at the smallest scale; the full comparison is
``python -m riskengine.catalog.check``."""

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

CHECKED = [
    "entry_velocity_rule", "j1_transaction_results", "a9_daily_performance", "q1_feedback_upsert", "v4_constraint_violations",
    "v9_validation_report", "v11_outliers", "v13_constant_features", "a18_amount_histogram", "p18_chronological_split",
    "w1_trailing_window", "w5_segment_velocity", "w8_window_range_skew", "a3_pr_auc_trapezoid", "a6_threshold_sweep",
    "a20_missed_vs_caught",
]


def test_every_comparison_belongs_to_a_query():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and set(CHECKED) <= set(sql)
    assert len(sql) > 100


def test_entry_runs(spark, small):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, small, name):
    from riskengine.catalog.check import compare, connect

    text, _took, ok = compare(spark, connect(small), name, entry.queries()[name], entry.oracle_sql()[name], small)
    assert ok, text
