"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, database
from vitalgrid.queries.registry import ORACLES, QUERIES

SLICED = [
    "m2_interpolate_backfill",
    "m6_handle_missing",
    "q1_iqr_outliers",
    "t3_expansion_guard",
    "t5_resample_any_width",
    "t6_complete_grid",
    "a9_extrema",
    "a13_box_summary",
    "x2_windows",
    "x23_impute",
    "n2_sustained_threshold",
    "n5_residual_anomaly",
    "n5_residual_report",
    "l3_detect",
    "x26_extract_features",
    "r4_predict",
    "m6_nan",
    "q1_nan",
    "q8_raw_table",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", SLICED)
def test_equals_sql_in_slices(spark, con, sf_dir, name):
    spark.conf.set("spark.vitalgrid.maxSeriesRows", "20")
    try:
        assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None
    finally:
        spark.conf.unset("spark.vitalgrid.maxSeriesRows")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["m2_interpolate_backfill", "n2_sustained_threshold", "x4_mean", "t12_unusual_gaps", "q8_validate_rows"])
def test_one_exchange(spark, sf_dir, name):
    """Chained window operators share one exchange on the keys."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ArrowEvalPython" not in plan
