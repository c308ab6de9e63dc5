"""Every registered query beside its SQL; the rest by their own properties."""

import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare, connect

QUERIES = {query.__name__: query for query in contract.QUERIES}
ORACLES = contract.ORACLES
TRAINED = {
    "lr_scores", "dt_scores", "rf_scores", "saved_model_scores", "predicted_alerts",
    "importances", "importances_by_source", "model_results", "cv_best", "cv_best_linear",
    "cv_best_forest", "grid_search", "rf_scores_cells", "lr_scores_cells", "resumed_results", "run_summary_document",
}


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_contract(spark):
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 24


@pytest.mark.parametrize("name", sorted(set(ORACLES) - TRAINED))
def test_query_equals_its_sql(spark, sf_dir, db, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    assert compare(ours, db.execute(ORACLES[name]).fetchdf()) is None


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_trained_query_equals_the_rule(spark, sf_dir, db, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    assert compare(ours, db.execute(ORACLES[name]).fetchdf()) is None


EAGER = TRAINED | {
    "quantiles_exact", "quantiles_exact_lineitem", "saved_profile", "profile_document_paths",
    "run_log_events",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan_has_no_nested_loop_and_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition, R"):
        assert unwanted not in plan


def test_kept_sketches_shuffle_no_values(spark, sf_dir):
    """However large the sketches are thought to be, their quantiles go to the rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["kept_sketches"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
