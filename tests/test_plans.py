"""Physical-plan properties that matter at scale, checked on every registered query."""

import pytest

from conftest import SF_SMALL
from fleetsight.plans import registry

# a model fit returns a local table of metrics; the smallest tables have no positives to fit on
NAMES = sorted(set(registry.queries()) - {"train_and_evaluate"})
# their Python is outside the data path: the CSV header probe and the models' fits
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")
LAZY = [n for n in NAMES if n not in {"stream_scores", "csv_ingest", "evaluate_scored", "best_threshold", "downsampled_rows"}]


@pytest.fixture(scope="module")
def plans(spark):
    return {name: executed_plan(registry.queries()[name](spark, SF_SMALL)) for name in NAMES}


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop_join(plans, name):
    assert "CartesianProduct" not in plans[name]
    assert "BroadcastNestedLoopJoin" not in plans[name]


@pytest.mark.parametrize("name", NAMES)
def test_no_python_in_the_returned_plan(plans, name):
    assert not any(node in plans[name] for node in PYTHON)


@pytest.mark.parametrize("name", LAZY)
def test_lazy_queries_read_the_tables_themselves(plans, name):
    """Nothing was run or checkpointed while the query was built."""
    assert "Scan ExistingRDD" not in plans[name] and "parquet" in plans[name]


def test_scan_reads_only_needed_columns(spark):
    df = registry.queries()["model_failure_summary"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_tax" not in plan
