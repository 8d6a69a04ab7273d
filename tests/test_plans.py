"""Shape of the physical plans: what must not be there, and what must be bounded."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from billscope.operators.retries import exhausted_invoices
from billscope.plans.catalog import QUERIES, queries
from billscope.sources.sample import sample_staging

SF = "/root/testdata/sf0.01"
SOURCES = Path(__file__).resolve().parent.parent / "billscope"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", params=["10MB", "-1"], ids=["broadcast", "shuffled"])
def plans(request, spark):
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    built = {name: plan(query(spark, SF)) for name, query in queries().items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
    return built


def test_no_cross_or_nested_loop_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_no_python_in_any_plan(plans):
    for name, text in plans.items():
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|InPandas|InArrow|PythonUDF", text), name


def test_single_partition_steps_follow_an_aggregation(plans):
    """Everything that meets in one task is already one row per month, cohort or reason."""
    for name, text in plans.items():
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert any("Aggregate" in below for below in lines[i + 1 : i + 4]), name


def test_an_event_is_shuffled_once_or_reduced_before(plans):
    text = plans["closing_events"]
    assert "SortAggregate" not in text and "SortAggregate" not in plans["mrr_state"]
    assert text.count("Exchange hashpartitioning(subscription_id") == 2
    all_events, hot_ones = text.split("Exchange hashpartitioning(subscription_id")[1:]
    assert hot_ones.startswith("#") and ", event_month" in hot_ones.splitlines()[0]
    assert ", event_month" not in all_events.splitlines()[0]
    assert "WindowGroupLimit" in hot_ones and "Partial" in hot_ones, "a hot subscription ships a row for each month and task"
    assert "approx_top_k" in text and "Join" not in text


def test_distinct_counts_multiply_no_rows(plans):
    for name in ("mrr_totals", "mrr_rate_of_change"):
        assert "Expand" not in plans[name], name


def test_signup_bound_reaches_the_parquet_scan(plans):
    assert re.search(r"PushedFilters: \[.*LessThan\(o_orderdate", plans["paid_signup_cohort"])


def test_small_invoice_side_prunes_the_charges(spark):
    """A semi join on few invoices stands below the aggregation of the charges."""
    staging = sample_staging(spark, SF)
    few = staging.invoices.filter(F.col("invoice_id") == "7")
    lines = exhausted_invoices(few, staging.charges)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    charges = next(i for i, line in enumerate(lines) if "l_orderkey" in line and "Relation" in line)
    semi = max(i for i, line in enumerate(lines[:charges]) if "Join LeftSemi" in line)
    assert any("Aggregate" in line for line in lines[:semi])
    assert not any("Aggregate" in line for line in lines[semi:charges])


def test_cohort_window_reaches_the_parquet_scan(plans):
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", plans["invoice_cohort"])


def test_movement_pairing_adds_no_shuffle_to_the_state(plans):
    state = plans["mrr_state"].count("Exchange hashpartitioning")
    assert plans["mrr_movements"].count("Exchange hashpartitioning") == state


@pytest.mark.parametrize("folder", ["operators", "functions"])
def test_operators_stay_in_the_engine(folder):
    for source in (SOURCES / folder).glob("*.py"):
        text = source.read_text()
        assert not re.search(r"\.collect\(|\.toPandas\(|\.rdd\b|\budf\(|localCheckpoint|broadcast\(|crossJoin", text), source


def test_query_names_are_unique():
    assert len(set(QUERIES)) == len(QUERIES)


def test_bloom_filter_of_the_cohort_reaches_both_scans(spark):
    """Beyond broadcast size the cohort still prunes ledger and charges before any shuffle."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        text = plan(queries()["processor_side"](spark, SF))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    filters = [line for line in text.splitlines() if "might_contain" in line and "Filter" in line]
    assert any("o_orderkey" in line for line in filters)
    assert any("l_orderkey" in line for line in filters)


def test_small_cohort_prunes_below_every_aggregation(spark):
    """With a broadcastable cohort the semi joins read the scans, not aggregated history."""
    text = queries()["processor_side"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    lines = [(re.search(r"[A-Z]", line).start(), line) for line in text.splitlines()]
    semi = [i for i, (_, line) in enumerate(lines) if "Join LeftSemi" in line]
    assert len(semi) == 2
    for i in semi:
        for depth, line in lines[i + 1 :]:
            if depth <= lines[i][0]:
                break
            assert "Aggregate" not in line


def test_lost_revenue_plans_the_state_once(plans):
    """Its input events are scanned once, however often the reports' parts use them."""
    text = plans["retry_exhausted_revenue_lost"]
    assert text.count("partial_approx_top_k") == plans["mrr_state"].count("partial_approx_top_k") > 0
