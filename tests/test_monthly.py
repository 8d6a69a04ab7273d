"""Staging tables laid out by month: the same results from fewer files."""

import re
from datetime import datetime

import pytest

from billscope.plans.catalog import QUERIES, sample_layer
from billscope.plans.layer import Layer
from billscope.plans.periods import SAMPLE_1999
from billscope.sources.monthly import read_monthly, write_monthly
from billscope.sources.sample import sample_staging
from billscope.sources.sinks import BrokenGrain
from tests.fixtures import staging

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    return Layer(write_monthly(sample_staging(spark, SMALL), str(tmp_path_factory.mktemp("monthly"))), SAMPLE_1999)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("grain_")])
def test_every_query_gives_the_same(spark, layer, name):
    plain = getattr(sample_layer(spark, SMALL), name)
    monthly = getattr(layer, name).select(*plain.columns)
    assert monthly.exceptAll(plain).count() == 0 == plain.exceptAll(monthly).count()


def scans(df, table: str) -> list[str]:
    return [line for line in plan(df).splitlines() if "FileScan" in line and f"/{table}]" in line]


def filters(line: str) -> str:
    return re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", line)[1]


def test_the_cohort_prunes_the_months_of_ledger_and_charges(layer):
    side = layer.processor_side
    for table in ("balance_transactions", "charges"):
        assert any("dynamicpruning" in filters(line) and "invoice_month" in filters(line) for line in scans(side, table)), table
    for line in scans(side, "invoices"):
        assert "invoice_month" in filters(line) and "1999-06-01" in filters(line) and "1999-11-01" in filters(line)


def test_chargebacks_open_the_months_of_their_windows(layer):
    found = layer.old_invoice_chargebacks
    for line in scans(found, "balance_transactions"):
        assert "available_month" in filters(line) and "1999-08-01" in filters(line)
    lost = layer.retry_exhausted_revenue_lost
    assert all("1998-12-01" in filters(line) for line in scans(lost, "invoices"))


def months_read(df, table: str) -> int:
    """Partitions that the scans of a table read when the query ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    counted, todo = 0, [text]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and table in node.toString():
            counted = max(counted, node.metrics().apply("numPartitions").value())
        else:
            todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return counted


def test_only_the_cohorts_months_of_charges_are_read(spark, layer):
    everything = len(layer.staging.charges.select("invoice_month").distinct().collect())
    assert 0 < months_read(layer.processor_side, "/charges") <= 6 < everything


def test_rows_of_unknown_invoices_stay_and_repeated_invoices_are_refused(spark, tmp_path):
    invoice = {"invoice_id": "a", "invoice_created": datetime(2024, 6, 3), "invoice_paid": True}
    charge = {"charge_id": "c1", "invoice_id": "a"}
    good = staging(spark, invoices=[invoice], charges=[charge, {"charge_id": "c2", "invoice_id": "gone"}, {"charge_id": "c3"}])
    root = str(tmp_path / "m")
    write_monthly(good, root)
    assert {(r.charge_id, str(r.invoice_month)) for r in read_monthly(spark, root).charges.collect()} == {("c1", "2024-06-01"), ("c2", "None"), ("c3", "None")}
    twice = staging(spark, invoices=[invoice, dict(invoice, invoice_created=datetime(2024, 7, 3))])
    with pytest.raises(BrokenGrain, match="invoices"):
        write_monthly(twice, root)
    assert read_monthly(spark, root).charges.count() == 3
