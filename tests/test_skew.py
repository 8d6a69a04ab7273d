"""A third of all rows on one key, broadcasts off: same results, and no task that gets them all."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from billscope.operators import mrr, reconciliation
from billscope.plans.catalog import queries, sample_layer
from billscope.plans.oracle import oracle_sql
from billscope.plans.periods import SAMPLE_1999
from tests.test_oracle import ordered

SF = "/root/testdata/sf0.01"
NAMES = (
    "processor_side",
    "invoice_recon",
    "chargeback_restatement",
    "mrr_state",
    "mrr_rate_of_change",
    "mrr_movement_drivers",
    "cohort_nrr_movement",
    "retry_exhausted_revenue_lost",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """One customer holds a third of the orders, on one plan; one June order a third of the lines."""
    root = str(tmp_path_factory.mktemp("skewed"))
    third = F.pmod(F.xxhash64("*"), F.lit(3)) == 0
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    hot = orders.filter("o_orderdate between '1999-06-01' and '1999-06-20' and o_orderstatus = 'F'").filter(
        "o_orderpriority = '1-URGENT'"
    )
    hot_order = hot.agg(F.min("o_orderkey")).first()[0]
    orders.withColumn("hot", third).selectExpr(
        "o_orderkey",
        "if(hot, 7, o_custkey) as o_custkey",
        "o_orderstatus",
        "if(hot, o_totalprice + 250000, o_totalprice) as o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    ).write.parquet(f"{root}/orders.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("hot", third).withColumn(
        "l_orderkey", F.when(F.col("hot"), hot_order).otherwise(F.col("l_orderkey"))
    ).drop("hot").write.parquet(f"{root}/lineitem.parquet")
    spark.read.parquet(f"{SF}/customer.parquet").write.parquet(f"{root}/customer.parquet")
    return root


@pytest.fixture(scope="module", autouse=True)
def shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", NAMES)
def test_results_hold_under_skew(spark, skewed, name):
    duck = duckdb.connect()
    for table in ("orders", "lineitem", "customer"):
        files = f"{Path(skewed) / table}.parquet/*.parquet"
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{files}')")
    df = queries()[name](spark, skewed)
    columns = sorted(df.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]})").fetchall()
    actual = [tuple(row) for row in df.select(*columns).collect()]
    assert len(actual) > 0
    assert ordered(actual) == ordered(expected)


def test_lead_sees_a_bounded_number_of_rows(spark, skewed):
    layer = sample_layer(spark, skewed)
    events = layer.staging.subscription_events
    hottest = events.groupBy("subscription_id").count().agg(F.max("count")).first()[0]
    closing = mrr.closing_events(events, SAMPLE_1999.anchor_month, SAMPLE_1999.n_months)
    kept = closing.groupBy("subscription_id").count().agg(F.max("count")).first()[0]
    assert hottest > 4000
    assert kept <= SAMPLE_1999.n_months + 1


def test_attempts_of_one_invoice_spread_over_partitions(spark, skewed):
    layer = sample_layer(spark, skewed)
    charges = layer.staging.charges
    hottest = charges.groupBy("invoice_id").count().orderBy(F.desc("count")).first()
    assert hottest["count"] > 15000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = (
            reconciliation.charge_outcomes(charges)
            .filter(F.col("invoice_id") == hottest["invoice_id"])
            .groupBy(F.spark_partition_id())
            .count()
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spread) > 1


def test_chargebacks_of_one_invoice_are_split_or_summed_first(spark):
    """A third of the chargebacks hit one invoice: row-level joins split it, the report sums first."""
    from datetime import date

    from billscope.operators import chargebacks

    rows = 300_000
    ledger = spark.range(rows).selectExpr(
        f"concat('d', if(id < {rows // 3}, 0, id)) as balance_source_id",
        f"concat('in_', if(id < {rows // 3}, 0, id)) as invoice_id",
        "concat('cus_', sha2(string(id), 256)) as customer_id",
        "'dispute' as balance_reporting_category",
        "-id as balance_net_cents",
        "timestamp_ntz'2024-06-10' as balance_available_on",
    )
    disputes = spark.range(rows).selectExpr("concat('d', id) as dispute_id", "if(id = 0, 'hot', 'cold') as dispute_reason")
    invoices = spark.range(rows).selectExpr("concat('in_', id) as invoice_id", "timestamp_ntz'2024-05-01' as invoice_period_end")
    periods = ((date(2024, 6, 1), date(2024, 7, 1)), (date(2024, 1, 1), date(2024, 6, 1)))
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        detail = chargebacks.old_invoice_chargebacks(ledger, disputes, invoices, *periods)
        detail = detail.select("dispute_reason", "customer_id", "balance_net_cents")
        assert len(detail.collect()) == rows
        assert "skew=true" in detail._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    report = chargebacks.chargeback_restatement(ledger, disputes, invoices, *periods)
    third = rows // 3
    assert sorted(tuple(r) for r in report.collect()) == [
        ("cold", rows - third, sum(range(third, rows))),
        ("hot", 1, sum(range(third))),
    ]
