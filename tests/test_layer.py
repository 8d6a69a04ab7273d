"""The stored layer, the staging sources and the sinks."""

import re

import pytest

from billscope.plans.catalog import sample_layer
from billscope.plans.layer import BUCKETED, COUNTED, GRAINS, STORED, in_database, in_folder, write_layer
from billscope.plans.periods import SAMPLE_1999
from billscope.sources.sample import sample_staging
from billscope.sources.sinks import BrokenGrain, export_csv, replace_catalog_table, replace_table
from billscope.sources.staging import SCHEMAS, Staging, staging_from_catalog, staging_from_parquet

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layer"))
    return root, write_layer(sample_staging(spark, SMALL), SAMPLE_1999, in_folder(root))


def test_stored_tables_equal_the_lazy_plans(spark, stored):
    root, layer = stored
    lazy = sample_layer(spark, SMALL)
    for name in (*STORED, "mrr_driver_peaks", "nrr_extremes"):
        kept, planned = getattr(layer, name), getattr(lazy, name)
        assert kept.columns == planned.columns
        assert kept.count() > 0, name
        assert kept.exceptAll(planned).count() == 0 == planned.exceptAll(kept).count(), name


def test_retention_reads_two_month_partitions(stored):
    _, layer = stored
    from billscope.operators.retention import customer_nrr_base

    base = customer_nrr_base(
        layer.paid_signup_cohort, layer.mrr_state, SAMPLE_1999.anchor_month, SAMPLE_1999.last_month
    )
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [mrr_month" in plan
    assert len(layer.mrr_state.select("mrr_month").distinct().collect()) == 13


def test_replacing_a_table_leaves_only_the_new_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    assert replace_table(spark.range(2), path).count() == 2


def test_catalog_table_is_replaced(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS billscope_test LOCATION '{tmp_path}'")
    try:
        replace_catalog_table(spark.range(3), "billscope_test.numbers")
        assert replace_catalog_table(spark.range(2), "billscope_test.numbers").count() == 2
    finally:
        spark.sql("DROP DATABASE billscope_test CASCADE")


def test_csv_export_has_an_upper_case_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    export_csv(sample_layer(spark, SMALL).mrr_rate_of_change, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns[:3] == ["PREV_MRR_MONTH", "MRR_MONTH", "MRR_CUTOFF"]
    assert back.count() == 12


def test_staging_from_parquet_reads_only_the_known_columns(spark, tmp_path):
    for name, schema in SCHEMAS.items():
        empty = spark.createDataFrame([], schema).selectExpr("*", "1 as extra")
        empty.write.parquet(str(tmp_path / name))
    tables = staging_from_parquet(spark, str(tmp_path)).tables()
    assert {name: df.columns for name, df in tables.items()} == {n: s.names for n, s in SCHEMAS.items()}


def test_staging_from_catalog(spark):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).createOrReplaceGlobalTempView(f"stg_{name}")
    tables = staging_from_catalog(spark, "global_temp").tables()
    assert {name: df.columns for name, df in tables.items()} == {n: s.names for n, s in SCHEMAS.items()}


def test_incomplete_staging_is_refused(spark):
    with pytest.raises(ValueError, match="charges"):
        Staging(**{name: spark.range(1) for name in SCHEMAS if name != "charges"})


def test_command_line_builds_tables_and_exports(spark, tmp_path):
    from billscope.__main__ import main

    staged, out, csv = (str(tmp_path / name) for name in ("staging", "out", "csv"))
    for name, df in sample_staging(spark, SMALL).tables().items():
        df.write.parquet(f"{staged}/{name}")
    main(["--staging-path", staged, "--out-path", out, "--csv", csv, "--year", "1999", "--month", "6"])
    cohort = spark.read.parquet(f"{out}/invoice_cohort")
    june = sample_staging(spark, SMALL).invoices.filter(
        "invoice_created >= '1999-06-01' and invoice_created < '1999-07-01' and invoice_paid"
        " and invoice_collection_method = 'charge_automatically'"
    )
    assert 0 < cohort.count() == june.count()
    assert {p.name for p in (tmp_path / "out").iterdir()} == set(STORED)
    exported = spark.read.option("header", True).csv(f"{csv}/mrr_movement_drivers")
    assert exported.count() == 12
    assert exported.columns[0] == "MRR_MONTH"


def test_command_line_reads_and_writes_catalog_tables(spark, tmp_path):
    from billscope.__main__ import main

    spark.sql(f"CREATE DATABASE IF NOT EXISTS billscope_raw LOCATION '{tmp_path}/raw'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS billscope_out LOCATION '{tmp_path}/out'")
    try:
        for name, df in sample_staging(spark, SMALL).tables().items():
            df.write.saveAsTable(f"billscope_raw.stg_{name}")
        command = ["--staging-database", "billscope_raw", "--out-database", "billscope_out", "--year", "1999", "--month", "6"]
        main(command)
        first = spark.table("billscope_out.cohort_nrr").count()
        main(command)
        assert 0 < first == spark.table("billscope_out.cohort_nrr").count()
        assert {t.name for t in spark.catalog.listTables("billscope_out") if not t.isTemporary} == set(STORED)
        lazy = sample_layer(spark, SMALL).mrr_movement_drivers
        kept = spark.sql("SELECT * FROM billscope_out.mrr_movement_drivers")
        assert kept.exceptAll(lazy).count() == 0 == lazy.exceptAll(kept).count()
    finally:
        spark.sql("DROP DATABASE billscope_raw CASCADE")
        spark.sql("DROP DATABASE billscope_out CASCADE")


def test_periods_of_a_month():
    from datetime import date

    from billscope.plans.periods import JUNE_2024, Periods

    assert JUNE_2024.closed == (date(2024, 1, 1), date(2024, 6, 1))
    assert (JUNE_2024.anchor_month, JUNE_2024.last_month) == (date(2023, 12, 1), date(2024, 12, 1))
    assert Periods.for_month(2024, 12).invoices == (date(2024, 12, 1), date(2025, 1, 1))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    """The layer in a catalog with 8 buckets a table, as many as shuffle partitions, and joins that cannot broadcast."""
    spark.sql(f"CREATE DATABASE billscope_buckets LOCATION '{tmp_path_factory.mktemp('buckets')}'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield write_layer(sample_staging(spark, SMALL), SAMPLE_1999, in_database("billscope_buckets", 8))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.sql("DROP DATABASE billscope_buckets CASCADE")


def test_bucketed_tables_equal_the_lazy_plans(spark, bucketed):
    lazy = sample_layer(spark, SMALL)
    for name in STORED:
        kept, planned = getattr(bucketed, name), getattr(lazy, name)
        assert kept.exceptAll(planned).count() == 0 == planned.exceptAll(kept).count(), name


def depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-*()0123456789"))


def step_above(df, table: str) -> str:
    """The first join, window or shuffle that the rows of a table meet in the physical plan; the one for each scan of it."""
    lines = plan(df).splitlines()
    found = set()
    for i, line in enumerate(lines):
        if f".{table}[" in line:
            at = depth(line)
            for above in reversed(lines[:i]):
                if depth(above) < at:
                    at = depth(above)
                    if kind := re.search(r"Exchange|Join|Window|Aggregate", above):
                        found.add(kind[0])
                        break
    return "/".join(sorted(found))


def test_steps_by_key_shuffle_no_bucketed_table(bucketed):
    from billscope.operators import mrr, reconciliation, retention

    s, p = bucketed.staging, bucketed.periods
    side = reconciliation.processor_side(s.balance_transactions, s.charges, bucketed.invoice_cohort)
    gaps = reconciliation.reconcile(bucketed.invoice_cohort, bucketed.processor_side)
    movements = mrr.mrr_movements(bucketed.mrr_state, p.year)
    base = retention.customer_nrr_base(bucketed.paid_signup_cohort, bucketed.mrr_state, p.anchor_month, p.last_month)
    assert step_above(side, "invoice_cohort") == "Join"
    assert step_above(gaps, "invoice_cohort") == step_above(gaps, "processor_side") == "Join"
    assert step_above(movements, "mrr_state") == "Window"
    assert step_above(base, "paid_signup_cohort") == "Join"
    assert "Exchange" not in plan(gaps) + plan(movements)


@pytest.mark.parametrize("place", ["stored", "bucketed"])
def test_totals_of_a_stored_state_sort_and_shuffle_nothing_by_subscription(place, request, spark):
    """The store has refused repeats, so the distinct counts need one shuffle of (month, customer) and one of months."""
    found = request.getfixturevalue(place)
    layer = found[1] if place == "stored" else found
    totals = plan(layer.mrr_totals)
    assert "Window" not in totals and "Sort" not in totals and "subscription_id" not in "".join(re.findall("Exchange.*", totals))
    assert totals.count("Exchange") == 2
    lazy = sample_layer(spark, SMALL)
    assert "Window" in plan(lazy.mrr_totals), "a plan may repeat rows and stays exact"
    assert layer.mrr_totals.exceptAll(lazy.mrr_totals).count() == 0 == lazy.mrr_totals.exceptAll(layer.mrr_totals).count()


def test_every_stored_table_declares_its_grain(stored):
    _, layer = stored
    assert set(GRAINS) == set(STORED) >= set(BUCKETED)
    for name, grain in GRAINS.items():
        table = getattr(layer, name)
        assert table.select(*grain).distinct().count() == table.count(), name
    for name, columns in BUCKETED.items():
        assert set(columns) <= set(GRAINS[name])


def test_a_clean_layer_pays_no_shuffle_for_its_grains(spark):
    from pyspark.sql import Observation

    from billscope.sources.sinks import watched

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lazy = sample_layer(spark, SMALL)
        for name, grain in COUNTED.items():
            table = getattr(lazy, name)
            own, checked = plan(table).count("Exchange"), plan(watched(table, grain, Observation())).count("Exchange")
            # The cohort is a filtered scan: nothing has dealt its rows by key yet.
            assert checked == own + (name == "invoice_cohort"), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_repeated_subscription_record_is_refused_and_the_old_layer_stays(spark, tmp_path):
    root = str(tmp_path / "layer")
    staging = sample_staging(spark, SMALL)
    write_layer(staging, SAMPLE_1999, in_folder(root))
    rows = spark.read.parquet(f"{root}/mrr_state").count()
    tables = staging.tables()
    tables["subscriptions"] = tables["subscriptions"].unionByName(tables["subscriptions"].orderBy("subscription_id").limit(1))
    with pytest.raises(BrokenGrain, match="mrr_state") as refused:
        write_layer(Staging(**tables), SAMPLE_1999, in_folder(root))
    assert all(key["rows"] == 2 for key in refused.value.keys)
    assert spark.read.parquet(f"{root}/mrr_state").count() == rows


def test_reports_of_a_stored_layer_read_its_movements(stored):
    """Neither the drivers nor the lost revenue builds the state or pairs its months again."""
    from billscope.operators import retries
    from billscope.operators.mrr import movement_drivers

    _, layer = stored
    s, year = layer.staging, layer.periods.year
    for df in (movement_drivers(layer.mrr_movements), retries.revenue_lost_of(layer.mrr_movements, s.invoices, s.charges, year)):
        text = plan(df)
        assert text.count("/mrr_movements") == 1 and "/mrr_state" not in text and "Window" not in text
    assert re.search(r"PartitionFilters: \[[^]]*mrr_month", plan(layer.mrr_movements.filter("mrr_month = date'1999-05-01'")))
