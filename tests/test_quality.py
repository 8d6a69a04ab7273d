from datetime import date

import pytest
from pyspark.sql import functions as F

from billscope.operators import quality
from tests.fixtures import by_key


def test_grain_violations_and_report(spark):
    clean = spark.createDataFrame([(1, "a"), (2, "a")], "id bigint, k string")
    repeated = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (None, "c"), (None, "c")], "id bigint, k string")
    empty = clean.limit(0)
    assert quality.grain_violations(clean, ["id"]).count() == 0
    assert sorted(tuple(r) for r in quality.grain_violations(repeated, ["id", "k"]).fillna(0).collect()) == [
        (0, "c", 2),
        (1, "b", 2),
    ]
    every, part = F.lit(True), F.col("k") == "b"
    grains = [
        (clean, ["id"], {"clean": every}),
        (repeated, ["id", "k"], {"repeated": every, "part": part}),
        (empty, ["id"], {"empty": every}),
    ]
    report = by_key(quality.grain_report(grains), "table_name")
    assert {t: (r["grain"], r["row_count"], r["key_count"], r["repeated_key_count"]) for t, r in report.items()} == {
        "clean": ("id", 2, 2, 0),
        "repeated": ("id, k", 5, 3, 2),
        "part": ("id, k", 2, 1, 1),
        "empty": ("id", 0, 0, 0),
    }
    assert sorted(tuple(r) for r in quality.grain_listing(grains).collect()) == [
        ("part", "1, b", 2),
        ("repeated", "1, b", 2),
        ("repeated", "NULL, c", 2),
    ]


def monthly(spark, rows):
    return spark.createDataFrame(
        rows,
        "mrr_month date, net_mrr_change_cents bigint, new_mrr_cents bigint, reactivation_mrr_cents bigint,"
        " expansion_mrr_cents bigint, contraction_mrr_cents bigint, churn_mrr_cents bigint",
    )


def test_movement_identity(spark):
    drivers = monthly(
        spark,
        [
            (date(2024, 1, 1), 60, 100, 10, 20, 30, 40),
            (date(2024, 2, 1), 61, 100, 10, 20, 30, 40),
            (date(2024, 3, 1), 60, 100, 10, 20, 30, 40),
        ],
    )
    totals = drivers.select(
        "mrr_month",
        F.when(F.month("mrr_month") == 3, 59).otherwise(F.col("net_mrr_change_cents")).alias("net_mrr_change_cents"),
    )
    assert tuple(quality.movement_identity_check(totals, drivers).first()) == (3, 1, 1, 0)
    only_one_side = totals.filter(F.month("mrr_month") < 3)
    assert tuple(quality.movement_identity_check(only_one_side, drivers).first()) == (3, 1, 1, 0)


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, (1, 0, 0, 0)),
        ({"ending_mrr_cents": 101}, (1, 1, 0, 1)),
        ({"churned_customer_count": 2}, (1, 0, 1, 0)),
        ({"nrr_pct": 99.99}, (1, 0, 0, 1)),
    ],
)
def test_nrr_identity(spark, change, expected):
    row = {
        "customer_count": 4,
        "expanded_customer_count": 1,
        "contracted_customer_count": 1,
        "churned_customer_count": 1,
        "unchanged_customer_count": 1,
        "starting_mrr_cents": 100,
        "ending_mrr_cents": 100,
        "expansion_mrr_cents": 30,
        "contraction_mrr_cents": 10,
        "churn_mrr_cents": 20,
        "nrr_pct": 100.0,
    } | change
    columns = [F.lit(v).cast("decimal(20,2)" if c == "nrr_pct" else "bigint").alias(c) for c, v in row.items()]
    movement = spark.range(1).select(F.lit(date(2022, 1, 1)).alias("paid_signup_cohort_month"), *columns)
    nrr = spark.range(1).select(
        F.lit(date(2022, 1, 1)).alias("paid_signup_cohort_month"),
        F.lit(4).cast("bigint").alias("customer_count"),
        F.lit(100).cast("bigint").alias("starting_mrr_cents"),
        F.lit(100).cast("bigint").alias("ending_mrr_cents"),
        F.lit(1).cast("decimal(20,4)").alias("nrr_pct"),
    )
    assert tuple(quality.nrr_identity_check(nrr, movement).first()) == expected


def test_a_cohort_missing_from_one_report_is_a_violation(spark):
    schema = "paid_signup_cohort_month date, customer_count bigint, starting_mrr_cents bigint, ending_mrr_cents bigint, nrr_pct decimal(20,4)"
    nrr = spark.createDataFrame([(date(2022, 1, 1), 1, 1, 1, None)], schema)
    kinds = [f"{k}_customer_count" for k in ("expanded", "contracted", "churned", "unchanged")]
    cents = [f"{k}_mrr_cents" for k in ("starting", "ending", "expansion", "contraction", "churn")]
    movement = nrr.limit(0).select(
        "paid_signup_cohort_month",
        "customer_count",
        "nrr_pct",
        *(F.lit(0).cast("bigint").alias(c) for c in kinds + cents),
    )
    assert quality.nrr_identity_check(nrr, movement).first().report_violations == 1
