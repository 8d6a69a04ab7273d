"""Paid-signup cohorts and their net and gross revenue retention."""

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billscope.functions import vocabulary as v
from billscope.functions.months import in_months, later_month, month_of
from billscope.functions.numbers import count_where, fraction, percent


def first_paid_invoices(invoices: DataFrame) -> DataFrame:
    """Each customer's earliest invoice that is both marked paid and in status paid."""
    return (
        invoices.filter(F.col("invoice_paid") & (F.col("invoice_status") == v.INVOICE_PAID))
        .groupBy("customer_id")
        .agg(F.min("invoice_created").alias("first_paid_invoice_date"))
    )


def paid_signup_cohort(invoices: DataFrame, before: date) -> DataFrame:
    """Customers whose first payment fell in a month before `before`, with that month.

    The date test follows the MIN: a later payment must not stand in for an early first one.
    An upper bound may also precede it, and prunes the scan: a customer without an invoice
    below the bound has no first one below it either.
    """
    month = before.replace(day=1)
    bound = month if month == before else later_month(month, 1)
    early = in_months(invoices, "invoice_month", None, bound).filter(F.col("invoice_created") < F.lit(bound))
    return first_paid_invoices(early).withColumn(
        "paid_signup_cohort_month", month_of(F.col("first_paid_invoice_date"))
    ).filter(F.col("paid_signup_cohort_month") < F.lit(before))


def customer_nrr_base(
    cohort: DataFrame, state: DataFrame, start_month: date, end_month: date
) -> DataFrame:
    """Starting and ending MRR of each cohort customer that had MRR at the start.

    Both months come out of one aggregation of the state. A customer without a row in the end
    month keeps a NULL ending, which is not the same as an ending of 0.
    """
    month = F.col("mrr_month")
    by_customer = (
        state.filter(month.isin(start_month, end_month))
        .groupBy("customer_id")
        .agg(
            F.sum(F.when(month == start_month, F.col("mrr_cents"))).alias("starting_mrr_cents"),
            F.sum(F.when(month == end_month, F.col("mrr_cents"))).alias("ending_mrr_cents"),
        )
        .filter(F.col("starting_mrr_cents") > 0)
    )
    return cohort.select("customer_id", "paid_signup_cohort_month").join(by_customer, "customer_id")


def cohort_nrr(base: DataFrame) -> DataFrame:
    """NRR per cohort as a fraction, ranked from both ends. Ranks run over one row per cohort."""
    return (
        base.groupBy("paid_signup_cohort_month")
        .agg(
            F.countDistinct("customer_id").alias("customer_count"),
            F.sum("starting_mrr_cents").alias("starting_mrr_cents"),
            F.sum(F.coalesce("ending_mrr_cents", F.lit(0))).alias("ending_mrr_cents"),
        )
        .withColumn("nrr_pct", fraction(F.col("ending_mrr_cents"), F.col("starting_mrr_cents"), 4))
        .withColumn("nrr_rank_highest", F.rank().over(Window.orderBy(F.desc("nrr_pct"))))
        .withColumn("nrr_rank_lowest", F.rank().over(Window.orderBy(F.asc("nrr_pct"))))
        .orderBy(F.desc("nrr_pct"), "paid_signup_cohort_month")
    )


def customer_nrr_movement(base: DataFrame) -> DataFrame:
    """How each customer's MRR moved over the period: amounts per kind, net change, label."""
    start, end = F.col("starting_mrr_cents"), F.col("ending_mrr_cents")
    grew, gone, held = end > start, end.isNull() | (end == 0), end == start
    shrank = (end < start) & (end > 0)
    return base.select(
        "customer_id",
        "paid_signup_cohort_month",
        start,
        end,
        F.when(grew, end - start).otherwise(0).alias("expansion_mrr_cents"),
        F.when(shrank, start - end).otherwise(0).alias("contraction_mrr_cents"),
        F.when(gone, start).otherwise(0).alias("churn_mrr_cents"),
        F.when(held, start).otherwise(0).alias("unchanged_mrr_cents"),
        (F.coalesce(end, F.lit(0)) - start).alias("net_mrr_change_cents"),
        F.when(grew, v.EXPANDED)
        .when(shrank, v.CONTRACTED)
        .when(gone, v.CHURNED)
        .otherwise(v.UNCHANGED)
        .alias("customer_movement_type"),
    )


def cohort_nrr_movement(movement: DataFrame) -> DataFrame:
    """Customer counts, MRR amounts and percent rates per cohort, with gross and net retention."""
    kind = F.col("customer_movement_type")
    kinds = (v.EXPANDED, v.CONTRACTED, v.CHURNED, v.UNCHANGED)
    amounts = ("expansion", "contraction", "churn", "unchanged")
    start, expansion, contraction, churn = (
        F.col(f"{name}_mrr_cents") for name in ("starting", "expansion", "contraction", "churn")
    )
    kept = start - contraction - churn
    rates = {
        "expansion_rate_pct": expansion,
        "contraction_rate_pct": contraction,
        "churn_rate_pct": churn,
        "grr_pct": kept,
        "nrr_pct": kept + expansion,
    }
    return (
        movement.groupBy("paid_signup_cohort_month")
        .agg(
            F.count("*").alias("customer_count"),
            *(count_where(kind == k).alias(f"{k}_customer_count") for k in kinds),
            F.sum("starting_mrr_cents").alias("starting_mrr_cents"),
            F.sum(F.coalesce("ending_mrr_cents", F.lit(0))).alias("ending_mrr_cents"),
            *(F.sum(f"{a}_mrr_cents").alias(f"{a}_mrr_cents") for a in amounts),
            F.sum("net_mrr_change_cents").alias("net_mrr_change_cents"),
        )
        .select("*", *(percent(part, start, 2).alias(name) for name, part in rates.items()))
    )
