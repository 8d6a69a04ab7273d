"""Revenue of already closed periods taken back by later chargebacks."""

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billscope.functions import vocabulary as v
from billscope.functions.months import in_months, invoice_key, within
from billscope.functions.numbers import percent

Period = tuple[date, date]


def chargebacks(balance_transactions: DataFrame, window: Period) -> DataFrame:
    """Dispute rows whose money moved inside the window, keyed by dispute."""
    return in_months(balance_transactions, "available_month", *window).filter(
        (F.col("balance_reporting_category") == v.DISPUTE)
        & within(F.col("balance_available_on"), *window)
    ).select(
        F.col("balance_source_id").alias("dispute_id"),
        *invoice_key(balance_transactions),
        "customer_id",
        "balance_available_on",
        "balance_net_cents",
    )


def closed_invoices(invoices: DataFrame, period: Period) -> DataFrame:
    """Invoices whose billing period ended inside the closed period."""
    return invoices.filter(within(F.col("invoice_period_end"), *period)).select(
        *invoice_key(invoices), "invoice_period_end"
    )


def old_invoice_chargebacks(
    balance_transactions: DataFrame,
    disputes: DataFrame,
    invoices: DataFrame,
    chargeback_window: Period,
    period_window: Period,
) -> DataFrame:
    """Row-level view: each chargeback of a closed invoice with its reason."""
    return (
        chargebacks(balance_transactions, chargeback_window)
        .join(disputes.select("dispute_id", "dispute_reason"), "dispute_id")
        .join(closed_invoices(invoices, period_window), invoice_key(balance_transactions, invoices))
        .select(
            "dispute_id",
            "invoice_id",
            "customer_id",
            "invoice_period_end",
            "balance_available_on",
            "balance_net_cents",
            "dispute_reason",
        )
    )


def chargeback_restatement(
    balance_transactions: DataFrame,
    disputes: DataFrame,
    invoices: DataFrame,
    chargeback_window: Period,
    period_window: Period,
) -> DataFrame:
    """Closed-period revenue lost to chargebacks, by reason.

    Sums are taken before each join, so a dispute or invoice repeated very often reaches the
    join as one row. A sum distributes over an equi-join, so totals are unchanged.
    """
    key = invoice_key(balance_transactions, invoices)
    by_dispute = (
        chargebacks(balance_transactions, chargeback_window)
        .groupBy("dispute_id", *key)
        .agg(F.sum("balance_net_cents").alias("net_cents"))
    )
    by_reason_and_invoice = (
        by_dispute.join(disputes.select("dispute_id", "dispute_reason"), "dispute_id")
        .groupBy("dispute_reason", *key)
        .agg(F.sum("net_cents").alias("net_cents"))
    )
    return (
        by_reason_and_invoice.join(
            closed_invoices(invoices, period_window).select(*key), key
        )
        .groupBy("dispute_reason")
        .agg(
            F.countDistinct("invoice_id").alias("invoice_count"),
            F.abs(F.sum("net_cents")).alias("total_lost_net_cents"),
        )
        .orderBy(F.desc("invoice_count"), "dispute_reason")
    )


def chargeback_share(restatement: DataFrame) -> DataFrame:
    """Each reason's share of all lost revenue. The window spans one row per reason."""
    everything = Window.partitionBy()
    lost = F.col("total_lost_net_cents")
    return restatement.select(
        "dispute_reason",
        "invoice_count",
        lost,
        F.sum("invoice_count").over(everything).alias("all_invoice_count"),
        F.sum(lost).over(everything).alias("all_lost_net_cents"),
        percent(lost, F.sum(lost).over(everything), 2).alias("lost_share_pct"),
    )
