"""MRR lost to payments whose retries ran out."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.functions.months import in_months, invoice_key, month_of, within
from billscope.operators.mrr import mrr_movements
from billscope.operators.reconciliation import attempts_by_invoice, charges_of


def ran_out() -> Column:
    """Attempts failed and none collected money."""
    return (F.col("processor_failed_charge_count") > 0) & (F.col("processor_captured_charge_count") == 0)


def exhausted_invoices(invoices: DataFrame, charges: DataFrame) -> DataFrame:
    """Invoices with at least one failed charge attempt and none that collected money.

    Charges of other invoices go first: where the invoices are few the semi join prunes the
    scan, else it moves the history once, and what is aggregated afterwards is only theirs.
    """
    outcome = attempts_by_invoice(charges_of(charges, invoices)).filter(ran_out())
    return invoices.select("invoice_id", "customer_id", "invoice_created").join(
        outcome.select("invoice_id", F.col("processor_failed_charge_count").alias("failed_count")), "invoice_id"
    )


def revenue_lost_of(movements: DataFrame, invoices: DataFrame, charges: DataFrame, year: int) -> DataFrame:
    """Churned MRR of customers who had a retry-exhausted invoice in the month before.

    Only the result's columns are given for this report, so the definition is ours. Churn is one
    row per (customer, month); movements are one row per (subscription, month), so the row
    count is the subscription count. Churn stands in the plan once: it picks the customers'
    invoices of the month before, whose amounts then travel with the invoice's charges,
    so nothing has to be looked up again. The charges are spread by charge before they are
    counted, as in `charges_of`.
    """
    churned = (
        movements.filter(F.col("mrr_movement_driver") == "churn")
        .groupBy("customer_id", "mrr_month")
        .agg(
            F.count("*").alias("subscriptions_lost"),
            F.sum("prev_mrr_cents").alias("mrr_lost_cents"),
        )
    )
    month_after = F.add_months(month_of(F.col("invoice_created")), 1)
    window, key = (date(year - 1, 12, 1), date(year, 12, 1)), invoice_key(charges, invoices)
    loss = ["customer_id", "mrr_month", "subscriptions_lost", "mrr_lost_cents"]
    before_churn = (
        in_months(invoices, "invoice_month", *window)
        .filter(within(F.col("invoice_created"), *window))
        .select(*key, "customer_id", month_after.alias("mrr_month"))
        .join(churned, ["customer_id", "mrr_month"])
        .select(*key, *loss)
    )
    tried = charges.join(before_churn, key).repartition("invoice_id", "charge_id")
    return (
        attempts_by_invoice(tried, loss)
        .filter(ran_out())
        .select(*loss)
        .distinct()
        .groupBy("mrr_month")
        .agg(
            F.sum("subscriptions_lost").alias("subscriptions_lost"),
            F.sum("mrr_lost_cents").alias("retry_exhausted_mrr_lost_cents"),
        )
    )


def retry_exhausted_revenue_lost(
    state: DataFrame, invoices: DataFrame, charges: DataFrame, year: int
) -> DataFrame:
    """The same straight from the state, where its movements are not stored."""
    return revenue_lost_of(mrr_movements(state, year), invoices, charges, year)
