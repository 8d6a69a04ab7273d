"""Billed invoices against the payment processor's ledger."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.functions import vocabulary as v
from billscope.functions.months import in_months, invoice_key, within
from billscope.functions.numbers import any_flag, count_where, flag, quotient, sum_where


# One bit per charge outcome.
CAPTURED, UNCAPTURED, FAILED = 1, 2, 4
OUTCOMES = {"captured": CAPTURED, "uncaptured": UNCAPTURED, "failed": FAILED}


def invoice_cohort(
    invoices: DataFrame, start: date, end: date, method: str = v.CHARGE_AUTOMATICALLY
) -> DataFrame:
    """Paid invoices created in [start, end) and collected by `method`; one row per invoice."""
    of_months = in_months(invoices, "invoice_month", start, end)
    return of_months.filter(in_cohort(start, end, method)).select(
        "invoice_id", "customer_id", "invoice_amount_paid_cents", *invoice_key(invoices)[1:]
    )


def in_cohort(start: date, end: date, method: str = v.CHARGE_AUTOMATICALLY) -> Column:
    return (
        within(F.col("invoice_created"), start, end)
        & F.col("invoice_paid")
        & (F.col("invoice_collection_method") == method)
    )


def ledger_movements(balance_transactions: DataFrame) -> DataFrame:
    """Ledger rows that move an invoice's money, cut to the columns the processor side needs."""
    return balance_transactions.filter(
        F.col("balance_reporting_category").isin(*v.LEDGER_CATEGORIES)
    ).select(
        *invoice_key(balance_transactions),
        F.col("balance_reporting_category").alias("category"),
        F.col("balance_amount_cents").alias("amount_cents"),
        F.col("balance_available_on").cast("date").alias("available_date"),
    )


def outcome_masks(charges: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per (invoice, charge) with the outcomes the charge ever had, as a bit mask.

    `carried` are columns of the invoice that its charges came with. Grouping by charge first is what makes the per-invoice counts distinct counts, and it
    spreads an invoice with very many attempts over all tasks. A row whose status or capture
    flag is NULL has no outcome and is left out, so it cannot make an invoice appear.
    """
    approved, captured = F.col("charge_status") == v.SUCCEEDED, F.col("charge_captured")
    outcome = (
        F.when(approved & captured, CAPTURED).when(approved & ~captured, UNCAPTURED).when(~approved, FAILED)
    )
    return (
        charges.select("invoice_id", "charge_id", *carried, outcome.alias("outcome"))
        .filter(F.col("outcome").isNotNull())
        .groupBy("invoice_id", "charge_id", *carried)
        .agg(F.bit_or("outcome").alias("outcomes"))
    )


def had(bit: int) -> Column:
    """Whether a charge with an id ever had the outcome."""
    return F.col("charge_id").isNotNull() & (F.col("outcomes").bitwiseAND(bit) > 0)


def charge_outcomes(charges: DataFrame) -> DataFrame:
    """The same as one flag per outcome."""
    return outcome_masks(charges).select(
        "invoice_id", "charge_id", *(flag(had(bit)).alias(name) for name, bit in OUTCOMES.items())
    )


def ledger_by_invoice(balance_transactions: DataFrame) -> DataFrame:
    """Net money of each invoice, what happened to it, and when it was charged."""
    category, amount = F.col("category"), F.col("amount_cents")
    charge_date = F.when(category == v.CHARGE, F.col("available_date"))
    disputed = sum_where(category.isin(v.DISPUTE, v.DISPUTE_REVERSAL), amount)
    return ledger_movements(balance_transactions).groupBy(*invoice_key(balance_transactions)).agg(
        F.sum(amount).alias("processor_balance_amount_cents"),
        any_flag(category == v.CHARGE).alias("has_charge_row"),
        any_flag(category == v.REFUND).alias("has_refund_activity"),
        flag(disputed < 0).alias("has_dispute_activity"),
        any_flag(category == v.DISPUTE).alias("has_dispute_raised"),
        any_flag(category == v.DISPUTE_REVERSAL).alias("has_dispute_reversal"),
        F.min(charge_date).alias("first_charge_available_date"),
        F.max(charge_date).alias("last_charge_available_date"),
    )


def attempts_by_invoice(charges: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Distinct charges of each invoice by outcome.

    Counts straight from the masks, one aggregation on the other.
    """
    return outcome_masks(charges, carried).groupBy("invoice_id", *carried).agg(
        *(count_where(had(bit)).alias(f"processor_{name}_charge_count") for name, bit in OUTCOMES.items())
    )


def charges_of(charges: DataFrame, invoices: DataFrame) -> DataFrame:
    """Charges of these invoices, spread by charge.

    Dealing the rows out anew costs a shuffle of what is left, and without it everything after
    the join would stay on its partitioning by invoice: adaptive execution could not split an
    invoice with very many attempts, and one task would aggregate it.
    """
    key = invoice_key(charges, invoices)
    own = charges.join(invoices.select(*key), key, "left_semi")
    return own.repartition("invoice_id", "charge_id")


def processor_side(
    balance_transactions: DataFrame, charges: DataFrame, cohort: DataFrame
) -> DataFrame:
    """What the processor shows for each cohort invoice; one row per invoice.

    Ledger and charges are aggregated apart, so they cannot fan out, and an invoice known to
    only one of them keeps its row. A small cohort prunes both scans. Beyond a broadcast, the
    ledger is summed by invoice (map-side first) before it meets the cohort; the charges, which
    need a distinct count, meet it as narrow rows, so their history moves once and both
    aggregations after it are of cohort size. An invoice with very many attempts is a skewed
    key of that one join, which adaptive execution splits, and is spread over its charges next.
    """
    key = invoice_key(balance_transactions, cohort)
    ledger = ledger_by_invoice(balance_transactions).join(cohort.select(*key), key, "left_semi").drop(*key[1:])
    attempts = attempts_by_invoice(charges_of(charges, cohort))
    both = ledger.join(attempts, "invoice_id", "full")
    zeros = [c for c in both.columns if c != "invoice_id" and not c.endswith("_date")]
    has_charge_row, captured = F.col("has_charge_row") == 1, F.col("processor_captured_charge_count")
    return both.fillna(0, subset=zeros).select(
        "invoice_id",
        "processor_balance_amount_cents",
        "processor_captured_charge_count",
        "processor_uncaptured_charge_count",
        "processor_failed_charge_count",
        "has_refund_activity",
        "has_dispute_activity",
        "has_dispute_raised",
        "has_dispute_reversal",
        flag((captured > 0) & ~has_charge_row).alias("has_charge_without_balance"),
        flag(has_charge_row & (captured == 0)).alias("has_balance_without_charge"),
        "first_charge_available_date",
        "last_charge_available_date",
    )


def billed_and_processed(cohort: DataFrame, processor: DataFrame) -> DataFrame:
    """Every cohort invoice beside its processor row; a missing processor row reads as zeros."""
    evidence = [
        c for c in processor.columns
        if c not in ("invoice_id", "first_charge_available_date", "last_charge_available_date")
    ]
    return (
        cohort.select("invoice_id", "customer_id", "invoice_amount_paid_cents")
        .join(processor.select("invoice_id", *evidence), "invoice_id", "left")
        .fillna(0, subset=evidence)
    )


def reconcile(cohort: DataFrame, processor: DataFrame) -> DataFrame:
    """Invoices whose billed and processed amounts differ, with the evidence for each gap."""
    billed, processed = F.col("invoice_amount_paid_cents"), F.col("processor_balance_amount_cents")
    captured = F.col("processor_captured_charge_count")
    severity = (
        F.when(processed == 0, v.FULL)
        .when((processed > 0) & (processed < billed), v.PARTIAL)
        .otherwise(v.NONE)
    )
    direction = (
        F.when(billed > processed, v.BILLING_HIGHER)
        .when(billed < processed, v.PROCESSOR_HIGHER)
        .otherwise(v.MATCHED)
    )
    return billed_and_processed(cohort, processor).filter(billed != processed).select(
        "invoice_id",
        "customer_id",
        "invoice_amount_paid_cents",
        "processor_balance_amount_cents",
        (billed - processed).alias("recon_gap_cents"),
        flag(captured == 0).alias("has_no_processor_charge"),
        flag(captured > 1).alias("has_multiple_processor_charges"),
        "processor_uncaptured_charge_count",
        "processor_failed_charge_count",
        F.col("has_refund_activity").alias("has_refund"),
        F.col("has_dispute_activity").alias("has_dispute"),
        "has_dispute_raised",
        "has_dispute_reversal",
        "has_charge_without_balance",
        "has_balance_without_charge",
        severity.alias("balance_reduction_severity"),
        direction.alias("gap_direction"),
    )


def recon_summary(gaps: DataFrame) -> DataFrame:
    """Gap invoices by evidence: how many, how much in total, how much on average."""
    return gaps.groupBy("has_refund", "has_dispute", "balance_reduction_severity").agg(
        F.count("*").alias("invoice_count"),
        F.sum("recon_gap_cents").alias("total_gap_cents"),
        quotient(F.sum("recon_gap_cents"), F.count("*"), 2).alias("mean_gap_cents"),
    )
