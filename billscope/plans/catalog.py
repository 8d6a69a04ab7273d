"""Every query by name, over the sample tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from billscope.plans.layer import Layer
from billscope.plans.periods import SAMPLE_1999
from billscope.sources.sample import sample_staging

QUERIES = (
    "invoice_cohort",
    "ledger_movements",
    "charge_outcomes",
    "processor_side",
    "billed_and_processed",
    "invoice_recon",
    "recon_summary",
    "chargebacks",
    "old_invoice_chargebacks",
    "chargeback_restatement",
    "chargeback_share",
    "closing_events",
    "mrr_state",
    "mrr_state_refreshed",
    "mrr_totals",
    "mrr_rate_of_change",
    "mrr_growth_summary",
    "month_pairs",
    "mrr_movements",
    "mrr_movement_drivers",
    "mrr_driver_peaks",
    "exhausted_invoices",
    "retry_exhausted_revenue_lost",
    "first_paid_invoices",
    "paid_signup_cohort",
    "customer_nrr_base",
    "cohort_nrr",
    "nrr_extremes",
    "nrr_above_below",
    "nrr_by_cohort_year",
    "customer_nrr_movement",
    "cohort_nrr_movement",
    "dominant_negative_driver",
    "grain_report",
    "grain_violations",
    "movement_identity_check",
    "nrr_identity_check",
)


def ratios_as_double(df: DataFrame) -> DataFrame:
    """Exact decimals leave the engine as DOUBLE, the type SQL clients compare most easily."""
    return df.select(
        *(
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else f.name
            for f in df.schema.fields
        )
    )


def sample_layer(spark: SparkSession, sf_dir: str) -> Layer:
    return Layer(sample_staging(spark, sf_dir), SAMPLE_1999)


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ratios_as_double(getattr(sample_layer(spark, sf_dir), name))

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(name) for name in QUERIES}
