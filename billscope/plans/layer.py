"""The whole analytics layer: from staging to every table and report."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.functions.months import later_month
from billscope.operators import chargebacks, mrr, quality, reconciliation, refresh, reports, retention, retries
from billscope.plans.periods import Periods
from billscope.sources.sinks import (
    export_csv,
    read_table,
    replace_catalog_partitions,
    replace_catalog_table,
    replace_partitions,
    replace_table,
)
from billscope.sources.staging import Staging


@dataclass(frozen=True)
class Layer:
    """Every result as a lazy DataFrame over `staging`, built once per instance.

    `keep(name, df)` decides what happens to a table that later steps read: by default it stays
    a plan, `write_layer` stores it.
    """

    staging: Staging
    periods: Periods
    keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df

    @cached_property
    def invoice_cohort(self) -> DataFrame:
        cohort = reconciliation.invoice_cohort(self.staging.invoices, *self.periods.invoices)
        return self.keep("invoice_cohort", cohort)

    @cached_property
    def ledger_movements(self) -> DataFrame:
        return reconciliation.ledger_movements(self.staging.balance_transactions)

    @cached_property
    def charge_outcomes(self) -> DataFrame:
        return reconciliation.charge_outcomes(self.staging.charges)

    @cached_property
    def processor_side(self) -> DataFrame:
        s = self.staging
        side = reconciliation.processor_side(s.balance_transactions, s.charges, self.invoice_cohort)
        return self.keep("processor_side", side)

    @cached_property
    def billed_and_processed(self) -> DataFrame:
        return reconciliation.billed_and_processed(self.invoice_cohort, self.processor_side)

    @cached_property
    def invoice_recon(self) -> DataFrame:
        gaps = reconciliation.reconcile(self.invoice_cohort, self.processor_side)
        return self.keep("invoice_recon", gaps)

    @cached_property
    def recon_summary(self) -> DataFrame:
        return reconciliation.recon_summary(self.invoice_recon)

    @cached_property
    def chargebacks(self) -> DataFrame:
        return chargebacks.chargebacks(self.staging.balance_transactions, self.periods.chargebacks)

    @cached_property
    def old_invoice_chargebacks(self) -> DataFrame:
        s, p = self.staging, self.periods
        return chargebacks.old_invoice_chargebacks(
            s.balance_transactions, s.disputes, s.invoices, p.chargebacks, p.closed
        )

    @cached_property
    def chargeback_restatement(self) -> DataFrame:
        s, p = self.staging, self.periods
        restated = chargebacks.chargeback_restatement(
            s.balance_transactions, s.disputes, s.invoices, p.chargebacks, p.closed
        )
        return self.keep("chargeback_restatement", restated)

    @cached_property
    def chargeback_share(self) -> DataFrame:
        return chargebacks.chargeback_share(self.chargeback_restatement)

    @cached_property
    def closing_events(self) -> DataFrame:
        p = self.periods
        return mrr.closing_events(self.staging.subscription_events, p.anchor_month, p.n_months)

    @cached_property
    def mrr_state(self) -> DataFrame:
        s, p = self.staging, self.periods
        state = mrr.mrr_state(s.subscription_events, s.subscriptions, p.anchor_month, p.n_months)
        return self.keep("mrr_state", state)

    @cached_property
    def mrr_state_refreshed(self) -> DataFrame:
        """The state built from the events before the middle of the year, then refreshed by all later ones."""
        s, p = self.staging, self.periods
        middle, of = F.lit(later_month(p.year_start, 6)), (p.anchor_month, p.n_months)
        earlier = s.subscription_events.filter(F.col("event_effective_at") < middle)
        known = mrr.mrr_state(earlier, s.subscriptions, *of)
        changed = refresh.changed_keys(earlier, s.subscription_events, "subscription_id")
        return refresh.refreshed_state(known, s.subscription_events, s.subscriptions, changed, *of)

    @property
    def _state_repeats_nothing(self) -> bool:
        """A store that refuses a state with a broken grain has only states without repeats."""
        return "mrr_state" in getattr(self.keep, "refuses_repeats_in", ())

    @cached_property
    def mrr_totals(self) -> DataFrame:
        return mrr.mrr_totals(self.mrr_state, self._state_repeats_nothing)

    @cached_property
    def mrr_rate_of_change(self) -> DataFrame:
        rates = mrr.mrr_rate_of_change(self.mrr_state, self.periods.year, self._state_repeats_nothing)
        return self.keep("mrr_rate_of_change", rates)

    @cached_property
    def mrr_growth_summary(self) -> DataFrame:
        return reports.mrr_growth_summary(self.mrr_rate_of_change)

    @cached_property
    def month_pairs(self) -> DataFrame:
        return mrr.month_pairs(self.mrr_state)

    @cached_property
    def mrr_movements(self) -> DataFrame:
        return self.keep("mrr_movements", mrr.mrr_movements(self.mrr_state, self.periods.year))

    @cached_property
    def mrr_movement_drivers(self) -> DataFrame:
        return self.keep("mrr_movement_drivers", mrr.movement_drivers(self.mrr_movements))

    @cached_property
    def mrr_driver_peaks(self) -> DataFrame:
        return reports.mrr_driver_peaks(self.mrr_movement_drivers)

    @cached_property
    def exhausted_invoices(self) -> DataFrame:
        return retries.exhausted_invoices(self.staging.invoices, self.staging.charges)

    @cached_property
    def retry_exhausted_revenue_lost(self) -> DataFrame:
        s = self.staging
        lost = retries.revenue_lost_of(self.mrr_movements, s.invoices, s.charges, self.periods.year)
        return self.keep("retry_exhausted_revenue_lost", lost)

    @cached_property
    def first_paid_invoices(self) -> DataFrame:
        return retention.first_paid_invoices(self.staging.invoices)

    @cached_property
    def paid_signup_cohort(self) -> DataFrame:
        cohort = retention.paid_signup_cohort(self.staging.invoices, self.periods.year_start)
        return self.keep("paid_signup_cohort", cohort)

    @cached_property
    def customer_nrr_base(self) -> DataFrame:
        p = self.periods
        base = retention.customer_nrr_base(
            self.paid_signup_cohort, self.mrr_state, p.anchor_month, p.last_month
        )
        return self.keep("customer_nrr_base", base)

    @cached_property
    def cohort_nrr(self) -> DataFrame:
        return self.keep("cohort_nrr", retention.cohort_nrr(self.customer_nrr_base))

    @cached_property
    def nrr_extremes(self) -> DataFrame:
        return reports.nrr_extremes(self.cohort_nrr)

    @cached_property
    def nrr_above_below(self) -> DataFrame:
        return reports.nrr_above_below(self.cohort_nrr)

    @cached_property
    def nrr_by_cohort_year(self) -> DataFrame:
        return reports.nrr_by_cohort_year(self.cohort_nrr)

    @cached_property
    def customer_nrr_movement(self) -> DataFrame:
        movement = retention.customer_nrr_movement(self.customer_nrr_base)
        return self.keep("customer_nrr_movement", movement)

    @cached_property
    def cohort_nrr_movement(self) -> DataFrame:
        movement = retention.cohort_nrr_movement(self.customer_nrr_movement)
        return self.keep("cohort_nrr_movement", movement)

    @cached_property
    def dominant_negative_driver(self) -> DataFrame:
        return reports.dominant_negative_driver(self.cohort_nrr_movement)

    @cached_property
    def _grains(self) -> list[quality.Grain]:
        s, every = self.staging, F.lit(True)
        cohort = reconciliation.in_cohort(*self.periods.invoices)
        return [
            (s.invoices, ["invoice_id"], {"invoices": every, "invoice_cohort": cohort}),
            (s.balance_transactions, ["balance_transaction_id"], {"balance_transactions": every}),
            (s.charges, ["charge_id"], {"charges": every}),
            (s.disputes, ["dispute_id"], {"disputes": every}),
            (s.subscription_events, ["subscription_event_id"], {"subscription_events": every}),
            (s.subscriptions, ["subscription_id"], {"subscriptions": every}),
            (self.processor_side, ["invoice_id"], {"processor_side": every}),
            (self.mrr_state, ["subscription_id", "mrr_month"], {"mrr_state": every}),
            (self.paid_signup_cohort, ["customer_id"], {"paid_signup_cohort": every}),
            (self.customer_nrr_base, ["customer_id"], {"customer_nrr_base": every}),
        ]

    @cached_property
    def grain_report(self) -> DataFrame:
        return quality.grain_report(self._grains)

    @cached_property
    def grain_violations(self) -> DataFrame:
        return quality.grain_listing(self._grains)

    @cached_property
    def movement_identity_check(self) -> DataFrame:
        return quality.movement_identity_check(self.mrr_rate_of_change, self.mrr_movement_drivers)

    @cached_property
    def nrr_identity_check(self) -> DataFrame:
        return quality.nrr_identity_check(self.cohort_nrr, self.cohort_nrr_movement)


# The stored tables of the layer, in the order their inputs allow.
STORED = (
    "invoice_cohort",
    "processor_side",
    "invoice_recon",
    "chargeback_restatement",
    "mrr_state",
    "mrr_rate_of_change",
    "mrr_movements",
    "mrr_movement_drivers",
    "retry_exhausted_revenue_lost",
    "paid_signup_cohort",
    "customer_nrr_base",
    "cohort_nrr",
    "customer_nrr_movement",
    "cohort_nrr_movement",
)


# The tables that are also published as CSV files.
EXPORTED = (
    "invoice_recon",
    "chargeback_restatement",
    "mrr_rate_of_change",
    "mrr_movement_drivers",
    "retry_exhausted_revenue_lost",
    "cohort_nrr",
    "cohort_nrr_movement",
)


# What identifies a row of each stored table.
GRAINS = {
    "invoice_cohort": ("invoice_id",),
    "processor_side": ("invoice_id",),
    "invoice_recon": ("invoice_id",),
    "chargeback_restatement": ("dispute_reason",),
    "mrr_state": ("subscription_id", "mrr_month"),
    "mrr_rate_of_change": ("mrr_month",),
    "mrr_movements": ("subscription_id", "mrr_month"),
    "mrr_movement_drivers": ("mrr_month",),
    "retry_exhausted_revenue_lost": ("mrr_month",),
    "paid_signup_cohort": ("customer_id",),
    "customer_nrr_base": ("customer_id",),
    "cohort_nrr": ("paid_signup_cohort_month",),
    "customer_nrr_movement": ("customer_id",),
    "cohort_nrr_movement": ("paid_signup_cohort_month",),
}


# Tables whose keys the staging tables could repeat: writing counts the rows that do, and a table with any is refused. All
# others come out of an aggregation by their key, or a full outer join of two, which cannot repeat one.
COUNTED = {
    name: GRAINS[name]
    for name in ("invoice_cohort", "invoice_recon", "mrr_state", "mrr_movements", "customer_nrr_base", "customer_nrr_movement")
}


# Tables stored by month, so that a later step opens only the months it needs.
PARTITIONED = {"mrr_state": ("mrr_month",), "mrr_movements": ("mrr_month",)}


# Tables that later steps join or group by these columns; a catalog keeps them in buckets.
BUCKETED = {
    "invoice_cohort": ("invoice_id",),
    "processor_side": ("invoice_id",),
    "invoice_recon": ("invoice_id",),
    "mrr_state": ("subscription_id",),
    "mrr_movements": ("subscription_id",),
    "paid_signup_cohort": ("customer_id",),
    "customer_nrr_base": ("customer_id",),
    "customer_nrr_movement": ("customer_id",),
}

Store = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class in_folder:  # noqa: N801: reads as a place, in_folder(root)
    """Store tables as parquet under a folder all executors share."""

    root: str
    refuses_repeats_in = frozenset(COUNTED)

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        return replace_table(df, f"{self.root}/{name}", PARTITIONED.get(name, ()), COUNTED.get(name, ()))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, f"{self.root}/{name}")

    def replace_months(self, name: str, df: DataFrame, months: Sequence[date]) -> None:
        replace_partitions(df, f"{self.root}/{name}", *PARTITIONED[name], months)


@dataclass(frozen=True)
class in_database:  # noqa: N801
    """Store tables in a catalog database, those of `BUCKETED` in so many buckets.

    A join shuffles neither of two tables with equal buckets, and of a table without them only that one. Spark keeps to
    the buckets if they are no fewer than `spark.sql.shuffle.partitions`.
    """

    database: str
    buckets: int = 0
    refuses_repeats_in = frozenset(COUNTED)

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        bucket_by = BUCKETED.get(name, ())
        return replace_catalog_table(
            df, f"{self.database}.{name}", PARTITIONED.get(name, ()), COUNTED.get(name, ()), bucket_by, self.buckets
        )

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"{self.database}.{name}")

    def replace_months(self, name: str, df: DataFrame, months: Sequence[date]) -> None:
        bucketed = df.repartition(self.buckets, *BUCKETED[name]) if self.buckets else df
        replace_catalog_partitions(bucketed, f"{self.database}.{name}", *PARTITIONED[name], months)


def write_layer(staging: Staging, periods: Periods, store: Store) -> Layer:
    """Store every table and return the layer reading them.

    Each table is computed once and read back by its successors. The MRR state is partitioned
    by month, so the retention base opens two of its thirteen partitions. A table that breaks its
    declared grain ends the run with BrokenGrain, before it replaces the one that is there.
    """
    layer = Layer(staging, periods, store)
    for name in STORED:
        getattr(layer, name)
    return layer


def export_layer(layer: Layer, root: str) -> None:
    """The published reports as CSV under `root`."""
    for name in EXPORTED:
        export_csv(getattr(layer, name), f"{root}/{name}")
