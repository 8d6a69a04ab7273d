"""Bring a stored layer up to date after late or corrected events, without rebuilding its MRR state."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.months import later_month
from billscope.operators.mrr import mrr_movements
from billscope.operators.quality import grain_violations
from billscope.operators.refresh import all_but_changed, fresh_state, only_changed, touched_months
from billscope.plans.layer import GRAINS, Layer, in_database, in_folder
from billscope.plans.periods import Periods
from billscope.sources.sinks import LISTED_KEYS, BrokenGrain
from billscope.sources.staging import Staging

# What is computed from the state and its movements, in the order their inputs allow; each is written anew.
DEPENDENT = (
    "mrr_rate_of_change",
    "mrr_movement_drivers",
    "retry_exhausted_revenue_lost",
    "customer_nrr_base",
    "cohort_nrr",
    "customer_nrr_movement",
    "cohort_nrr_movement",
)


def refresh_mrr(staging: Staging, periods: Periods, store: in_folder | in_database, changed: DataFrame) -> list[date]:
    """Rewrite the months of the stored state and movements in which a changed subscription differs, and return them.

    `staging` is as of now; `changed` has a row (subscription_id) for each subscription whose events or record changed. Only
    these are recomputed, from all their events. Other months keep their files. A run that fails midway leaves months old
    and new; running it again repairs them, because what differs is found anew. A subscription with two rows in a month
    ends the run before anything is written.
    """
    spark = changed.sparkSession
    state = store.read(spark, "mrr_state")
    calendar = (periods.anchor_month, periods.n_months)
    fresh = fresh_state(staging.subscription_events, staging.subscriptions, changed, *calendar).select(*state.columns)
    grain = GRAINS["mrr_state"]
    broken = grain_violations(fresh.filter("subscription_id IS NOT NULL"), grain).limit(LISTED_KEYS).collect()
    if broken:
        raise BrokenGrain("mrr_state", grain, sum(row.row_count - 1 for row in broken), [row.asDict() for row in broken])
    months = sorted(row.mrr_month for row in touched_months(only_changed(state, changed), fresh).collect())
    if not months:
        return []

    def of(some: list[date]):
        return F.col("mrr_month").isin(some)

    rows = all_but_changed(state.filter(of(months)), changed).unionByName(fresh.filter(of(months)))
    store.replace_months("mrr_state", rows, months)
    # A month's movements come from its rows and those of the month before.
    affected = sorted({m for month in months for m in (month, later_month(month, 1)) if m.year == periods.year})
    if affected:
        needed = sorted({m for month in affected for m in (month, later_month(month, -1))})
        state = store.read(spark, "mrr_state").filter(of(needed))
        store.replace_months("mrr_movements", mrr_movements(state, periods.year).filter(of(affected)), affected)
    return months


def refresh_layer(staging: Staging, periods: Periods, store: in_folder | in_database, changed: DataFrame) -> Layer:
    """The stored layer after `refresh_mrr`, with every report over the state written anew if any month was."""
    spark = changed.sparkSession
    months = refresh_mrr(staging, periods, store, changed)
    layer = Layer(staging, periods, store)
    for name in GRAINS:
        if not months or name not in DEPENDENT:
            layer.__dict__[name] = store.read(spark, name)  # stored, and still right
    for name in DEPENDENT:
        getattr(layer, name)
    return layer
