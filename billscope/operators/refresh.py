"""The MRR state after its events changed, from the old state and the changed subscriptions alone."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.operators.mrr import mrr_state


def changed_keys(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Key values whose rows differ between two states of a table: added, taken away or corrected ones; one row each.

    Each side is summed up by key, map-side first, in numbers that do not depend on the order of rows: how many there are,
    and two sums of hashes in which every column counts. So each side moves one narrow row per key and task.
    """
    columns = now.columns

    def summed(rows: DataFrame, side: str) -> DataFrame:
        halves = (F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)") for seed in (1, 2))
        sums = (F.sum(half) for half in halves)
        return rows.groupBy(key).agg(F.struct(F.count("*"), *sums).alias(side))

    old, new = summed(before.select(*columns), "old"), summed(now, "new").withColumnRenamed(key, "new_key")
    both = old.join(new, F.col(key).eqNullSafe(F.col("new_key")), "full")
    either = F.when(F.col("new").isNull(), F.col(key)).otherwise(F.col("new_key"))
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(either.alias(key))


def _is_changed(changed: DataFrame) -> tuple[DataFrame, Column]:
    return changed.select(F.col("subscription_id").alias("changed_id")), F.col("subscription_id").eqNullSafe(F.col("changed_id"))


def only_changed(rows: DataFrame, changed: DataFrame) -> DataFrame:
    return rows.join(*_is_changed(changed), "left_semi")


def all_but_changed(rows: DataFrame, changed: DataFrame) -> DataFrame:
    return rows.join(*_is_changed(changed), "left_anti")


def fresh_state(
    events: DataFrame, subscriptions: DataFrame, changed: DataFrame, first_month: date, n_months: int
) -> DataFrame:
    """The state of the changed subscriptions, from all their events. Others' events go before the first shuffle if the
    changed ones are few, and never reach an aggregation."""
    return mrr_state(only_changed(events, changed), subscriptions, first_month, n_months)


def refreshed_state(
    state: DataFrame, events: DataFrame, subscriptions: DataFrame, changed: DataFrame, first_month: date, n_months: int
) -> DataFrame:
    """The whole state as a rebuild from `events` would give it; `state` is the one before the change."""
    fresh = fresh_state(events, subscriptions, changed, first_month, n_months)
    return all_but_changed(state, changed).unionByName(fresh)


def touched_months(stale: DataFrame, fresh: DataFrame) -> DataFrame:
    """Months in which the changed subscriptions' rows are not what they were; as many rows as the calendar has, at most."""
    return stale.exceptAll(fresh).union(fresh.exceptAll(stale)).select("mrr_month").distinct()
