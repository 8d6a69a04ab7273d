"""Checks on the results: declared grains and accounting identities.

Identity checks return one row with how much was checked and how much failed, so an empty
result cannot pass for a clean one.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.functions.numbers import count_where


def grain_violations(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur on more than one row, with how often."""
    return table.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


# A table's rows, the columns that identify one, and which rows count.
Grain = tuple[DataFrame, Sequence[str], Mapping[str, Column]]


def grain_report(tables: Sequence[Grain]) -> DataFrame:
    """One row per table: rows, distinct keys, and keys that occur more than once.

    A table that is a part of another one's rows is counted in the same pass: each grain names
    the tables in it and the condition that makes a row one of theirs.
    """

    def one(table: DataFrame, keys: Sequence[str], parts: Mapping[str, Column]) -> DataFrame:
        counted = table.groupBy(*keys).agg(*(count_where(is_row).alias(name) for name, is_row in parts.items()))
        summed = counted.agg(
            *(
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(", ".join(keys)).alias("grain"),
                    F.coalesce(F.sum(name), F.lit(0)).alias("row_count"),
                    count_where(F.col(name) > 0).alias("key_count"),
                    count_where(F.col(name) > 1).alias("repeated_key_count"),
                ).alias(name)
                for name in parts
            )
        )
        return summed.select(F.inline(F.array(*parts)))

    return reduce(DataFrame.unionByName, (one(*grain) for grain in tables))


def grain_listing(tables: Sequence[Grain]) -> DataFrame:
    """The repeated keys behind the report: table, key (columns joined by a comma) and rows."""

    def one(table: DataFrame, keys: Sequence[str], parts: Mapping[str, Column]) -> DataFrame:
        counted = table.groupBy(*keys).agg(*(count_where(is_row).alias(name) for name, is_row in parts.items()))
        key = F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys))
        each = F.array(*(F.struct(F.lit(name).alias("table_name"), F.col(name).alias("row_count")) for name in parts))
        return counted.select(key.alias("key"), F.inline(each)).filter("row_count > 1")

    return reduce(DataFrame.unionByName, (one(*grain) for grain in tables)).select("table_name", "key", "row_count")


def movement_identity_check(rate_of_change: DataFrame, drivers: DataFrame) -> DataFrame:
    """The drivers of a month must add up to its net change, and to the change in total MRR.

    A business's first month has no month before it, hence no change in total MRR to hold the
    drivers against; such months are counted apart and are no violation.
    """
    totals = rate_of_change.select(
        "mrr_month",
        F.col("net_mrr_change_cents").alias("total_change"),
        F.col("net_mrr_change_cents").isNull().alias("first"),
    )
    split = (
        F.col("new_mrr_cents")
        + F.col("reactivation_mrr_cents")
        + F.col("expansion_mrr_cents")
        - F.col("contraction_mrr_cents")
        - F.col("churn_mrr_cents")
    )
    net = F.col("net_mrr_change_cents")
    return drivers.join(totals, "mrr_month", "full").agg(
        F.count("*").alias("months_checked"),
        count_where(~net.eqNullSafe(split)).alias("split_violations"),
        count_where(~net.eqNullSafe(F.col("total_change")) & ~F.coalesce("first", F.lit(False))).alias(
            "total_violations"
        ),
        count_where(F.col("first")).alias("months_without_predecessor"),
    )


def nrr_identity_check(nrr: DataFrame, movement: DataFrame) -> DataFrame:
    """Cohort movements must explain the ending MRR and agree with the NRR report."""
    report = nrr.select(
        "paid_signup_cohort_month",
        F.struct("customer_count", "starting_mrr_cents", "ending_mrr_cents").alias("reported"),
        F.col("nrr_pct").alias("nrr_fraction"),
    )
    explained = (
        F.col("starting_mrr_cents")
        + F.col("expansion_mrr_cents")
        - F.col("contraction_mrr_cents")
        - F.col("churn_mrr_cents")
    )
    kinds = ("expanded", "contracted", "churned", "unchanged")
    counted = sum((F.col(f"{k}_customer_count") for k in kinds), F.lit(0))
    moved = F.struct("customer_count", "starting_mrr_cents", "ending_mrr_cents")
    same_rate = F.col("nrr_pct") == F.col("nrr_fraction") * 100
    return movement.join(report, "paid_signup_cohort_month", "full").agg(
        F.count("*").alias("cohorts_checked"),
        count_where(~F.col("ending_mrr_cents").eqNullSafe(explained)).alias("ending_violations"),
        count_where(~F.col("customer_count").eqNullSafe(counted)).alias("count_violations"),
        count_where(~(moved.eqNullSafe(F.col("reported")) & F.coalesce(same_rate, F.lit(False)))).alias(
            "report_violations"
        ),
    )
