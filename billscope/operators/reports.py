"""Headline figures read off the monthly and cohort tables (a few dozen rows each)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.functions import vocabulary as v
from billscope.functions.numbers import count_where, fraction


def largest(value: Column, period: Column) -> Column:
    """Aggregate: struct(value, period) of the largest value; the earliest period wins a tie, a NULL never."""
    return F.min(F.when(value.isNotNull(), F.struct((-value).alias("negated"), period.alias("period"))))


def mrr_growth_summary(rate_of_change: DataFrame) -> DataFrame:
    """First to last month growth, the best month, and how many months declined."""
    month, mrr, change = F.col("mrr_month"), F.col("mrr_cents"), F.col("net_mrr_change_cents")
    return (
        rate_of_change.agg(
            F.min(month).alias("first_month"),
            F.max(month).alias("last_month"),
            F.min_by(mrr, month).alias("first_mrr_cents"),
            F.max_by(mrr, month).alias("last_mrr_cents"),
            largest(change, month).alias("best"),
            count_where(change < 0).alias("declining_months"),
        )
        .withColumn("growth_cents", F.col("last_mrr_cents") - F.col("first_mrr_cents"))
        .select(
            "first_month",
            "last_month",
            "first_mrr_cents",
            "last_mrr_cents",
            "growth_cents",
            fraction(F.col("growth_cents"), F.col("first_mrr_cents"), 4).alias("growth_rate"),
            F.col("best.period").alias("best_month"),
            (-F.col("best.negated")).alias("best_gain_cents"),
            "declining_months",
        )
    )


def mrr_driver_peaks(drivers: DataFrame) -> DataFrame:
    """The month in which each driver was strongest, and its total over all months."""
    columns = {d: F.col(f"{d}_mrr_cents") for d in v.DRIVERS}
    each = F.explode(
        F.array(*(F.struct(F.lit(d).alias("driver"), c.alias("cents")) for d, c in columns.items()))
    )
    return (
        drivers.select("mrr_month", each.alias("one"))
        .groupBy(F.col("one.driver").alias("driver"))
        .agg(
            largest(F.col("one.cents"), F.col("mrr_month")).alias("peak"),
            F.sum("one.cents").alias("total_cents"),
        )
        .select(
            "driver",
            F.col("peak.period").alias("peak_month"),
            (-F.col("peak.negated")).alias("peak_cents"),
            "total_cents",
        )
    )


def nrr_extremes(nrr: DataFrame) -> DataFrame:
    """Overall NRR with the strongest and the weakest cohort; the earliest cohort wins a tie."""
    month, rate = F.col("paid_signup_cohort_month"), F.col("nrr_pct")
    return nrr.agg(
        F.sum("customer_count").alias("customer_count"),
        fraction(F.sum("ending_mrr_cents"), F.sum("starting_mrr_cents"), 4).alias("overall_nrr"),
        largest(rate, month).alias("best"),
        F.min(F.when(rate.isNotNull(), F.struct(rate.alias("rate"), month.alias("period")))).alias("worst"),
    ).select(
        "customer_count",
        "overall_nrr",
        F.col("best.period").alias("strongest_cohort"),
        (-F.col("best.negated")).alias("strongest_nrr"),
        F.col("worst.period").alias("weakest_cohort"),
        F.col("worst.rate").alias("weakest_nrr"),
    )


def nrr_above_below(nrr: DataFrame) -> DataFrame:
    """How many cohorts shrank and how many kept or grew their MRR."""
    return nrr.agg(
        F.count("*").alias("cohort_count"),
        count_where(F.col("nrr_pct") < 1).alias("below_count"),
        count_where(F.col("nrr_pct") >= 1).alias("at_or_above_count"),
    )


def nrr_by_cohort_year(nrr: DataFrame) -> DataFrame:
    """Unweighted mean NRR of the cohorts of each signup year."""
    return nrr.groupBy(F.year("paid_signup_cohort_month").alias("cohort_year")).agg(
        F.count("*").alias("cohort_count"),
        F.round(F.avg("nrr_pct"), 4).alias("mean_nrr"),
    )


def dominant_negative_driver(movement: DataFrame) -> DataFrame:
    """Which loss weighed more, churn or contraction, and in how many cohorts."""
    churn, contraction = F.col("churn_mrr_cents"), F.col("contraction_mrr_cents")
    dominant = (
        F.when(churn > contraction, "churn").when(churn < contraction, "contraction").otherwise("even")
    )
    return movement.groupBy(dominant.alias("dominant_driver")).agg(
        F.count("*").alias("cohort_count"),
        F.sum(churn).alias("churn_mrr_cents"),
        F.sum(contraction).alias("contraction_mrr_cents"),
    )
