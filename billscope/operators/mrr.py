"""Monthly recurring revenue: as-of state, rate of change, and what drove each movement."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billscope.functions import vocabulary as v
from billscope.functions.months import in_months, in_year, later_month, month_of
from billscope.functions.numbers import flag, quotient, sum_where


EVENT_FIELDS = (
    "event_effective_at",
    "subscription_event_id",
    "customer_id",
    "subscription_event_type",
    "previous_plan_amount_cents",
    "new_plan_amount_cents",
)

# A subscription with more than this share of the events has them reduced before they are shuffled.
HOT_SHARE = 1 / 1000


def hot_subscriptions(events: DataFrame) -> Column:
    """The subscriptions with a share of HOT_SHARE or more (ids), and whether events without one have it (unnamed): a scalar
    subquery over a sketch of one column.

    There are at most 1 / HOT_SHARE of them, and mostly none. The sketch may err by a fraction of that share, which
    changes where an event is reduced and not what comes out.
    """
    most = round(1 / HOT_SHARE)
    top = events.agg(F.expr(f"approx_top_k(subscription_id, {most}, {10 * most})").alias("top"), F.count("*").alias("n"))
    hot = F.filter("top", lambda item: item["count"] >= F.greatest(F.lit(2), F.col("n") * HOT_SHARE))
    ids = top.select(F.transform(hot, lambda item: item["item"]).alias("ids"))
    return ids.select(F.struct("ids", F.exists("ids", lambda item: item.isNull()).alias("unnamed"))).scalar()


def closing_events(events: DataFrame, first_month: date, n_months: int) -> DataFrame:
    """The last event of each subscription in each month, with the month of the next one.

    Only the last event before a month's cutoff can be in force in that month, so one event is
    kept for each month, and one for everything before the first reported month. The order is
    (effective_at, event id) with a NULL id last. Dealt by subscription and sorted, an event is
    the last one of its month if the next one is of another month, and that is the month asked
    for: one shuffle and one sort, whatever the number of months. Events of a subscription that
    has a notable share of all are reduced to one for each month and task before they move.
    """
    start = later_month(first_month, -1)
    cutoff = later_month(first_month, n_months)
    in_scope = in_months(events, "effective_month", None, cutoff).filter(F.col("event_effective_at") < F.lit(cutoff))
    rows = in_scope.select(
        "subscription_id",
        F.greatest(month_of(F.col("event_effective_at")), F.lit(start)).alias("event_month"),
        *EVENT_FIELDS,
    )
    hot, subscription = hot_subscriptions(in_scope), F.col("subscription_id")
    is_hot = F.coalesce(F.when(subscription.isNull(), hot["unnamed"]).otherwise(F.array_contains(hot["ids"], subscription)), F.lit(False))
    order = ("event_effective_at", F.col("subscription_event_id").isNull(), "subscription_event_id")
    latest_first = Window.partitionBy("subscription_id", "event_month").orderBy(*(F.desc(c) if isinstance(c, str) else c.desc() for c in order))
    reduced = rows.filter(is_hot).withColumn("place", F.row_number().over(latest_first)).filter("place = 1").drop("place")
    history = Window.partitionBy("subscription_id").orderBy(*order)
    return (
        rows.filter(~is_hot)
        .unionByName(reduced)
        .withColumn("next_event_month", F.lead("event_month").over(history))
        .filter(F.col("next_event_month").isNull() | (F.col("next_event_month") != F.col("event_month")))
        .select("subscription_id", "event_month", *EVENT_FIELDS, "next_event_month")
    )


def event_months(first_month: date, n_months: int) -> tuple[Column, Column]:
    """First and last reported month in which a closing event is the one in force.

    An ordinary event holds until the month before the next one. A cancellation (or an event
    of unknown type) counts only in the month it happened.
    """
    first_month, last_month = later_month(first_month, 0), F.lit(later_month(first_month, n_months - 1))
    holds_until = F.coalesce(F.add_months("next_event_month", -1), last_month)
    starts = F.greatest(F.col("event_month"), F.lit(first_month))
    ends = F.when(F.col("subscription_event_type") != v.CANCELED, holds_until).otherwise(
        F.col("event_month")
    )
    return starts, ends


def monthly_amount(plan_amount: Column, interval: Column) -> Column:
    """Plan amount as monthly cents: a year's plan is spread over 12, half a cent rounds away from 0."""
    half = F.when(plan_amount < 0, -6).otherwise(6)
    yearly = F.call_function("div", plan_amount + half, F.lit(12))
    return F.when(interval == v.YEARLY, yearly).when(interval == v.MONTHLY, plan_amount).otherwise(0)


def mrr_state(
    events: DataFrame, subscriptions: DataFrame, first_month: date, n_months: int
) -> DataFrame:
    """MRR of every live subscription in every month; one row per (subscription, month).

    Upgrades, creations and reactivations count from their own month. A downgrade or
    cancellation still counts its previous amount in its own month and bites the month after.

    As-of matching needs no range join: each closing event is joined to its plan once and
    expanded into the months it holds, so the work grows with live subscription-months. The
    join shares the events' only shuffle.
    """
    first, last = event_months(first_month, n_months)
    held = (
        closing_events(events, first_month, n_months)
        .select("*", first.alias("first_held"), last.alias("last_held"))
        .filter(F.col("first_held") <= F.col("last_held"))
        .join(subscriptions.select("subscription_id", "plan_interval"), "subscription_id", "left")
    )
    months = F.sequence("first_held", "last_held", F.expr("interval 1 month"))
    reduced_now = F.col("subscription_event_type").isin(v.CANCELED, v.DOWNGRADED) & (
        F.col("event_month") == F.col("mrr_month")
    )
    plan_amount = F.when(
        reduced_now, F.coalesce("previous_plan_amount_cents", F.lit(0))
    ).otherwise(F.coalesce("new_plan_amount_cents", F.lit(0)))
    return held.withColumn("mrr_month", F.explode(months)).select(
        "subscription_id",
        "subscription_event_id",
        "customer_id",
        "subscription_event_type",
        F.add_months("mrr_month", -1).alias("prev_mrr_month"),
        "mrr_month",
        F.add_months("mrr_month", 1).alias("mrr_cutoff"),
        "plan_interval",
        monthly_amount(plan_amount, F.col("plan_interval")).alias("mrr_cents"),
    )


def mrr_totals(state: DataFrame, one_row_each: bool = False) -> DataFrame:
    """Total MRR, customers and subscriptions per month.

    Two distinct counts side by side would send every state row three times. Here each
    (subscription, month) marks one of its rows, on the partitioning a lazy state already has,
    and one aggregation by (month, customer) gives both counts and the sum.

    `one_row_each` says that the state is known to repeat no (subscription, month), as stored
    states are: every row is then a subscription, and nothing is shuffled or sorted by it.
    """
    subscription = F.col("subscription_id").isNotNull()
    if not one_row_each:
        one_row = Window.partitionBy("subscription_id", "mrr_month").orderBy("customer_id")
        subscription = subscription & (F.row_number().over(one_row) == 1)
    return (
        state.select("mrr_month", "customer_id", "mrr_cents", flag(subscription).alias("subscription"))
        .groupBy("mrr_month", "customer_id")
        .agg(F.sum("mrr_cents").alias("mrr_cents"), F.sum("subscription").alias("subscriptions"))
        .groupBy("mrr_month")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.sum("subscriptions").alias("subscription_count"),
            F.sum("mrr_cents").alias("mrr_cents"),
        )
        .select(
            F.add_months("mrr_month", -1).alias("prev_mrr_month"),
            "mrr_month",
            F.add_months("mrr_month", 1).alias("mrr_cutoff"),
            "customer_count",
            "subscription_count",
            "mrr_cents",
        )
    )


def mrr_rate_of_change(state: DataFrame, year: int, one_row_each: bool = False) -> DataFrame:
    """Month-over-month change of total MRR in `year`; `one_row_each` as in `mrr_totals`.

    The LAG runs over the monthly totals (one row per month, whatever the input size), and the
    year is cut out after it, so January still sees the December before.
    """
    previous = F.lag("mrr_cents").over(Window.orderBy("mrr_month"))
    change = F.col("mrr_cents") - F.col("prev_mrr_cents")
    return (
        mrr_totals(state, one_row_each)
        .withColumn("prev_mrr_cents", previous)
        .filter(in_year(F.col("mrr_month"), year))
        .select(
            "prev_mrr_month",
            "mrr_month",
            "mrr_cutoff",
            "prev_mrr_cents",
            "mrr_cents",
            change.alias("net_mrr_change_cents"),
            quotient(change, F.col("prev_mrr_cents"), 6).alias("mrr_change_rate"),
            "customer_count",
            "subscription_count",
        )
    )


def month_pairs(state: DataFrame) -> DataFrame:
    """Each subscription's MRR in a month beside its MRR in the month before.

    The result of a full outer self-join on consecutive months, in one pass: a row looks back
    at its predecessor, and a row without a successor in the next month also speaks for that
    month, with nothing left. A subscription has at most one row per month, so the window holds
    few rows, and it reuses the shuffle by subscription a lazy state already has. Repeated rows
    would need the join's fan-out; they are refused rather than miscounted (`grain_report`
    finds them). Rows without a subscription id never match another row.
    """
    history = Window.partitionBy("subscription_id").orderBy("mrr_month")
    carried = ("customer_id", "subscription_event_type", "mrr_cents")
    month, gone, known = F.col("mrr_month"), F.col("gone"), F.col("subscription_id").isNotNull()
    follows = known & (F.col("earlier_month") == F.add_months(month, -1))
    followed = known & (F.col("later_month") == F.add_months(month, 1))
    repeated = known & (F.col("later_month") == month)
    refusal = F.raise_error(F.lit("more than one state row for a subscription and month"))
    cents, nothing = F.coalesce("mrr_cents", F.lit(0)), F.lit(0).cast("bigint")
    states = F.when(followed, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))

    def earlier(column: str) -> Column:
        return F.when(follows, F.col(f"earlier_{column}"))

    return (
        state.select(
            "subscription_id",
            "mrr_month",
            *carried,
            *(F.lag(c).over(history).alias(f"earlier_{c}") for c in carried),
            F.lag("mrr_month").over(history).alias("earlier_month"),
            F.lead("mrr_month").over(history).alias("later_month"),
        )
        .withColumn("gone", F.explode(states))
        .select(
            "subscription_id",
            F.when(gone, F.add_months(month, 1)).otherwise(month).alias("mrr_month"),
            *(F.when(gone, F.col(c)).otherwise(F.coalesce(c, earlier(c))).alias(c) for c in carried[:2]),
            F.when(gone, cents).otherwise(F.coalesce(earlier("mrr_cents"), nothing)).alias("prev_mrr_cents"),
            F.when(repeated, refusal).when(gone, nothing).otherwise(cents).alias("mrr_cents"),
        )
    )


def mrr_movements(state: DataFrame, year: int) -> DataFrame:
    """Every subscription-month of `year` with its change in MRR and the driver behind it."""
    now, before = F.col("mrr_cents"), F.col("prev_mrr_cents")
    appeared = (now > 0) & (before == 0)
    driver = (
        F.when(appeared & (F.col("subscription_event_type") == v.REACTIVATED), "reactivation")
        .when(appeared, "new")
        .when((now == 0) & (before > 0), "churn")
        .when((now > before) & (before > 0), "expansion")
        .when((now < before) & (now > 0), "contraction")
        .when((now == before) & (now > 0), v.FLAT)
        .otherwise(v.NO_MRR)
    )
    return month_pairs(state).filter(in_year(F.col("mrr_month"), year)).select(
        "subscription_id",
        "customer_id",
        "subscription_event_type",
        "mrr_month",
        "prev_mrr_cents",
        "mrr_cents",
        (now - before).alias("net_mrr_change_cents"),
        driver.alias("mrr_movement_driver"),
    )


def movement_drivers(movements: DataFrame) -> DataFrame:
    """Net MRR change of each month split by driver; losses are given as positive amounts."""
    change = F.col("net_mrr_change_cents")
    amounts = {d: F.abs(change) if d in ("contraction", "churn") else change for d in v.DRIVERS}
    return movements.groupBy("mrr_month").agg(
        F.sum(change).alias("net_mrr_change_cents"),
        *(
            sum_where(F.col("mrr_movement_driver") == d, amount).alias(f"{d}_mrr_cents")
            for d, amount in amounts.items()
        ),
    )


def mrr_movement_drivers(state: DataFrame, year: int) -> DataFrame:
    """The drivers straight from the state, where its movements are not stored."""
    return movement_drivers(mrr_movements(state, year))
