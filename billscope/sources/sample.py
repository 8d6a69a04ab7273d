"""Billing-shaped staging tables derived from the TPC-H-like sample tables.

An order is an invoice, its ledger rows and one subscription event; a line item is a charge
attempt; a customer holds two subscriptions. Every rule looks at one source row only, so the
staging tables are plain projections: no shuffle, and a hot key costs nothing here. Line
items repeat (order, line number), so a charge id recurs the way a retried charge does.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from billscope.sources.staging import Staging

DISPUTED = "(o_orderstatus = 'F' and day between 5 and 14)"
REVERSED = f"({DISPUTED} and o_orderpriority in ('1-URGENT', '2-HIGH') and day between 8 and 11)"
REFUND = "case when day = 28 then cents when day <= 10 and o_orderpriority = '3-MEDIUM' then fifth end"

# (condition, entry number, category, amount, net amount, days after the order)
LEDGER_RULES = (
    ("day <> 13", 1, "charge", "cents", "cents - fee", 2),
    ("day = 21 and o_orderpriority = '1-URGENT'", 2, "charge", "cents", "cents - fee", 3),
    (f"{REFUND} is not null", 3, "refund", f"-({REFUND})", f"-({REFUND})", 35),
    (DISPUTED, 4, "dispute", "-cents", "-cents - 1500", 60),
    (REVERSED, 5, "dispute_reversal", "cents", "cents", 90),
    ("true", 6, "fee", "-fee", "0L", 2),
)


def sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "*",
        "cast(round(o_totalprice * 100) as bigint) as cents",
        "dayofmonth(o_orderdate) as day",
    ).selectExpr("*", "cents div 34 as fee", "cents div 5 as fifth")


def sample_invoices(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey as invoice_id",
        "o_custkey as customer_id",
        "cents as invoice_amount_paid_cents",
        "o_orderdate as invoice_created",
        "o_orderdate as invoice_period_end",
        "o_orderstatus <> 'P' as invoice_paid",
        """case when o_orderstatus = 'P' then 'open'
                when o_orderstatus = 'O' and o_orderpriority = '3-MEDIUM' then 'uncollectible'
                else 'paid' end as invoice_status""",
        """case when o_orderpriority = '5-LOW' then 'send_invoice'
                else 'charge_automatically' end as invoice_collection_method""",
    )


def sample_balance_transactions(orders: DataFrame) -> DataFrame:
    """Up to six ledger rows per order, built as one array and exploded; rules not met give no row."""
    rows = ", ".join(
        f"""if({condition}, named_struct(
              'balance_transaction_id', o_orderkey * 10 + {number},
              'balance_reporting_category', '{category}',
              'balance_amount_cents', {amount},
              'balance_net_cents', {net},
              'balance_available_on', o_orderdate + interval {days} days), null)"""
        for condition, number, category, amount, net, days in LEDGER_RULES
    )
    return orders.selectExpr(
        f"inline(array({rows}))",
        "o_orderkey as balance_source_id",
        "o_orderkey as invoice_id",
        "o_custkey as customer_id",
    ).filter("balance_transaction_id is not null")


def sample_disputes(orders: DataFrame) -> DataFrame:
    """The processor's dispute records; disputes of the 14th have none."""
    return orders.filter(f"{DISPUTED} and day <> 14").selectExpr(
        "o_orderkey as dispute_id",
        """case o_orderpriority
             when '1-URGENT' then 'fraudulent'
             when '2-HIGH' then 'product_not_received'
             when '3-MEDIUM' then 'subscription_canceled'
             when '4-NOT SPECIFIED' then 'duplicate'
             else 'general' end as dispute_reason""",
    )


def sample_charges(lineitem: DataFrame) -> DataFrame:
    """A line item is a charge attempt; some open returned lines have no known status."""
    open_return = "(l_returnflag = 'R' and l_linestatus = 'O')"
    return lineitem.selectExpr(
        "l_orderkey * 100 + l_linenumber as charge_id",
        "l_orderkey as invoice_id",
        f"""case when {open_return} and l_quantity >= 46 then null
                 when l_returnflag = 'A' then 'failed' else 'succeeded' end as charge_status""",
        f"not {open_return} as charge_captured",
    )


def sample_subscription_events(orders: DataFrame) -> DataFrame:
    """An order is a plan event; pending orders of the 30th have no known event type."""
    return orders.selectExpr(
        "o_orderkey as subscription_event_id",
        "o_custkey * 2 + if(o_totalprice >= 250000, 1, 0) as subscription_id",
        "o_custkey as customer_id",
        """case when day = 30 and o_orderstatus = 'P' then null
                when o_orderpriority = '1-URGENT' then 'created'
                when o_orderpriority = '2-HIGH' then 'upgraded'
                when o_orderpriority = '3-MEDIUM' then 'downgraded'
                when o_orderpriority = '4-NOT SPECIFIED' then 'reactivated'
                else 'canceled' end as subscription_event_type""",
        "o_orderdate as event_effective_at",
        """case o_orderpriority when '2-HIGH' then cents - fifth when '3-MEDIUM' then cents + fifth
                when '5-LOW' then cents end as previous_plan_amount_cents""",
        "case when o_orderpriority <> '5-LOW' then cents end as new_plan_amount_cents",
    )


def sample_subscriptions(customer: DataFrame) -> DataFrame:
    """Two plans per customer; customers in debt have no record of their second one."""
    return customer.selectExpr(
        "c_custkey",
        "c_mktsegment",
        "explode(if(c_acctbal < 0, array(0), array(0, 1))) as number",
    ).selectExpr(
        "c_custkey * 2 + number as subscription_id",
        """case when c_mktsegment in ('AUTOMOBILE', 'BUILDING') then 'year'
                when c_mktsegment in ('MACHINERY', 'HOUSEHOLD') then 'month'
                else 'week' end as plan_interval""",
    )


class SampleStaging(Staging):
    """The sample's staging tables, each set up when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def orders(self) -> DataFrame:
        return sample_orders(self.spark, self.sf_dir)

    @cached_property
    def invoices(self) -> DataFrame:
        return sample_invoices(self.orders)

    @cached_property
    def balance_transactions(self) -> DataFrame:
        return sample_balance_transactions(self.orders)

    @cached_property
    def charges(self) -> DataFrame:
        return sample_charges(self.spark.read.parquet(f"{self.sf_dir}/lineitem.parquet"))

    @cached_property
    def disputes(self) -> DataFrame:
        return sample_disputes(self.orders)

    @cached_property
    def subscription_events(self) -> DataFrame:
        return sample_subscription_events(self.orders)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return sample_subscriptions(self.spark.read.parquet(f"{self.sf_dir}/customer.parquet"))


def sample_staging(spark: SparkSession, sf_dir: str) -> Staging:
    return SampleStaging(spark, sf_dir)
