"""The six staging tables the operators read, by name and shape."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Staging:
    """Six DataFrames; a source may set them up eagerly or when first asked for."""

    invoices: DataFrame
    balance_transactions: DataFrame
    charges: DataFrame
    disputes: DataFrame
    subscription_events: DataFrame
    subscriptions: DataFrame

    def __init__(self, **tables: DataFrame):
        missing = SCHEMAS.keys() - tables.keys()
        if missing:
            raise ValueError(f"staging tables missing: {sorted(missing)}")
        self.__dict__.update(tables)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SCHEMAS}


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, CENTS, MOMENT, TRUTH = T.StringType(), T.LongType(), T.TimestampNTZType(), T.BooleanType()

SCHEMAS = {
    "invoices": _schema(
        invoice_id=TEXT,
        customer_id=TEXT,
        invoice_amount_paid_cents=CENTS,
        invoice_created=MOMENT,
        invoice_period_end=MOMENT,
        invoice_paid=TRUTH,
        invoice_status=TEXT,
        invoice_collection_method=TEXT,
    ),
    "balance_transactions": _schema(
        balance_transaction_id=TEXT,
        balance_source_id=TEXT,
        invoice_id=TEXT,
        customer_id=TEXT,
        balance_reporting_category=TEXT,
        balance_amount_cents=CENTS,
        balance_net_cents=CENTS,
        balance_available_on=MOMENT,
    ),
    "charges": _schema(charge_id=TEXT, invoice_id=TEXT, charge_status=TEXT, charge_captured=TRUTH),
    "disputes": _schema(dispute_id=TEXT, dispute_reason=TEXT),
    "subscription_events": _schema(
        subscription_event_id=TEXT,
        subscription_id=TEXT,
        customer_id=TEXT,
        subscription_event_type=TEXT,
        event_effective_at=MOMENT,
        previous_plan_amount_cents=CENTS,
        new_plan_amount_cents=CENTS,
    ),
    "subscriptions": _schema(subscription_id=TEXT, plan_interval=TEXT),
}


def staging_from_parquet(spark: SparkSession, root: str) -> Staging:
    """Read `<root>/<table>` parquet datasets; extra columns are left unread."""
    return Staging(
        **{
            name: spark.read.parquet(f"{root}/{name}").select(*schema.names)
            for name, schema in SCHEMAS.items()
        }
    )


def staging_from_catalog(spark: SparkSession, database: str, prefix: str = "stg_") -> Staging:
    """Read catalog tables such as `staging.stg_invoices`."""
    return Staging(
        **{
            name: spark.table(f"{database}.{prefix}{name}").select(*schema.names)
            for name, schema in SCHEMAS.items()
        }
    )
