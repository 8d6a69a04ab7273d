"""Staging tables laid out by month, so that a window opens only its months and a cohort only those of its invoices.

Invoices, their ledger rows and their charges are partitioned by the month the invoice was created in, ledger rows also by the
month their money becomes available, subscription events by the month they take effect in. The operators know these columns: a
window becomes a test on the partition column, and joins of an invoice's rows take its month as a second key, from which Spark prunes
the months of one side by those that the other side turns out to have.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.functions.months import month_of
from billscope.sources.sinks import read_table, replace_table
from billscope.sources.staging import SCHEMAS, Staging

LAYOUT = {
    "invoices": ("invoice_month",),
    "balance_transactions": ("invoice_month", "available_month"),
    "charges": ("invoice_month",),
    "subscription_events": ("effective_month",),
}


def with_months(staging: Staging) -> dict[str, DataFrame]:
    """The staging tables with their partition columns.

    Ledger rows and charges get the month of their invoice from it; of an unknown invoice, or of none, they have no month, and no
    cohort can ask for them. One invoice may hold very many rows: it is a skewed key of an ordinary join.
    """
    tables = dict(staging.tables())
    tables["invoices"] = tables["invoices"].withColumn("invoice_month", month_of(F.col("invoice_created")))
    months = tables["invoices"].select("invoice_id", "invoice_month")
    for name in ("balance_transactions", "charges"):
        tables[name] = tables[name].join(months, "invoice_id", "left").select(*tables[name].columns, "invoice_month")
    ledger, events = tables["balance_transactions"], tables["subscription_events"]
    tables["balance_transactions"] = ledger.withColumn("available_month", month_of(F.col("balance_available_on")))
    tables["subscription_events"] = events.withColumn("effective_month", month_of(F.col("event_effective_at")))
    return tables


def write_monthly(staging: Staging, root: str) -> Staging:
    """Write all six tables under `root`, each replaced whole, and return them read back.

    Two invoices of one id could lie in two months, so they are refused (BrokenGrain) before a table is replaced.
    """
    spark = staging.invoices.sparkSession
    for name, table in with_months(staging).items():
        replace_table(table, f"{root}/{name}", LAYOUT.get(name, ()), ("invoice_id",) if name == "invoices" else ())
    return read_monthly(spark, root)


def read_monthly(spark: SparkSession, root: str) -> Staging:
    """An empty table has no file to tell its types: it has those of the staging tables."""

    def read(name: str) -> DataFrame:
        months = LAYOUT.get(name, ())
        try:
            table = read_table(spark, f"{root}/{name}")
        except AnalysisException as no_files:
            if no_files.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            table = spark.createDataFrame([], T.StructType([*SCHEMAS[name], *(T.StructField(m, T.DateType()) for m in months)]))
        return table.select(*SCHEMAS[name].names, *months)

    return Staging(**{name: read(name) for name in SCHEMAS})
