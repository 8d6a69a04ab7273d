"""Build the analytics layer: `spark-submit -m billscope` or `python -m billscope --help`."""

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from billscope.plans.layer import export_layer, in_database, in_folder, write_layer
from billscope.plans.periods import Periods
from billscope.sources.monthly import read_monthly, write_monthly
from billscope.sources.staging import staging_from_catalog, staging_from_parquet


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="billscope", description="Build the billing analytics tables.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--staging-path", help="folder with one parquet dataset per staging table")
    source.add_argument("--staging-database", help="catalog database with stg_* tables")
    source.add_argument("--monthly-path", help="folder with staging tables laid out by month (see --lay-out)")
    parser.add_argument("--lay-out", help="folder to lay the staging tables out in by month first, and to read them from")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--out-path", help="folder for the tables, shared by all executors")
    target.add_argument("--out-database", help="catalog database for the tables")
    parser.add_argument("--buckets", type=int, default=0, help="buckets of the catalog's tables that are joined by key; at least spark.sql.shuffle.partitions")
    parser.add_argument("--csv", help="folder for CSV exports of the reports")
    parser.add_argument("--year", type=int, required=True, help="year of the MRR and retention reports")
    parser.add_argument("--month", type=int, required=True, help="month to reconcile, 1-12")
    parser.add_argument("--closed-from", type=date.fromisoformat, help="first day that chargebacks restate; by default the year of the month before")
    parser.add_argument("--months", type=int, default=13, help="months of the MRR calendar, from the December before the year")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("billscope").getOrCreate()
    if args.monthly_path:
        staging = read_monthly(spark, args.monthly_path)
    elif args.staging_path:
        staging = staging_from_parquet(spark, args.staging_path)
    else:
        staging = staging_from_catalog(spark, args.staging_database)
    if args.lay_out:
        staging = write_monthly(staging, args.lay_out)
    store = in_folder(args.out_path) if args.out_path else in_database(args.out_database, args.buckets)
    layer = write_layer(staging, Periods.for_month(args.year, args.month, args.closed_from, args.months), store)
    if args.csv:
        export_layer(layer, args.csv)


if __name__ == "__main__":
    main()
