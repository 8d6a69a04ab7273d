"""Writing results: analytics tables, replaced whole or by partition, and CSV exports.

A replacement is complete beside the old table before it takes its place, so a run that fails while writing, or whose rows are
refused, leaves the old rows. Later steps read the written files: an executor lost afterwards costs a re-read.
"""

import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: Keys listed in the message about a broken grain.
LISTED_KEYS = 20


class BrokenGrain(ValueError):
    """A table has keys on more than one row; `keys` holds some of them with their number of rows."""

    def __init__(self, table: str, grain: Sequence[str], repeated_rows: int, keys: list[dict]):
        self.table, self.grain, self.repeated_rows, self.keys = table, tuple(grain), repeated_rows, keys
        listed = "; ".join(", ".join(f"{k}={v}" for k, v in key.items()) for key in keys)
        super().__init__(f"{table}: {repeated_rows} rows repeat a key of ({', '.join(grain)}), such as {listed}")


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one table partition side by side, in tasks of the advisory size.

    Without this every task would write a small file into every partition. Adaptive execution
    splits large partitions over many tasks; with it off, the hint does nothing.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _known(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))


def watched(df: DataFrame, grain: Sequence[str], observed: Observation) -> DataFrame:
    """`df` with the rows beyond the first of their key counted while it is written.

    The count looks at the row before in a window by key, which runs on the partitioning that rows made by an aggregation,
    a join or a shuffle by key already have. As in a UNIQUE constraint, a key with a NULL in it equals no other.
    """
    same_key = Window.partitionBy(*grain).orderBy(*grain)
    repeated = F.coalesce((F.row_number().over(same_key) > 1) & _known(grain), F.lit(False))
    return (
        df.withColumn("repeats_its_key", repeated)
        .observe(observed, F.coalesce(F.sum(F.col("repeats_its_key").cast("bigint")), F.lit(0)).alias("repeated"))
        .select(*df.columns)
    )


def _refuse_repeats(written: DataFrame, name: str, grain: Sequence[str], observed: Observation) -> None:
    """Only a table whose count is not zero is read again for its keys."""
    repeated = observed.get["repeated"]
    if repeated:
        counted = written.filter(_known(grain)).groupBy(*grain).agg(F.count("*").alias("rows")).filter("rows > 1")
        some = counted.orderBy(F.desc("rows"), *grain).limit(LISTED_KEYS).collect()
        raise BrokenGrain(name, grain, repeated, [row.asDict() for row in some])


class _Folder:
    """A folder in whatever store Spark reads it from."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, spark._jvm.org.apache.hadoop.fs.Path(path)
        self.store = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def sibling(self, kind: str, number: str) -> "_Folder":
        """A folder beside this one whose name Spark's readers of the parent pass over."""
        return _Folder(self.spark, self.spark._jvm.org.apache.hadoop.fs.Path(self.path.getParent(), f".{self.path.getName()}.{kind}-{number}").toString())

    def exists(self) -> bool:
        return self.store.exists(self.path)

    def move(self, to: "_Folder") -> None:
        if not self.store.rename(self.path, to.path):
            raise OSError(f"cannot rename {self.path} to {to.path}")

    def delete(self) -> None:
        self.store.delete(self.path, True)

    def left_behind(self, kind: str) -> list["_Folder"]:
        parent = self.path.getParent()
        if not self.store.exists(parent):
            return []
        start = f".{self.path.getName()}.{kind}-"
        found = [status.getPath() for status in self.store.listStatus(parent) if status.getPath().getName().startswith(start)]
        return [_Folder(self.spark, path.toString()) for path in found]


def _take_place(staged: _Folder, table: _Folder, number: str) -> None:
    """Two renames. If the second one fails the old table is put back; if the run dies between them, `recover` does it."""
    old = table.sibling("replaced", number)
    had_one = table.exists()
    if had_one:
        table.move(old)
    try:
        staged.move(table)
    except Exception:
        if had_one:
            old.move(table)
        raise
    if had_one:
        old.delete()


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a run that died while replacing left: a table without its folder gets the old one back, and staged folders go.

    Only for a table that no other run is writing.
    """
    table = _Folder(spark, path)
    old = table.left_behind("replaced")
    if old and not table.exists():
        old.pop().move(table)
    for folder in (*old, *table.left_behind("staged")):
        folder.delete()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table written here."""
    recover(spark, path)
    return spark.read.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), grain: Sequence[str] = ()) -> DataFrame:
    """Write `df` as a parquet table, replacing what is there, and return it read back.

    The counterpart of CREATE OR REPLACE TABLE AS. The rows are written beside the old table, which `df` may read, and
    replace it by renames of folders. With a grain, rows that repeat a key are counted while they are written, and if there
    are any the old table stays and BrokenGrain is raised.
    """
    spark, number = df.sparkSession, uuid.uuid4().hex
    recover(spark, path)
    table = _Folder(spark, path)
    staged, observed = table.sibling("staged", number), Observation()
    rows = watched(df, grain, observed) if grain else df
    place = staged.path.toString()
    try:
        _gathered(rows, partition_by).write.partitionBy(*partition_by).parquet(place)
        if grain:
            _refuse_repeats(spark.read.schema(df.schema).parquet(place), table.path.getName(), grain, observed)
        _take_place(staged, table, number)
    except BaseException:
        staged.delete()
        raise
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first().data_type


def _rename(spark: SparkSession, name: str, to: str, partition_by: Sequence[str]) -> None:
    """Not every catalog takes a table's partitions along when its folder moves: each is pointed to its place in the new one."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")
    if partition_by:
        folder = _location(spark, to)
        for row in spark.sql(f"SHOW PARTITIONS {to}").collect():
            values = (part.split("=", 1) for part in row.partition.split("/"))
            spec = ", ".join(f"{column}='{unquote(value)}'" for column, value in values)
            spark.sql(f"ALTER TABLE {to} PARTITION ({spec}) SET LOCATION '{folder}/{row.partition}'")
        spark.catalog.refreshTable(to)


def replace_catalog_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), grain: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0
) -> DataFrame:
    """The same for a catalog table: a staged table, renamed once it is complete.

    With `buckets`, rows are dealt by `bucket_by` in the one shuffle that writing then takes, which the count of repeated keys
    shares; readers that join or group by these columns need none. A key that holds many rows makes one large bucket, so
    these are columns whose values the grain spreads.
    """
    spark, number = df.sparkSession, uuid.uuid4().hex
    staged, old = f"{name}__staged_{number}", f"{name}__replaced_{number}"
    observed, in_buckets = Observation(), bool(buckets and bucket_by)
    rows = df.repartition(buckets, *bucket_by) if in_buckets else df
    rows = watched(rows, grain, observed) if grain else rows
    writer = (rows if in_buckets else _gathered(rows, partition_by)).write.format("parquet").partitionBy(*partition_by)
    if in_buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    try:
        writer.saveAsTable(staged)
        if grain:
            _refuse_repeats(spark.table(staged), name, grain, observed)
        had_one = spark.catalog.tableExists(name)
        was_partitioned = had_one and [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        if had_one:
            _rename(spark, name, old, was_partitioned)
        try:
            _rename(spark, staged, name, partition_by)
        except Exception:
            if had_one:
                _rename(spark, old, name, was_partitioned)
            raise
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name).select(*df.columns)


class _Dynamic:
    """While it lasts, an overwrite replaces only the partitions that the rows are in."""

    key = "spark.sql.sources.partitionOverwriteMode"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(self.key)
        self.spark.conf.set(self.key, "dynamic")

    def __exit__(self, *_) -> None:
        self.spark.conf.set(self.key, self.before)


def _written_values(rows: DataFrame, column: str) -> tuple[DataFrame, Observation]:
    observed = Observation()
    return rows.observe(observed, F.collect_set(column).alias("values")), observed


def replace_partitions(df: DataFrame, path: str, column: str, values: Sequence) -> None:
    """Replace the partitions of these values of `column` by the rows of `df`, which may read the table and hold no others.

    Every other partition keeps its files. A partition that `df` has no row for is removed. Spark writes the new files
    aside and moves them in when the job is done; a run that dies while moving is repaired by running it again.
    """
    spark = df.sparkSession
    rows, observed = _written_values(df, column)
    with _Dynamic(spark):
        _gathered(rows, [column]).write.mode("overwrite").partitionBy(column).parquet(path)
    for value in set(values) - set(observed.get["values"]):
        _Folder(spark, f"{path}/{column}={value}").delete()


def replace_catalog_partitions(df: DataFrame, name: str, column: str, values: Sequence) -> None:
    """The same for a catalog table, whose buckets stay as they are declared."""
    spark = df.sparkSession
    spark.catalog.refreshTable(name)
    rows, observed = _written_values(df, column)
    with _Dynamic(spark):
        rows.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    for value in set(values) - set(observed.get["values"]):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column}='{value}')")
    spark.catalog.refreshTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with upper-case headers, one file per partition of the result."""
    df.toDF(*(c.upper() for c in df.columns)).write.mode("overwrite").option("header", True).csv(path)
