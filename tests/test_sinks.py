"""Tables are replaced whole or not at all, by partition, in buckets, and never with a broken grain."""

from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from billscope.sources import sinks
from billscope.sources.sinks import BrokenGrain, read_table, recover, replace_catalog_partitions, replace_catalog_table, replace_partitions, replace_table


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE billscope_sinks LOCATION '{tmp_path}/database'")
    yield "billscope_sinks"
    spark.sql("DROP DATABASE billscope_sinks CASCADE")


def numbers(df):
    return sorted(row[0] for row in df.collect())


def failing(spark):
    """Ten rows in four tasks, of which one fails after others have written."""
    refused = F.when(F.col("id") == 9, F.raise_error(F.lit("no nine"))).otherwise(F.col("id"))
    return spark.range(0, 10, 1, 4).select(refused.cast("bigint").alias("id"))


def names(folder):
    return sorted(p.name for p in Path(folder).iterdir())


def test_a_write_that_fails_midway_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(3), path)
    with pytest.raises(PySparkException, match="no nine"):
        replace_table(failing(spark), path)
    assert numbers(spark.read.parquet(path)) == [0, 1, 2]
    assert names(tmp_path) == ["t"]


def test_a_first_write_that_fails_leaves_nothing(spark, tmp_path):
    with pytest.raises(PySparkException):
        replace_table(failing(spark), f"{tmp_path}/t")
    assert names(tmp_path) == []


def test_a_catalog_write_that_fails_midway_leaves_the_old_rows(spark, database):
    table = f"{database}.t"
    replace_catalog_table(spark.range(3), table)
    with pytest.raises(PySparkException, match="no nine"):
        replace_catalog_table(failing(spark), table)
    assert numbers(spark.table(table)) == [0, 1, 2]
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_a_failed_swap_puts_the_old_table_back(spark, tmp_path, monkeypatch):
    path, move = f"{tmp_path}/t", sinks._Folder.move

    def move_unless_staged(folder, to):
        if ".staged-" in folder.path.toString():
            raise OSError("the store is away")
        move(folder, to)

    replace_table(spark.range(3), path)
    monkeypatch.setattr(sinks._Folder, "move", move_unless_staged)
    with pytest.raises(OSError, match="away"):
        replace_table(spark.range(7), path)
    assert numbers(spark.read.parquet(path)) == [0, 1, 2]
    assert names(tmp_path) == ["t"]


def test_a_run_that_died_between_the_renames_is_recovered(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(3), path)
    Path(path).rename(tmp_path / ".t.replaced-1")
    spark.range(5).write.parquet(f"{tmp_path}/.t.staged-1")
    assert numbers(read_table(spark, path)) == [0, 1, 2]
    assert names(tmp_path) == ["t"]
    recover(spark, f"{tmp_path}/never/written")


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, tmp_path, database):
    path, table = f"{tmp_path}/t", f"{database}.t"
    assert numbers(replace_table(replace_table(spark.range(4), path).filter("id > 1"), path)) == [2, 3]
    assert numbers(replace_catalog_table(replace_catalog_table(spark.range(4), table).filter("id > 1"), table)) == [2, 3]


@pytest.mark.parametrize("buckets", [0, 3])
def test_a_broken_grain_is_refused_before_the_old_table_goes(spark, tmp_path, database, buckets):
    good = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 3), (None, 3)], "k string, m int")
    bad = good.unionByName(spark.createDataFrame([("b", 2), ("b", 2), ("a", 1)], "k string, m int"))
    path, table = f"{tmp_path}/t", f"{database}.t"
    write = {
        path: lambda df: replace_table(df, path, grain=("k", "m")),
        table: lambda df: replace_catalog_table(df, table, grain=("k", "m"), bucket_by=("k",), buckets=buckets),
    }
    for name, written in write.items():
        assert written(good).count() == 5, "a key with a NULL equals no other"
        with pytest.raises(BrokenGrain, match=r"3 rows repeat a key of \(k, m\), such as k=b, m=2, rows=3") as refused:
            written(bad)
        assert refused.value.keys == [{"k": "b", "m": 2, "rows": 3}, {"k": "a", "m": 1, "rows": 2}]
        assert (spark.read.parquet(path) if name == path else spark.table(table)).count() == 5
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_counting_repeats_needs_no_second_shuffle(spark):
    from pyspark.sql import Observation

    grouped = spark.range(100).groupBy((F.col("id") % 7).alias("k"), (F.col("id") % 2).alias("m")).count()
    by_part = grouped.repartition("k")
    for df in (grouped, by_part):
        plain = df._jdf.queryExecution().executedPlan().toString().count("Exchange")
        checked = sinks.watched(df, ("k", "m"), Observation())
        assert checked._jdf.queryExecution().executedPlan().toString().count("Exchange") == plain


def files(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


@pytest.mark.parametrize("kind", ["folder", "table", "bucketed"])
def test_partitions_are_replaced_and_others_keep_their_files(spark, tmp_path, database, kind):
    rows = spark.createDataFrame([(k, m) for k in range(6) for m in ("a", "b", "c")], "k int, m string")
    table, path = f"{database}.t", f"{tmp_path}/t"
    if kind == "folder":
        stored = replace_table(rows, path, ["m"])
    else:
        stored = replace_catalog_table(rows, table, ["m"], ["k", "m"], ["k"], 2 if kind == "bucketed" else 0)
        path = f"{tmp_path}/database/t"
    before = files(path)
    # b loses a row, c loses all
    changed = stored.filter("m in ('b', 'c')").filter("m = 'b' and k <> 3")
    if kind == "folder":
        replace_partitions(changed, path, "m", ["b", "c"])
        found = spark.read.parquet(path)
    else:
        replace_catalog_partitions(changed, table, "m", ["b", "c"])
        found = spark.table(table)
    assert sorted(tuple(r) for r in found.select("k", "m").collect()) == sorted([(k, "a") for k in range(6)] + [(k, "b") for k in range(6) if k != 3])
    assert {f for f in before if f.startswith("m=a")} == {f for f in files(path) if f.startswith("m=a")}
    assert not {f for f in files(path) if f.startswith("m=c")}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    if kind == "bucketed":
        plan = found.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
