"""Intermediate tables and files in the folder that driver and executors share."""

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a session on one machine without that setting gets a temporary folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused folder there, deleted when the application ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, folder)
    return folder


def _delete(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet and read back: lineage ends there, a lost executor costs a re-read, sizes are known."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
