"""Local session for tests and the benchmark; on a cluster, use the session it provides."""

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("billscope")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
