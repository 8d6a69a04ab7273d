"""Connected components by alternating star contraction; every round moves each link a bounded number of times."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.scratch import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())


def _downward(edges: DataFrame, high: str, low: str) -> DataFrame:
    return edges.where(F.col(high) != F.col(low)).select(F.greatest(high, low).alias("high"), F.least(high, low).alias("low")).distinct()


def components(links: DataFrame) -> DataFrame:
    """doc, component (the smallest doc of its component) for every doc with a link; links: a, b.

    Large star: each document hands its larger neighbours its smallest one. Small star: it does so with the others. Both
    keep who is connected, and end when every document points to the smallest one it can reach. A document with very many
    links is a skewed join key, which adaptive execution splits: both sides of each join are shuffled tables.
    """
    edges = stored(_downward(links, "a", "b"), "links")
    before, now = None, _state(edges)
    while now != before:
        both = edges.select(F.col("high").alias("of"), F.col("low").alias("to")).union(edges.select(F.col("low").alias("of"), F.col("high").alias("to")))
        least = stored(both.groupBy("of").agg(F.least(F.min("to"), F.first("of")).alias("least")), "least-neighbours")
        large = both.where("to > of").join(least, "of").select("to", "least")
        large = stored(_downward(large, "to", "least"), "large-stars")
        lowest = stored(large.groupBy("high").agg(F.min("low").alias("least")), "lowest-neighbours")
        others = large.join(lowest, "high").select("low", "least")
        small = others.union(lowest.select(F.col("high").alias("low"), "least"))
        edges = stored(_downward(small, "low", "least"), "small-stars")
        before, now = now, _state(edges)
    return edges.select(F.col("high").alias("doc"), F.col("low").alias("component"))
