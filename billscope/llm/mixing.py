"""Operator 3, mixing: each document is repeated as often as a hash-seeded Poisson draw with its source's rate says."""

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.llm.scratch import stored

SEED = 7
#: Without given weights a source gets a share in proportion to its characters to this power: small sources gain.
POWER = 0.5


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from an MD5 digest: the same for the same parts wherever and whenever a task runs."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_cdf(rate: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... until the rest is below what a double tells from 1."""
    if not rate > 0:
        return [1.0]
    total, found, k = 0.0, [], 0
    while True:
        term = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        total += term
        found.append(total)
        if k > rate and term < 1e-18:
            return found
        k += 1


def source_rates(documents: DataFrame, weights: DataFrame | None = None, total: float | None = None) -> DataFrame:
    """source, chars, share, rate: mean repetitions that give each source its share of total characters.

    weights: source, weight (not negative; a source without one gets none, and those of absent sources don't count). total: as many characters as there are.
    """
    sizes = documents.groupBy("source").agg(F.sum(F.length("text")).cast("double").alias("chars"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow("chars", F.lit(POWER)))
    else:
        given = weights.select(F.coalesce("source", F.lit("")).alias("source"), F.col("weight").cast("double")).groupBy("source").agg(F.sum("weight").alias("weight"))
        sizes = sizes.join(given, "source", "left").fillna(0.0, ["weight"])
    sizes = stored(sizes.withColumn("weight", F.when(F.col("chars") > 0, F.col("weight")).otherwise(0.0)), "source-sizes")
    whole = sizes.agg(F.sum("weight"), F.sum("chars")).first()  # two numbers
    all_weight, all_chars = whole[0] or 0.0, whole[1] or 0.0
    share = F.col("weight") / all_weight if all_weight > 0 else F.lit(0.0)
    wanted = F.lit(all_chars if total is None else float(total))
    return sizes.select("source", "chars", share.alias("share"), F.when(F.col("chars") > 0, wanted * share / F.col("chars")).otherwise(0.0).alias("rate"))


def mix_sources(
    documents: DataFrame,
    weights: DataFrame | None = None,
    *,
    total: float | None = None,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    copy_column: str = "copy",
    key_column: str = "shuffle_key",
) -> DataFrame:
    """The columns of documents, copy (1, 2, ...) and shuffle_key, in the order of shuffle_key across all partitions.

    Shares are of characters. A null source is the empty one; a source without any text has rate 0. Rows that repeat a
    doc_id draw alike; rows without doc_id draw by their text. An empty table gives an empty one. A column of documents
    with the name of copy_column or key_column is replaced.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    own = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("text "), F.md5(text)))
    source = F.coalesce(F.col(source_column), F.lit(""))
    rates = source_rates(documents.select(source.alias("source"), text.alias("text")), weights, total)

    def with_cdf(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"of": part["source"], "cdf": part["rate"].map(poisson_cdf)})

    # A row for each source; stored, so that its true size decides between a broadcast and a join with split partitions.
    drawn_from = stored(rates.mapInPandas(with_cdf, "of string, cdf array<double>"), "source-rates")
    kept = [F.col(f"row.{name}").alias(name) for name in dict.fromkeys(documents.columns) if name not in (copy_column, key_column)]
    drawn = (
        documents.select(F.struct("*").alias("row"), own.alias("own"), source.alias("source"))
        .join(drawn_from, F.col("source") == F.col("of"))
        .withColumn("u", uniform(F.lit(str(seed)), F.col("own")))
        .withColumn("n", F.size(F.filter("cdf", lambda c: c <= F.col("u"))))
        .where("n > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    )
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"order {seed}"), F.col("own"), F.col("copy").cast("string"))), 1, 15), 16, 10).cast("long")
    return drawn.select(*kept, F.col("copy").alias(copy_column), key.alias(key_column)).orderBy(key_column, copy_column)
