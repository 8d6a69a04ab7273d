import hashlib
import math

from billscope.llm.catalog import ORACLE_SQL, QUERIES
from billscope.llm.mixing import mix_sources, poisson_cdf, source_rates
from pyspark.sql import functions as F
from tests.llm.helpers import SCHEMA, oracle_rows, planted_documents, spark_rows


def drawn(doc_id, text, cdf):
    """Copies of a document by its own draw."""
    own = str(doc_id) if doc_id is not None else "text " + hashlib.md5((text or "").encode()).hexdigest()
    u = int(hashlib.md5(f"7|{own}".encode()).hexdigest()[:13], 16) / 2**52
    return sum(c <= u for c in cdf)


def test_cdf():
    for rate in (0.0, 0.3, 4.0, 900.0):
        cdf = poisson_cdf(rate)
        assert all(a <= b for a, b in zip(cdf, cdf[1:], strict=False)) and abs(cdf[-1] - 1) < 1e-9
    assert abs(poisson_cdf(2.0)[1] - math.exp(-2) * 3) < 1e-12


def test_shares_follow_the_weights(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x" * 50).alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 9.0)], "source string, weight double")
    rates = {r.source: r for r in source_rates(docs, weights, total=450_000).collect()}
    assert abs(rates["a"].share - 3 / 4) < 1e-12 and abs(rates["b"].rate - 450_000 / 4 / 200_000) < 1e-12
    mixed = mix_sources(docs, weights, total=4 * 50 * 3000)
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["a"] - 9000) < 400 and abs(n["b"] - 3000) < 250
    assert mixed.groupBy("doc_id", "copy").count().where("count > 1").count() == 0


def test_draws_are_the_same_in_any_partitioning(spark):
    docs = spark.createDataFrame([(k, f"text {k}" * (k % 9 + 1), f"s{k % 4}") for k in range(300)], "doc_id long, text string, source string")
    one, other = (mix_sources(docs.repartition(n)).collect() for n in (1, 7))
    assert one == other
    assert [r.shuffle_key for r in one] == sorted(r.shuffle_key for r in one)
    cdf = {r.source: poisson_cdf(r.rate) for r in source_rates(docs).collect()}
    for k in range(300):
        assert sum(r.doc_id == k for r in one) == drawn(k, "", cdf[f"s{k % 4}"])


def test_odd_rows(spark):
    frame = spark.createDataFrame(planted_documents(), SCHEMA)
    mixed = mix_sources(frame, total=20e6)
    assert sorted(mixed.columns) == sorted([*frame.columns, "shuffle_key"])
    texts = {r.text for r in mixed.collect()}
    assert {planted_documents()[k][1] for k in (0, 1, 2, 6)} <= texts
    assert mix_sources(frame.limit(0)).count() == 0
    assert mix_sources(frame.where("doc_id = 4")).count() == 0  # its source has no text


def test_query_against_sql(spark):
    name = "op3_source_mixing"
    assert spark_rows(QUERIES[name](spark, "/root/testdata/sf0.01")) == oracle_rows(ORACLE_SQL[name])
