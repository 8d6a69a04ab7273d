import re

import numpy as np

from billscope.llm import bloom
from billscope.llm.catalog import ORACLE_SQL, QUERIES
from billscope.llm.line_dedup import dedup_lines
from tests.llm.helpers import SCHEMA, oracle_rows, planted_documents, spark_rows

STRIPPED = " \t\n\x0b\x0c\r"


def brute_force(rows, min_chars=20, min_documents=3):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(STRIPPED))
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= min_documents}
    found = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or gone.get(key(x), i) == i]
        found.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(found, key=repr)


def test_odd_rows_against_brute_force(spark):
    rows = planted_documents()
    found = dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_force([r[:2] for r in rows])
    assert any(r.n_dropped for r in found)


def test_full_filters_change_nothing(spark):
    """A filter with room for few lines suspects most of them, and the result is the same."""
    rows = [(k, f"line number {k % 700} of a text that is long enough\nshared by all documents here") for k in range(2000)]
    found = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), max_filter_bytes=1)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_force(rows)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_sql(spark):
    name = "op1_line_dedup"
    assert spark_rows(QUERIES[name](spark, "/root/testdata/sf0.01")) == oracle_rows(ORACLE_SQL[name])


def test_filter_pair_never_misses(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    parts = [keys[:3000], keys[2000:], keys[:10]]
    n = bloom.segments_for(5000, 1 << 20)
    rows = [row for part in parts for batch in bloom.seen_bits(iter([part]), n) for row in batch.to_pylist()]
    df = spark.createDataFrame([(r["segment"], r["seen"], r["again"]) for r in rows], "segment int, seen binary, again binary")
    seen, again = bloom.filter_pair(df, n)
    assert bloom.contains(seen, keys).all()
    assert bloom.contains(again, keys[2000:3000]).all() and bloom.contains(again, keys[:10]).all()
    other = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    assert bloom.contains(seen, other).mean() < 0.05
    assert bloom.contains(again, keys[3000:]).mean() < 0.2
