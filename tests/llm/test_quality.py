import collections
import random
import re

from billscope.llm.catalog import ORACLE_SQL, QUERIES
from billscope.llm.quality import RULES, Rule, judge_quality
from pyspark.sql import functions as F
from tests.llm.helpers import SCHEMA, oracle_rows, planted_documents, spark_rows


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = collections.Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


PROSE = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k % 7)} and" if k % 3 else f"other{k}" for k in range(90)) + "."


def judged(spark, texts, **options):
    rows = judge_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **options).collect()
    return {r.doc_id: r for r in rows}


def test_counts_against_brute_force(spark):
    texts = [r[1] for r in planted_documents()[:9]] + [PROSE, "a b c a b c d", "é x y é x y é x y", "# | <a>\n# | <a>\n \n \n", "a a a a a"]
    for k, row in judged(spark, texts).items():
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counts(texts[k])
        n, _, _, _, repeated = counts(texts[k])
        assert row.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (row.base_failed and row.kept)


def test_rules_reject_junk_and_keep_prose(spark):
    junk = {
        "symbols": " ".join(f"{w}***" for w in PROSE.split()),
        "capitals": PROSE.upper(),
        "letters": " ".join(f"{k}{k}77" for k in range(1000, 1100)),
        "cut_lines": "\n".join(f"a line about thing {x} that goes on..." for x in "abcdefghijklmnop"),
    }
    found = judged(spark, [PROSE, *junk.values()])
    assert found[0].kept and found[0].rejected_by is None
    assert [found[k + 1].rejected_by is not None for k in range(len(junk))] == [True] * len(junk)


def test_verdict_does_not_depend_on_the_order(spark):
    texts = [PROSE, PROSE.upper(), " ".join(f"{w}***" for w in PROSE.upper().split()), None]
    verdicts = [{k: r.kept for k, r in judged(spark, texts, rules=rules).items()} for rules in (RULES, RULES[::-1])]
    assert verdicts[0] == verdicts[1] == {0: True, 1: False, 2: False, 3: False}


def test_a_rejected_document_is_asked_no_more(spark):
    boom = Rule("boom", lambda: F.raise_error(F.lit("asked")).cast("boolean"))
    assert judged(spark, ["few words"], rules=(boom,))[0].rejected_by == "base"


def test_no_filter_moves_below_the_counts(spark):
    docs = judge_quality(spark.createDataFrame([(1, PROSE)], "doc_id long, text string"))
    assert docs.where("n_repeat_words >= 0 and kept").count() == 1


def test_odd_tables(spark):
    frame = spark.createDataFrame(planted_documents(), SCHEMA)
    assert judge_quality(frame).count() == frame.count()
    assert judge_quality(frame.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    plan = judge_quality(spark.createDataFrame([(1, PROSE)], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_few_different_words_are_rejected_at_every_length(spark):
    rng = random.Random(6)
    few, many = [[f"{x}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(n)] for x, n in (("few", 20), ("many", 600))]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for words in (few, many) for n in (240, 400, 401, 600, 1200)]
    found = judged(spark, texts)
    assert [(found[k].base_failed, found[k].rejected_by) for k in range(5)] == [(False, "word_variety")] * 5
    assert all(found[k].kept for k in range(5, 10))


def test_query_against_sql(spark):
    name = "op4_quality_rules"
    assert spark_rows(QUERIES[name](spark, "/root/testdata/sf0.01")) == oracle_rows(ORACLE_SQL[name])
