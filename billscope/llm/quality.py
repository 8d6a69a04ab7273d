"""Operator 4, quality rules as a short-circuit cascade: the rule that rejects most for its cost is asked first.

Everything is DataFrame functions; counts that rules share are computed once for each document.
"""

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The ASCII white space between words, and the characters counted as symbols.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Rows, about, on which cost and selectivity are estimated. The order they give changes the work, never the verdict.
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """rejects: a condition over text, lines, words and the base counts that is true for a bad document, never null."""

    name: str
    rejects: Callable[[], Column]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _letters() -> Column:
    return F.length(F.regexp_replace("text", r"\P{L}", ""))


def _capitals() -> Column:
    return F.length(F.regexp_replace("text", r"\P{Lu}", ""))


def _ended(pattern: str) -> Column:
    return F.size(F.filter("lines", lambda line: line.rlike(pattern)))


#: Asked beyond the base rules. Bounds are wide: clean prose of any language stays far inside them.
RULES = (
    Rule("symbols", lambda: _share(F.col("n_symbols"), F.col("n_words")) > 0.3),
    Rule("word_length", lambda: ~_share(F.col("word_chars"), F.col("n_words")).between(2, 15)),
    Rule("repeated_lines", lambda: _share(F.col("n_dup_lines"), F.size("lines")) > 0.5),
    # Different words grow about with the root of a text's length: clean text of any length has five times that root or more.
    Rule("word_variety", lambda: F.pow(F.size(F.array_distinct("words")), F.lit(2)) < F.col("n_words") * 2.25),
    Rule("letters", lambda: _share(_letters(), F.col("word_chars")) < 0.6),
    Rule("capitals", lambda: _share(_capitals(), F.greatest(_letters(), F.lit(1))) > 0.6),
    Rule("cut_lines", lambda: _share(_ended(r"(\.\.\.|…)\s*$"), F.size("lines")) > 0.5),
    Rule("bullets", lambda: _share(_ended(r"^\s*[-*•]\s"), F.size("lines")) > 0.9),
)


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more: windows sorted by hash, equal neighbours marked, their words counted once."""
    n = F.size(words) - 2
    windows = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at")))
    return F.when(n > 0, F.sort_array(windows))


def with_counts(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, text, lines, words and the base counts."""
    docs = documents.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    docs = docs.withColumns({"words": _words(F.col("text")), "lines": F.split("text", "\n")})
    docs = docs.withColumn("windows", _repeated_words(F.col("words")))

    def repeated(x: Column, i: Column) -> Column:
        windows = F.col("windows")
        return (x["h"] == F.get(windows, i - 1)["h"]) | (x["h"] == F.get(windows, i + 1)["h"])

    marked = F.filter("windows", lambda x, i: F.coalesce(repeated(x, i), F.lit(False)))
    docs = docs.withColumn("starts", F.sort_array(F.transform(marked, lambda x: x["at"])))
    starts = F.col("starts")
    # Each start covers its three words, less those that the next start covers too.
    covered = F.aggregate(
        F.transform(starts, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - at, F.lit(3)))), F.lit(0), lambda a, b: a + b
    )
    spoken = F.filter("lines", lambda line: F.btrim(line, F.lit(SPACES)) != "")
    counts = F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(spoken) - F.size(F.array_distinct(spoken))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    # inline() of one struct: no filter moves below it, where it would repeat these expressions inside themselves.
    return docs.select("doc_id", "text", "words", "lines", F.inline(F.array(counts)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)


def ordered_rules(sample: DataFrame, rules: tuple[Rule, ...]) -> list[Rule]:
    """Rules by rejected rows a second, most first, as measured on a small sample with its counts."""
    sample = sample.persist()
    try:
        sample.count()
        rank, passed = [], sample.where(~base_failed())
        for rule in rules:
            began = time.perf_counter()
            rejected = passed.where(rule.rejects()).count()
            rank.append((-(rejected + 1) / (time.perf_counter() - began), rule.name, rule))
    finally:
        sample.unpersist()
    return [rule for _, _, rule in sorted(rank, key=lambda x: x[:2])]


def judge_quality(
    documents: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    *,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, text, the base counts, base_failed, kept, rejected_by: one row for each row of documents.

    Rules are asked in the order of the cascade, and a document that one rejects is asked no more. rejected_by names that
    rule ("base" for the base rules), so it depends on the measured order where several would reject; kept does not.
    A null text has no words and one empty line, and fails the base rules. Rows that repeat are judged alike, an empty
    table gives an empty one, other columns are ignored.
    """
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    total = source.count()
    few = source.sample(min(1.0, sample_rows / max(total, 1)), seed=7)
    cascade = ordered_rules(with_counts(few, "doc_id", "text"), rules)
    counted = with_counts(source, "doc_id", "text").withColumn("base_failed", base_failed())
    verdict = reduce(lambda asked, rule: asked.when(rule.rejects(), F.lit(rule.name)), cascade, F.when(F.col("base_failed"), F.lit("base")))
    return counted.withColumn("rejected_by", verdict).select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by"
    )
