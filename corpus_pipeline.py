"""A training corpus from documents: toxic text out, near copies out, benchmark passages out, sources mixed, tokens written.

STAGES lists the stages in order. Each takes (spark, docs, sf_dir) and returns the rows that the next one gets as docs, after
they have been written as Parquet. All but the last keep the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.llm.catalog import END_ID
from billscope.llm.decontamination import find_contamination
from billscope.llm.minhash import near_duplicates
from billscope.llm.mixing import mix_sources
from billscope.llm.scratch import new_folder, stored
from billscope.llm.token_files import read_token_files, write_token_files
from billscope.llm.toxicity import fit_toxicity, with_toxicity

#: Similarity in percent from which the stage drops near copies; the query op8 has 85.
NEAR_PERCENT = 80
#: Words of the shortest overlap for which a document goes: an item such as "yes" is no reason.
LEAST_OVERLAP = 5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels beside them, scores below one half.

    Null texts are scored as empty ones, repeated rows alike; without toxic labels every document stays, an empty table stays empty.
    """
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_toxicity(docs, model, "score_of_toxicity").where("score_of_toxicity < 0.5").select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, which share 80% of their shingles or more: the one with the smallest doc_id.

    Null and empty texts are copies of nothing. Rows that repeat a doc_id are one document and stay or go together. Each row
    without doc_id is a document of its own, and yields to copies that have one.
    """
    rows, key = _with_keys(docs)
    gone = near_duplicates(rows, percent=NEAR_PERCENT, id_column=key).where(~F.col("kept")).select(F.col("doc_id").alias(key))
    return _without(rows, key, gone).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item in LEAST_OVERLAP words or more.

    Null and empty texts overlap nothing. If one row of a doc_id does, all go; each row without doc_id is judged by itself.
    """
    rows, key = _with_keys(docs)
    found = find_contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_column=key).where(F.col("n_words") >= LEAST_OVERLAP)
    return _without(rows, key, found.select(F.col("doc_id").alias(key))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson draws until sources have their target shares, in a global random order."""
    return mix_sources(docs, copy_column="copy_of_mixing", key_column="key_of_mixing").select(*docs.columns)


def as_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the token files hold each document: doc_id, start, n_tokens, ids_crc32."""
    folder = new_folder(spark, "corpus-tokens")
    parts = write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return read_token_files(spark, folder, parts).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def _with_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that holds doc_id, and the name of that column.

    Rows without doc_id get numbers above all of them. These rows alone are stored, so that a number stays with its row.
    """
    key = "row_key"
    while key in docs.columns:
        key += "_"
    known = docs.where("doc_id is not null").withColumn(key, F.col("doc_id").cast("long"))
    unknown = docs.where("doc_id is null")
    if unknown.isEmpty():
        return known, key
    highest = max(known.agg(F.max(key)).first()[0] or 0, 0)
    return known.unionByName(stored(unknown.withColumn(key, F.lit(highest + 1) + F.monotonically_increasing_id()), "rows-without-id")), key


def _without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows whose key is not in gone. The keys are stored: their true size decides the join."""
    return rows.join(stored(gone.distinct(), "dropped-keys"), key, "left_anti")


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", as_token_files),
]

#: The classifier, hashed signatures and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
