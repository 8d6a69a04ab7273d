"""Operator 1, line deduplication: two Bloom filters name the lines that may repeat; only those are shuffled and counted."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm import bloom
from billscope.llm.scratch import stored
from billscope.llm.text import SPACES, ascii_lower, batches, texts

MIN_CHARS = 20
MIN_DOCUMENTS = 3
#: Largest size of each of the two filters; beyond 16 bits a line more lines are suspected, and results stay the same.
MAX_FILTER_BYTES = 128 << 20


def line_keys(text: str) -> list[str]:
    """The key of each line: without white space at both ends, A-Z lower-cased."""
    return [line.strip(SPACES) for line in ascii_lower(text).split("\n")]


def _long_keys(text: str, min_chars: int) -> list[bytes]:
    return [key.encode() for key in dict.fromkeys(line_keys(text)) if len(key) >= min_chars]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def dedup_lines(
    documents: DataFrame,
    *,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    max_filter_bytes: int = MAX_FILTER_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, text (the kept lines joined by newlines), n_lines, n_dropped: one row for each row of documents.

    A key of at least min_chars code points that at least min_documents (two or more) documents hold keeps its lines
    only in the largest doc_id. A null or empty text is one empty line. Rows that repeat a doc_id are one document for
    the count, and all of them keep or lose a line alike. A row without doc_id is not counted and keeps its lines. An
    empty table gives an empty one; other columns of documents are ignored, whatever their names.
    """
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    newline = F.lit("\n")
    n_lines = docs.select((F.length("text") - F.length(F.replace("text", newline, F.lit(""))) + 1).alias("n")).agg(F.sum("n")).first()[0]
    n_segments = bloom.segments_for(n_lines or 1, max_filter_bytes)

    def bits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (_hashes([k for text in texts(batch) for k in _long_keys(text, min_chars)]) for batch in parts)
        return bloom.seen_bits(keys, n_segments)

    identified = docs.where("doc_id is not null")
    _, again = bloom.filter_pair(identified.select("text").mapInArrow(bits, "segment int, seen binary, again binary"), n_segments)
    repeats = docs.sparkSession.sparkContext.broadcast(again)

    suspect_schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])

    def suspected(text: str) -> list[bytes]:
        keys = _long_keys(text, min_chars)
        return [key for key, hit in zip(keys, bloom.contains(repeats.value, _hashes(keys)), strict=True) if hit]

    def suspects(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (i, digest(key))
            for batch in parts
            for i, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True)
            for key in suspected(text)
        )
        return batches(rows, suspect_schema)

    lines = stored(identified.mapInArrow(suspects, "doc_id long, digest binary"), "line-suspects")
    confirmed = lines.groupBy("digest").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_documents)
    confirmed = stored(confirmed.select("digest", "keeper"), "line-repeats")
    dropped = (
        lines.join(confirmed, "digest")
        .where("doc_id <> keeper")
        .groupBy("doc_id")
        .agg(F.collect_set("digest").alias("digests"))
        .withColumnRenamed("doc_id", "of")
    )
    result_schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])
    columns = "doc_id long, text string, n_lines long, n_dropped long"

    def untouched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (i, text, text.count("\n") + 1, 0)
            for batch in parts
            for i, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True)
            if i is None or not suspected(text)
        )
        return batches(rows, result_schema)

    def with_suspects(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (i, text)
            for batch in parts
            for i, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True)
            if i is not None and suspected(text)
        )
        return batches(rows, pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))

    def without_dropped(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in parts:
                for i, text, digests in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "text", "digests")), strict=True):
                    lines, gone = text.split("\n"), set(digests or ())
                    if gone:
                        keep = [digest(k.encode()) not in gone for k in line_keys(text)]
                        text = "\n".join(line for line, stays in zip(lines, keep, strict=True) if stays)
                        yield i, text, len(lines), len(lines) - sum(keep)
                    else:
                        yield i, text, len(lines), 0

        return batches(rows(), result_schema)

    held = docs.mapInArrow(with_suspects, "doc_id long, text string")
    cleaned = held.join(dropped, held.doc_id == dropped.of, "left").select("doc_id", "text", "digests").mapInArrow(without_dropped, columns)
    return docs.mapInArrow(untouched, columns).unionByName(cleaned)
