"""Operator 7, token files: flat unsigned ids, 64-bit document offsets, bases from prefix sums, read through a memory map.

A folder holds, for each part: <name>.bin, the ids of its documents one after another (little-endian, two bytes while all
ids fit, else four); <name>.doc, their doc_ids (int64; the smallest int64 stands for null); <name>.off, the place of each
document's first id among the ids of all parts, and the end (int64). Parts follow each other in doc_id order. Only files
that the returned list of parts names count: a task that ran twice leaves files that nothing reads.
"""

import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.llm.text import batches, pieces, release_memory, texts
from billscope.llm.tokenizing import cached_tokenizer

NO_ID = np.iinfo(np.int64).min

PARTS = "part int, name string, n_docs long, n_tokens long, base long, id_bytes int"
_WRITTEN = pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("id_bytes", pa.int32())])
_DOCUMENT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def _mapped(folder: str, name: str, dtype: np.dtype) -> np.ndarray:
    """A file's numbers: mapped into memory where the folder is a mounted one, else read from its store."""
    store, path = pa.fs.FileSystem.from_uri(folder)
    local = isinstance(store, pa.fs.LocalFileSystem)
    with pa.memory_map(f"{path}/{name}") if local else store.open_input_file(f"{path}/{name}") as file:
        return np.frombuffer(file.read_buffer(), dtype)


def _write(folder: str, name: str, numbers: np.ndarray) -> None:
    store, path = pa.fs.FileSystem.from_uri(folder)
    with store.open_output_stream(f"{path}/{name}") as file:
        file.write(numbers.tobytes())


def _portions(whole: list[str], most: int = 2_000_000) -> Iterator[list[str]]:
    """Texts one after another, of so many characters together or a single longer one: a pre-token in many is looked up once."""
    some, chars = [], 0
    for text in whole:
        if some and chars + len(text) > most:
            yield some
            some, chars = [], 0
        some.append(text)
        chars += len(text)
    if some:
        yield some


def write_token_files(
    documents: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Writes the folder and returns its list of parts, which read_token_files takes.

    Documents are written in ascending doc_id order, rows without doc_id first; rows that repeat a doc_id are all written,
    ordered by a hash of their text. A null text is empty: its only id is end_id. An empty table writes no part. Other
    columns are ignored. Each task holds the ids of one portion, the lengths of its documents and the pre-tokens it has encoded.
    """
    spark = documents.sparkSession
    store, path = pa.fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)

    def encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, store = cached_tokenizer(tokenizer_path, end_id), pa.fs.FileSystem.from_uri(folder)[0]
        width = tokenizer.dtype.itemsize
        end = np.array([end_id], tokenizer.dtype).tobytes()
        part, name = TaskContext.get().partitionId(), f"part-{uuid.uuid4().hex}"
        ids, lengths, file = [], [], None
        try:
            for batch in pieces(parts, 1000):
                for some in _portions(texts(batch)):
                    if file is None:
                        file = store.open_output_stream(f"{path}/{name}.bin")
                    for one in tokenizer.encode(some):
                        file.write(one + end)
                        lengths.append(len(one) // width + 1)
                ids += [NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()]
        finally:
            tokenizer.forget()  # the worker goes on to tasks of other stages
            release_memory()
        if file is not None:
            file.close()
            _write(folder, f"{name}.doc", np.array(ids, "<i8"))
            _write(folder, f"{name}.len", np.array(lengths, "<i8"))
            yield from batches(iter([(part, name, len(ids), sum(lengths), width)]), _WRITTEN)

    def offsets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                lengths = _mapped(folder, f"{row['name']}.len", np.dtype("<i8"))
                _write(folder, f"{row['name']}.off", row["base"] + np.concatenate([[0], np.cumsum(lengths)]).astype("<i8"))
            yield batch.select(["part"])

    # Equal rows may lie apart: any order among them gives the same files.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("tie")]
    ranged = (
        documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).alias("tie"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    written = ranged.mapInArrow(encoded, "part int, name string, n_docs long, n_tokens long, id_bytes int").collect()  # one row a file
    written.sort(key=lambda row: row.part)
    bases = accumulate((row.n_tokens for row in written), initial=0)
    rows = [(row.part, row.name, row.n_docs, row.n_tokens, base, row.id_bytes) for row, base in zip(written, bases, strict=False)]
    listed = spark.createDataFrame(rows, PARTS)
    if rows:
        listed = listed.repartition(min(len(rows), 1000))
        listed.mapInArrow(offsets, "part int").write.format("noop").mode("overwrite").save()
    return listed


def read_token_files(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (binary: unsigned 32-bit little-endian) from the files."""

    def documents(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(row: dict):
            ids = _mapped(folder, f"{row['name']}.bin", np.dtype(f"<u{row['id_bytes']}"))
            doc_ids = _mapped(folder, f"{row['name']}.doc", np.dtype("<i8"))
            starts = _mapped(folder, f"{row['name']}.off", np.dtype("<i8"))
            for k, doc_id in enumerate(doc_ids.tolist()):
                some = ids[starts[k] - row["base"] : starts[k + 1] - row["base"]]
                yield None if doc_id == NO_ID else doc_id, int(starts[k]), some.astype("<u4").tobytes()

        return batches((x for batch in rows for row in batch.to_pylist() for x in of(row)), _DOCUMENT)

    return parts.mapInArrow(documents, "doc_id long, start long, ids binary")
