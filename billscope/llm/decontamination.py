"""Operator 2, benchmark decontamination: spaced seeds find where a text may repeat a benchmark item despite substitutions.

A seed is the hash of the words at the set positions of a mask, so a substituted word between them leaves it unchanged.
Seeds of both sides are joined; around each diagonal with a common seed, words are compared one by one.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm import bloom
from billscope.llm.scratch import stored
from billscope.llm.text import WordHashes, batches, pieces, plain_words, texts, window_hashes

#: Every stretch of ten or more words of which one in five, its ends apart, is substituted holds one of these, as a search
#: over all such patterns of 10 to 14 words and a sample of those up to 25 has found.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 4, 6, 7), (0, 1, 2, 3, 4))
#: An overlap has this many words (four fifths of a shorter item's) and this share of them equal.
MIN_WORDS = 13
MIN_SIMILARITY = 0.8
#: Words compared before and after the common seeds of a diagonal.
CONTEXT = 64
MAX_FILTER_BYTES = 16 << 20

_SALTS = np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def seeds(words: np.ndarray, masks: tuple[tuple[int, ...], ...]) -> tuple[np.ndarray, np.ndarray]:
    """All seeds of hashed words, and the position of each."""
    found = [window_hashes(words, mask) ^ _SALTS[k] for k, mask in enumerate(masks)]
    return np.concatenate(found), np.concatenate([np.arange(len(x)) for x in found])


def whole_seeds(words: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of all stretches of these lengths, for items that no mask fits into, and their positions."""
    found = [window_hashes(words, tuple(range(n))) ^ _SALTS[-n] for n in lengths]
    return np.concatenate([np.zeros(0, np.uint64), *found]), np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in found)])


def longest_similar(equal: np.ndarray, similarity: float) -> tuple[int, int]:
    """Start and end of the longest stretch, of equal words at both ends, with at least this share of equal words."""
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0
    # From equal word a to equal word b (both counted): b - a + 1 equal words over at[b] - at[a] + 1 words.
    order = np.arange(len(at))
    value = order - similarity * at  # a stretch counts if value[b] + 1 - similarity >= value[a]
    best, most, lowest = (int(at[0]), int(at[0]) + 1), 1, np.minimum.accumulate(value)
    for b in range(len(at)):
        a = int(np.searchsorted(-lowest, -(value[b] + 1 - similarity + 1e-9)))
        if a <= b and at[b] - at[a] + 1 > most:
            most, best = at[b] - at[a] + 1, (int(at[a]), int(at[b]) + 1)
    return best


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    masks: tuple[tuple[int, ...], ...] = MASKS,
    min_words: int = MIN_WORDS,
    similarity: float = MIN_SIMILARITY,
    context: int = CONTEXT,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, n_words, n_equal: the longest overlap on each diagonal, in words.

    Words are runs of digits, ASCII letters in lower case and characters beyond ASCII. Items with fewer words than the
    widest mask spans are found only through the masks that fit, and those that none fits (one to four words) where they
    stand whole and unchanged; null and empty texts hold nothing. Rows without an id
    are left out; rows that repeat an id are searched each, and equal findings are one. Empty tables give an empty one,
    other columns are ignored.
    """
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).where("doc_id is not null")
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text_column).alias("text")).where("item_id is not null")
    spark = docs.sparkSession
    narrowest = min(mask[-1] for mask in masks) + 1
    item_schema = pa.schema([("item_id", pa.int64()), ("n", pa.int32()), ("words", pa.binary()), ("seeds", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])

    def of_items(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            hashes = WordHashes()
            for batch in parts:
                for item, text in zip(batch.column("item_id").to_pylist(), texts(batch), strict=True):
                    words = hashes.of(plain_words(text))
                    found, places = seeds(words, masks) if len(words) >= narrowest else whole_seeds(words, [len(words)] if len(words) else [])
                    yield item, len(words), words.tobytes(), found.view(np.int64), places.astype(np.int32)

        return batches(rows(), item_schema)

    questions = stored(items.mapInArrow(of_items, "item_id long, n int, words binary, seeds array<long>, places array<int>"), "benchmark-items")
    n_seeds = questions.agg(F.sum(F.size("seeds"))).first()[0] or 0
    short = sorted(row.n for row in questions.where(F.col("n").between(1, narrowest - 1)).select("n").distinct().collect())  # fewer than narrowest
    n_segments = bloom.segments_for(n_seeds, MAX_FILTER_BYTES)

    def bits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return bloom.seen_bits((batch.column("seeds").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for batch in parts), n_segments)

    seen, _ = bloom.filter_pair(questions.select("seeds").mapInArrow(bits, "segment int, seen binary, again binary"), n_segments)
    asked = spark.sparkContext.broadcast(seen)  # MAX_FILTER_BYTES at most
    region = pa.struct([("start", pa.int32()), ("words", pa.binary())])
    hit_schema = pa.schema([("doc_id", pa.int64()), ("seeds", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("regions", pa.list_(region))])
    span = max(mask[-1] for mask in masks) + 1

    def of_documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            hashes = WordHashes()
            for batch in pieces(parts):
                for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                    words = hashes.of(plain_words(text))
                    found, places = seeds(words, masks)
                    if short:
                        found, places = (np.concatenate(both) for both in zip((found, places), whole_seeds(words, short), strict=True))
                    hit = bloom.contains(asked.value, found) if len(found) else np.zeros(0, bool)
                    if not hit.any():
                        continue
                    found, places = found[hit], places[hit]
                    starts, ends = np.maximum(np.unique(places) - context, 0), np.minimum(np.unique(places) + span + context, len(words))
                    new = np.append(True, starts[1:] > ends[:-1])
                    firsts, lasts = starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]
                    around = [{"start": int(a), "words": words[a:b].tobytes()} for a, b in zip(firsts, lasts, strict=True)]
                    yield doc, found.view(np.int64), places.astype(np.int32), around

        return batches(rows(), hit_schema)

    columns = "doc_id long, seeds array<long>, places array<int>, regions array<struct<start:int,words:binary>>"
    hits = stored(docs.mapInArrow(of_documents, columns), "seed-hits")
    pair = F.arrays_zip("seeds", "places")
    asked_at = questions.select("item_id", F.explode(pair).alias("s")).select("item_id", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_place"))
    found_at = hits.select("doc_id", F.explode(pair).alias("s")).select("doc_id", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))
    diagonals = (
        found_at.join(asked_at, "seed")
        .groupBy("doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(F.min("item_place").alias("first"), F.max("item_place").alias("last"))
    )
    compared = (
        diagonals.join(questions.select("item_id", F.col("words").alias("item_words")), "item_id")
        .join(hits.select("doc_id", "regions"), "doc_id")
        .select("doc_id", "item_id", "shift", "first", "last", "item_words", "regions")
    )
    overlap_schema = pa.schema([(x, pa.int64()) for x in ("doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal")])

    def verified(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in pieces(parts):
                for row in batch.to_pylist():
                    item = np.frombuffer(row["item_words"], np.uint64)
                    low, high = max(0, row["first"] - context), min(len(item), row["last"] + span + context)
                    equal = np.zeros(high - low, bool)
                    for around in row["regions"]:
                        words = np.frombuffer(around["words"], np.uint64)
                        # Item word j stands against document word j + shift.
                        a = max(low, around["start"] - row["shift"])
                        b = min(high, around["start"] + len(words) - row["shift"])
                        if a < b:
                            at = a + row["shift"] - around["start"]
                            equal[a - low : b - low] |= item[a:b] == words[at : at + b - a]
                    start, end = longest_similar(equal, similarity)
                    needed = min(min_words, max(min(narrowest, len(item)), math.ceil(similarity * len(item))))
                    if end - start >= needed:
                        yield row["doc_id"], row["item_id"], low + start + row["shift"], low + start, end - start, int(equal[start:end].sum())

        return batches(rows(), overlap_schema)

    return compared.mapInArrow(verified, "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_equal long").distinct()
