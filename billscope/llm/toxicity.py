"""Operator 10, toxicity: non-negative positive-unlabelled learning of a linear classifier, trained with numpy.

Confirmed toxic examples stand against unlabelled text. The risk of calling unlabelled text clean is corrected by what the
toxic share of it (the class prior) contributes, and where that corrected risk falls below zero the step undoes it.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.llm.scratch import stored
from billscope.llm.text import batches, pieces, plain_words, release_memory, texts

#: Bounds of what is fitted on: toxic examples, unlabelled documents, and features that the classifier may use.
MAX_TOXIC = 4000
MAX_UNLABELLED = 12_000
MAX_FEATURES = 400
#: Standard deviations by which a feature's count must exceed chance.
MIN_EXCESS = 4.0
FOLDS = 5
HASH_BITS = 24


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _hash(kind: int, part: bytes) -> int:
    return xxhash.xxh32_intdigest(part, kind) >> (32 - HASH_BITS)


def word_features(word: bytes) -> tuple[int, ...]:
    """The word itself and how it begins: invented endings don't hide a word."""
    return tuple(_hash(len(part) if part is not word else 0, part) for part in ([word] + [word[:n] for n in (4, 5, 6) if len(word) > n]))


@lru_cache(maxsize=50_000)
def _cached_features(word: bytes) -> tuple[int, ...]:
    return word_features(word)


def features(text: str) -> tuple[list[int], int]:
    """Distinct features of a whole text, and its number of words."""
    words = plain_words(text)
    return list({f for word in set(words) for f in _cached_features(word)}), len(words)


@dataclass(frozen=True)
class Model:
    """weights by feature; length: weight, mean and deviation of the logarithm of the number of words."""

    weights: dict[int, float]
    bias: float
    length: tuple[float, float, float]

    def margin(self, found: list[int], n_words: int) -> float:
        weight, mean, deviation = self.length
        return self.bias + sum(self.weights[f] for f in found) + weight * (np.log1p(n_words) - mean) / deviation


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def nn_gradient(weights: np.ndarray, toxic: np.ndarray, unlabelled: np.ndarray, prior: float, decay: float) -> tuple[float, np.ndarray]:
    """The corrected risk of calling unlabelled text clean, and the step's gradient; the matrices' last column is 1.

    While that risk is not negative, it is the gradient of the whole risk (with decay on all weights but the bias); below
    zero it is the negated one of the corrected risk alone.
    """
    of_toxic, of_unlabelled = toxic @ weights, unlabelled @ weights
    clean_risk = np.logaddexp(0, of_unlabelled).mean() - prior * np.logaddexp(0, of_toxic).mean()
    as_clean = unlabelled.T @ _sigmoid(of_unlabelled) / len(unlabelled) - prior * (toxic.T @ _sigmoid(of_toxic)) / len(toxic)
    if clean_risk < 0:
        return clean_risk, -as_clean
    return clean_risk, as_clean - prior * (toxic.T @ _sigmoid(-of_toxic)) / len(toxic) + decay * np.append(weights[:-1], 0)


def nnpu_fit(toxic: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights, the last one the bias, of the non-negative risk estimator with logistic loss; rows are documents."""
    toxic, unlabelled = (np.hstack([x, np.ones((len(x), 1), np.float32)]) for x in (toxic, unlabelled))
    weights, first, second = np.zeros(toxic.shape[1], np.float32), np.float32(0), np.float32(0)
    for step in range(1, steps + 1):
        _, gradient = nn_gradient(weights, toxic, unlabelled, prior, decay)
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        weights -= (rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return weights


def sketch(found: list[int], doc_id: int) -> int:
    """Alike for near copies, which mostly agree in their features of least rank; of its own for a text without features."""
    ranks = (np.asarray(found, np.uint32) * np.uint32(0x9E3779B1)) ^ np.uint32(0x5BD1E995)
    least = np.sort(ranks)[:6].tobytes() or b"no features %d" % doc_id
    return xxhash.xxh64_intdigest(least) - (1 << 63)


def telling_features(examples: DataFrame, n_toxic: int, n_other: int, most: int, excess: float = MIN_EXCESS) -> list[int]:
    """Features that toxic examples hold far more often than other text would by chance, the clearest first, ties by number.

    examples: toxic (1 or 0), features. Counted where the rows lie; `most` numbers come back.
    """
    counted = (
        examples.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_other"))
        .where("in_toxic >= 3")
    )
    expected = n_toxic * (F.col("in_other") + 0.5) / (n_other + 1)
    above = ((F.col("in_toxic") - expected) / F.sqrt(expected + 1)).alias("excess")
    return [row.feature for row in counted.select("feature", above).where(F.col("excess") > excess).orderBy(F.desc("excess"), "feature").limit(most).collect()]


def _rows(found: list[list[int]], lengths: np.ndarray, index: dict[int, int]) -> np.ndarray:
    matrix = np.zeros((len(found), len(index) + 1), np.float32)
    for row, some in zip(matrix, found, strict=True):
        row[[index[f] for f in some]] = 1
    matrix[:, -1] = lengths
    return matrix


def _examples(both: DataFrame) -> DataFrame:
    """doc_id, toxic, n_words, sketch, features of each (doc_id, toxic, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("n_words", pa.int64()), ("sketch", pa.int64()), ("features", pa.list_(pa.int32()))])

    def featured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in pieces(parts):
                for doc_id, text, toxic in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("toxic").to_pylist(), strict=True):
                    found, n_words = features(text)
                    yield doc_id, toxic, n_words, sketch(found, doc_id), found

        try:
            yield from batches(rows(), schema)
        finally:
            _cached_features.cache_clear()  # the worker goes on to tasks of other stages
            release_memory()

    return both.mapInArrow(featured, "doc_id long, toxic int, n_words long, sketch long, features array<int>")


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    max_toxic: int = MAX_TOXIC,
    max_unlabelled: int = MAX_UNLABELLED,
    max_features: int = MAX_FEATURES,
    min_excess: float = MIN_EXCESS,
    prior: float | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model | None:
    """Fitted on documents that are not held out: at most max_toxic confirmed ones and max_unlabelled others, by hash.

    prior: the toxic share of text; by default that of the labelled rows which are not held out. A document with several
    labels is toxic if one says so; null labels say nothing. Rows that repeat a doc_id count once, by their smallest text,
    and of near copies the one with the smallest doc_id counts. Without a toxic example or other text there is no model.
    The driver gets, for each example, its length and which of the chosen features it has.
    """
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    seen = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col(id_column)))
    seen = seen.groupBy(F.col(id_column).cast("long").alias("of")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    if prior is None:
        prior = seen.agg(F.avg("toxic")).first()[0]
    if not prior:
        return None
    few = seen.where("toxic = 1").orderBy(F.xxhash64("of"), "of").limit(max_toxic).select("of")
    total = max(1, docs.count())
    limit = int(min(1.0, max_unlabelled / total) * (1 << 30))
    some = docs.where(~held_out(F.col("doc_id")) & (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < limit))
    # At most max_toxic ids of 8 bytes.
    toxic = docs.join(F.broadcast(few), F.col("doc_id") == F.col("of")).select("doc_id", "text", F.lit(1).alias("toxic"))
    both = toxic.unionByName(some.select("doc_id", "text", F.lit(0).alias("toxic"))).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    featured = stored(_examples(both), "toxicity-features")
    unlike = featured.groupBy("toxic", "sketch").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic")
    # Two numbers for each example, of which there are about max_toxic + max_unlabelled.
    examples = stored(featured.join(F.broadcast(unlike), ["doc_id", "toxic"], "left_semi"), "toxicity-examples")
    sizes = {row.toxic: row["count"] for row in examples.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    chosen = telling_features(examples, sizes[1], sizes[0], max_features, min_excess)
    has = F.array_intersect("features", F.array(*map(F.lit, chosen)).cast("array<int>")).alias("features")
    fitted = examples.select("doc_id", "toxic", "n_words", has).toPandas().sort_values(["toxic", "doc_id"])
    positive, other = fitted[fitted.toxic == 1], fitted[fitted.toxic == 0]
    index = {f: k for k, f in enumerate(chosen)}
    logs = [np.log1p(part.n_words.to_numpy(float)) for part in (positive, other)]
    mean, deviation = float(logs[1].mean()), float(logs[1].std()) or 1.0
    matrices = [_rows(list(part.features), (log - mean) / deviation, index) for part, log in zip((positive, other), logs, strict=True)]
    weights = nnpu_fit(*matrices, prior)
    return Model({f: float(weights[k]) for f, k in index.items()}, float(weights[-1]), (float(weights[-2]), mean, deviation))


class _Known(dict):
    """Features of a word that the model weighs; bounded."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 100_000:
            self.clear()
        self[word] = found = tuple(f for f in word_features(word) if f in self.model.weights)
        return found


def with_toxicity(documents: DataFrame, model: Model | None, name: str = "score", *, text_column: str = "text") -> DataFrame:
    """documents and a score from 0 to 1 for each whole text, in a column of this name; no row moves.

    Null texts are empty, and empty texts are scored like others. Without a model every score is 0. Repeated rows score
    alike, an empty table gives an empty one, other columns play no part.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # max_features weights

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        known = _Known(model)

        def margin(text: str | None) -> float:
            words = plain_words(text or "")
            found = {f for some in map(known.__getitem__, set(words)) for f in some}
            return model.margin(sorted(found), len(words))

        for part in parts:
            yield pd.Series(_sigmoid(np.array([margin(text) for text in part], float)) if model else np.zeros(len(part)))
            del part
            release_memory()

    return documents.withColumn(name, score(F.col(text_column)))


def score_toxicity(documents: DataFrame, model: Model | None, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score, predicted (1 from 0.5 on): one row for each row of documents, as with_toxicity scores it."""
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return with_toxicity(docs, model).select("doc_id", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
