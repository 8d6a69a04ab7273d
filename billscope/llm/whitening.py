"""Operator 11, embedding whitening from exact integer statistics gathered by bit-sliced scatter.

Entries become integers (fixed point). In a block of rows each dimension is shifted by its least entry, and bit b of its entries, over
the rows, is packed into 64-bit words: one bit plane. The cross-product of two dimensions is then the sum over their planes of
2**(b + c) * popcount(plane_b AND plane_c), which is exact, as are the sums that undo the shift. Whole numbers are added up by
Spark, centred as integers (n * XX - S S'), and only then divided and given to eigh. What a task sends grows with
the dimensions alone, never with the rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.llm.scratch import stored

#: Integer steps in one unit of an entry.
STEPS = 256
COMPONENTS = 4
#: Rows of a block: its planes and what is counted of them at a time stay within a processor's caches.
BLOCK_ROWS = 8192
#: Sums leave a task as limbs of so many bits, so that Spark adds 64-bit numbers without overflow and without rounding.
LIMB_BITS = 40
LIMBS = 5


@dataclass(frozen=True)
class Whitening:
    """n vectors with per-dimension sums; components by falling eigenvalue as columns; total is the trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    total: float

    def __len__(self) -> int:
        return len(self.values)


def finite(vector: Column) -> Column:
    """True where the vector is not null, not empty, and all its entries are finite numbers."""
    doubles = vector.cast("array<double>")
    fine = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def fixed_point(vector: Column) -> Column:
    """floor(STEPS * entry) as long; beyond the range of long its nearest end."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * STEPS).cast("long"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal-length lists as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def scatter(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and cross-products (upper triangle) of the integer columns of x, from bit planes."""
    rows, dims = x.shape
    least = [int(v) for v in x.min(axis=0)]
    shifted = x.astype(np.uint64) - np.array([v % 2**64 for v in least], np.uint64)
    bits = [int(v).bit_length() for v in shifted.max(axis=0)]
    shifted = np.vstack([shifted, np.zeros((-rows % 64, dims), np.uint64)])
    first = np.concatenate([[0], np.cumsum(bits)])
    planes = np.empty((first[-1], len(shifted) // 64), np.uint64)
    for d in range(dims):
        for b in range(bits[d]):
            planes[first[d] + b] = np.packbits((shifted[:, d] >> np.uint64(b)).astype(np.uint8) & 1).view(np.uint64)
    weights = [1 << b for d in range(dims) for b in range(bits[d])]
    ones = [int(v) for v in np.bitwise_count(planes).sum(axis=1, dtype=np.int64)]
    sums = [sum(w * c for w, c in zip(weights[first[d] : first[d + 1]], ones[first[d] : first[d + 1]], strict=True)) for d in range(dims)]
    # Products of two planes' weights times a count of rows fit 64 bits unless entries are very wide.
    narrow = 2 * max(bits) + rows.bit_length() < 62
    dtype = np.int64 if narrow else object
    scale = np.array(weights, dtype)
    cross = []
    for d in range(dims):
        of_pairs = np.zeros(first[-1] - first[d], dtype)
        for p in range(first[d], first[d + 1]):
            both = np.bitwise_count(planes[p] & planes[first[d] :]).sum(axis=1, dtype=np.int64)
            of_pairs += both.astype(dtype) * scale[p]
        of_pairs = of_pairs * scale[first[d] :]
        ends = first[d:] - first[d]
        row = [int(of_pairs[a:b].sum()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        # (y + m)(z + k) = yz + k y + m z + m k, summed over rows
        cross.append([v + least[d + k] * sums[d] + least[d] * sums[d + k] + rows * least[d] * least[d + k] for k, v in enumerate(row)])
    return [s + rows * m for s, m in zip(sums, least, strict=True)], cross


def _limbs(value: int) -> list[int]:
    """The lowest limb first; the highest one carries the sign."""
    low = [(value >> (LIMB_BITS * k)) & ((1 << LIMB_BITS) - 1) for k in range(LIMBS - 1)]
    return [*low, value >> (LIMB_BITS * (LIMBS - 1))]


def exact_statistics(vectors: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and cross-products (upper triangle) over all rows of vectors (x: array<long> of one length)."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), *((f"l{k}", pa.int64()) for k in range(LIMBS))])

    def gathered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross, held, waiting = 0, None, None, [], 0

        def add(block: np.ndarray) -> None:
            nonlocal n, sums, cross
            of_block, products = scatter(block)
            n += len(block)
            sums = of_block if sums is None else [a + b for a, b in zip(sums, of_block, strict=True)]
            cross = products if cross is None else [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(cross, products, strict=True)]

        for batch in parts:
            if batch.num_rows:
                held.append(_matrix(batch.column("x")))
                waiting += batch.num_rows
            while waiting >= BLOCK_ROWS:
                rows = np.vstack(held)
                add(rows[:BLOCK_ROWS])
                held, waiting = [rows[BLOCK_ROWS:]], waiting - BLOCK_ROWS
        if waiting:
            add(np.vstack(held))
        if n:
            entries = [(-1, -1, n), *((i, -1, s) for i, s in enumerate(sums)), *((i, i + k, v) for i, row in enumerate(cross) for k, v in enumerate(row))]
            numbers = np.array([_limbs(v) for _, _, v in entries], np.int64)
            yield pa.record_batch([pa.array([e[0] for e in entries], pa.int32()), pa.array([e[1] for e in entries], pa.int32()), *map(pa.array, numbers.T)], schema=schema)

    limbs = [f"l{k}" for k in range(LIMBS)]
    found = vectors.select("x").mapInArrow(gathered, "i int, j int, " + ", ".join(f"{c} long" for c in limbs))
    # As many rows as there are pairs of dimensions.
    totals = found.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in limbs)).collect()
    value = {(r.i, r.j): sum(r[c] << (LIMB_BITS * k) for k, c in enumerate(limbs)) for r in totals}
    if not value:
        return 0, [], []
    dims = max(i for i, _ in value) + 1
    return value[-1, -1], [value[i, -1] for i in range(dims)], [[value[i, j] for j in range(i, dims)] for i in range(dims)]


def whitening_of(n: int, sums: list[int], cross: list[list[int]], components: int = COMPONENTS) -> Whitening:
    """Centred in whole numbers, divided once, then eigh. Directions without variance are no components."""
    dims = len(sums)
    covariance = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            covariance[i, j] = covariance[j, i] = (n * cross[i][j - i] - sums[i] * sums[j]) / n**2  # of whole numbers: rounded once
    values, vectors = np.linalg.eigh(covariance) if dims else (np.empty(0), np.empty((0, 0)))
    values, vectors = values[::-1], vectors[:, ::-1]
    some = int((values > max(values, default=0.0) * dims * np.finfo(float).eps).sum())
    top = min(components, some)
    return Whitening(n, tuple(sums), values[:top].copy(), vectors[:, :top].copy(), float(np.trace(covariance)))


def prepared(embeddings: DataFrame, vector_column: str = "embedding", name: str = "x") -> DataFrame:
    """Rows whose vector is finite and of the table's usual length, with x: its entries as whole numbers.

    The usual length is the most frequent one, the larger of equally frequent ones; vectors of other lengths have no place among
    the dimensions and are left out, like null, empty and non-finite ones.
    """
    rows = embeddings.where(finite(F.col(vector_column)))
    usual = rows.groupBy(F.size(vector_column).alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    dims = usual.dims if usual else 0
    return rows.where(F.size(vector_column) == dims).withColumn(name, fixed_point(F.col(vector_column)))


def fit_whitening(rows: DataFrame, *, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The whitening of the distinct vectors x of rows, and those vectors (stored). Copies combine map-side before the shuffle."""
    distinct = stored(rows.select("x").distinct(), "distinct-vectors")
    return whitening_of(*exact_statistics(distinct), components), distinct


def with_whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """rows with whitened (array<double>, a place for each component) and deviation (decimal(38,0), exact; null beyond that)."""
    centre, scaled = np.array([s / model.n for s in model.sums] if model.n else []), model.components / np.sqrt(model.values)
    n, sums, dims = model.n, np.array(model.sums, object), len(model.sums)
    limit, beyond = max((abs(s) for s in model.sums), default=0), 10**38

    def deviations(x: np.ndarray) -> list:
        widest = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
        if dims * (n * widest + limit) ** 2 < 2**63:
            apart = n * x - sums.astype(np.int64)
            return [Decimal(v) for v in (apart * apart).sum(axis=1).tolist()]
        exact = [int(v) for v in ((n * x.astype(object) - sums) ** 2).sum(axis=1)]
        return [Decimal(v) if v < beyond else None for v in exact]

    def placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            white = (x - centre) @ scaled
            column = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(model), white.ravel())
            exact = pa.array(deviations(x), pa.decimal128(38, 0))
            kept = [batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, column, exact], names=[*batch.schema.names, "whitened", "deviation"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(placed, f"{schema}, whitened array<double>, deviation decimal(38,0)")


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened distinct vectors' measured covariance minus the identity."""
    if not len(model):
        return 0.0
    places = range(len(model))
    columns = with_whitened(distinct, model).select(*(F.get("whitened", F.lit(k)).alias(f"w{k}") for k in places))
    pairs = [(a, b) for a in places for b in places if a <= b]
    found = columns.agg(*(F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs)).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whitened_embeddings(embeddings: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each usable row and component.

    The fit list is each distinct whole-number vector once. Null and empty vectors, those with null or non-finite entries and those
    of another length than the most frequent one give no rows. Rows that repeat an id, or have none, each give their rows; repeated
    vectors count once in the fit. Directions without variance are no components: with r of them beside, there are at most r rows
    fewer, and none for a table without rows or with one distinct vector. Equal eigenvalues come in any order. Other columns are
    ignored, whatever their names.
    """
    given = embeddings.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    rows = prepared(given, "vector").select("vec_id", "x")
    model, distinct = fit_whitening(rows, components=components)
    error = identity_error(distinct, model)
    explained = [float(v / model.total) for v in model.values]
    of_component = F.posexplode("whitened").alias("place", "whitened")
    return with_whitened(rows, model).select("vec_id", "deviation", of_component).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
