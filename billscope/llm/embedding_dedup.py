"""Operator 13, near-duplicates among embeddings: exact cosine links by dual traversal of cover trees, and their components.

Equal vectors of a label are one point. A label's points are dealt to cells around pivots, and cells to blocks of bounded size; each
block has a cover tree, written to the shared folder. A task takes one block, joins it with itself and then with the label's other
blocks, one at a time, pruned or taken whole by the covering radii of their roots. It returns a row for each of its points, and at most
one link for each two groups of linked points: no pair of points leaves a task. Work between blocks that no bound keeps apart stays
quadratic in different vectors, as exact joins are where distances say little.
"""

import io
import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.components import components
from billscope.llm.cover_tree import MARGIN, CoverTree, traverse
from billscope.llm.scratch import new_folder, stored
from billscope.llm.text import batches

LEAST_COSINE = 0.93
#: Points of a block, about.
BLOCK = 2048
#: Pivots of all labels together, about: what is sent to every task. More points make larger cells, never fewer results.
PIVOTS = 4096

_GROUP = ("label", "dims")
_BLOCK_KEY = ("label", "dims", "cell", "sub")


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label (as text), dims, digest and unit (binary) of rows that can be compared."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dims", pa.int32()), ("digest", pa.binary()), ("unit", pa.binary())])

    def scaled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in parts:
                vectors = batch.column("vector")
                bounds, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
                for k, (vec_id, label) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                    v = flat[bounds[k] : bounds[k + 1]]
                    v = v / np.abs(v).max()  # no overflow or underflow in the norm
                    unit = (v / np.sqrt(v @ v) + 0.0).astype("<f8").tobytes()
                    yield vec_id, label, len(v), blake2b(f"{label}\n".encode() + unit, digest_size=16).digest(), unit

        return batches(rows(), schema)

    return embeddings.mapInArrow(scaled, "vec_id long, label string, dims int, digest binary, unit binary")


def _by_label(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Label, dims and places of each group in the batch."""
    groups: dict[tuple, list[int]] = {}
    for k, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist(), strict=True)):
        groups.setdefault(key, []).append(k)
    return ((*key, places) for key, places in groups.items())


def _in_blocks(points: DataFrame) -> DataFrame:
    """points with cell, sub and blocks (of their label), so that a block has about BLOCK points at most."""
    sizes = stored(points.groupBy(*_GROUP).agg(F.count("*").alias("n")), "label-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    share = F.floor(F.col("n") * min(1 / BLOCK, PIVOTS / max(total, 1)))
    many = stored(sizes.withColumn("pivots", share).where("pivots > 1"), "labels-with-pivots")
    chosen = points.join(many, [*_GROUP]).where(F.pmod(F.xxhash64("digest"), F.col("n")) < F.col("pivots"))
    pivots: dict[tuple, list] = {}
    for row in chosen.select(*_GROUP, "unit").orderBy(*_GROUP, "digest").collect():  # about PIVOTS rows
        pivots.setdefault((row.label, row.dims), []).append(np.frombuffer(row.unit))
    matrices = {key: np.array(rows) for key, rows in pivots.items()}

    def nearest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            cells = np.zeros(batch.num_rows, np.int32)
            for label, dims, places in _by_label(batch):
                if (label, dims) in matrices:
                    units = np.frombuffer(b"".join(batch.column("unit").take(pa.array(places)).to_pylist())).reshape(-1, dims)
                    cells[places] = (units @ matrices[label, dims].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    celled = stored(points.mapInArrow(nearest, f"{schema}, cell int"), "points-in-cells")
    cells = celled.groupBy(*_GROUP, "cell").agg(F.ceil(F.count("*") / BLOCK).alias("subs"))
    blocks = stored(cells.groupBy(*_GROUP).agg(F.sum("subs").alias("blocks")), "blocks-of-labels")
    sub = F.pmod(F.xxhash64("digest", F.lit(1)), F.col("subs")).cast("int").alias("sub")
    return celled.join(stored(cells, "cell-sizes"), [*_GROUP, "cell"]).join(blocks, [*_GROUP]).select("point", "unit", "weight", *_GROUP, "cell", sub, "blocks")


class _Groups:
    """Union-find over places of a block."""

    def __init__(self, n: int):
        self.above = list(range(n))

    def of(self, k: int) -> int:
        while self.above[k] != k:
            self.above[k] = k = self.above[self.above[k]]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.of(a), self.of(b)
        self.above[max(a, b)] = min(a, b)


class Block:
    """Points of one block in the order of their tree: ids, weights, links (weight of linked points so far), roots (a point's id for each
    group of points linked within the block)."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, units: np.ndarray, least_cosine: float):
        self.tree = CoverTree(units)
        self.ids, self.weights = ids[self.tree.order], weights[self.tree.order]
        self._before = np.concatenate([[0], np.cumsum(self.weights)])
        self.least_cosine = least_cosine
        self.links = np.zeros(len(ids), np.int64)
        groups, whole = _Groups(len(ids)), np.zeros(len(ids) + 1, np.int64)

        def unite(a: np.ndarray, b: np.ndarray, near: np.ndarray) -> None:
            # Rows and columns with a link, each labelled by the least row it reaches within this matrix.
            rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            some = near[np.ix_(rows, columns)]
            label = np.arange(len(rows))
            while True:
                of_column = np.where(some, label[:, None], len(rows)).min(axis=0)
                least = np.minimum(label, np.where(some, of_column, len(rows)).min(axis=1))
                if (least == label).all():
                    break
                label = least
            starts, beside = self.tree.start[a[rows]], self.tree.start[b[columns]]
            for own, to in ((starts, label), (beside, of_column)):
                for k, at in zip(own.tolist(), to.tolist(), strict=True):
                    groups.join(k, int(starts[at]))
            for nodes in (a[rows], b[columns]):
                np.add.at(whole, self.tree.start[nodes], 1)
                np.add.at(whole, self.tree.end[nodes] - 1, -1)

        self._traverse(self, unite)
        for k in np.flatnonzero(np.cumsum(whole)[:-1] > 0).tolist():  # points beside each other in a node taken whole
            groups.join(k, k + 1)
        self.roots = self.ids[[groups.of(k) for k in range(len(ids))]]

    def _traverse(self, other: "Block", also) -> None:
        added = np.zeros(len(self.ids) + 1, np.int64)

        def linked(a: np.ndarray, b: np.ndarray, near: np.ndarray) -> None:
            weights = other._before[other.tree.end[b]] - other._before[other.tree.start[b]]
            of_node = near @ weights
            np.add.at(added, self.tree.start[a], of_node)
            np.add.at(added, self.tree.end[a], -of_node)
            also(a, b, near)

        traverse(self.tree, other.tree, self.least_cosine, linked)
        self.links += np.cumsum(added)[:-1]

    def meet(self, other: "Block") -> set[tuple[int, int]]:
        """Adds the links to another block's points; which groups of both are linked, as pairs of roots."""
        found: set[tuple[int, int]] = set()

        def pairs(a: np.ndarray, b: np.ndarray, near: np.ndarray) -> None:
            # A node's points may be in several groups; the other side's task sees to the groups of its own.
            theirs = other.roots[other.tree.start[b]]
            for k in np.flatnonzero(near.any(axis=1)).tolist():
                mine = np.unique(self.roots[self.tree.start[a[k]] : self.tree.end[a[k]]]).tolist()
                found.update((x, y) for y in np.unique(theirs[near[k]]).tolist() for x in mine)

        self._traverse(other, pairs)
        return found

    def packed(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, ids=self.ids, weights=self.weights, links=self.links, roots=self.roots, **self.tree.parts())
        return file.getvalue()

    @classmethod
    def of_packed(cls, data: bytes, least_cosine: float) -> "Block":
        """With its links and roots as they were packed."""
        block = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as kept:
            block.tree = CoverTree.of_parts(kept)
            block.ids, block.weights, block.links, block.roots = (kept[k] for k in ("ids", "weights", "links", "roots"))
        block._before = np.concatenate([[0], np.cumsum(block.weights)])
        block.least_cosine = least_cosine
        return block


_FOUND = pa.schema([("point", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("label", pa.string()), ("dims", pa.int32()), ("name", pa.string()), ("weight", pa.int64()), ("centre", pa.binary()), ("radius", pa.float64())])
_FOUND_SPARK = "point long, links long, root long, label string, dims int, name string, weight long, centre binary, radius double"


def _read(folder: str, name: str) -> bytes:
    store, path = pa.fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{name}") as file:
        return file.read()


def _within_blocks(blocked: DataFrame, folder: str, least_cosine: float) -> DataFrame:
    """A row for each point of labels with one block; a row for each block of other labels, whose file is written: its root's
    id, its name, weight, centre and covering radius."""

    def built(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pa.fs.FileSystem.from_uri(folder)

        def finished(key: tuple, alone: bool, rows: list[tuple]) -> Iterator[tuple]:
            ids, weights = (np.array([r[k] for r in rows], np.int64) for k in (0, 2))
            block = Block(ids, weights, np.frombuffer(b"".join(r[1] for r in rows)).reshape(len(rows), -1), least_cosine)
            if alone:
                yield from ((p, n, r, None, None, None, None, None, None) for p, n, r in zip(block.ids.tolist(), block.links.tolist(), block.roots.tolist(), strict=True))
                return
            name = f"block-{uuid.uuid4().hex}"
            with store.open_output_stream(f"{path}/{name}") as file:
                file.write(block.packed())
            centre = block.tree.points[block.tree.centre[0]].tobytes()
            yield None, None, int(block.roots[0]), key[0], key[1], name, int(block.weights.sum()), centre, float(block.tree.radius[0])

        def rows():
            key, alone, held = None, True, []
            for batch in parts:
                for point, unit, weight, *at, blocks in zip(*(batch.column(k).to_pylist() for k in ("point", "unit", "weight", *_BLOCK_KEY, "blocks")), strict=True):
                    if at != key and held:
                        yield from finished(key, alone, held)
                        held = []
                    key, alone = at, blocks == 1
                    held.append((point, unit, weight))
            if held:
                yield from finished(key, alone, held)

        return batches(rows(), _FOUND)

    return blocked.repartition(*_BLOCK_KEY).sortWithinPartitions(*_BLOCK_KEY, "point").mapInArrow(built, _FOUND_SPARK)


def _across_blocks(heads: DataFrame, listed: str, folder: str, least_cosine: float) -> DataFrame:
    """point, links, root for each point of the heads' blocks, and rows with only links between roots: root, other.

    listed: the folder with all heads as Parquet, sorted by label, which each task reads as a stream.
    """
    schema = pa.schema([("point", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("other", pa.int64())])
    within = float(np.sqrt(2.0 - 2.0 * least_cosine))

    def joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pa.fs.FileSystem.from_uri(listed)
        every = pa.dataset.dataset(path, filesystem=store, format="parquet")

        def of(head: dict) -> Iterator[tuple]:
            block = Block.of_packed(_read(folder, head["name"]), least_cosine)
            centre, radius = np.frombuffer(head["centre"]), head["radius"]
            same = (pa.dataset.field("label") == head["label"]) & (pa.dataset.field("dims") == head["dims"])
            for batch in every.scanner(columns=["name", "root", "weight", "centre", "radius"], filter=same, batch_size=1024, batch_readahead=1, fragment_readahead=1).to_batches():
                for other in batch.to_pylist():
                    if other["name"] == head["name"]:
                        continue
                    apart, reach = float(np.sqrt(((centre - np.frombuffer(other["centre"])) ** 2).sum())), radius + other["radius"]
                    if apart - reach > within + MARGIN:
                        continue
                    if apart + reach <= within - MARGIN:  # all of both, without reading the other
                        block.links += other["weight"]
                        met = {(r, other["root"]) for r in np.unique(block.roots).tolist()}
                    else:
                        met = block.meet(Block.of_packed(_read(folder, other["name"]), least_cosine))
                    yield from ((None, None, a, b) for a, b in sorted(met))
            yield from ((p, n, r, None) for p, n, r in zip(block.ids.tolist(), block.links.tolist(), block.roots.tolist(), strict=True))

        return batches((row for batch in parts for head in batch.to_pylist() for row in of(head)), schema)

    return heads.mapInArrow(joined, "point long, links long, root long, other long")


def _linked_points(points: DataFrame, least_cosine: float) -> tuple[DataFrame, DataFrame]:
    """point, links, root; and links between roots: a, b."""
    spark = points.sparkSession
    folder = new_folder(spark, "vector-blocks")
    store, path = pa.fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    found = stored(_within_blocks(_in_blocks(points), folder, least_cosine), "linked-in-blocks")
    listed = new_folder(spark, "block-heads")
    found.where("name IS NOT NULL").drop("point", "links").repartitionByRange("label", "dims", "name").sortWithinPartitions("label", "dims", "name").write.parquet(listed)
    heads = spark.read.parquet(listed)
    n = heads.count()
    across = stored(_across_blocks(heads.repartition(max(1, min(n, 10_000))), listed, folder, least_cosine), "linked-across-blocks")
    linked = found.where("point IS NOT NULL").select("point", "links", "root").unionByName(across.where("point IS NOT NULL").select("point", "links", "root"))
    return linked, across.where("other IS NOT NULL").select(F.col("root").alias("a"), F.col("other").alias("b"))


def near_duplicate_vectors(
    embeddings: DataFrame, *, least_cosine: float = LEAST_COSINE, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable), kept (vec_id = component_id), a row for each row.

    Rows with equal labels are linked if the cosine of their vectors, in double precision, is least_cosine or more. Rows without label,
    and vectors that are null, empty, zero or hold null or non-finite entries, link with nothing, as do vectors of different lengths.
    Rows that repeat a vec_id are one vector of the components, whatever their vectors: what one reaches the others reach; each
    counts its own links, equal rows among them; such rows whose vector links with nothing stay apart. Rows without vec_id take part in links, and are kept only if linked with no
    row that has one, in a component without id. An empty table gives an empty one, other columns are ignored.
    """
    if not 0 < least_cosine <= 1:
        raise ValueError("the least cosine is above 0 and at most 1")
    given = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("string").alias("label"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("vector", lambda c: c != 0)
    comparable = F.coalesce(F.col("label").isNotNull() & fine, F.lit(False))
    units = stored(unit_vectors(given.where(comparable)), "unit-vectors")
    points = stored(
        units.groupBy("label", "dims", "digest", "unit").agg(F.count("*").alias("weight")).withColumn("point", F.monotonically_increasing_id()), "distinct-vectors"
    )
    linked, links = _linked_points(points, least_cosine)
    of_digest = stored(points.select("point", "digest").join(linked, "point").select("digest", "links", "root"), "links-of-vectors")
    rows = stored(units.select("vec_id", "digest").join(of_digest, "digest").select("vec_id", (F.col("links") - 1).alias("n_links"), "root"), "rows-with-links")
    # Rows of one vec_id on different vectors belong together.
    several = stored(rows.groupBy("vec_id").agg(F.min("root").alias("a"), F.max("root").alias("z")).where("vec_id IS NOT NULL AND a < z").select("vec_id", "a"), "repeated-ids")
    same_id = rows.join(several, "vec_id").where("root <> a").select("a", F.col("root").alias("b"))
    found = components(links.unionByName(same_id))
    component = F.coalesce("component", "root").alias("component")
    whole = stored(rows.join(found.withColumnRenamed("doc", "root"), "root", "left").select("vec_id", "n_links", component), "rows-with-components")
    least = stored(whole.groupBy("component").agg(F.min("vec_id").alias("component_id")), "component-ids")
    named = whole.join(least, "component").select("vec_id", "n_links", "component_id")
    alone = given.where(~comparable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return named.unionByName(alone).withColumn("kept", kept)
