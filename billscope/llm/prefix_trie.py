"""Operator 12, the trie of conversation prefixes, with subtree totals by time-forward processing.

Turns get their places by a range shuffle and counts carried from one part to the next, so a conversation of any length lies over many
tasks. A node is known by 128 bits: the XOR of one hash for each of its (place, role, text), so prefixes are running XORs and a node's
parent follows from the node without a join. Nodes with the same members form chains; a chain is one vertex below.

Subtree totals: vertices with few members stand in shards, one below each vertex that has many members. In each shard, vertices sorted
by falling depth send their totals forward in that order to their parents through a priority queue that spills sorted runs. What shard
roots hand on is summed by parent, and the vertices with many members, no more than the square root of the table's rows, are done in
the same way.
"""

import heapq
import math
import struct
import tempfile
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billscope.llm.scratch import stored
from billscope.llm.text import batches

#: Every conversation starts with up to this many turns, less one, of the first one of its hundred.
SHARED_TURNS = 6
FAMILY = 100
#: Running totals are taken within so many places and carried over: no group of a window is larger.
CHUNK = 4096
#: Ids joined into one string before the strings of a node are hashed in order.
IDS_OF_CHUNK = 20_000
#: Messages that a queue holds in memory.
QUEUE_LIMIT = 200_000
EMPTY_SHA256 = sha256(b"").hexdigest()


class SpillingQueue:
    """A priority queue of tuples of 64-bit integers; beyond the limit it writes sorted runs to temporary files."""

    def __init__(self, width: int, limit: int):
        self.format, self.limit = struct.Struct(f"<{width}q"), limit
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # the next message of each run, its number and the rest of it
        self.runs = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()  # noqa: SIM115: its run reads it later; gone when closed
        for message in sorted(self.heap):
            file.write(self.format.pack(*message))
        file.seek(0)
        self.heap = []
        self.runs += 1
        rest = self._run(file)
        heapq.heappush(self.heads, (next(rest), self.runs, rest))

    def _run(self, file) -> Iterator[tuple]:
        with file:
            while some := file.read(self.format.size * 4096):
                yield from self.format.iter_unpack(some)

    def take(self, key: tuple) -> Iterator[tuple]:
        """Removes and yields the messages that begin with the key; none may be smaller."""
        n = len(key)
        while self.heap and self.heap[0][:n] == key:
            yield heapq.heappop(self.heap)
        while self.heads and self.heads[0][0][:n] == key:
            message, run, rest = self.heads[0]
            following = next(rest, None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, run, rest))
            yield message


def _placed(conversations: DataFrame) -> DataFrame:
    """conv_id, part, place (from 1 within conversation and part), a, b (hashes of role and text), chars; parts follow each other.

    Order: turn, null first; equal turns by role, then text.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("chars", pa.int64()), ("part", pa.int32()), ("place", pa.int64())])

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in parts:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            start = np.repeat(first, np.diff(np.append(first, len(ids))))
            place = np.arange(1, len(ids) + 1) - start
            if ids[0] == last:
                place[start == 0] += seen
            last, seen = ids[-1], int(place[-1])
            columns = [batch.column(k) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(ids), part, np.int32)), pa.array(place)], schema=schema)

    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("tie")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("tie")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    hashed = ranged.select("conv_id", F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "text", "role").alias("b"), F.char_length("text").cast("long").alias("chars"))
    return hashed.mapInArrow(counted, "conv_id long, a long, b long, chars long, part int, place long")


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from its family's first one: crc32 of its decimal id modulo SHARED_TURNS."""
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED_TURNS


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, depth, last, a, b, chars), and each conversation's number of them (conv_id, total)."""
    turns = stored(_placed(conversations), "placed-turns")
    segments = stored(turns.groupBy("conv_id", "part").agg(F.count("*").alias("n")), "conversation-parts")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first conversation of a part can have begun before it: a row for each part at most.
    begun = stored(segments.withColumn("before", F.sum("n").over(earlier)).where("before > 0").select("conv_id", "part", "before"), "begun-before")
    lengths = stored(segments.groupBy("conv_id").agg(F.sum("n").alias("own")), "conversation-lengths")
    of_base = lengths.where(f"conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    taken = F.least("h", F.coalesce("of_base", F.lit(0)))
    plan = stored(
        lengths.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), shared_turns(F.col("conv_id")).alias("h"))
        .join(of_base, "base", "left")
        .select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("total")),
        "rebuilt-lengths",
    )
    at = turns.join(begun, ["conv_id", "part"], "left").select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "a", "b", "chars")
    hashes = ("a", "b", "chars")
    own = at.join(plan, "conv_id").where("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "total", *hashes)
    first = at.where(f"conv_id % {FAMILY} = 0 AND place < {SHARED_TURNS}").select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), *hashes)
    shared = plan.where("taken > 0").join(first, "base").where("depth <= taken").select("conv_id", "depth", "total", *hashes)
    rows = own.unionByName(shared).select("conv_id", "depth", (F.col("depth") == F.col("total")).alias("last"), *hashes)
    return rows, plan.select("conv_id", "total")


def _paths(rebuilt: DataFrame) -> DataFrame:
    """conv_id, depth, last, chars, n1, n2 (the node), p1, p2 (its parent; the root is 0, 0): a row for each rebuilt turn."""
    hashed = rebuilt.select(
        "conv_id", "depth", "last", "chars", F.floor((F.col("depth") - 1) / CHUNK).alias("chunk"), F.xxhash64(F.lit(3), "depth", "a", "b").alias("z1"), F.xxhash64(F.lit(4), "b", "a", "depth").alias("z2")
    )
    within = Window.partitionBy("conv_id", "chunk").orderBy("depth")
    some = stored(hashed.withColumn("x1", F.bit_xor("z1").over(within)).withColumn("x2", F.bit_xor("z2").over(within)), "chunk-prefixes")
    so_far = Window.partitionBy("conv_id").orderBy("chunk")
    full = some.where(f"depth % {CHUNK} = 0").select(
        "conv_id", (F.col("chunk") + 1).alias("chunk"), F.bit_xor("x1").over(so_far).alias("c1"), F.bit_xor("x2").over(so_far).alias("c2")
    )
    whole = some.join(stored(full, "full-chunks"), ["conv_id", "chunk"], "left")
    n1, n2 = (F.col(x).bitwiseXOR(F.coalesce(c, F.lit(0))) for x, c in (("x1", "c1"), ("x2", "c2")))
    return whole.select("conv_id", "depth", "last", "chars", n1.alias("n1"), n2.alias("n2"), n1.bitwiseXOR(F.col("z1")).alias("p1"), n2.bitwiseXOR(F.col("z2")).alias("p2"))


def _end_hashes(ends: DataFrame) -> DataFrame:
    """n1, n2, depth, ends_sha256. Sorted ids are joined into strings where they lie; a node's strings are hashed in their order."""
    joined = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    hashed = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

    def rows(parts: Iterator[pa.RecordBatch], names: tuple) -> Iterator[tuple]:
        return (row for batch in parts for row in zip(*(batch.column(k).to_pylist() for k in names), strict=True))

    def join(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def strings():
            node, ids = None, []
            for *key, conv_id in rows(parts, ("n1", "n2", "depth", "conv_id")):
                if ids and (key != node or len(ids) >= IDS_OF_CHUNK):
                    yield *node, ids[0], ",".join(map(str, ids))
                    ids = []
                node = key
                ids.append(conv_id)
            if ids:
                yield *node, ids[0], ",".join(map(str, ids))

        return batches(strings(), joined)

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes():
            node, running = None, None
            for *key, ids in rows(parts, ("n1", "n2", "depth", "ids")):
                if key == node:
                    running.update(b"," + ids.encode())
                    continue
                if node:
                    yield *node, running.hexdigest()
                node, running = key, sha256(ids.encode())
            if node:
                yield *node, running.hexdigest()

        return batches(nodes(), hashed)

    order = ("n1", "n2", "depth", "conv_id")
    strings = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "n1 long, n2 long, depth long, first long, ids string")
    return strings.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "depth", "first").mapInArrow(digest, "n1 long, n2 long, depth long, ends_sha256 string")


_VERTEX = ("s1", "s2", "depth", "conv_id", "n_convs", "up_depth", "up_conv", "inside", "saved", "n_leaves", "below", "n_children")


def _time_forward(vertices: DataFrame) -> DataFrame:
    """conv_id, n_convs, n_leaves, below (saved beneath), n_children, and total, up_depth, up_conv of those whose parent is elsewhere.

    Each partition's vertices come by shard, falling depth and conv_id. n_leaves, below and n_children arrive with what lower shards
    sent. A total goes to the parent, which comes later in that order, if it is in the shard (inside).
    """
    schema = pa.schema([(k, pa.int64()) for k in ("conv_id", "n_convs", "n_leaves", "below", "n_children", "total", "up_depth", "up_conv")])

    def forward(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            queue = SpillingQueue(7, QUEUE_LIMIT)
            for batch in parts:
                for s1, s2, depth, conv_id, n_convs, up_depth, up_conv, inside, saved, leaves, below, children in zip(*(batch.column(k).to_pylist() for k in _VERTEX), strict=True):
                    for *_, more_leaves, more_saved, _child in queue.take((s1, s2, -depth, conv_id)):
                        leaves, below, children = leaves + more_leaves, below + more_saved, children + 1
                    leaves = leaves or 1
                    if inside:
                        queue.push((s1, s2, -up_depth, up_conv, leaves, below + saved, conv_id))
                    sent = (None, None, None) if inside else (below + saved, up_depth, up_conv)
                    yield conv_id, n_convs, leaves, below, children, *sent

        return batches(rows(), schema)

    ordered = vertices.select(*_VERTEX).sortWithinPartitions("s1", "s2", F.desc("depth"), "conv_id")
    return ordered.mapInArrow(forward, ", ".join(f"{f.name} long" for f in schema))


def _totals(nodes: DataFrame, paths: DataFrame, many: int) -> DataFrame:
    """conv_id, n_convs, top, bottom (depths of the chain), up_conv, n_leaves, below, n_children: a row for each chain."""
    chains = stored(
        nodes.groupBy("conv_id", "n_convs").agg(
            F.min("depth").alias("top"), F.max("depth").alias("depth"), F.sum("saved").alias("saved"),
            *(F.max_by(k, "depth").alias(k) for k in ("n1", "n2")), *(F.min_by(k, "depth").alias(k) for k in ("p1", "p2")),
        ),
        "chains",
    )
    # A chain hangs from the bottom of another one.
    ups = chains.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), (F.col("depth") + 1).alias("top"), F.col("conv_id").alias("up_conv"), F.col("n_convs").alias("up_convs"))
    linked = chains.join(ups, ["p1", "p2", "top"], "left").withColumn("up_depth", F.col("top") - 1)
    none = [F.lit(0).cast("long").alias(k) for k in ("n_leaves", "below", "n_children")]
    crowded = stored(nodes.where(F.col("n_convs") > many).select("n1", "n2"), "crowded-nodes")
    # Of each conversation the first node that is not crowded: the root of its shard.
    roots = paths.join(crowded.toDF("p1", "p2"), ["p1", "p2"], "left_semi").join(crowded, ["n1", "n2"], "left_anti")
    shards = stored(roots.select("conv_id", F.col("n1").alias("s1"), F.col("n2").alias("s2")), "shards")
    linked = stored(linked, "linked-chains")
    inside = F.coalesce(F.col("up_convs") <= many, F.lit(False)).alias("inside")
    small = linked.where(F.col("n_convs") <= many).join(shards, "conv_id", "left")
    shard = [F.coalesce(k, F.lit(0)).alias(k) for k in ("s1", "s2")]
    small = small.select(*shard, "depth", "conv_id", "n_convs", "up_depth", "up_conv", inside, "saved", *none)
    within = stored(_time_forward(small.repartition("s1", "s2")), "totals-in-shards")
    sent = within.where("up_conv is not null").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth")).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("total").alias("below"), F.count("*").alias("n_children")
    )
    arrived = [F.coalesce(k, F.lit(0)).alias(k) for k in ("n_leaves", "below", "n_children")]
    large = linked.where(F.col("n_convs") > many).join(sent, ["conv_id", "depth"], "left")
    across = large.select(*(F.lit(0).cast("long").alias(k) for k in ("s1", "s2")), "depth", "conv_id", "n_convs", "up_depth", "up_conv", F.col("up_conv").isNotNull().alias("inside"), "saved", *arrived)
    over = stored(_time_forward(across.repartition(1)), "totals-across-shards")
    known = ("conv_id", "n_convs", "n_leaves", "below", "n_children")
    found = within.select(*known).unionByName(over.select(*known))
    return linked.select("conv_id", "n_convs", "top", F.col("depth").alias("bottom"), "up_conv").join(found, ["conv_id", "n_convs"])


def prefix_trie(conversations: DataFrame, *, many: int | None = None) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row for each node.

    conversations: conv_id, turn, role, text. Turns are ordered by turn, null first, equal ones by role and text; null roles and
    texts are empty. Rows without conv_id belong to no conversation and are left out. Repeated rows are turns of their own. An empty
    table has no node. Other columns are ignored, whatever their names. many: members from which a node is left out of shards; by
    default the square root of the number of rebuilt turns, which bounds both the chains of a shard and the nodes outside shards.
    """
    rebuilt, lengths = _rebuilt(conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text"))
    paths = _paths(rebuilt)
    size = lengths.agg(F.count("*").alias("n"), F.sum("total").alias("turns"), F.min("conv_id").alias("least"))
    many = many or max(64, math.isqrt(size.first().turns or 0))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = size.where("n > 0").select(
        zero.alias("n1"), zero.alias("n2"), zero.alias("depth"), F.col("least").alias("conv_id"), F.col("n").alias("n_convs"), zero.alias("chars"), none.alias("p1"), none.alias("p2")
    )
    grouped = paths.groupBy("n1", "n2", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.max(k).alias(k) for k in ("chars", "p1", "p2")))
    saved = (F.col("n_convs") - 1) * F.col("chars")
    nodes = stored(grouped.unionByName(root).withColumn("saved", saved), "trie-nodes")
    turnless = lengths.where("total = 0").select(zero.alias("n1"), zero.alias("n2"), zero.alias("depth"), "conv_id")
    ends = _end_hashes(paths.where("last").select("n1", "n2", "depth", "conv_id").unionByName(turnless))
    below_in_chunk = Window.partitionBy("conv_id", "n_convs", "chunk").orderBy(F.desc("depth"))
    summed = stored(nodes.withColumn("chunk", F.floor(F.col("depth") / CHUNK)).withColumn("own", F.sum("saved").over(below_in_chunk)), "saved-in-chunks")
    deeper = Window.partitionBy("conv_id", "n_convs").orderBy(F.desc("chunk"))
    carried = stored(
        summed.where(f"depth % {CHUNK} = 0 AND depth > 0").select("conv_id", "n_convs", (F.col("chunk") - 1).alias("chunk"), F.sum("own").over(deeper).alias("deeper")), "saved-by-chunk"
    )
    whole = summed.join(carried, ["conv_id", "n_convs", "chunk"], "left").join(stored(_totals(nodes, paths, many), "chain-totals"), ["conv_id", "n_convs"])
    return whole.join(stored(ends, "end-hashes"), ["n1", "n2", "depth"], "left").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("up_conv")).alias("parent_conv_id"),
        "n_convs",
        F.when(F.col("depth") < F.col("bottom"), F.lit(1)).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves",
        (F.col("own") + F.coalesce("deeper", F.lit(0)) + F.col("below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
