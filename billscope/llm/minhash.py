"""Operator 8, near-duplicates: circulant MinHash, banding, and exact Jaccard similarity on full shingle sets.

Two permutations give a whole signature: one scatters the shingles, the other, shifted circularly by one place for each
coordinate, ranks them. Documents that agree in a band meet in a bucket. No bucket is turned into all its pairs: each
bucket has a hub, every member is compared with it exactly. Members that are not similar to it elect a hub of their own, for a few
rounds. What is left to find, between members of different families, follows from how each differs from the hub (see near_pairs).
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from billscope.llm.components import components
from billscope.llm.scratch import stored
from billscope.llm.text import WordHashes, batches, lower_words, mixed, pieces, texts, window_hashes

WORDS_OF_SHINGLE = 5
ROWS = 5
#: Similarity, in percent, from which documents are linked unless the caller names another.
PERCENT = 85


def bands_for(percent: int) -> int:
    """So many bands that at this similarity all of them differ with a probability below 1e-6: 24 at 85, 35 at 80."""
    if not 1 <= percent <= 100:
        raise ValueError("percent is from 1 to 100")
    differs = 1 - (percent / 100) ** ROWS
    return max(1, math.ceil(math.log(1e-6) / math.log(differs))) if differs else 1


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """64-bit hashes of the distinct five-word shingles, sorted; a shorter text is one shingle, an empty one has none."""
    words = hashes.of(lower_words(text))
    if not len(words):
        return words
    return np.unique(window_hashes(words, tuple(range(min(len(words), WORDS_OF_SHINGLE)))))


def _permuted(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(13)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def signature(of: np.ndarray, bands: int = bands_for(PERCENT)) -> np.ndarray:
    """Coordinate k: the least rank of a scattered shingle under the second permutation shifted by k places."""
    scattered = _permuted(of.astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    shifts = np.arange(bands * ROWS, dtype=np.uint32)
    least = np.full(len(shifts), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), 512):
        ranks = _permuted(scattered[at : at + 512, None] - shifts, 0x7FEB352D, 0x846CA68B)
        np.minimum(least, ranks.min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One key for each band, different from those of other bands."""
    bands = coordinates.reshape(-1, ROWS)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for row in bands.T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
    return key


def sketches(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, set_key (equal for equal shingle sets), n_shingles, bands (none for an empty set): a row for each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("set_key", pa.binary()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64()))])
    n_bands = bands_for(percent)

    def sketched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            hashes = WordHashes()
            for batch in pieces(parts):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                    found = shingles(text, hashes)
                    if doc_id is None or not len(found):
                        # Keys of other lengths than a digest: such rows are equal to no other document.
                        yield doc_id, b"none" if doc_id is None else doc_id.to_bytes(8, "little", signed=True), len(found), []
                    else:
                        yield doc_id, hashlib.blake2b(found.tobytes(), digest_size=16).digest(), len(found), band_keys(signature(found, n_bands)).view(np.int64)

        return batches(rows(), schema)

    return documents.mapInArrow(sketched, "doc_id long, set_key binary, n_shingles long, bands array<long>")


def hub_members(band_rows: DataFrame) -> DataFrame:
    """hub, doc: for each bucket of two or more documents, its other members beside the one that meets most documents.

    band_rows: doc, key. A document near many others stands in large buckets, so buckets of one group mostly agree on it.
    """
    sizes = stored(band_rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes")
    crowded = stored(band_rows.join(sizes, "key"), "crowded-buckets")
    met = stored(crowded.groupBy("doc").agg(F.sum("n").alias("met")), "documents-met")
    ranked = stored(crowded.select("key", "doc").join(met, "doc"), "ranked-members")
    hubs = stored(ranked.groupBy("key").agg(F.max(F.struct("met", (-F.col("doc")).alias("other"))).alias("best")).select("key", (-F.col("best.other")).alias("hub")), "bucket-hubs")
    return ranked.join(hubs, "key").where("hub <> doc").select("hub", "doc").distinct()


def differences(members: DataFrame, documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """hub, doc, h (the hub's set size), weight (100 * missing + percent * extra shingles), difference (those shingles).

    Similar enough to the hub means weight <= (100 - percent) * h: the intersection is h - missing, the union h + extra.
    """
    both = (
        members.join(documents.select(F.col("doc_id").alias("doc"), F.col("text").alias("own")), "doc")
        .join(documents.select(F.col("doc_id").alias("hub"), F.col("text").alias("of_hub")), "hub")
        .select("hub", "doc", "own", "of_hub")
    )
    schema = pa.schema([("hub", pa.int64()), ("doc", pa.int64()), ("h", pa.int64()), ("weight", pa.int64()), ("difference", pa.list_(pa.int64()))])

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            hashes, last, of_hub = WordHashes(), None, np.empty(0, np.uint64)
            for batch in pieces(parts):
                for hub, doc, own, hub_text in zip(*(batch.column(k).to_pylist() for k in ("hub", "doc", "own", "of_hub")), strict=True):
                    if last != (hub, hub_text):  # rows of a hub come one after another
                        last, of_hub = (hub, hub_text), shingles(hub_text or "", hashes)
                    found = shingles(own or "", hashes)
                    apart = np.setxor1d(found, of_hub, assume_unique=True)
                    missing = int(np.isin(apart, of_hub, assume_unique=True).sum())
                    yield hub, doc, len(of_hub), 100 * missing + percent * (len(apart) - missing), apart.view(np.int64)

        return batches(rows(), schema)

    return both.mapInArrow(compared, "hub long, doc long, h long, weight long, difference array<long>")


def _needed(percent: int, *weights: Column) -> Column:
    """Shingles that two differences must share for their documents to be similar enough."""
    total = sum(weights[1:], weights[0]) - (100 - percent) * F.col("h")
    return F.ceil(total / (100 + percent))


#: Rounds in which members far from a hub elect another one among themselves; near_pairs is exact after any number of them.
ROUNDS = 3


def families(apart: DataFrame, documents: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """hub, doc, family for members similar to a hub elected by those that are far from theirs; and the links found: a, b.

    Each round compares every member still far with one document per hub, so work and rows grow with members and not with pairs.
    """
    far = stored(apart.where(F.col("weight") > (100 - percent) * F.col("h")).select("hub", "doc").distinct(), "far-members")
    found = None
    for _ in range(ROUNDS):
        elected = stored(far.groupBy("hub").agg(F.min("doc").alias("family"), F.count("*").alias("n")).where("n > 1").drop("n"), "elected-hubs")
        others = stored(far.join(elected, "hub").where("doc <> family"), "far-from-elected")
        compared = differences(others.select(F.col("family").alias("hub"), "doc").distinct(), documents, percent)
        near = compared.where(F.col("weight") <= (100 - percent) * F.col("h")).select(F.col("hub").alias("family"), "doc").distinct()
        joined = stored(others.join(stored(near, "near-elected"), ["family", "doc"]).select("hub", "doc", "family"), "families")
        found = joined if found is None else found.unionByName(joined)
        # Those that found no family go on, without the one they were compared with.
        far = stored(others.select("hub", "doc").join(joined, ["hub", "doc"], "left_anti"), "far-members")
        if far.isEmpty():
            break
    return found, found.select(F.col("family").alias("a"), F.col("doc").alias("b"))


def near_pairs(apart: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: similar documents among the members of a hub, where not both are similar to the hub itself or to one elected hub.

    found: hub, doc, family (see families). With s shingles common to the differences of a and b, the intersection of a and b is h - missing(a) - missing(b) + s
    and their union h + extra(a) + extra(b) - s. So they are similar enough if and only if
    (100 + percent) * s >= weight(a) + weight(b) - (100 - percent) * h, which is above zero unless both are similar to the hub and so linked anyway.
    Only shingles that two families share can be common to documents of different ones. A document with fewer of them
    at all than that is out; the others meet over their rarest ones.
    """
    far = F.col("weight") > (100 - percent) * F.col("h")
    open_hubs = apart.groupBy("hub").agg(F.count("*").alias("n"), F.max(far).alias("any_far")).where("n > 1 and any_far")
    apart = apart.join(stored(open_hubs.select("hub"), "open-hubs"), "hub", "left_semi").withColumn("far", far)
    of_family = F.coalesce(F.col("family"), F.when(F.col("far"), F.col("doc")).otherwise(F.col("hub")))
    apart = apart.join(found, ["hub", "doc"], "left").withColumn("family", of_family)
    elements = stored(apart.select("hub", "doc", "family", "h", "weight", "far", F.explode("difference").alias("element")), "difference-elements")
    shared = elements.groupBy("hub", "element").agg(F.count("*").alias("n"), F.min("family").alias("least"), F.max("family").alias("most"))
    shared = stored(shared.where("least < most").select("hub", "element", "n"), "shared-elements")
    held = stored(elements.join(shared, ["hub", "element"]), "held-elements")
    counted = held.groupBy("hub", "doc", "h", "weight", "far").agg(F.count("*").alias("held"))
    limit = (100 - percent) * F.col("h")
    # The other one of a pair is far if this one isn't; and it is as light as the lightest candidate at best.
    first = F.when(F.col("far"), F.greatest(F.lit(1), _needed(percent, F.col("weight")))).otherwise(_needed(percent, F.col("weight"), limit + 1))
    possible = stored(counted.where(F.col("held") >= first), "possible-documents")
    lightest = stored(possible.groupBy("hub").agg(F.min("weight").alias("lightest"), F.count("*").alias("n")).where("n > 1").drop("n"), "lightest-documents")
    partner = F.when(F.col("far"), F.col("lightest")).otherwise(F.greatest(F.col("lightest"), limit + 1))
    needed = F.greatest(F.lit(1), _needed(percent, F.col("weight"), partner))
    possible = possible.join(lightest, "hub").withColumn("needed", needed).where("held >= needed").select("hub", "doc", F.col("held").alias("of"), "needed")
    rare_first = Window.partitionBy("hub", "doc").orderBy("n", "element")
    prefix = (
        held.join(stored(possible, "pair-candidates"), ["hub", "doc"])
        .withColumn("place", F.row_number().over(rare_first))
        .where("place <= of - needed + 1")
        .select("hub", "element", "doc", "family", "h", "weight", "far", (F.col("of") - F.col("place") + 1).alias("rest"))
    )
    prefix = stored(prefix, "rare-elements")
    a = prefix.where("far").select("hub", "element", "h", F.col("doc").alias("a"), F.col("family").alias("family_a"), F.col("weight").alias("weight_a"), F.col("rest").alias("rest_a"))
    b = prefix.select("hub", "element", F.col("doc").alias("b"), F.col("family").alias("family_b"), F.col("weight").alias("weight_b"), F.col("rest").alias("rest_b"), F.col("far").alias("far_b"))
    least = _needed(percent, F.col("weight_a"), F.col("weight_b"))
    meet = (
        (a.hub == b.hub)
        & (a.element == b.element)
        & (F.col("family_a") != F.col("family_b"))
        & (~F.col("far_b") | (F.col("a") < F.col("b")))
        & (F.least("rest_a", "rest_b") >= least)
    )
    pairs = a.join(b, meet).select(a.hub, "a", "b").distinct()
    one = apart.select("hub", F.col("doc").alias("a"), "h", F.col("weight").alias("weight_a"), F.col("difference").alias("difference_a"))
    other = apart.select("hub", F.col("doc").alias("b"), F.col("weight").alias("weight_b"), F.col("difference").alias("difference_b"))
    checked = pairs.join(one, ["hub", "a"]).join(other, ["hub", "b"])
    common = F.size(F.array_intersect("difference_a", "difference_b"))
    return checked.where(common * (100 + percent) >= F.col("weight_a") + F.col("weight_b") - limit).select("a", "b")


def _linked(docs: DataFrame, percent: int, repeated: bool, more: DataFrame | None = None) -> DataFrame:
    """doc_id, n_shingles, component (none of a row without doc_id). All rows of a doc_id have one text; repeated: some have several rows.
    more: further links a, b."""
    known = stored(sketches(docs, percent), "sketches")
    # One document stands for all with the same set.
    alike = stored(known.where(F.size("bands") > 0).groupBy("set_key").agg(F.min("doc_id").alias("doc")), "distinct-sets")
    standing = known.join(alike.withColumnRenamed("doc", "doc_id"), ["set_key", "doc_id"])
    band_rows = stored(standing.select(F.col("doc_id").alias("doc"), F.explode("bands").alias("key")).distinct(), "band-rows")
    members = stored(hub_members(band_rows), "hub-members")
    texts_of = docs.where("doc_id is not null")
    if repeated:
        texts_of = texts_of.dropDuplicates(["doc_id"])
    apart = stored(differences(members, texts_of, percent), "differences")
    with_hub = apart.where(F.col("weight") <= (100 - percent) * F.col("h")).select(F.col("hub").alias("a"), F.col("doc").alias("b"))
    found, in_families = families(apart, texts_of, percent)
    links = with_hub.unionByName(in_families).unionByName(near_pairs(apart, found, percent))
    if more is not None:
        # Links between rows that others may stand for.
        of = known.where("doc_id is not null").join(alike, "set_key", "left").select("doc_id", F.coalesce("doc", "doc_id").alias("doc")).distinct()
        of = stored(of, "standing-documents")
        both = more.join(of.toDF("a", "of_a"), "a").join(of.toDF("b", "of_b"), "b")
        links = links.unionByName(both.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    named = alike.join(components(links), "doc", "left").select("set_key", F.coalesce("component", "doc").alias("component"))
    return known.select("doc_id", "set_key", "n_shingles").join(stored(named, "component-names"), "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component")
    )


def near_duplicates(documents: DataFrame, *, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id = component_id), a row for each row.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets. Null and empty texts have no shingles
    and no links; they are kept. Rows that repeat a doc_id are one document, whatever their texts: it is linked with all that
    any of them is similar to, and all its rows are kept or none. A row without doc_id is kept, links with nothing and has no
    component. An empty table gives an empty one, other columns are ignored.
    """
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    on_texts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.min(own).alias("one"), F.max(own).alias("other"))
    repeated = stored(on_texts.where("n > 1").select("doc_id", (F.col("one") != F.col("other")).alias("several")), "repeated-ids")
    several = repeated.where("several").select("doc_id")
    if several.isEmpty():
        found = _linked(docs, percent, not repeated.isEmpty()).withColumnRenamed("component", "component_id")
    else:
        # Each of their texts goes by a number of its own, and these are linked.
        marked = docs.join(several.withColumn("several", F.lit(True)), "doc_id", "left")
        number = F.when(F.col("several"), F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.lit(8))).otherwise(F.col("doc_id"))
        rows = stored(marked.select("doc_id", number.alias("number"), "text"), "numbered-texts")
        numbers = stored(rows.select("doc_id", "number").distinct(), "numbers-of-documents")
        first = numbers.join(several, "doc_id").groupBy("doc_id").agg(F.min("number").alias("a"))
        more = stored(numbers.join(first, "doc_id").where("number <> a").select("a", F.col("number").alias("b")), "texts-of-one-document")
        linked = _linked(rows.select(F.col("number").alias("doc_id"), "text"), percent, True, more)
        linked = stored(linked.withColumnRenamed("doc_id", "number"), "linked-texts")
        per_row = numbers.join(linked.where("number is not null").dropDuplicates(["number"]), "number")
        least = stored(per_row.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least-documents")
        named = stored(per_row.join(least, "component").select("number", "n_shingles", "component_id"), "named-texts")
        found = rows.select("doc_id", "number").join(named, "number").drop("number")
        found = found.unionByName(linked.where("number is null").select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id")))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
