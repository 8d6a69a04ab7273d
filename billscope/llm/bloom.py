"""A pair of Bloom filters over a whole table: keys seen, and keys seen again.

Each key sets its bits inside one segment of 65,536 bits. Tasks emit the bits they set, segment by segment; bits of one
segment meet in one place, where a bit that two tasks set as "seen" counts as "seen again". No repeat is ever missed.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT_BITS = 1 << 16
BITS_OF_KEY = 4
BITS_FOR_KEY = 16
#: Keys that a task holds before it emits their bits.
KEYS_AT_ONCE = 1_000_000


def segments_for(n_keys: int, max_bytes: int) -> int:
    """16 bits a key, and never more than max_bytes: beyond that more keys pass as suspects, and none is lost."""
    wanted = -(-n_keys * BITS_FOR_KEY // SEGMENT_BITS)
    return max(1, min(wanted, max_bytes * 8 // SEGMENT_BITS))


def bit_positions(keys: np.ndarray, n_segments: int) -> np.ndarray:
    """The bits of each key, one row a key."""
    segment = ((keys >> np.uint64(32)) * np.uint64(n_segments)) >> np.uint64(32)
    first = keys & np.uint64(0xFFFF)
    step = ((keys >> np.uint64(16)) & np.uint64(0xFFFF)) | np.uint64(1)
    within = (first[:, None] + step[:, None] * np.arange(BITS_OF_KEY, dtype=np.uint64)) & np.uint64(0xFFFF)
    return (segment[:, None] << np.uint64(16)) | within


def contains(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a filter of packed bits may hold."""
    at = bit_positions(keys, len(bits) * 8 // SEGMENT_BITS)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


_PART = pa.schema([("segment", pa.int32()), ("seen", pa.binary()), ("again", pa.binary())])


def seen_bits(keys: Iterator[np.ndarray], n_segments: int) -> Iterator[pa.RecordBatch]:
    """Bits that the keys of one task set, by segment; keys come as arrays."""
    held, n = [], 0
    for some in keys:
        held.append(some)
        n += len(some)
        if n >= KEYS_AT_ONCE:
            yield from _part(np.concatenate(held), n_segments)
            held, n = [], 0
    if n:
        yield from _part(np.concatenate(held), n_segments)


def _part(keys: np.ndarray, n_segments: int) -> Iterator[pa.RecordBatch]:
    unique, counts = np.unique(keys, return_counts=True)
    seen = np.unique(bit_positions(unique, n_segments))
    again = np.unique(bit_positions(unique[counts > 1], n_segments))
    present = np.unique(seen >> np.uint64(16))
    rows = []
    for segment in present:
        low, high = segment << np.uint64(16), (segment + np.uint64(1)) << np.uint64(16)
        of = [x[np.searchsorted(x, low) : np.searchsorted(x, high)].astype("<u2").tobytes() for x in (seen, again)]
        rows.append((int(segment), *of))
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PART, strict=True)], schema=_PART)


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a segment from rows sorted by segment; holds one segment's bits at a time."""
    now, seen, again = None, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
    schema = pa.schema([("segment", pa.int32()), ("seen", pa.binary()), ("again", pa.binary())])

    def row():
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((now, *(np.packbits(x, bitorder="little").tobytes() for x in (seen, again))), schema, strict=True)], schema=schema)

    for batch in parts:
        for segment, a, b in zip(*(batch.column(k).to_pylist() for k in ("segment", "seen", "again")), strict=True):
            if segment != now:
                if now is not None:
                    yield row()
                now, seen[:], again[:] = segment, False, False
            at = np.frombuffer(a, "<u2")
            again[at[seen[at]]] = True
            seen[at] = True
            again[np.frombuffer(b, "<u2")] = True
    if now is not None:
        yield row()


def filter_pair(parts: DataFrame, n_segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The filters of all keys as packed bits; parts are rows (segment, seen, again) of seen_bits.

    What reaches the driver is n_segments rows of 16 KB at most, the size that segments_for has bounded.
    """
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merged, "segment int, seen binary, again binary")
    seen, again = (np.zeros(n_segments * SEGMENT_BITS // 8, np.uint8) for _ in range(2))
    for row in merged.select("segment", F.col("seen"), F.col("again")).collect():
        at = slice(row.segment * SEGMENT_BITS // 8, (row.segment + 1) * SEGMENT_BITS // 8)
        seen[at], again[at] = np.frombuffer(row.seen, np.uint8), np.frombuffer(row.again, np.uint8)
    return seen, again
