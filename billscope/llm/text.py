"""Words, keys and hashes shared by the operators; plain functions over whole texts."""

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: The six ASCII white space characters that separate words and that line keys lose at both ends.
SPACES = " \t\n\x0b\x0c\r"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def ascii_lower(text: str) -> str:
    """A-Z lower-cased, every other character as it is."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def lower_words(text: str) -> list[bytes]:
    """UTF-8 words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split()


#: Every byte that is no digit, no letter and not part of a character beyond ASCII becomes a space; A-Z become a-z.
_WORD_BYTES = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else 0x20 for byte in range(256)
)


def plain_words(text: str) -> list[bytes]:
    """UTF-8 words of digits, ASCII letters in lower case and characters beyond ASCII."""
    return text.encode().translate(_WORD_BYTES).split()


class WordHashes(dict):
    """64-bit hash of a word, kept for words seen before; bounded."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit of the input moves every bit of the output."""
    hashes = hashes ^ (hashes >> np.uint64(31))
    hashes = hashes * np.uint64(0x7FB5D329728EA185)
    hashes = hashes ^ (hashes >> np.uint64(27))
    hashes = hashes * np.uint64(0x81DADEF4BC2DD44D)
    return hashes ^ (hashes >> np.uint64(33))


def window_hashes(words: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """One hash for each window: of the words at these offsets from its first word."""
    n = len(words) - offsets[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, len(offsets), np.uint64)
    for offset in offsets:
        total = mixed(total * _MIX + words[offset : offset + n])
    return total


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def release_memory() -> None:
    """Gives freed memory back to the system. Arrow and libc keep it otherwise, and a worker lives on through all later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def pieces(parts: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few, views of those that came: so many texts at a time become Python objects."""
    for batch in parts:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        release_memory()


def _weight(x: object) -> int:
    """Bytes in memory, about: a list's entries are objects of their own."""
    if isinstance(x, np.ndarray):
        return x.nbytes
    return 40 * len(x) if isinstance(x, list) else len(x) if isinstance(x, (str, bytes)) else 8


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of bounded bytes (strings, binaries, lists and arrays counted) and of 10,000 rows at most."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(map(_weight, row))
        if weight >= size or len(held) >= 10_000:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
