"""Operator 9, edit-aware token counts: a segment tree of counts for each document; edits re-encode only what they touch.

Leaves are stretches of a text that start where a pre-token surely starts: at a space before a letter or digit. An edit
re-encodes the leaves it touches, and the one before if it touches such a start; sums change on the way to the root only.
"""

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.text import batches, texts
from billscope.llm.tokenizing import CachedTokenizer, cached_tokenizer

LEAF_CHARS = 256

_START = re.compile(r" (?=[^\W_])")

Edit = tuple[int, int, str]


def leaf_starts(text: str, leaf_chars: int = LEAF_CHARS, end: int | None = None) -> list[int]:
    """Where leaves start: 0, then the first sure start at least leaf_chars after the last, none of them beyond end."""
    starts, end = [0], len(text) if end is None else end
    while match := _START.search(text, starts[-1] + leaf_chars, max(end, 0)):
        starts.append(match.start())
    return starts


class CountTree:
    """Token counts of a text's leaves and their sums; sums[1] is the whole, the leaves are sums[size:].

    Made from a text, which is encoded, or from the starts and sums that an earlier tree of the same text left, where
    nothing is encoded. reencoded counts the characters that edits made it encode.
    """

    def __init__(self, tokenizer: CachedTokenizer, text: str, leaf_chars: int = LEAF_CHARS, *, starts: list[int] | None = None, sums: np.ndarray | None = None):
        self.tokenizer, self.text, self.leaf_chars, self.reencoded = tokenizer, text, leaf_chars, 0
        if starts and sums is not None and len(sums):
            self.starts, self.sums = list(starts), np.array(sums, np.int64)
            self.size = len(self.sums) // 2
        else:
            self.starts = self._cut(text, len(text))
            self._grow(self._counts([text[a:b] for a, b in zip(self.starts, [*self.starts[1:], len(text)], strict=True)]))

    def _cut(self, text: str, end: int) -> list[int]:
        return leaf_starts(text, self.leaf_chars, end) if self.tokenizer.by_parts else [0]

    def _counts(self, leaves: list[str]) -> list[int]:
        return [len(x) // self.tokenizer.dtype.itemsize for x in self.tokenizer.encode(leaves)]

    def _grow(self, counts: list[int]) -> None:
        """The tree over these counts; encodes nothing."""
        self.size = 1 << (len(counts) - 1).bit_length()
        self.sums = np.zeros(2 * self.size, np.int64)
        self.sums[self.size : self.size + len(counts)] = counts
        low = self.size
        while low > 1:
            low //= 2
            self.sums[low : 2 * low] = self.sums[2 * low : 4 * low].reshape(-1, 2).sum(axis=1)

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def _set(self, leaf: int, count: int) -> None:
        node = self.size + leaf
        change = count - self.sums[node]
        while change and node:
            self.sums[node] += change
            node >>= 1

    def _touched(self, edits: list[Edit]) -> list[tuple[int, int, list[Edit]]]:
        """Groups of leaves that edits touch, apart and in order: first leaf, last leaf, edits."""
        groups: list[tuple[int, int, list[Edit]]] = []
        for edit in edits:
            start, end, _ = edit
            first = bisect_right(self.starts, start) - 1
            # A start is a space and the character after it: the leaf before joins in if either may change.
            while first and start <= self.starts[first] + 1:
                first -= 1
            last = bisect_right(self.starts, max(start, end - 1)) - 1
            if last + 1 < len(self.starts) and end >= self.starts[last + 1]:
                last += 1
            if groups and first <= groups[-1][1]:
                before = groups.pop()
                first, last, edit_list = before[0], max(before[1], last), [*before[2], edit]
                groups.append((first, last, edit_list))
            else:
                groups.append((first, last, [edit]))
        return groups

    def apply(self, edits: list[Edit]) -> None:
        """Replaces text[start:end] by each edit's text; edits are sorted, apart, and count places in the text before.

        What a group of leaves now holds is cut into leaves again. They take the places of the old ones, of which some
        may stay empty; only where there are more of them is the tree laid out anew, from the counts that it has.
        """
        bounds, before = [*self.starts, len(self.text)], self.starts
        starts: list[int] = []
        parts: list[str] = []
        changed: list[tuple[int, int, list[str]]] = []  # first leaf, last leaf before, texts of the leaves now
        done = length = 0

        def keep(until: int) -> None:
            """Leaves from done to until stay as they are and move."""
            nonlocal length
            shift = length - bounds[done]
            starts.extend([x + shift for x in before[done:until]] if shift else before[done:until])
            parts.append(self.text[bounds[done] : bounds[until]])
            length += bounds[until] - bounds[done]

        for first, last, some in self._touched(edits):
            keep(first)
            pieces, at = [], bounds[first]
            for start, end, text in some:
                pieces += [self.text[at:start], text]
                at = end
            new = "".join([*pieces, self.text[at : bounds[last + 1]]])
            cuts = self._cut(new, len(new) - self.leaf_chars)
            cuts += [len(new)] * (last + 1 - first - len(cuts))
            starts += [length + x for x in cuts]
            parts.append(new)
            changed.append((first, last, [new[a:b] for a, b in zip(cuts, [*cuts[1:], len(new)], strict=True)]))
            length += len(new)
            self.reencoded += len(new)
            done = last + 1
        if not changed:
            return
        keep(len(before))
        counts = iter(self._counts([leaf for _, _, leaves in changed for leaf in leaves]))
        if len(starts) == len(before):
            for first, _, leaves in changed:
                for leaf in range(first, first + len(leaves)):
                    self._set(leaf, next(counts))
        else:
            laid: list[int] = []
            old, done = self.sums[self.size :].tolist(), 0
            for first, last, leaves in changed:
                laid += [*old[done:first], *(next(counts) for _ in leaves)]
                done = last + 1
            self._grow(laid + old[done : len(before)])
        self.text, self.starts = "".join(parts), starts


#: What a scrubbing step replaces: mail addresses, then long numbers such as telephone and card numbers.
SCRUBBED = ((re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "<EMAIL>"), (re.compile(r"\+?\d(?:[ .()-]?\d){6,}"), "<NUMBER>"))


def scrub_edits(text: str) -> list[Edit]:
    """Edits that take personal data out, apart and in order; of two that overlap the earlier one stays."""
    found = sorted((m.start(), m.end(), to) for pattern, to in SCRUBBED for m in pattern.finditer(text))
    kept: list[Edit] = []
    for edit in found:
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


_TREE = [("leaf_starts", pa.list_(pa.int64())), ("sums", pa.list_(pa.int64()))]
_KEPT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64()), *_TREE])
_AFTER = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), *((x, pa.int64()) for x in ("n_tokens", "n_edits", "n_tokens_after", "reencoded_chars")), *_TREE])


def _columns(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string"}
    return ", ".join(f"{field.name} {names.get(field.type, 'array<long>')}" for field in schema)


def token_trees(
    documents: DataFrame, tokenizer_path: str, *, leaf_chars: int = LEAF_CHARS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, text, n_tokens, leaf_starts, sums: the tree of each text, which recount takes, at once or from a stored table.

    Null texts are empty and have no tokens. Rows that repeat a doc_id have a tree each, a null doc_id stays null, an
    empty table gives an empty one, other columns are ignored.
    """
    docs = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def planted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = cached_tokenizer(tokenizer_path)

        def rows():
            for batch in parts:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                    tree = CountTree(tokenizer, text, leaf_chars)
                    yield doc_id, text, tree.total, tree.starts, tree.sums

        return batches(rows(), _KEPT)

    return docs.mapInArrow(planted, _columns(_KEPT))


def recount(trees: DataFrame, tokenizer_path: str, edits: DataFrame | None = None, *, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """doc_id, text (edited), n_tokens (before), n_edits, n_tokens_after, reencoded_chars, leaf_starts, sums.

    trees: rows of token_trees, or of an earlier recount; untouched leaves are never encoded. Rows without leaf_starts or
    sums are encoded whole first. edits: doc_id, start, end, replacement in code points of the text in trees; of
    overlapping ones the first by (start, end, replacement) stays, and ends beyond the text mean its end. Without edits,
    those of scrub_edits are made. Null texts are empty; null replacements too. Each row that repeats a doc_id gets that
    document's edits; edits without a document or place are left out. An empty table gives an empty one, other columns
    are ignored.
    """
    trees, given = trees.select("doc_id", "text", "leaf_starts", "sums"), edits is not None
    if edits is not None:
        one = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.coalesce("replacement", F.lit("")).alias("to"))
        placed = edits.where("doc_id is not null and start is not null and end is not null and start >= 0 and end >= start")
        gathered = placed.groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.sort_array(F.collect_list(one)).alias("edits"))
        trees = trees.join(gathered, F.col("doc_id") == F.col("of"), "left").drop("of")

    def wanted(found: list[dict] | None, text: str) -> list[Edit]:
        kept: list[Edit] = []
        for edit in found or []:
            if edit["start"] <= len(text) and (not kept or edit["start"] >= kept[-1][1]):
                kept.append((edit["start"], min(edit["end"], len(text)), edit["to"]))
        return kept

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = cached_tokenizer(tokenizer_path)

        def rows():
            for batch in parts:
                own = batch.column("edits").to_pylist() if given else [None] * batch.num_rows
                kept = (batch.column(x).to_pylist() for x in ("doc_id", "leaf_starts", "sums"))
                for doc_id, starts, sums, text, some in zip(*kept, texts(batch), own, strict=True):
                    tree = CountTree(tokenizer, text, leaf_chars, starts=starts, sums=sums)
                    before, changes = tree.total, wanted(some, text) if given else scrub_edits(text)
                    tree.apply(changes)
                    yield doc_id, tree.text, before, len(changes), tree.total, tree.reencoded, tree.starts, tree.sums

        return batches(rows(), _AFTER)

    return trees.mapInArrow(counted, _columns(_AFTER))


def count_after_edits(
    documents: DataFrame,
    tokenizer_path: str,
    edits: DataFrame | None = None,
    *,
    leaf_chars: int = LEAF_CHARS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """recount of the token_trees of documents, with the columns and the defined cases of both."""
    trees = token_trees(documents, tokenizer_path, leaf_chars=leaf_chars, id_column=id_column, text_column=text_column)
    return recount(trees, tokenizer_path, edits, leaf_chars=leaf_chars)
