"""Byte-level BPE over whole texts, with the ids of words seen before kept."""

import gc
import json
import os
import re
import sys
from array import array
from functools import cached_property, lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402
from tokenizers.pre_tokenizers import ByteLevel  # noqa: E402

_SPACE = r"[ \t\n\x0b\x0c\r]"
_LETTER = "A-Za-zÀ-ÖØ-öø-ž"
_MARK = "!-/:-@\\[-`{-~¡«»¿\u2010-\u2027"
#: How byte-level pre-tokenizers cut, stated for these letters, digits, marks and white space only.
_PART = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+|{_SPACE}+(?!{_SPACE[:1]}^{_SPACE[1:]})|{_SPACE}+")
_LONGEST = 64


def _alphabet() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary, read off the library's own mapping of characters that have it."""
    whole = ByteLevel(add_prefix_space=False, use_regex=False)
    found = {}
    for code in (*range(0x800), *range(0x800, 0xD800, 0x400), *range(0xE000, 0x110000, 0x1000)):
        found.update(zip(chr(code).encode(), whole.pre_tokenize_str(chr(code))[0][0], strict=True))
    return found


class CachedTokenizer:
    """Ids of whole texts as little-endian bytes, equal to those of the tokenizer itself.

    A byte-level tokenizer encodes each pre-token by itself, so one that was encoded before needs no second encoding. Texts
    with characters beyond those that _PART covers or with a special token's string, and all texts of tokenizers of another
    kind, are encoded whole. The memory is bounded.
    """

    def __init__(self, path: str, end_id: int | None = None, limit: int = 200_000):
        self.path, self.of_parts = path, Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        before = stated.get("pre_tokenizer") or {}
        self.by_parts = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not stated.get("normalizer")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in stated["added_tokens"])
        )
        self.special = [t["content"] for t in stated["added_tokens"]]
        largest = max(self.of_parts.get_vocab(with_added_tokens=True).values())
        self.dtype = np.dtype("<u2" if max(largest, end_id or 0) < 1 << 16 else "<u4")
        assert sys.byteorder == "little"
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.alphabet = _alphabet()
        self.limit, self.known, self.before = limit, {}, {}

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """For texts that are encoded whole."""
        return Tokenizer.from_file(self.path)

    def _bytes(self, texts: list[str], tokenizer: Tokenizer) -> list[bytes]:
        found = []
        for at in range(0, len(texts), 2000):
            found += [array(self.code, x.ids).tobytes() for x in tokenizer.encode_batch_fast(texts[at : at + 2000], add_special_tokens=False)]
        return found

    def _parts(self, words: list[str]) -> list[bytes]:
        """The ids of pre-tokens, by the model alone: nothing else is left to do for a word that is cut and holds no special token."""
        tokenize, alphabet, found = self.of_parts.model.tokenize, self.alphabet, []
        for word in words:
            letters = (word if word.isascii() else word.encode().decode("latin-1")).translate(alphabet)
            found.append(array(self.code, [token.id for token in tokenize(letters)]).tobytes())
        return found

    def _split(self, text: str) -> list[str] | None:
        """The pre-tokens of a text; None where it is to be encoded whole."""
        if any(x in text for x in self.special):
            return None
        parts = _PART.findall(text)
        return parts if "".join(parts) == text else None

    def forget(self) -> None:
        """Lets go of the pre-tokens encoded before."""
        self.known, self.before = {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, in order."""
        if not self.by_parts:
            return self._bytes(texts, self.tokenizer)
        collecting = gc.isenabled()
        gc.disable()  # millions of strings in lists and no cycle among them: walking through them finds nothing
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:  # what is still in use moves over from the generation before
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        split = [self._split(text) for text in texts]
        wanted = set().union(*(x for x in split if x))
        new = [x for x in wanted if x not in known]
        known.update([(x, before[x]) for x in new if x in before])
        new = [x for x in new if x not in before]
        ids = dict(zip(new, self._parts(new), strict=True))
        short = all(len(x) <= _LONGEST for x in new)
        known.update(ids if short else {x: y for x, y in ids.items() if len(x) <= _LONGEST})
        lookup = (known if short else known | ids).__getitem__
        rest = [text for text, one in zip(texts, split, strict=True) if one is None]
        whole = iter(self._bytes(rest, self.tokenizer) if rest else [])
        return [next(whole) if one is None else b"".join(map(lookup, one)) for one in split]


@lru_cache(maxsize=2)
def cached_tokenizer(path: str, end_id: int | None = None) -> CachedTokenizer:
    """One for each Python worker. Its tasks share what they have encoded until one calls forget."""
    return CachedTokenizer(path, end_id)
