"""Operator 5, license scan: ordered signature rules behind a keyword prefilter; priority and containment settle overlaps.

A text is reduced to its words (ASCII lower-cased; digits, letters and every character beyond ASCII) with one space between
them. One pass of an Aho-Corasick automaton finds the keywords that occur; only rules with such a keyword run.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.license_signatures import PRIORITY, SIGNATURES, SPDX, keyword
from billscope.llm.text import batches, plain_words, texts

#: The phrases every scan reports with all their places, and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

@dataclass(frozen=True)
class Rule:
    """pattern runs over normalised text; keyword is a word or phrase that every match holds. Higher priorities win."""

    name: str
    label: str
    priority: int
    keyword: str
    pattern: str


#: One line a licence: label, then how texts name it, in normalised words. Longer names stand first within a label.
LICENCES = {
    "mit": ("mit license", "mit licence", "expat license"),
    "mit-0": ("mit no attribution license", "mit no attribution"),
    "x11": ("x11 license", "mit x11 license"),
    "apache-1.1": ("apache software license version 1 1", "apache license 1 1"),
    "apache-2.0": ("apache license version 2 0", "apache software license version 2 0", "apache license v2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"),
    "bsd-2-clause": ("bsd 2 clause license", "2 clause bsd license", "two clause bsd license", "simplified bsd license", "freebsd license"),
    "bsd-3-clause": ("bsd 3 clause license", "3 clause bsd license", "three clause bsd license", "new bsd license", "modified bsd license", "revised bsd license"),
    "bsd-4-clause": ("bsd 4 clause license", "4 clause bsd license", "original bsd license"),
    "0bsd": ("zero clause bsd license", "bsd zero clause license", "0bsd license"),
    "bsd": ("bsd style license", "bsd license"),
    "isc": ("isc license", "internet systems consortium license"),
    "gpl-2.0": ("gnu general public license version 2", "gnu general public license v2", "gnu gpl version 2", "gnu gpl v2", "gpl version 2", "gplv2", "gpl 2 0"),
    "gpl-3.0": ("gnu general public license version 3", "gnu general public license v3", "gnu gpl version 3", "gnu gpl v3", "gpl version 3", "gplv3", "gpl 3 0"),
    "gpl-any": ("gnu general public license", "gnu gpl"),
    "lgpl-2.1": ("gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgpl version 2 1", "lgpl v2 1", "lgpl 2 1"),
    "lgpl-3.0": ("gnu lesser general public license version 3", "gnu lesser general public license v3", "lgpl version 3", "lgplv3", "lgpl 3 0"),
    "lgpl-any": ("gnu lesser general public license", "gnu library general public license", "gnu lgpl"),
    "agpl-3.0": ("gnu affero general public license version 3", "gnu affero general public license v3", "agpl version 3", "agplv3", "agpl 3 0"),
    "agpl-any": ("gnu affero general public license", "affero general public license", "gnu agpl"),
    "gfdl": ("gnu free documentation license", "gfdl"),
    "mpl-1.1": ("mozilla public license version 1 1", "mozilla public license 1 1", "mpl 1 1"),
    "mpl-2.0": ("mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"),
    "mpl-any": ("mozilla public license",),
    "epl-1.0": ("eclipse public license version 1 0", "eclipse public license 1 0", "epl 1 0"),
    "epl-2.0": ("eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"),
    "epl-any": ("eclipse public license",),
    "cddl": ("common development and distribution license", "cddl license"),
    "cpl": ("common public license",),
    "eupl": ("european union public licence", "european union public license", "eupl"),
    "artistic-2.0": ("artistic license 2 0", "artistic license version 2 0"),
    "artistic": ("artistic license", "perl artistic license"),
    "boost": ("boost software license version 1 0", "boost software license"),
    "zlib": ("zlib libpng license", "zlib license"),
    "unlicense": ("the unlicense", "unlicense org"),
    "wtfpl": ("do what the fuck you want to public license", "wtfpl"),
    "cc0": ("creative commons zero", "cc0 1 0 universal", "cc0 public domain dedication", "cc0"),
    "cc-by-nc-nd": ("creative commons attribution noncommercial noderivatives", "cc by nc nd"),
    "cc-by-nc-sa": ("creative commons attribution noncommercial sharealike", "cc by nc sa"),
    "cc-by-nc": ("creative commons attribution noncommercial", "creative commons attribution non commercial", "cc by nc"),
    "cc-by-nd": ("creative commons attribution noderivatives", "creative commons attribution noderivs", "cc by nd"),
    "cc-by-sa": ("creative commons attribution sharealike", "creative commons attribution share alike", "cc by sa"),
    "cc-by-4.0": ("creative commons attribution 4 0", "cc by 4 0"),
    "cc-by-any": ("creative commons attribution", "cc by"),
    "cc-any": ("creative commons license", "creative commons licence"),
    "odbl": ("open database license", "open data commons open database license", "odbl"),
    "odc-by": ("open data commons attribution license", "odc by"),
    "pddl": ("public domain dedication and license", "pddl"),
    "ogl-uk": ("open government licence",),
    "ofl": ("sil open font license", "open font license", "ofl 1 1"),
    "psf": ("python software foundation license", "psf license"),
    "php": ("php license",),
    "ruby": ("ruby license",),
    "openssl": ("openssl license",),
    "postgresql": ("postgresql license",),
    "ncsa": ("university of illinois ncsa open source license", "ncsa license"),
    "ms-pl": ("microsoft public license", "ms pl"),
    "ms-rl": ("microsoft reciprocal license", "ms rl"),
    "sspl": ("server side public license", "sspl"),
    "busl": ("business source license", "busl 1 1"),
    "elastic": ("elastic license 2 0", "elastic license"),
    "polyform": ("polyform noncommercial license", "polyform small business license", "polyform shield license"),
    "afl": ("academic free license",),
    "osl": ("open software license",),
    "rail": ("creativeml open rail m", "bigscience openrail m license", "openrail"),
    "public-domain": ("public domain",),
}

#: Templates around a licence's name, strongest first: (kind, pattern, priority).
TEMPLATES = (
    ("declared", r"(?:licensed|released|distributed|published|available|provided|covered|governed)(?: \S+){{0,2}} under (?:the )?(?:terms of (?:the )?)?{name}", 90),
    ("conditions", r"(?:terms|conditions|provisions) of (?:the )?{name}", 85),
    ("tagged", r"(?:spdx license identifier|license|licence) {name}", 80),
    ("mentioned", r"{name}", 50),
)

#: Wording of licences and notices that names none: (label, keyword, pattern, priority).
WORDINGS = (
    ("mit", "permission is hereby granted free of charge", r"permission is hereby granted free of charge to any person obtaining a copy", 95),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose", 95),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted", 95),
    ("apache-2.0", "apache org licenses", r"apache org licenses license 2 0", 95),
    ("gpl-any", "redistribute it and or modify", r"you can redistribute it and or modify it under the terms of the gnu general public license", 95),
    ("gpl-or-later", "any later version", r"either version \d(?: \d)? of the license or at your option any later version", 70),
    ("reserved", "all rights reserved", r"all rights reserved", 60),
    ("reserved", "rights are reserved", r"all (?:other )?rights are reserved", 60),
    ("some-rights", "some rights reserved", r"some rights reserved", 60),
    ("copyright", "copyright", r"copyright(?: c)? (?:19|20)\d\d", 40),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential", 75),
    ("proprietary", "unauthorized copying", r"unauthorized copying of this (?:file|document|material)", 75),
    ("no-reproduction", "may be reproduced", r"no part of this \S+ may be reproduced", 75),
    ("as-is", "without warranty", r"without warranty of any kind", 30),
    ("trademark", "registered trademark", r"registered trademarks? of", 20),
    ("public-domain", "dedicated to the public domain", r"dedicated to the public domain", 90),
    ("cc-any", "creativecommons org", r"creativecommons org (?:licenses|publicdomain)", 80),
)


def signature_rules() -> tuple[Rule, ...]:
    """All rules in their order: by priority, then by the length of name or keyword, so that the most specific one is first."""
    named = [
        Rule(f"{label}:{kind}:{name}", label, priority, name, template.format(name=re.escape(name).replace(r"\ ", " ")))
        for label, names in LICENCES.items()
        for name in names
        for kind, template, priority in TEMPLATES
    ]
    worded = [Rule(f"{label}:wording:{keyword}", label, priority, keyword, pattern) for label, keyword, pattern, priority in WORDINGS]
    signed = [
        Rule(f"{label}:{kind}:{pattern}", label, PRIORITY[kind], keyword(pattern), pattern)
        for kind, signatures in SIGNATURES.items()
        for label, pattern in signatures
    ]
    listed = [
        Rule(f"{label}:spdx:{identifier}", label, PRIORITY["spdx"], f"identifier {identifier}", f"spdx license identifier {identifier}")
        for label, identifiers in SPDX.items()
        for identifier in identifiers
    ]
    return tuple(sorted(named + worded + signed + listed, key=lambda rule: (-rule.priority, -len(rule.keyword), rule.name)))


def normalised(text: str) -> str:
    """Words with a space between them and at both ends."""
    words = plain_words(text)
    return f" {b' '.join(words).decode()} " if words else " "


class Scanner:
    """Rules compiled once for each Python worker."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(rule, re.compile(rf"(?<= ){rule.pattern}(?= )")) for rule in rules]
        by_keyword: dict[str, list[int]] = {}
        for k, rule in enumerate(rules):
            by_keyword.setdefault(f" {rule.keyword} ", []).append(k)
        self.automaton = ahocorasick.Automaton()
        for keyword, which in by_keyword.items():
            self.automaton.add_word(keyword, tuple(which))
        self.automaton.make_automaton()

    def detections(self, text: str) -> list[tuple[str, str, int, int, int]]:
        """(rule, label, priority, first word, words) that overlaps leave, in text order; text is normalised.

        Rules take their matches in order. A match whose words lie inside one taken before it is suppressed, so a name
        inside a declaration counts once, under the more specific rule.
        """
        wanted = {k for _, which in self.automaton.iter(text) for k in which}
        taken: list[tuple[int, int, Rule]] = []
        covered = _Intervals()
        for k in sorted(wanted):
            rule, pattern = self.rules[k]
            for match in pattern.finditer(text):
                if covered.add(*match.span()):
                    taken.append((*match.span(), rule))
        taken.sort(key=lambda x: x[:2])
        starts, ends = (_spaces_before(text, [x[side] for x in taken]) for side in (0, 1))
        return [(rule.name, rule.label, rule.priority, a - 1, b - a + 1) for (_, _, rule), a, b in zip(taken, starts, ends, strict=True)]


class _Intervals:
    """The intervals that lie in no other one, in order: their starts rise, and so do their ends."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, start: int, end: int) -> bool:
        """False if an interval added before holds this one."""
        at = bisect_right(self.starts, start)
        if at and self.ends[at - 1] >= end:
            return False
        low, high = bisect_left(self.starts, start), bisect_right(self.ends, end)
        self.starts[low:high], self.ends[low:high] = [start], [end]  # in place of those that it holds
        return True


def _spaces_before(text: str, places: list[int]) -> list[int]:
    """How many spaces stand before each place, the text read once."""
    if not places:
        return []
    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
    return np.searchsorted(spaces, places).tolist()


def base_places(text: str, phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a phrase in normalised text."""
    found = []
    for phrase, label in phrases.items():
        at = text.find(f" {phrase} ")
        while at >= 0:
            found.append((at, label))
            at = text.find(f" {phrase} ", at + 1)
    words = _spaces_before(text, [at for at, _ in found])
    return sorted((word, label) for word, (_, label) in zip(words, found, strict=True))


@lru_cache(maxsize=2)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


_DETECTION = pa.struct([("rule", pa.string()), ("label", pa.string()), ("priority", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64())])
_PLACE = pa.struct([("first_word", pa.int64()), ("label", pa.string())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(_PLACE)), ("detections", pa.list_(_DETECTION))])


def scan_licenses(
    documents: DataFrame,
    rules: tuple[Rule, ...] | None = None,
    phrases: dict[str, str] = BASE_PHRASES,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_words, places (of base phrases: first_word, label), detections (rule, label, priority, first_word, n_words).

    One row for each row of documents, so repeated rows repeat. Null and empty texts have no words, no places and no
    detections. An empty table gives an empty one; a null doc_id stays null; other columns are ignored. Rules of equal
    priority and length of name stand in order of their names.
    """
    rules = rules or signature_rules()

    def scanned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, keys = _scanner(rules), [f.name for f in _DETECTION]

        def rows():
            for batch in parts:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                    words = normalised(text)
                    places = [{"first_word": at, "label": label} for at, label in base_places(words, phrases)]
                    detections = [dict(zip(keys, found, strict=True)) for found in scanner.detections(words)]
                    yield doc_id, words.count(" ") - 1, places, detections

        return batches(rows(), _RESULT)

    columns = (
        "doc_id long, n_words long, places array<struct<first_word:long,label:string>>, "
        "detections array<struct<rule:string,label:string,priority:int,first_word:long,n_words:long>>"
    )
    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(scanned, columns)
