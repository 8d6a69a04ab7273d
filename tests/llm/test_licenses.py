import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from billscope.llm.catalog import op5_license_scan
from billscope.llm.license_signatures import PRIORITY, SIGNATURES, SPDX, keyword
from billscope.llm.licenses import BASE_PHRASES, Scanner, _Intervals, base_places, normalised, scan_licenses, signature_rules
from tests.llm.helpers import DATA, SCHEMA, planted_documents


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def places(text):
    words = words_of(text)
    return sorted((k, label) for phrase, label in BASE_PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())


SCANNER = Scanner(signature_rules())


def labels(text):
    return [x[1] for x in SCANNER.detections(normalised(text))]


def test_hundreds_of_rules():
    rules = signature_rules()
    assert len(rules) > 300 and len({r.name for r in rules}) == len(rules)
    assert [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)


def test_every_rule_needs_its_keyword():
    """A rule's own name is found by it or by one before it, so the keyword gate closes no rule off."""
    scanner = Scanner(signature_rules())
    for rule in signature_rules():
        if ":mentioned:" in rule.name:
            assert scanner.detections(f" {rule.keyword} "), rule


SIGNED = [(kind, label, pattern) for kind, some in SIGNATURES.items() for label, pattern in some]


def test_signatures_are_hundreds_and_each_has_a_keyword():
    assert len(SIGNED) > 250 and len({x[2] for x in SIGNED}) == len(SIGNED)
    assert set(SIGNATURES) | {"spdx"} == set(PRIORITY)
    for _, _, pattern in SIGNED:
        assert len(keyword(pattern).split()) >= 2 and normalised(keyword(pattern)) == f" {keyword(pattern)} ", pattern
    assert keyword("with reserved font names?") == "with reserved font"
    assert keyword("used by(?: kind)? permission") == "used by" and keyword("no rights reserved") == "no rights reserved"
    assert keyword("by share ?alike") == "by" and keyword("a b? c") == "a"
    assert keyword("eclipse org legal epl (?:v10|v20)") == "eclipse org legal epl"


@pytest.mark.parametrize("kind", SIGNATURES)
@settings(max_examples=200, deadline=None)
@given(st.data())
def test_every_match_of_a_signature_passes_its_keyword(kind, data):
    """Texts drawn from the pattern itself: its keyword stands in them as whole words, and a rule at least as strong covers them."""
    _, pattern = data.draw(st.sampled_from(SIGNATURES[kind]))
    words = data.draw(st.from_regex(pattern.replace(r"\S+", "[a-z0-9]{1,5}"), fullmatch=True, alphabet=st.characters(max_codepoint=0x17F)))
    assert f" {keyword(pattern)} " in f" {words} "
    found = SCANNER.detections(f" before {words} after ")
    assert any(priority >= PRIORITY[kind] and first <= 1 and first + n >= 1 + len(words.split()) for _, _, priority, first, n in found), words


def test_spdx_identifiers():
    for label, identifiers in SPDX.items():
        for identifier in identifiers:
            text = f"// SPDX-License-Identifier: {identifier.replace(' ', '-')}\nint main() {{}}"
            assert labels(text) == [label], identifier
    assert labels("SPDX-License-Identifier: GPL-2.0-or-later") == ["gpl-or-later"]
    assert labels("an identifier mit der Zahl") == []


#: Passages as licences and notices print them, and a label that each must get.
PASSAGES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\""),
    ("bsd", " * 1. Redistributions of source code must retain the above copyright\n *    notice"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-3-clause", "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-any", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY"),
    ("lgpl-any", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0", "To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to this work."),
    ("cc-by-nc-sa", "see https://creativecommons.org/licenses/by-nc-sa/4.0/"),
    ("cc-by-4.0", "(http://creativecommons.org/licenses/by/4.0/)"),
    ("cc-any", "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung 4.0 International Lizenz."),
    ("reserved", "© 2019 Editorial X. Todos los derechos reservados."),
    ("no-reproduction", "This material may not be published, broadcast, rewritten. It may not be reproduced in any form without prior written permission."),
    ("no-training", "This text may not be used for training artificial intelligence systems."),
    ("eula", "This End-User License Agreement is a legal agreement"),
    ("us-government", "This article is a work of the United States Government."),
    ("odbl", "https://opendatacommons.org/licenses/odbl/1-0/"),
    ("ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
]


@pytest.mark.parametrize(("label", "passage"), PASSAGES)
def test_passages(label, passage):
    assert label in labels(passage)


def test_plain_prose_has_no_detection():
    assert labels("The court granted permission to build a bridge; everyone is free to copy the plan, and the author thanked the public.") == []


def test_the_more_specific_detection_suppresses_those_inside():
    assert labels("Licensed under the GNU General Public License, version 3.") == ["gpl-3.0"]
    assert labels("GNU General Public License") == ["gpl-any"]
    assert labels("Licensed under CC BY-NC 4.0; all rights reserved") == ["cc-by-nc", "reserved"]
    assert labels("MIT License and Apache License, Version 2.0") == ["mit", "apache-2.0"]
    assert labels("Permission is hereby granted, free of charge, to any person obtaining a copy") == ["mit"]
    assert labels("the mitten licence") == labels("") == []


def test_detections_give_their_words():
    text = normalised("x y Released under the MIT License. z")
    assert Scanner(signature_rules()).detections(text)[0][3:] == (2, 5)


def test_base_places_against_brute_force():
    for text in ("cc by cc by CC-BY", "All rights reserved all rights, reserved", "general public license general public licenses", "écc by", "", "cc", "cc  by x"):
        assert base_places(normalised(text), BASE_PHRASES) == places(text)


def test_odd_rows(spark):
    rows = planted_documents() + [(20, "CC BY " * 30_000, "s", 0, 0, "x", None)]
    found = scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.n_words, len(r.places)) for r in found) == sorted((r[0] or -1, len(words_of(r[1])), len(places(r[1]))) for r in rows)
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark):
    sf = str(DATA / "sf0.001")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_license_scan(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        at = places(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (len(words_of(texts[r.doc_id])), len(at))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_intervals_inside_others_are_refused():
    for seed in range(200):
        draw, kept, intervals = random.Random(seed), [], _Intervals()
        for _ in range(30):
            start = draw.randrange(20)
            one = (start, start + draw.randrange(1, 9))
            inside = any(a <= one[0] and one[1] <= b for a, b in kept)
            assert intervals.add(*one) == (not inside)
            if not inside:
                kept.append(one)
        assert intervals.starts == sorted(intervals.starts) and intervals.ends == sorted(intervals.ends)


def test_time_grows_with_the_text():
    """Forty thousand hits in one text: seconds, where each hit tested against all others takes a minute."""
    text, scanner = normalised("cc by licensed under the mit license é " * 40_000), Scanner(signature_rules())
    began = time.process_time()
    assert len(base_places(text, BASE_PHRASES)) == 40_000
    found = scanner.detections(text)
    assert time.process_time() - began < 20
    some = scanner.detections(normalised("cc by licensed under the mit license é " * 40))
    assert len(found) == 1000 * len(some) > 0 and found[: len(some) - 5] == some[:-5]
