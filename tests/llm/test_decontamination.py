import random

import numpy as np

from billscope.llm.decontamination import MIN_WORDS, find_contamination, longest_similar, seeds
from billscope.llm.text import plain_words


def brute_force(doc, item, min_words=MIN_WORDS, similarity=0.8):
    """Whether any diagonal holds a long enough stretch with enough equal words."""
    d, t = plain_words(doc), plain_words(item)
    needed = min(min_words, max(min(5, len(t)), -(-len(t) * 4 // 5)))
    for shift in range(-len(t) + 1, len(d)):
        equal = [0 <= j + shift < len(d) and d[j + shift] == t[j] for j in range(len(t))]
        for a in range(len(t)):
            for b in range(a + needed, len(t) + 1):
                if equal[a] and equal[b - 1] and sum(equal[a:b]) >= similarity * (b - a) - 1e-9:
                    return True
    return False


def test_longest_similar_against_all_stretches():
    rng = np.random.default_rng(1)
    for _ in range(300):
        equal = rng.random(rng.integers(0, 25)) < rng.choice([0.2, 0.6, 0.85])
        a, b = longest_similar(equal, 0.8)
        lengths = [y - x for x in range(len(equal)) for y in range(x + 1, len(equal) + 1) if equal[x] and equal[y - 1] and equal[x:y].sum() >= 0.8 * (y - x) - 1e-9]
        assert b - a == max(lengths, default=0)
        assert not lengths or (equal[a] and equal[b - 1])


def test_a_substitution_at_an_ignored_place_keeps_the_seed():
    words = np.arange(1, 10, dtype=np.uint64)
    other = words.copy()
    other[3] = 99
    masks = ((0, 1, 2, 4, 5),)
    assert seeds(words, masks)[0][0] == seeds(other, masks)[0][0]
    assert seeds(words, masks)[0][1] != seeds(other, masks)[0][1]


def test_planted_passages_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["the", "of"] * 5
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(prose(rng.randint(1, 4) if k % 4 == 0 else rng.randint(5, 40)))) for k in range(16)]
    documents = []
    for k in range(80):
        words = prose(rng.randint(0, 60))
        if k % 2:
            passage = rng.choice(items)[1].split()
            passage = passage[rng.randint(0, len(passage) // 3) :]
            for _ in range(rng.randint(0, len(passage) // 4 + 1)):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = passage
        text = " ".join(words)
        documents.append((k, text.upper() + "!" if k % 5 == 0 else text.replace(" ", ", ")))
    found = find_contamination(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(d, i) for d, text in documents for i, item in items if brute_force(text, item)}
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert len(want) > 10 and any(len(items[i][1].split()) < 5 for _, i in want)
    texts, wording = dict(documents), dict(items)
    for r in found:
        a, b = plain_words(texts[r.doc_id])[r.doc_start :][: r.n_words], plain_words(wording[r.item_id])[r.item_start :][: r.n_words]
        assert sum(x == y for x, y in zip(a, b, strict=True)) == r.n_equal >= 0.8 * r.n_words


def test_odd_rows(spark):
    item = " ".join(f"w{k}" for k in range(20))
    docs = [(1, item, 0), (1, item, 0), (2, None, 0), (3, "", 0), (None, item, 0), (4, item + " tail " * 30_000, 0)]
    documents = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, "short"), (None, item)], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.n_words) for r in find_contamination(documents, benchmark).collect()}
    assert found == {(1, 7, 20), (4, 7, 20)}
    assert find_contamination(documents.limit(0), benchmark).count() == 0
    assert find_contamination(documents, benchmark.limit(0)).count() == 0
