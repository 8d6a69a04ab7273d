"""The pipeline's stages against brute force on a small corpus, and how they join the query catalog."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from billscope.llm.catalog import ORACLE_SQL, QUERIES
from billscope.llm.mixing import poisson_cdf, source_rates
from tests.llm.helpers import DATA
from tests.llm.test_decontamination import brute_force as contaminated
from tests.llm.test_minhash import brute_force as groups
from tests.llm.test_mixing import drawn

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key int"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean, toxic, copied and contaminated documents, and odd rows, with the tables beside them."""
    rng = random.Random(8)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(prose(30))) for k in range(5)]
    rows, labels = [], []
    for k in range(400):
        text = prose(rng.randint(20, 80))
        if k % 7 == 0:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grotty", "vilex"]))
        elif k % 7 == 1 and rows:
            text = rows[rng.randrange(len(rows))][1].split()
            text[0] = "other" if len(text) > 70 else text[0]
        elif k % 20 == 2:
            text[5:5] = rng.choice(items)[1].split()
        if k % 2 == 0:
            labels.append((k, 1, int("grotty" in text or "vilex" in text)))
        rows.append((k, " ".join(text)))
    rows += [(900, None), (901, ""), (902, "word " * 30_000), (None, "text without a number"), (17, rows[17][1])]
    full = [(i, t, "en", f"s{(i or 0) % 3}" if i != 900 else None, len(t or ""), 1) for i, t in rows]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(full, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, full, items


def test_stages_against_brute_force(spark, corpus, tmp_path):
    folder, rows, items = corpus
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = read(name)
        found[name] = sorted((tuple(r) for r in docs.collect()), key=repr)
        if name != "token_files":
            assert docs.columns == COLUMNS.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    clean = [r for r in rows if not {"grotty", "vilex"} & set((r[1] or "").split())]
    assert found["toxicity"] == sorted(clean, key=repr)
    component = groups([r[:2] for r in clean if r[0] is not None])
    single = [r for r in clean if r[0] is None or component[r[0]][1] == r[0]]
    assert found["near_dedup"] == sorted(single, key=repr) and len(single) < len(clean) - 10
    apart = [r for r in single if r[0] is None or not any(contaminated(r[1] or "", text) for _, text in items)]
    assert found["decontamination"] == sorted(apart, key=repr) and len(apart) < len(single) - 5
    rates = {r.source: poisson_cdf(r.rate) for r in source_rates(spark.createDataFrame([(r[3] or "", r[1] or "") for r in apart], "source string, text string")).collect()}
    mixed = [r for r in apart for _ in range(drawn(r[0], r[1], rates[r[3] or ""]))]
    assert found["mixing"] == sorted(mixed, key=repr)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {id(r): [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in mixed}
    crc = lambda some: zlib.crc32(np.array(some, "<u4").tobytes())
    assert sorted((r[0], r[2], r[3]) for r in found["token_files"] if r[0] is not None) == sorted((r[0], len(ids[id(r)]), crc(ids[id(r)])) for r in mixed if r[0] is not None)
    written = sorted(found["token_files"], key=lambda r: r[1])
    assert [r[1] for r in written] == np.cumsum([0, *(r[2] for r in written[:-1])]).tolist()


def test_run_gives_what_the_stages_give(spark, corpus):
    folder, rows, _ = corpus
    assert 0 < corpus_pipeline.run(spark, folder).count() < 2 * len(rows)


def test_stages_take_empty_tables(spark, corpus):
    folder, _, _ = corpus
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_every_operator_is_registered():
    names = contract.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 11)] == [1] * 10
    assert names["pipeline"] is corpus_pipeline.run
    assert QUERIES.keys() <= names.keys() and ORACLE_SQL.keys() <= contract.oracle_sql().keys()
    assert (DATA / "sf0.01").exists()


def test_near_copies_from_four_fifths_on_are_dropped(spark, tmp_path):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(104)]  # 100 shingles
    ends = {n: base[:-n] + [f"x{n}x{k}" for k in range(n)] for n in (5, 9, 11, 12)}  # n shingles differ: (100 - n) / (100 + n)
    similar = {5: 95 / 105, 9: 91 / 109, 11: 89 / 111, 12: 88 / 112}
    rows = []
    for k, (n, text) in enumerate(ends.items()):
        own = {w: f"{w}of{k}" for w in base}  # pairs of their own words: no links between pairs
        rows += [(10 * k, " ".join(own[w] for w in base)), (10 * k + 1, " ".join(own.get(w, w) for w in text))]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1) for i, t in rows], COLUMNS)
    left = {r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, str(tmp_path)).collect()}
    assert left == {10 * k for k in range(4)} | {10 * k + 1 for k, n in enumerate(ends) if similar[n] < 0.8}
    assert [n for n in ends if 0.8 <= similar[n] < 0.85] == [9, 11]


def test_rows_without_doc_id_are_documents_of_their_own(spark, corpus):
    folder, rows, items = corpus
    clean = [" ".join(f"own{k}x{j}" for j in range(40)) for k in range(4)]
    leak = f"{clean[2]} {items[0][1]}"
    given = [(3, clean[0]), (None, clean[0]), (None, clean[1]), (None, clean[1] + " end"), (None, leak), (None, None), (None, None), (8, clean[3])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1) for i, t in given], COLUMNS)
    once = corpus_pipeline.without_near_copies(spark, docs, folder)
    left = [(r.doc_id, r.text) for r in once.collect()]
    assert once.columns == docs.columns and sorted(t or "" for _, t in left)[:2] == ["", ""]
    assert {x for x in left if x[1]} in ({(3, clean[0]), (8, clean[3]), (None, leak), (None, other)} for other in given_texts(clean[1]))
    apart = corpus_pipeline.without_benchmark(spark, docs, folder)
    assert sorted(((r.doc_id, r.text) for r in apart.collect()), key=repr) == sorted((x for x in given if x[1] != leak), key=repr)


def given_texts(text):
    return text, text + " end"
