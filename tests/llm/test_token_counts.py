import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from billscope.llm.catalog import op9_token_counts
from billscope.llm.token_counts import SCRUBBED, CountTree, count_after_edits, leaf_starts, recount, scrub_edits, token_trees
from billscope.llm.tokenizing import CachedTokenizer
from tests.llm.helpers import DATA

PATH = public_tokenizers.path("byte_bpe_50k.json")
OURS, THEIRS = CachedTokenizer(PATH), Tokenizer.from_file(PATH)

PIECES = ["word ", " the", "  ", "\n", " a", "b", "'s", ". ", "é", "12", " <|endoftext|>", "<|endo", "ftext|>", ""]
text = st.lists(st.sampled_from(PIECES), max_size=40).map("".join)


def n_tokens(some):
    return len(THEIRS.encode(some, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_edits_one_after_another_keep_the_count_right(data):
    whole = data.draw(text)
    tree = CountTree(OURS, whole, leaf_chars=5)
    assert tree.total == n_tokens(whole)
    for _ in range(data.draw(st.integers(0, 3))):
        at = sorted(data.draw(st.lists(st.integers(0, len(whole)), min_size=2, max_size=6)))
        edits = [(a, b, data.draw(text.map(lambda x: x[:9]))) for a, b in zip(at[::2], at[1::2], strict=False)]
        edits = [e for k, e in enumerate(edits) if k == 0 or e[0] >= edits[k - 1][1]]
        tree.apply(edits)
        for a, b, new in reversed(edits):
            whole = whole[:a] + new + whole[b:]
        assert tree.text == whole
        assert tree.total == n_tokens(whole)
        assert tree.starts == sorted(tree.starts)
        # What a table keeps of the tree is enough to go on from.
        tree = CountTree(OURS, tree.text, 5, starts=tree.starts, sums=tree.sums)
        assert tree.total == n_tokens(whole)
        bounds = [*tree.starts, len(whole)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            assert tree.sums[tree.size + k] == n_tokens(whole[a:b])


def test_an_edit_in_a_long_text_re_encodes_little():
    tree = CountTree(OURS, "some words of a long text " * 5000)
    tree.apply([(60_000, 60_004, "other")])
    assert tree.total == n_tokens(tree.text)
    assert tree.reencoded < 1000


def test_scrubbed_documents(spark):
    rows = [(1, "write to a.b@c.org or 555-123-4567 now", "x"), (2, None, "y"), (3, "", None), (None, "no edits here", "z"), (1, "same id, 12345678", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sums string")
    found = {(r.doc_id, r.text): r for r in count_after_edits(docs, PATH).collect()}
    assert len(found) == 5
    first = found[1, "write to <EMAIL> or <NUMBER> now"]
    assert (first.n_edits, first.n_tokens, first.n_tokens_after) == (2, n_tokens(rows[0][1]), n_tokens(first.text))
    assert found[2, ""].n_tokens == found[3, ""].n_tokens_after == 0
    assert found[None, "no edits here"].n_edits == 0
    assert count_after_edits(docs.limit(0), PATH).count() == 0


def test_given_edits(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four"), (3, None)], "doc_id long, text string")
    edits = spark.createDataFrame(
        [(1, 4, 7, "2"), (1, 5, 9, "lost"), (2, 0, 99, None), (3, 0, 0, "new"), (None, 0, 1, "x"), (9, 0, 1, "x"), (1, None, 2, "x"), (2, 50, 60, "x")],
        "doc_id long, start long, end long, replacement string",
    )
    found = {r.doc_id: r for r in count_after_edits(docs, PATH, edits).collect()}
    assert {k: v.text for k, v in found.items()} == {1: "one 2 three", 2: "", 3: "new"}
    assert all(r.n_tokens_after == n_tokens(r.text) for r in found.values())


def test_scrub_edits_are_apart_and_in_order():
    edits = scrub_edits("a@b.co 1234567890 x@y.org")
    assert [e[2] for e in edits] == ["<EMAIL>", "<NUMBER>", "<EMAIL>"]


class Counting:
    """A tokenizer that notes how many characters it encodes."""

    def __init__(self):
        self.by_parts, self.dtype, self.chars = OURS.by_parts, OURS.dtype, 0

    def encode(self, leaves):
        self.chars += sum(map(len, leaves))
        return OURS.encode(leaves)


def test_a_kept_tree_encodes_touched_leaves_only():
    text, counting = "some words of a long text " * 5000, Counting()
    kept = CountTree(OURS, text)
    tree = CountTree(counting, text, starts=kept.starts, sums=kept.sums)
    assert counting.chars == 0
    tree.apply([])
    assert counting.chars == 0 and tree.starts == kept.starts
    tree.apply([(10, 14, "other"), (60_000, 60_004, "x")])
    assert counting.chars == tree.reencoded < 1500
    assert tree.total == n_tokens(tree.text)


def test_leaves_that_grew_are_cut_again():
    tree = CountTree(OURS, "some words of a long text " * 200)
    tree.apply([(1000, 1000, " and many more words" * 500)])
    bounds = [*tree.starts, len(tree.text)]
    assert max(b - a for a, b in zip(bounds, bounds[1:], strict=False)) < 600
    assert tree.total == n_tokens(tree.text)
    before = tree.reencoded
    tree.apply([(5000, 5001, "y")])
    assert tree.reencoded - before < 1200 and tree.total == n_tokens(tree.text)


def test_rounds_of_edits_on_stored_trees(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two three " * 100), (1, "repeated"), (2, None), (None, "no id")], "doc_id long, text string")
    token_trees(docs, PATH, leaf_chars=20).write.parquet(str(tmp_path / "trees"))
    trees = spark.read.parquet(str(tmp_path / "trees"))
    edits = spark.createDataFrame([(1, 4, 7, "2"), (2, 0, 0, "new")], "doc_id long, start long, end long, replacement string")
    first = recount(trees, PATH, edits, leaf_chars=20)
    first.write.parquet(str(tmp_path / "first"))
    again = recount(spark.read.parquet(str(tmp_path / "first")), PATH, edits, leaf_chars=20).collect()
    assert {r.text for r in again} == {"one 2hree " + "one two three " * 99, "repe2", "newnew", "no id"}
    assert all(r.n_tokens_after == n_tokens(r.text) and r.reencoded_chars <= 80 for r in again)
    bare = trees.select("doc_id", "text", *(trees[x].cast("array<long>").alias(x) for x in ("leaf_starts", "sums"))).limit(0)
    assert recount(bare, PATH).count() == 0
    unknown = docs.selectExpr("doc_id", "text", "cast(null as array<long>) leaf_starts", "cast(null as array<long>) sums")
    assert sorted(r.n_tokens for r in recount(unknown, PATH).collect()) == sorted(n_tokens(r.text or "") for r in docs.collect())


def test_query_against_whole_encodings(spark):
    sf = str(DATA / "sf0.001")
    whole = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_token_counts(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(whole) and len(rows) == len(whole)
    for r in rows:
        text = edited = whole[r.doc_id]
        edits = scrub_edits(text)
        for a, b, new in reversed(edits):
            edited = edited[:a] + new + edited[b:]
        assert (r.n_tokens, r.n_edits, r.n_tokens_after) == (n_tokens(text), len(edits), n_tokens(edited))
        if not edits:
            assert r.n_leaves == len(leaf_starts(text)) and not any(p.search(text) for p, _ in SCRUBBED)
