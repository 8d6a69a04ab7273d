"""The prefix trie against SQL, and against a plain one built in memory."""

import random
import zlib
from hashlib import sha256

import pytest

from billscope.llm import prefix_trie as trie
from billscope.llm.catalog import ORACLE_SQL, QUERIES
from tests.llm.helpers import DATA, oracle_rows, spark_rows

NAME = "op12_conversation_prefix_trie"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_force(rows):
    conversations = {}
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            conversations.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in conversations.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (-1 if c < 0 else 1)
        path = tuple(own.get(base, [])[:h] + turns[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) or 1
        saved[path] = sum(saved[p] for p in below) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (
            min(of), len(path), min(members[path[:-1]]) if path else None, len(of), len(children.get(path, [])), leaves[path], saved[path],
            sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, of in members.items()
    )


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def drawn(seed, n, ids, words):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        c = draw.choice(ids)
        for t in range(draw.randrange(1, 9)):
            rows.append((c, t, draw.choice(["user", "assistant", None]), draw.choice(words)))
    return rows


def test_query_matches_sql(spark):
    assert spark_rows(QUERIES[NAME](spark, f"{DATA}/sf0.01")) == oracle_rows(ORACLE_SQL[NAME])


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet").select(*SCHEMA.replace(" long", "").replace(" string", "").split(", ")).collect()
    result = QUERIES[NAME](spark, f"{DATA}/sf0.01")
    assert {t for c, t in result.dtypes if c != "ends_sha256"} == {"bigint"}
    assert found(result) == brute_force(rows)


@pytest.mark.parametrize("many", [1, 2, 7, None])
def test_shards_of_any_size_give_the_same(spark, monkeypatch, many):
    monkeypatch.setattr(trie, "CHUNK", 3)
    monkeypatch.setattr(trie, "IDS_OF_CHUNK", 2)
    monkeypatch.setattr(trie, "QUEUE_LIMIT", 2)
    rows = drawn(many or 0, 150, [*range(40), *range(95, 130), 200, 305, 1199], ["a", "é😀", "", None])
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), many=many)) == brute_force(rows)


def test_nulls_ties_repeats_clashes_and_absent_bases(spark):
    rows = [
        (None, 0, "user", "nobody's"), (None, None, None, None),
        (3, None, "b", "x"), (3, None, "a", "x"), (3, 5, "a", "y"), (3, 5, "a", "y"), (3, 5, None, None),
        (105, 0, "user", "no base and few turns"),
        (-150, 1, "user", "q"), (-101, 1, "user", "q"), (-100, 0, "user", "q"), (-7, 0, "user", ""), (0, 0, "user", ""),
        (200, 0, "", "long " * 40_000), (201, 0, "", "long " * 40_000), (202, 0, "", "long " * 40_000),
    ]
    frame = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], SCHEMA + ", depth int, n1 string, part int")
    assert found(trie.prefix_trie(frame)) == brute_force(rows)
    assert found(trie.prefix_trie(frame.where("conv_id IS NULL"))) == []
    assert found(trie.prefix_trie(spark.createDataFrame([], SCHEMA))) == []


def test_one_conversation_over_many_parts_and_its_copies(spark):
    rows = [(c, t, "user", str(t % 7)) for c in (300, 301, 302) for t in range(9000)] + [(c, 0, "user", "0") for c in range(303, 340)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        result = found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), many=2))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # Compared without the quadratic paths of the plain trie: chains of thousands of turns.
    assert len(result) == len({(r[0], r[1]) for r in result})
    by_node = {r[:2]: r for r in result}
    assert by_node[300, 9000][3] == 3 and by_node[300, 9000][4:7] == (0, 1, 2)
    assert by_node[300, 9000][7] == sha256(b"300,301,302").hexdigest()
    assert by_node[300, 6][6] == sum(2 for _ in range(6, 9001))
    assert by_node[300, 0][3] == 40 and by_node[300, 0][2] is None


def test_queue_spills_and_merges():
    draw, queue = random.Random(1), trie.SpillingQueue(3, 4)
    sent = [(draw.randrange(10), draw.randrange(3), k) for k in range(100)]
    for message in sent:
        queue.push(message)
    assert queue.runs > 10
    taken = {key: sorted(queue.take(key)) for key in sorted({m[:2] for m in sent})}
    assert taken == {key: sorted(m for m in sent if m[:2] == key) for key in taken}
    assert not queue.heap and not queue.heads
