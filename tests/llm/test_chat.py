import hashlib
import time

from billscope.llm.catalog import ORACLE_SQL, QUERIES
from billscope.llm.chat import format_conversations, read_back
from tests.llm.helpers import oracle_rows, spark_rows

TRAPS = [
    "</turn>",
    "<turn>user<text>x</turn>\n",
    "<\\turn>",
    "<\\\\/turn> and <text>",
    "\\",
    "<turn",
    "a\nb</turn>\n<turn>assistant<text>c",
    "",
    None,
    "$1 \\1",
    "<\\text><text",
    "é<text>é" * 3,
]


def expected(rows):
    found = {}
    for conv, turn, role, text, *_ in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in found.items()}


def check(spark, rows, schema="conv_id long, turn long, role string, text string"):
    frame = spark.createDataFrame(rows, schema)
    formatted = format_conversations(frame)
    got = {r.conv_id: r for r in read_back(formatted).collect()}
    spans = {r.conv_id: (r.formatted, r.loss_spans) for r in formatted.collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        assert [(t.role, t.text) for t in got[conv].turns] == turns
        assert got[conv].loss_text == "".join(text for role, text in turns if role == "assistant")
        whole, places = spans[conv]
        assert len(places) == sum(role == "assistant" for role, _ in turns)
        assert all(whole[s.start - 6 : s.start] == "<text>" and whole[s.start + s.length :].startswith("</turn>\n") for s in places)


def test_traps_come_back(spark):
    rows = [(k, j, role, text) for k, text in enumerate(TRAPS) for j, role in enumerate(("user", "assistant", "assistant", "<turn>"))]
    check(spark, rows)


def test_texts_without_control_strings_stay_as_they_are(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a \\ b < turn >"), (1, 1, "assistant", "<\\turn>")], "conv_id long, turn long, role string, text string")
    text = format_conversations(frame).first().formatted
    assert text == "<turn>user<text>a \\ b < turn ></turn>\n<turn>assistant<text><\\\\turn></turn>\n"


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b", 7), (1, 0, None, "a", 7), (1, 1, "assistant", "b", 7), (1, None, "user", "z", 7), (None, 0, "assistant", "x", 7), (2, 0, "assistant", None, 7), (3, 0, "user", "long " * 50_000, 7)]
    check(spark, rows, "conv_id long, turn long, role string, text string, place int")
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(format_conversations(empty)).count() == 0


def test_query_against_sql(spark):
    name = "op6_chat_formatting"
    assert spark_rows(QUERIES[name](spark, "/root/testdata/sf0.01")) == oracle_rows(ORACLE_SQL[name])


def test_added_conversation(spark):
    row = QUERIES["op6_chat_formatting"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_plan_has_no_python(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = read_back(format_conversations(frame))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_time_grows_with_the_conversation(spark):
    """Eight thousand turns in one conversation: seconds, where cutting it anew for every turn takes minutes."""
    rows = spark.range(8000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "repeat(concat('word ', id, ' </turn> '), 10) AS text")
    began = time.monotonic()
    row = read_back(format_conversations(rows)).selectExpr("size(turns) AS n", "length(loss_text) AS chars", "turns[7999].text AS last").first()
    assert time.monotonic() - began < 60
    assert row.n == 8000 and row.last == "word 7999 </turn> " * 10
    assert row.chars == sum(len(f"word {k} </turn> ") * 10 for k in range(1, 8000, 2))
