"""Operator 6, chat formatting: a template with control strings, a parser for it, and escapes until both agree.

Grammar: conversation = turn*; turn = "<turn>" role "<text>" text "</turn>" newline. Roles and texts hold no control
string: in one that would, a backslash follows the "<" (one more, if backslashes follow it already). The parser cuts at
control strings and takes that backslash away again, so it never depends on what a text says.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTROL = r"<(?:/?turn|text)>"
ESCAPABLE = r"<(\\*)(/?turn|text)>"
ESCAPED = r"<\\(\\*)(/?turn|text)>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPABLE, r"<\\$1$2>")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "<$1$2>")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<turn>"), role, F.lit("<text>"), text, F.lit("</turn>\n"))


def parse(pieces: Column) -> Column:
    """Turns (role, text) of a conversation cut at its control strings; null if it doesn't follow the grammar.

    `pieces` must be a column of its own: every turn looks into it.
    """
    n = ((F.size(pieces) - 1) / 3).cast("int")

    def turn(i: Column) -> Column:
        return F.struct(unescape(F.get(pieces, i * 3 + 1)).alias("role"), unescape(F.get(pieces, i * 3 + 2)).alias("text"))

    turns = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), turn))
    turns = F.coalesce(turns, F.expr("cast(array() as array<struct<role:string,text:string>>)"))
    between = F.filter(pieces, lambda _, i: i % 3 == 0)
    regular = (F.size(pieces) % 3 == 1) & (F.get(pieces, F.lit(0)) == "") & (F.size(F.filter(between, lambda x: x == "\n")) == n)
    return F.when(regular, turns)


def with_pieces(df: DataFrame, formatted: Column, name: str = "pieces") -> DataFrame:
    """A column with the cut text. Behind a generator, as expressions above would otherwise each repeat the cut, once a turn."""
    return df.select("*", F.explode(F.array(F.split(formatted, CONTROL))).alias(name))


def format_conversations(
    conversations: DataFrame,
    *,
    trained_role: str = "assistant",
    rounds: int = 1,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv_id, formatted, loss_spans (start, length in code points; the trained role's texts): one row a conversation.

    Turns follow the turn column; nulls come first, and equal turns follow role, then text, so repeated rows all stay.
    Null roles and texts are empty ones. Rows without a conv_id are one conversation. An empty table gives an empty one;
    other columns are ignored. A turn is rendered as it is, read back, and escaped where that differs, rounds times; one
    that still differs (none does after the first) ends the job with an error.
    """
    source = conversations.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def reads_back(line: Column) -> Column:
        # A line is one turn: what is cut again for it is short.
        return F.coalesce(parse(F.split(line, CONTROL)) == F.array(F.struct(F.col("role"), F.col("text"))), F.lit(False))

    plain = source.withColumn("safe_role", F.col("role")).withColumn("safe_text", F.col("text"))

    def escaped(df: DataFrame, _: int) -> DataFrame:
        same = df.withColumn("same", reads_back(render(F.col("safe_role"), F.col("safe_text"))))
        return same.select(
            "conv_id",
            "turn",
            "role",
            "text",
            F.when(F.col("same"), F.col("safe_role")).otherwise(escape(F.col("safe_role"))).alias("safe_role"),
            F.when(F.col("same"), F.col("safe_text")).otherwise(escape(F.col("safe_text"))).alias("safe_text"),
        )

    lines = reduce(escaped, range(rounds), plain).withColumn("line", render(F.col("safe_role"), F.col("safe_text")))
    lines = lines.withColumn("line", F.when(reads_back(F.col("line")), F.col("line")).otherwise(F.raise_error(F.lit("a turn can't be formatted reversibly"))))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.select(
        "conv_id",
        F.row_number().over(in_order).alias("place"),
        "line",
        (F.col("role") == trained_role).alias("trained"),
        (F.coalesce(F.sum(F.length("line")).over(before), F.lit(0)) + F.length("safe_role") + len("<turn><text>")).alias("start"),
        F.length("safe_text").cast("long").alias("length"),
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "line", "trained", "start", "length"))).alias("turns"))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text), loss_text (what the loss spans cover, unescaped, in order)."""

    def covered(span: Column) -> Column:
        return unescape(F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")))

    return with_pieces(formatted, F.col("formatted")).select(
        "conv_id",
        "formatted",
        parse(F.col("pieces")).alias("turns"),
        F.array_join(F.transform("loss_spans", covered), "").alias("loss_text"),
    )
