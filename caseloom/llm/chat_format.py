"""Chat formatting by a grammar round trip, with DataFrame functions only.

A conversation is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. The
rendered text is parsed again by a deterministic grammar and the turns that come back are
compared with the source. A turn that does not come back as it was is escaped and tried
again, and the whole conversation is compared once more before it is given out.

The grammar knows no choice points: a conversation is a sequence of turns, a turn is the
start mark, a role up to the first line break, a text up to the end mark, and a line break
after it. Marks with backslashes inside (``<|\\im_end|>``) are data that lost one backslash
to the reader, so any text can be written, one that holds escaped marks already included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.llm.common import first_column
from caseloom.session import run_path

# The marks of the template.
START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
TEXT_MARKS, ROLE_MARKS = "im_start|im_end", "im_start|im_end|nl"

#: Renderings of a turn: as it is, then escaped.
ROUNDS = 2


def _escaped(value: Column, marks: str) -> Column:
    return F.regexp_replace(value, rf"<\|(\\*)({marks})\|>", r"<|\\$1$2|>")


def _unescaped(value: Column, marks: str) -> Column:
    return F.regexp_replace(value, rf"<\|\\(\\*)({marks})\|>", "<|$1$2|>")


def escaped_role(role: Column) -> Column:
    return F.replace(_escaped(role, ROLE_MARKS), F.lit("\n"), F.lit(BREAK))


def escaped_text(text: Column) -> Column:
    return _escaped(text, TEXT_MARKS)


def rendered(role: Column, text: Column) -> Column:
    """One turn of the template."""
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def _pieces(formatted: Column) -> Column:
    return F.split(formatted, START.replace("|", r"\|"), -1)


def _turn(piece: Column) -> Column:
    """What stands behind a start mark, by the grammar; ``sound`` is false where it is broken."""
    head = F.instr(piece, "\n")
    length, tail = F.length(piece), len(END) + 1
    role = F.substring(piece, F.lit(1), F.greatest(head - 1, F.lit(0)))
    text = F.substring(piece, head + 1, F.greatest(length - head - tail, F.lit(0)))
    sound = (head > 0) & (length - head >= tail) & F.endswith(piece, F.lit(f"{END}\n")) & ~F.contains(text, F.lit(END)) & ~F.contains(role, F.lit(END))
    return F.struct(
        sound.alias("sound"),
        _unescaped(F.replace(role, F.lit(BREAK), F.lit("\n")), ROLE_MARKS).alias("role"),
        _unescaped(text, TEXT_MARKS).alias("text"),
    )


def parsed(formatted: Column) -> Column:
    """Turns (role, text) of a rendered conversation, null where the grammar does not accept it."""
    pieces = _pieces(formatted)
    turns = F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), _turn)
    accepted = (F.element_at(pieces, 1) == "") & F.forall(turns, lambda t: t["sound"])
    return F.when(accepted, F.transform(turns, lambda t: F.struct(t["role"], t["text"])))


def _written(turns: DataFrame) -> DataFrame:
    """``role`` and ``text`` with what is written for them: escaped only where the plain form does not come back."""
    df = turns.withColumns({"_role": F.col("role"), "_text": F.col("text")})
    source = F.array(F.struct("role", "text"))
    for last in [False] * (ROUNDS - 1) + [True]:
        same = parsed(rendered(F.col("_role"), F.col("_text"))).eqNullSafe(source)
        otherwise = (lambda _: F.raise_error(F.lit("a turn cannot be written")).cast("string")) if last else None
        df = df.withColumn("_same", same).withColumns(
            {
                "_role": F.when(F.col("_same"), F.col("_role")).otherwise((otherwise or escaped_role)(F.col("role"))),
                "_text": F.when(F.col("_same"), F.col("_text")).otherwise((otherwise or escaped_text)(F.col("text"))),
            }
        )
    return df.drop("_same")


def format_chats(conversations: DataFrame, assistant: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, n_turns, loss)``: a rendered text per conversation and its loss mask.

    ``loss`` has the spans of the texts of ``assistant`` turns, in order: ``begin`` (from 0)
    and ``length`` in code points of ``formatted``, and the same place as ``turn`` and ``start``
    behind that turn's start mark (both from 1).

    Turns stand by ``turn`` (missing ones first), equal ones by role and text; repeated rows
    are turns each. Null roles and texts are empty; rows without conv_id are one conversation.
    Empty and very long texts are turns like any other, though a conversation has to fit a
    cell (2 GB). No rows give no conversations; further columns are not looked at.
    """
    rows = first_column(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = _written(rows).withColumn("piece", rendered(F.col("_role"), F.col("_text")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.length("_role") + 2
    span = F.struct(
        (F.coalesce(before, F.lit(0)) + len(START) + start - 1).cast("long").alias("begin"),
        F.length("_text").cast("long").alias("length"),
        F.row_number().over(order).alias("turn"),
        start.alias("start"),
    )
    placed = turns.select(
        "conv_id", "role", "text", "piece", F.row_number().over(order).alias("pos"), F.when(F.col("role") == assistant, span).alias("span")
    )
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text", "piece", "span"))).alias("t"))
    whole = gathered.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"),
        F.size("t").alias("n_turns"),
        F.filter(F.transform("t", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss"),
        F.transform("t", lambda t: F.struct(t["role"], t["text"])).alias("source"),
    )
    same = parsed(F.col("formatted")).eqNullSafe(F.col("source"))
    checked = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not come back")).cast("string"))
    return whole.select("conv_id", checked.alias("formatted"), "n_turns", "loss")


def write_chats(conversations: DataFrame) -> str:
    """Write the formatted conversations to the shared folder; the path of the Parquet table."""
    path = run_path(conversations.sparkSession, "chats")
    format_chats(conversations).write.parquet(path)
    return path


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """``(conv_id, formatted, turns, loss_text)``: turns and text under the loss mask, as the source had them."""
    chats = spark.read.parquet(path)
    pieces = _pieces(F.col("formatted"))
    masked = F.transform("loss", lambda s: _unescaped(F.substring(F.get(F.col("pieces"), s["turn"]), s["start"], s["length"].cast("int")), TEXT_MARKS))
    return chats.withColumn("pieces", pieces).select(
        "conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), F.array_join(masked, "").alias("loss_text")
    )


def chat_digests(chats: DataFrame) -> DataFrame:
    """Per conversation of ``read_chats``: number of turns, digests of the turns and of the text under the mask, lengths."""
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
