"""Chat formatting from an event log (operator 5); DataFrame functions only.

Log rows are ``conv_id, message_id, seq, kind, role, text``; ``message_id`` is a struct whose field ``turn``
places the message (further fields tell equal turns apart). Kinds: ``message`` opens a message,
``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` empties it for new deltas. The
final text of a message is what follows its last reset, in order of ``seq``; messages of a
conversation are ordered by ``message_id``.

Template of a turn: ``<turn:ROLE>TEXT</turn>`` and a newline. In roles and texts a backslash, ``<``
and ``>`` become ``\\b``, ``\\l`` and ``\\g``, so a raw ``<`` is always a mark and the escape is undone by
three literal replacements.

Defined cases: null role or text is empty; null conv_id is a conversation of its own; ties of
``seq`` go by kind, then text; a message without any opening event takes its role from its smallest
non-null role; an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.columns import table

# Messages of one output part. A conversation is the concatenation of its parts, so no row or task
# has to hold an unbounded one.
PART = 64
RESETS = ("message", "edit", "regenerate")

# The extra conversation of the registered query.
EXTRA_ID = -7
EXTRA_TEXT = r"\### Assistant: </turn> ok"


def escaped(text: Column) -> Column:
    for mark, code in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(mark), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for code, mark in (("\\l", "<"), ("\\g", ">"), ("\\b", "\\")):
        text = F.replace(text, F.lit(code), F.lit(mark))
    return text


def folded(log: DataFrame) -> DataFrame:
    """``conv_id, message_id, role, text``: each message after its deltas, edits and regenerations.

    The aggregate is keyed by message, so a conversation holding much of the log is spread.
    """
    rank = F.when(F.col("kind").isin(*RESETS), 0).otherwise(1)
    body = F.when(F.col("kind") == "regenerate", "").otherwise(F.coalesce("text", F.lit("")))
    events = F.array_sort(F.collect_list(F.struct("seq", rank.alias("rank"), "kind", body.alias("body"))))
    opened = F.min_by("role", F.struct(F.col("kind") != "message", "seq", "role"))
    per_message = log.groupBy("conv_id", "message_id").agg(
        F.coalesce(opened, F.min("role"), F.lit("")).alias("role"),
        F.max(F.when(F.col("kind").isin(*RESETS), F.struct("seq", rank.alias("rank"), "kind", body.alias("body")))).alias("reset"),
        events.alias("events"),
    )
    live = F.filter("events", lambda e: F.coalesce(e >= F.col("reset"), F.lit(True)))
    return per_message.select(
        "conv_id", "message_id", "role",
        F.array_join(F.transform(live, lambda e: e["body"]), "").alias("text"),
    )


def rendered(messages: DataFrame, part: int = PART) -> DataFrame:
    """``conv_id, part, n_turns, formatted, loss``: bounded pieces of the formatted conversations.

    ``loss`` lists (start, length) in code points of this part's text: the contents of assistant
    turns. Parts are numbered by message position within a conversation's blocks of ids.
    """
    turn = messages.select(
        "conv_id",
        F.col("message_id").alias("message_id"),
        F.floor(F.coalesce(F.col("message_id.turn"), F.lit(-1)) / part).alias("part"),
        F.concat(F.lit("<turn:"), escaped(F.col("role")), F.lit(">")).alias("head"),
        escaped(F.col("text")).alias("body"),
        (F.col("role") == "assistant").alias("learn"),
    ).withColumn("piece", F.concat("head", "body", F.lit("</turn>\n")))
    sizes = F.struct(
        "message_id",
        "piece",
        F.char_length("piece").alias("size"),
        F.when(F.col("learn"), F.char_length("head")).alias("start"),
        F.char_length("body").alias("length"),
    )
    parts = turn.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(sizes)).alias("turns"))
    # offsets are running sums of at most the messages of one part
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda state, t: F.struct(
            (state["at"] + t["size"]).alias("at"),
            F.when(t["start"].isNull(), state["spans"])
            .otherwise(F.array_append(state["spans"], F.struct((state["at"] + t["start"]).alias("start"), t["length"].alias("length"))))
            .alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return parts.select(
        "conv_id", "part",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss"),
    )


def parsed_turns(formatted: Column) -> Column:
    """The (role, text) of each turn, read back from formatted text."""
    pieces = F.filter(F.split(formatted, "</turn>\n"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substring_index(F.substring(p, 7, 1 << 30), ">", 1)).alias("role"),
            unescaped(F.substring_index(p, ">", -1)).alias("text"),
        ),
    )


def masked_texts(formatted: Column, loss: Column) -> Column:
    """Unescaped texts under the loss mask, in order."""
    return F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"])))


def turn_log(turns: DataFrame) -> DataFrame:
    """Event log of finished turns. Equal rows are told apart by a copy number."""
    counted = turns.groupBy("conv_id", "turn", "role", "text").count()
    copies = F.explode(F.sequence(F.lit(1), F.col("count").cast("int")))
    return counted.withColumn("copy", copies).select(
        "conv_id",
        F.struct("turn", "role", "text", "copy").alias("message_id"),
        F.lit(0).cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from the rendered parts."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = [(EXTRA_ID, 0, "user", EXTRA_TEXT), (EXTRA_ID, 1, "assistant", EXTRA_TEXT)]
    turns = turns.unionByName(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string"))
    parts = rendered(folded(turn_log(turns)))
    read = parts.select(
        "conv_id", "part",
        F.char_length("formatted").alias("chars"),
        parsed_turns(F.col("formatted")).alias("turns"),
        F.array_join(masked_texts(F.col("formatted"), F.col("loss")), "").alias("learned"),
    ).select(
        "conv_id",
        F.struct(
            "part", "chars", F.size("turns").alias("n"),
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
            "learned",
        ).alias("p"),
    )
    whole = read.groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    joined = lambda field: F.array_join(F.transform("p", lambda x: x[field]), "")
    total = lambda field: F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x[field])
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(joined("said"), 256).alias("turns_sha256"),
        F.char_length(joined("learned")).cast("long").alias("loss_chars"),
        F.sha2(joined("learned"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )


_ESC = "replace(replace(replace({0}, '\\', '\\b'), '<', '\\l'), '>', '\\g')"
OP5_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES ({EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}'), ({EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}')))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESC.format('role')}) + length({_ESC.format('text')}) + 15)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
