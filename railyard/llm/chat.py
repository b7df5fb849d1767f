"""Chat formatting: conversation logs folded into final messages, then rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A turn opens and closes with these; a prompt's text follows the first of the two middle
#: marks, an assistant's text, on which alone loss is taken, the second.
OPEN, PROMPT, ANSWER, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"

#: What starts a control string, and how it is written inside a text. The escape sign comes
#: first; reading goes the other way round. No control string can stand in an escaped text.
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))

#: Kinds of events, and what they do to a message: all but the delta start it anew.
KINDS = ("message", "delta", "edit", "regenerate", "delete")

#: Where null places go: first, with room for window arithmetic below.
_FIRST = -(2**62)


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv, message, role, text) from a log.

    ``events`` has conv, seq, kind, message (the place of the message in its conversation),
    role and text. In order of seq: "message" starts a message, "delta" appends to it, "edit"
    replaces its text, "regenerate" starts its text anew; an edit or regeneration voids every
    later message up to then; "delete" removes the message, until it starts again. Equal seq:
    in the order of KINDS, then of the text. Null conv is a conversation; null seq and message
    come first; null texts are empty, null roles leave the role as it was (or empty); other
    kinds are ignored. Two events that agree in all are two events.

    One shuffle by conversation; the events of one message are gathered, not of more.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    log = events.select(
        "conv",
        F.coalesce("seq", F.lit(_FIRST)).alias("seq"),
        F.coalesce("message", F.lit(_FIRST)).alias("message"),
        "kind",
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
        rank.alias("rank"),
    ).where("rank > 0")
    log = log.withColumn("at", F.struct("seq", "rank"))
    conv = Window.partitionBy("conv")
    one = Window.partitionBy("conv", "message")
    voids = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq")))
    void = voids.over(conv.orderBy("message").rangeBetween(Window.unboundedPreceding, -1))
    start = F.max(F.when(F.col("kind") != "delta", F.col("at"))).over(one)
    known_role = F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at"))).over(one)
    live = (
        log.withColumn("void", void)
        .withColumn("known_role", known_role)
        .where("void IS NULL OR seq > void")
        .withColumn("start", start)
        .where("start IS NULL OR at >= start")
    )
    pieces = F.sort_array(F.collect_list(F.struct("at", "text")))
    return (
        live.groupBy("conv", "message")
        .agg(
            F.coalesce(F.first("known_role"), F.lit("")).alias("role"),
            F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"),
            F.max(F.struct("at", "kind"))["kind"].alias("last"),
            F.bool_or(F.col("kind") == "delete").alias("deleted"),
        )
        .where("NOT deleted")
        .select("conv", "message", "role", "text")
    )


def render(messages: DataFrame) -> DataFrame:
    """One row for each conversation: conv, formatted, and loss_spans.

    A span has the start (from 0) and length, in code points of ``formatted``, of one
    assistant's escaped text. A conversation is one value and so one row; only its own turns
    are gathered for it.
    """
    answer = F.lower("role") == "assistant"
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.when(answer, ANSWER).otherwise(PROMPT))
    parts = messages.select("conv", "message", answer.alias("answer"), head.alias("head"), escape(F.col("text")).alias("body"))
    size = F.length("head") + F.length("body") + len(CLOSE)
    before = F.sum(size).over(Window.partitionBy("conv").orderBy("message")) - size
    parts = parts.withColumn("start", before + F.length("head"))
    turn = F.struct("message", F.concat("head", "body", F.lit(CLOSE)).alias("turn"))
    span = F.when(F.col("answer"), F.struct(F.col("start").alias("start"), F.length("body").cast("bigint").alias("length")))
    turns = F.sort_array(F.collect_list(turn))
    return parts.groupBy("conv").agg(
        F.array_join(F.transform(turns, lambda t: t["turn"]), "").alias("formatted"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    closed = F.split(formatted, CLOSE)
    return F.transform(
        F.slice(closed, 1, F.size(closed) - 1),
        lambda t: F.struct(
            unescape(F.regexp_extract(t, r"(?s)^<s>(.*?)\[/?INST\]", 1)).alias("role"),
            unescape(F.regexp_extract(t, r"(?s)^<s>.*?\[/?INST\](.*)$", 1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, end to end."""
    parts = F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return F.array_join(parts, "")


def format_conversations(events: DataFrame) -> DataFrame:
    """``fold_events`` and ``render``: conv, formatted and loss_spans."""
    return render(fold_events(events))
