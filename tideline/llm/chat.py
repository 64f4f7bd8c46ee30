"""Conversations rebuilt from an event log and rendered for training.

Events (conv_id, seq, message, kind, role, text) of a conversation are folded in the order of
``seq``: ``message`` sets a message's role and text, ``delta`` appends streamed text, ``edit``
replaces the text, and ``regenerate`` starts the message anew and forgets all that was said in
later messages before it. What is left is rendered in the order of ``message``.

The template marks turns with ``<|turn|>``, ``<|text|>`` and ``<|end|>``. Inside roles and texts
``&``, ``<`` and ``[`` are written as entities, so that no control string of this or other
templates survives in a text; ``unescape`` restores them exactly. The result is a list of segments
with a loss flag, true for the texts of ``loss_role``; the formatted text is their concatenation.

A null text is empty and a null role an empty role. Events that share a ``seq`` are folded in the
order of message, kind, role and text. Conversations without messages have no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
RESETS = ("message", "edit", "regenerate")


def escape(c: Column) -> Column:
    """Text without any character that starts a control string."""
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES, c)


def unescape(c: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[1]), F.lit(e[0])), reversed(ENTITIES), c)


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): each message as its events leave it."""
    order = ["seq", "message", "kind", "role", "text"]
    later = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    anew = F.min(F.when(F.col("kind") == "regenerate", F.col("message"))).over(later)
    alive = events.withColumn("_anew", anew).filter(F.col("_anew").isNull() | (F.col("message") <= F.col("_anew")))
    parts = F.array_sort(
        F.collect_list(F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text")))
    )
    last_reset = F.max(F.when(F.col("kind").isin(*RESETS), F.col("seq")))
    role = F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq")))
    messages = alive.groupBy("conv_id", "message").agg(
        parts.alias("_parts"), last_reset.alias("_from"), role.alias("role")
    )
    told = F.filter("_parts", lambda e: F.col("_from").isNull() | (e["seq"] >= F.col("_from")))
    text = F.array_join(F.transform(told, lambda e: e["text"]), "")
    return messages.select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, segments, formatted) of each conversation."""
    said = messages.select(
        "conv_id",
        F.struct(
            "message",
            F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
            escape(F.col("text")).alias("text"),
            (F.col("role") == loss_role).alias("loss"),
        ).alias("m"),
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    turns = F.transform(
        F.array_sort(F.collect_list("m")),
        lambda m: F.array(segment(m["head"], no), segment(m["text"], m["loss"]), segment(F.lit(END), no)),
    )
    rendered = said.groupBy("conv_id").agg(F.flatten(turns).alias("segments"))
    return rendered.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def format_conversations(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Event log to (conv_id, segments, formatted)."""
    return render(fold_events(events), loss_role)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts) parsed from the rendered output alone."""
    pieces = F.split("formatted", r"<\|turn\|>")
    marked = F.slice(pieces, F.lit(2), F.size(pieces))

    def turn(x: Column) -> Column:
        bare = F.substr(x, F.lit(1), F.length(x) - len(END))
        parts = F.split(bare, r"<\|text\|>")
        return F.struct(unescape(F.get(parts, 0)).alias("role"), unescape(F.get(parts, 1)).alias("text"))

    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.select(
        "conv_id", F.transform(marked, turn).alias("turns"), learned.alias("loss_texts"), "formatted"
    )


def logged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as the event log that produces them.

    Rows of one turn number are separate messages, in the order of role and text. Assistant texts
    are streamed as two deltas behind an abandoned first answer.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        "conv_id",
        F.row_number().over(order).alias("message"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    half = (F.length("text") / 2).cast("int")

    def event(step: int, kind: str, text: Column) -> Column:
        seq = F.col("message").cast("bigint") * 4 + step
        return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    plain = F.array(event(0, "message", F.col("text")))
    streamed = F.array(
        event(0, "message", F.lit("...")),
        event(1, "regenerate", F.lit("")),
        event(2, "delta", F.substr("text", F.lit(1), half)),
        event(3, "delta", F.substr("text", half + 1)),
    )
    events = F.when(F.col("role") == "assistant", streamed).otherwise(plain)
    return rows.select("conv_id", "message", "role", F.explode(events).alias("e")).select(
        "conv_id", "message", "role", "e.*"
    )
