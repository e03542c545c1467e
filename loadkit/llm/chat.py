"""Chat formatting from event logs: reconstruct the final messages, render them, read them back.

The template, with one turn after another:

    <|role|>
    text<|end|>

Control strings begin with ``<``. Inside roles and texts three characters are
written as two, so no control string can occur there and reading back is exact:
backslash as ``\\b``, ``<`` as ``\\l``, ``|`` as ``\\p``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, END = "<|", "|>\n", "<|end|>\n"


def escaped(text: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("<", "\\l"), ("|", "\\p")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for raw, code in (("|", "\\p"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def reconstruct(events: DataFrame, conv: str, message: str, seq: str, kind: str, role: str, text: str) -> DataFrame:
    """Final messages of every conversation from its log of events.

    ``kind``: ``set`` gives a message its text, ``delta`` appends to it,
    ``edit`` replaces it, ``regenerate`` empties it and forgets every later
    message of the conversation that was begun before it, ``delete`` removes
    the message. Unknown and null kinds count as ``set``.

    Events are folded in the order of (seq, kind, role, text). Returns (conv,
    message, role, text), a row per message left; the role is the last one that
    an event names, else empty. Null texts count as empty; a delta to nothing
    starts a message; null conversations and messages are values like any
    other; a message without a name is before all others, and its regenerations
    forget none. A regeneration counts also where its message is forgotten, and
    what comes later for a forgotten message is ignored. Repeated events are
    folded as often as they stand; no events give no messages; extra columns are
    not read. One message's events are folded together in one row; a
    conversation's messages go past in order, and are not collected here.
    """
    e = events.select(
        F.col(conv).alias("conv"),
        F.col(message).alias("message"),
        F.col(seq).alias("seq"),
        F.coalesce(F.col(kind), F.lit("set")).alias("kind"),
        F.col(role).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    folded = (
        e.groupBy("conv", "message")
        .agg(
            F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("log"),
            F.min("seq").alias("first"),
            F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
        )
        .withColumn(
            "state",
            F.aggregate(
                "log",
                F.struct(F.lit(None).cast("string").alias("role"), F.array().cast("array<string>").alias("parts"), F.lit(True).alias("here")),
                lambda acc, x: F.struct(
                    F.coalesce(x["role"], acc["role"]).alias("role"),
                    F.when(x["kind"] == "delta", F.concat(acc["parts"], F.array(x["text"])))
                    .when(x["kind"].isin("regenerate", "delete"), F.array().cast("array<string>"))
                    .otherwise(F.array(x["text"]))
                    .alias("parts"),
                    (x["kind"] != "delete").alias("here"),
                ),
            ),
        )
    )
    # of the regenerations after a message was begun, only those of earlier messages count against it
    earlier = Window.partitionBy("conv").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max(F.when(F.col("message").isNotNull(), F.col("again"))).over(earlier)
    kept = folded.withColumn("gone", F.coalesce(F.col("first") < latest, F.lit(False)))
    return kept.where(F.col("state.here") & ~F.col("gone")).select(
        "conv", "message", F.coalesce("state.role", F.lit("")).alias("role"), F.array_join("state.parts", "").alias("text")
    )


def render(messages: DataFrame, trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One formatted text per conversation, with the spans of it that the loss covers.

    Takes (conv, message, role, text) and puts messages in the order of
    (message, role, text); null roles and texts count as empty, equal rows are
    turns of their own, and no messages give no texts. A conversation becomes
    one row here, so it must fit Spark's 2 GB of a value. Returns
    (conv, formatted, loss_spans): spans are (start, length) in characters,
    from 0, and hold exactly the escaped texts of the trained roles.
    """
    turns = messages.select(
        "conv",
        F.struct(
            F.col("message").alias("m"),
            escaped(F.coalesce("role", F.lit(""))).alias("r"),
            escaped(F.coalesce("text", F.lit(""))).alias("t"),
            F.coalesce(F.col("role").isin(*trained_roles), F.lit(False)).alias("loss"),
        ).alias("turn"),
    )
    grouped = turns.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    head = lambda x: F.concat(F.lit(OPEN), x["r"], F.lit(MIDDLE))
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(head(x)) + F.length(x["t"]) + len(END)).cast("long").alias("at"),
            F.when(
                x["loss"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(head(x))).cast("long").alias("start"),
                            F.length(x["t"]).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )["spans"]
    text = F.array_join(F.transform("turns", lambda x: F.concat(head(x), x["t"], F.lit(END))), "")
    return grouped.select("conv", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    turns = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda x: x != "")
    return F.transform(
        turns,
        lambda x: F.struct(
            unescaped(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), MIDDLE, 1)).alias("role"),
            unescaped(F.substr(x, F.locate(MIDDLE, x) + len(MIDDLE))).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
