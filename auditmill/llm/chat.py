"""Chat formatting from an event log. DataFrame functions only.

A conversation is a log of events: `open` starts a message (its text, if any, is a first version), `delta` appends a
streamed piece, `edit` replaces what the message says, `regenerate` discards it so that new deltas start from nothing.
The log is partitioned by conversation and message, sorted by sequence and folded into final messages; these are rendered
with one header and one end mark each, and the character spans of assistant texts form the loss mask.

Control strings inside texts and roles are escaped: every `<|` becomes `<||`, which no mark begins with, so reading
back is exact. Defined results: a null text or role is empty; messages that share a turn are ordered by role and
a digest of their text; a null conv_id is a conversation of its own; a message without `open` has an empty role; an empty log gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import let

START, END = "<|im_start|>", "<|im_end|>"
#: A line break inside a role, which would end the header line.
ROLE_BREAK = "<|n|>"
#: Characters of a streamed piece in the derived log.
PIECE = 400


def escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, message, seq, event, role, text)."""
    said = F.coalesce("text", F.lit(""))
    ordered = F.sort_array(F.collect_list(F.struct("seq", "event", F.coalesce("role", F.lit("")).alias("role"), said.alias("text"))))
    start = F.struct(F.lit("").alias("role"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, e: Column) -> Column:
        fresh = e["event"].isin("open", "edit")
        parts = F.when(e["event"] == "regenerate", F.array().cast("array<string>")).when(fresh, F.array(e["text"])).otherwise(
            F.concat(state["parts"], F.array(e["text"]))
        )
        return F.struct(F.when(e["event"] == "open", e["role"]).otherwise(state["role"]).alias("role"), parts.alias("parts"))

    folded = events.groupBy("conv_id", "message").agg(ordered.alias("log"))
    state = F.aggregate("log", start, step, lambda s: F.struct(s["role"].alias("role"), F.array_join(s["parts"], "").alias("text")))
    return folded.select("conv_id", "message", state.alias("s")).select("conv_id", "message", "s.role", "s.text")


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask) of final messages; mask is an array of (start, length) in code points from 0."""
    turn = F.struct(
        F.col("message"),
        F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(ROLE_BREAK)), F.lit("\n")).alias("head"),
        escaped(F.col("text")).alias("body"),
        (F.col("role") == "assistant").alias("learn"),
    )
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    tail = END + "\n"
    piece = lambda t: F.concat(t["head"], t["body"], F.lit(tail))

    def spans(state: Column, t: Column) -> Column:
        begin = state["at"] + F.char_length(t["head"])
        size = F.char_length(t["body"])
        return F.struct(
            (begin + size + len(tail)).cast("bigint").alias("at"),
            F.when(
                t["learn"], F.concat(state["mask"], F.array(F.struct(begin.cast("bigint").alias("start"), size.cast("bigint").alias("length"))))
            ).otherwise(state["mask"]).alias("mask"),
        )

    nothing = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("mask"))
    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", piece), "").alias("formatted"),
        F.aggregate("turns", nothing, spans, lambda s: s["mask"]).alias("mask"),
    )


def parsed(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    chunks = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 1 << 30)

    def turn(chunk: Column) -> Column:
        cut = F.instr(chunk, "\n")
        role = F.substring(chunk, F.lit(1), cut - 1)
        body = F.substring(chunk, cut + 1, F.char_length(chunk) - cut - len(END) - 1)
        return F.struct(unescaped(F.replace(role, F.lit(ROLE_BREAK), F.lit("\n"))).alias("role"), unescaped(body).alias("text"))

    return F.transform(chunks, turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(
        F.transform(mask, lambda m: unescaped(F.substring(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), ""
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each formatted conversation, all of them taken from the output."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        formatted.select("conv_id", "formatted", "mask", parsed(F.col("formatted")).alias("turns"))
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
            let(
                masked_text(F.col("formatted"), F.col("mask")),
                lambda t: F.struct(F.char_length(t).cast("bigint").alias("loss_chars"), F.sha2(t, 256).alias("loss_sha256")),
            ).alias("loss"),
            F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        )
        .select("conv_id", "n_turns", "turns_sha256", "loss.loss_chars", "loss.loss_sha256", "formatted_chars")
    )


def conversation_log(conversations: DataFrame) -> DataFrame:
    """The event log that a client writing these turns would leave.

    Assistant texts stream in pieces; a text of several pieces was first begun, then regenerated. Other roles post a
    first version and edit it. `message` is (turn, role, text's digest, copy), so rows that share a turn stay apart.
    """
    said = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    # Equal rows become as many messages; the count replaces a row number.
    counted = conversations.select("conv_id", "turn", role.alias("role"), said.alias("text")).groupBy("conv_id", "turn", "role", "text").count()
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), "count")).alias("copy")
    rows = counted.select("conv_id", "turn", "role", "text", copy).select(
        "conv_id", F.struct("turn", "role", F.xxhash64("text").alias("digest"), "copy").alias("message"), "role", "text"
    )
    event = lambda kind, text, who=None: F.struct(
        F.lit(kind).alias("event"), (who if who is not None else F.lit(None).cast("string")).alias("role"), text.alias("text")
    )
    count = F.ceil(F.char_length("text") / PIECE).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: event("delta", F.substring("text", i * PIECE + 1, F.lit(PIECE)))
    )
    opened = event("open", F.lit(""), F.col("role"))
    begun = F.array(opened, event("delta", F.substring("text", 1, PIECE)), event("regenerate", F.lit("")))
    streamed = F.concat(F.when(count > 1, begun).otherwise(F.array(opened)), pieces)
    posted = F.array(event("open", F.substring("text", 1, PIECE), F.col("role")), event("edit", F.col("text")))
    log = F.posexplode(F.when(F.col("role") == "assistant", streamed).otherwise(posted)).alias("seq", "e")
    return rows.select("conv_id", "message", log).select("conv_id", "message", "seq", "e.event", "e.role", "e.text")


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    return rendered(fold_events(conversation_log(conversations)))
