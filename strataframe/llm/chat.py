"""Conversations rebuilt from event logs and rendered with a chat template.

Events of a conversation, in order of ``seq``:

* ``message``: a turn with role and text;
* ``delta``: text streamed to the end of its turn;
* ``edit``: a new text of the turn (and role, where one is given);
* ``regenerate``: the turn starts again with this text, and all later turns so far are dropped.

A turn's text is that of its last message, edit or regeneration, followed by the deltas after it.
A turn of deltas alone starts empty, with the role of its first delta that has one.

The template marks each turn and escapes control strings in texts, reversibly, so that a text can
neither open nor close a turn. Output is one row per turn: a conversation is the join of its
rows in order, so the longest conversation needs no more memory than its longest turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: What a control string begins with, and how its second character is escaped in texts and roles.
GUARD, ESCAPE = "<|", "\\"
#: Stands for a line break in an escaped role.
LINE = "\u2424"


def escaped(text: Column) -> Column:
    """``text`` without control strings: backslashes are doubled, and <| becomes <\\|. Line breaks are left."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.replace(doubled, F.lit(GUARD), F.lit(GUARD[0] + ESCAPE + GUARD[1]))


def escaped_role(role: Column) -> Column:
    """A role stands before the first line break of a turn, so its own line breaks are escaped too."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(ESCAPE + LINE))


def unescaped_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)  # at each doubled backslash
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit(ESCAPE + LINE), F.lit("\n")), F.lit(ESCAPE), F.lit(""))), ESCAPE)


def unescaped(text: Column) -> Column:
    """The inverse: a backslash stands before each character that it keeps as it is."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def as_events(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """A table of finished turns as an event log: one message per row, numbered in order of turn; rows
    that repeat a turn are turns of their own, in order of role and text."""
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("at"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    turn = F.row_number().over(Window.partitionBy("conv_id").orderBy("at", "role", "text")).cast("long")
    return rows.select("conv_id", turn.alias("turn"), F.lit("message").alias("kind"), "role", "text").withColumn("seq", F.col("turn"))


def as_streamed_events(conversations: DataFrame, **columns: str) -> DataFrame:
    """A table of finished turns as the log of a streamed chat that was regenerated: its fold is that of ``as_events``.

    Each turn has a draft, a message and a delta. Then the first turn is regenerated and edited, and all
    turns stream their texts in two deltas (the first one behind the edit).
    """
    again = 1 << 40  # behind the drafts of any conversation
    text, n = F.coalesce("text", F.lit("")), F.col("turn")
    half = (F.char_length(text) / 2).cast("int")
    head, tail = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.char_length(text))
    draft, none = F.lit("draft"), F.lit(None).cast("string")

    def event(seq: Column, kind: str, role: Column, text: Column) -> Column:
        return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    first = F.array(event(4 * n, "message", F.col("role"), draft), event(4 * n + 1, "delta", none, draft), event(F.lit(again), "regenerate", none, draft),
                    event(4 * n + again, "edit", F.col("role"), head), event(4 * n + again + 1, "delta", none, tail))
    later = F.array(event(4 * n, "message", draft, draft), event(4 * n + 1, "delta", draft, draft),
                    event(4 * n + again, "delta", F.col("role"), head), event(4 * n + again + 1, "delta", none, tail))
    rows = as_events(conversations, **columns).select("conv_id", "turn", F.explode(F.when(n == 1, first).otherwise(later)).alias("event"))
    return rows.select("conv_id", "turn", "event.*")


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the turns that remain of (conv_id, turn, seq, kind, role, text).

    Null texts are empty, null roles too. What a regeneration of an earlier turn drops is left out
    first. Events of a turn are gathered, those of a conversation are only looked at in order: no
    conversation is held in memory. Events of the same seq apply in order of kind, role and text.
    Unknown kinds change nothing. A null turn is a turn before all others, a null conv_id a conversation.

    All steps follow one exchange by conv_id, none where the log comes dealt by it.
    """
    in_order = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    again = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(in_order)
    # the first event of a turn has only earlier turns before it; those behind it see these too, and more
    cut = F.min(F.struct(F.col("again").isNotNull(), "again")).over(Window.partitionBy("conv_id", "turn"))["again"]
    events = (events.select("conv_id", "turn", "seq", "kind", "role", "text", again.alias("again")).withColumn("cut", cut)
              .where(F.coalesce(F.col("seq") > F.col("cut"), F.lit(True))))
    base = F.col("kind").isin("message", "edit", "regenerate")
    event = F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = events.groupBy("conv_id", "turn").agg(
        F.max(F.when(base, event)).alias("base"),
        F.max(F.when(base & F.col("role").isNotNull(), F.struct("seq", "role"))).alias("named"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "delta", event))).alias("deltas"),
        F.min(F.when(F.col("kind") == "delta", F.struct(F.col("role").isNull().alias("unnamed"), "seq", "role"))).alias("first"))
    later = F.filter("deltas", lambda d: F.col("base").isNull() | F.coalesce(d["seq"] > F.col("base.seq"), F.lit(True)))
    text = F.concat(F.coalesce("base.text", F.lit("")), F.array_join(F.transform(later, lambda d: d["text"]), ""))
    live = turns.where(F.col("base").isNotNull() | (F.size("deltas") > 0))
    return live.select("conv_id", "turn", F.coalesce("named.role", "first.role", F.lit("")).alias("role"), text.alias("text"))


def render(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_end) of (conv_id, turn, role, text).

    ``formatted`` is the turn as the template marks it; its characters from loss_start (from 0) to
    loss_end are under the loss mask: the escaped text of a turn of ``loss_role``, nothing of others.
    """
    role, text = escaped_role(F.coalesce("role", F.lit(""))), escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    start = F.char_length(head).cast("long")
    masked = F.coalesce("role", F.lit("")) == loss_role
    return turns.select("conv_id", "turn", F.concat(head, text, F.lit(CLOSE + "\n")).alias("formatted"), start.alias("loss_start"),
                        F.when(masked, start + F.char_length(text)).otherwise(start).cast("long").alias("loss_end"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, masked, formatted_chars) out of rendered rows alone."""
    inner = F.substring(F.col("formatted"), F.lit(len(OPEN) + 1), F.char_length("formatted") - len(OPEN) - len(CLOSE) - 1)
    role = F.substring_index(inner, "\n", 1)
    masked = F.substring(F.col("formatted"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    text = F.substring(inner, F.char_length(role) + 2, F.char_length(inner))
    return formatted.select("conv_id", "turn", unescaped_role(role).alias("role"), unescaped(text).alias("text"),
                            unescaped(masked).alias("masked"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of ``read_back`` rows.

    The digest of a conversation runs over its turns one after the other, so rows are sorted and
    streamed; a task keeps two running digests, however long the conversation. A text under the mask as
    a whole goes through the exchange once.
    """
    id_type = turns.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None  # id, turns, digest, loss characters, loss digest, characters

        def flush(done: list, kind: pa.DataType) -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t or kind) for c, t in zip(columns, types, strict=True)], names)

        kind = None
        for batch in batches:
            kind, done = batch.column(0).type, []
            for conv, role, text, masked, chars in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5)), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                masked = text if masked is None else masked
                now[3] += len(masked)
                now[4].update(masked.encode())
                now[5] += chars
            if done:
                yield flush(done, kind)
        if now is not None:
            yield flush([(now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5])], kind)

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turns = turns.withColumn("masked", F.when(F.col("masked") != F.col("text"), F.col("masked")))
    ordered = turns.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "turn", "role", "text", "masked", "formatted_chars").mapInArrow(
        fold, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
