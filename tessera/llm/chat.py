"""Chat formatting with Spark expressions only (operator 9).

A conversation's rows are collected as structs, sorted by turn, adjacent turns of one role are
merged, and everything is concatenated with a template:

    <|im_start|>ROLE \\n TEXT [<|im_sep|> TEXT ...] <|im_end|> \\n

Inside texts and roles one backslash is put after the ``<`` of every ``<\\...\\|``, so a control
string can only come from the template; removing one backslash undoes it. A line feed or per cent
sign in a role is per-cent coded, for the role ends at the first line feed.

Defined results: NULL text or role is empty; NULL turn sorts first, ties by role, then text; NULL
conversation ids form one conversation; a repeated row is a turn of its own; other columns are
ignored; an empty table gives an empty result. The work per conversation is linear in its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_code(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_text(code: Column) -> Column:
    return F.replace(F.replace(unescape(code), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chats(conversations: DataFrame, loss_role: str = "assistant", conv_id: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments, loss_mask``.

    ``segments`` are the pieces whose texts concatenate to ``formatted``; ``loss`` marks the
    (escaped) texts of ``loss_role``. ``loss_mask`` is the same mask as run lengths in code points.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        _role_code(F.coalesce(F.col(role), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # first index of each run of one role, and the index after its last turn
    starts = turns.select("conv_id", "turns", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"])).alias("starts"))
    ends = starts.select("conv_id", "turns", F.arrays_zip(
        "starts", F.concat(F.expr("slice(starts, 2, size(starts))"), F.array(F.size("turns"))).alias("ends")).alias("runs"))
    merged = ends.select("conv_id", F.transform("runs", lambda r: F.struct(
        F.col("turns")[r["starts"]]["role"].alias("role"),
        F.transform(F.slice(F.col("turns"), r["starts"] + 1, r["ends"] - r["starts"]), lambda t: t["text"]).alias("texts"),
    )).alias("merged"))

    def piece(s: Column, loss: Column | None = None) -> Column:
        return F.struct(s.alias("text"), (F.lit(False) if loss is None else loss).alias("loss"))

    own = _role_code(F.lit(loss_role))
    segments = merged.select("conv_id", F.flatten(F.transform("merged", lambda m: F.concat(
        F.array(piece(F.concat(F.lit(START), m["role"], F.lit("\n")))),
        F.flatten(F.transform(m["texts"], lambda t, i: F.when(i == 0, F.array(piece(t, m["role"] == own)))
                              .otherwise(F.array(piece(F.lit(SEP)), piece(t, m["role"] == own))))),
        F.array(piece(F.lit(END + "\n"))))).alias("x")).alias("segments"))
    return segments.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments",
        F.transform("segments", lambda s: F.struct(F.char_length(s["text"]).alias("n"), s["loss"].alias("loss"))).alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as ``array<struct<role, text>>``, in order."""
    marked = F.slice(F.split(formatted, r"<\|im_start\|>"), F.lit(2), F.greatest(F.size(F.split(formatted, r"<\|im_start\|>")), F.lit(1)))

    def parse(s: Column) -> Column:
        role = F.substring_index(s, "\n", 1)
        body = F.substring(s, F.char_length(role) + 2, F.char_length(s) - F.char_length(role) - 2 - len(END))
        return F.transform(F.split(body, r"<\|im_sep\|>"),
                           lambda t: F.struct(_role_text(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(marked, parse))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
