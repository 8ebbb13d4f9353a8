"""Chat formatting with Spark expressions (operator 8)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """No ``<|`` is left: every ``<``, backslashes, ``|`` gets one backslash more. ``unescape`` takes it away."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _bytes(c: Column) -> Column:
    return F.octet_length(c).cast("long")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often a function over an array inside ``use`` looks at it."""
    return F.transform(F.array(value), use)[0]


def _loss_spans(steps: Column) -> Column:
    """(first, end) of the steps (loss, gap, len) under the mask.

    An array that grows by one element is copied each time, so steps are taken
    in about as many runs as a run has steps, which begin at known offsets.
    """
    span = "array<struct<first:bigint,end:bigint>>"
    width = F.ceil(F.sqrt(F.size(steps))).cast("int")
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / width).cast("int")),
                       lambda k: F.slice(steps, k * width + 1, width))
    zero = F.lit(0).cast("long")

    def offsets(parts):
        sums = F.transform(parts, lambda p: F.aggregate(p, zero, lambda n, s: n + s["gap"] + s["len"]))
        return F.aggregate(sums, F.array(zero), lambda at, n: F.array_append(at, F.element_at(at, -1) + n))

    def step(acc, s):
        first = acc["at"] + s["gap"]
        return F.struct((first + s["len"]).alias("at"), F.when(s["loss"], F.array_append(acc["spans"], F.struct(
            first.alias("first"), (first + s["len"]).alias("end")))).otherwise(acc["spans"]).alias("spans"))

    return _let(runs, lambda parts: _let(offsets(parts), lambda at: F.flatten(F.transform(parts, lambda p, k: F.aggregate(
        p, F.struct(at[k].alias("at"), F.array().cast(span).alias("spans")), step)["spans"]))))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, text)``: ``conv_id, formatted, loss_spans``.

    The turns of a conversation are collected, sorted by turn (then role, then
    text) and cut into blocks of adjacent turns of one role. A block is
    ``<|im_start|>role``, a newline, the texts joined by ``<|im_sep|>``, then
    ``<|im_end|>`` and a newline. Control strings inside texts and roles are
    escaped reversibly (``escape``), a newline in a role is ``<|nl|>``.
    ``loss_spans`` are the (first, last + 1) UTF-8 byte offsets of each
    assistant text within ``formatted``; separators and markers lie outside.

    Null texts and roles count as empty; null turns come first; repeated rows
    are turns of their own; a null conv_id is a conversation of its own. An empty
    table gives an empty result; further columns are ignored, whatever their names.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    role_at = lambda i: F.col("turns")[i]["role"]
    n = F.size("turns")
    # first turn of each block, and behind the last block the number of turns
    firsts = F.filter(F.sequence(F.lit(0), n), lambda i: (i == 0) | (i == n) | (role_at(i) != role_at(i - 1)))
    chats = chats.withColumn("firsts", firsts)
    chats = chats.withColumn("blocks", F.transform(
        F.slice("firsts", 1, F.size("firsts") - 1),
        lambda f, k: F.struct(
            role_at(f).alias("role"),
            F.concat(F.lit(START), F.replace(escape(role_at(f)), F.lit("\n"), F.lit("<|nl|>")), F.lit("\n")).alias("head"),
            F.transform(F.slice("turns", f + 1, F.col("firsts")[k + 1] - f), lambda t: escape(t["text"])).alias("texts"))))
    body = F.transform("blocks", lambda b: F.concat(b["head"], F.array_join(b["texts"], SEP), F.lit(END + "\n")))
    # each text with the bytes that stand between it and the text before it
    steps = F.flatten(F.transform("blocks", lambda b, k: F.transform(b["texts"], lambda t, j: F.struct(
        (b["role"] == "assistant").alias("loss"), _bytes(t).alias("len"),
        F.when(j > 0, F.lit(len(SEP))).when(k > 0, _bytes(b["head"]) + len(END) + 1).otherwise(_bytes(b["head"])).cast("long").alias("gap")))))
    spans = _let(steps, _loss_spans)
    return chats.select("conv_id", F.array_join(body, "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Add to the rows of ``format_chats``: ``turns`` (role, text per turn) and ``loss_text``."""
    blocks = F.transform(
        F.filter(F.split("formatted", r"<\|im_start\|>"), lambda b: b != ""),
        lambda b: F.struct(
            unescape(F.replace(F.substring_index(b, "\n", 1), F.lit("<|nl|>"), F.lit("\n"))).alias("role"),
            F.split(F.substring_index(b.substr(F.length(F.substring_index(b, "\n", 1)) + 2, F.length(b)), END, 1),
                    r"<\|im_sep\|>").alias("texts")))
    turns = F.flatten(F.transform(blocks, lambda b: F.transform(
        b["texts"], lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text")))))
    # each text is unescaped by itself: its neighbours don't stand beside it in the output
    loss = _let(F.encode("formatted", "utf-8"), lambda raw: F.array_join(F.transform("loss_spans", lambda s: unescape(F.decode(
        F.substring(raw, (s["first"] + 1).cast("int"), (s["end"] - s["first"]).cast("int")), "utf-8"))), ""))
    return formatted.withColumn("turns", turns).withColumn("loss_text", loss)
