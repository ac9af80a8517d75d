"""Chat formatting by prefix-target expansion: each reply is an example of its own, behind all turns before it.

A turn is written as ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings inside a role or text get a
backslash behind their first character, and one more where they already have some, so nothing in a text can
pass for a mark and every text comes back as it was. Only DataFrame functions are used.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and further strings that must not appear in a formatted text as they stand."""

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    #: Control strings of widespread chat templates.
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")

    def __post_init__(self) -> None:
        for one in self.controls:
            if len(one) < 2 or "\\" in one:
                raise ValueError(f"a control string has two characters at least and no backslash: {one!r}")
            for other in self.controls:
                if any(other.startswith(tail) or tail.startswith(other) for tail in (one[k:] for k in range(1, len(one)))):
                    raise ValueError(f"control strings may not overlap: {one!r}, {other!r}")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.middle, self.end, *self.reserved)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def _by_first(template: Template) -> list[tuple[str, str]]:
    """First characters of the control strings, each with a pattern of what follows it."""
    firsts = sorted({c[0] for c in template.controls})
    return [(_quoted(f), "|".join(_quoted(c[1:]) for c in template.controls if c[0] == f)) for f in firsts]


def escape(text: Column, template: Template = Template()) -> Column:
    """``text`` with one more backslash inside each control string."""
    pattern = "|".join(f"{first}(?=\\\\*(?:{rest}))" for first, rest in _by_first(template))
    return F.regexp_replace(text, pattern, r"$0\\")


def unescape(text: Column, template: Template = Template()) -> Column:
    """The inverse of ``escape``."""
    pattern = "|".join(f"(?<={first})\\\\(?=\\\\*(?:{rest}))" for first, rest in _by_first(template))
    return F.regexp_replace(text, pattern, "")


def prefix_examples(conversations: DataFrame, template: Template = Template(), target_role: str = "assistant") -> DataFrame:
    """``(conv_id, example, n_examples, text, loss_start, loss_end)``: one row for each turn of ``target_role``.

    ``text`` holds the formatted turns from the first to that one; characters ``loss_start`` (from 0) up to
    ``loss_end`` of it are that reply, all that is trainable. Turns behind a conversation's last reply, or a
    conversation without one, make one more example with nothing trainable (both ends at the text's length), so
    that no turn is lost. Turns stand by turn number, NULL first, ties by role and text; NULL roles and texts are
    empty; rows with a NULL conv_id are one conversation. An example holds all turns before its reply, so
    a conversation has to fit in one row; its examples are made one at a time.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.select("conv_id", F.struct("turn", role, text).alias("t"))
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    escaped = gathered.select("conv_id", F.transform("t", lambda t: F.struct(
        F.concat(F.lit(template.start), escape(t["role"], template), F.lit(template.middle)).alias("head"),
        escape(t["text"], template).alias("body"), (t["role"] == target_role).alias("is_target"))).alias("t"))
    whole = escaped.select(
        "conv_id", F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(template.end))).alias("turns"),
        F.transform("t", lambda t: F.when(t["is_target"], F.length(t["body"]))).alias("target"))
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda p: F.get("target", p - 1).isNotNull() | (p == F.size("turns")))
    each = whole.withColumn("places", places).select(
        "conv_id", "turns", "target", F.size("places").alias("n_examples"), F.posexplode("places").alias("example", "place"))
    built = each.select("conv_id", "example", "n_examples", F.get("target", F.col("place") - 1).alias("target"),
                        F.array_join(F.slice("turns", 1, F.col("place")), "").alias("text"))
    end = F.length("text") - F.when(F.col("target").isNull(), 0).otherwise(len(template.end))
    return built.select("conv_id", "example", "n_examples", "text",
                        (end - F.coalesce("target", F.lit(0))).alias("loss_start"), end.alias("loss_end"))


def read_turns(text: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    pieces = F.split(text, _quoted(template.end))
    def one(piece: Column) -> Column:
        halves = F.split(piece, _quoted(template.middle))
        return F.struct(unescape(F.substring(F.get(halves, 0), len(template.start) + 1, 1 << 30), template).alias("role"),
                        unescape(F.get(halves, 1), template).alias("text"))
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), one)


def digests(examples: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, read back from its examples: turns (of the last one, which holds them all), what is under
    the loss masks in order, and the length of all formatted texts."""
    loss = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")), template)
    last = F.col("example") == F.col("n_examples") - 1
    turns = F.when(last, read_turns(F.col("text"), template))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.select("conv_id", "example", loss.alias("loss"), turns.alias("turns"), F.length("text").cast("long").alias("chars"))
    short = read.select("conv_id", F.struct("example", "loss").alias("l"), "chars", F.size("turns").cast("long").alias("n"),
                        F.when(F.col("turns").isNotNull(), F.sha2(said, 256)).alias("sha"))
    per = short.groupBy("conv_id").agg(
        F.max("n").alias("n_turns"), F.max("sha").alias("turns_sha256"),
        F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    return per.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
