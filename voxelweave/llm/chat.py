"""Chat formatting by prefix-target expansion, with DataFrame functions.

Every assistant turn becomes an example of its own: all preceding turns are its context and only
the text of that reply is under the loss mask (a character range). A conversation that does not end
with an assistant turn gets a last example without a mask, so that no turn is lost.

A turn is ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts backslashes are doubled and
every control string gets a backslash after its first character, so control strings occur only
where the template puts them, and ``unescape`` restores the text.

Defined results: turns are ordered by (turn, role, text), null turns first; null role or text is
empty; rows with a null conversation id form one conversation; repeated rows are turns of their
own; an empty table gives no rows; other columns, whatever their names, are ignored; texts of any length are
formatted whole. The examples of a conversation hold all its prefixes, so their size grows with the square of
its length; that is the format's nature.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: This template's marks, and marks of other templates that texts may hold.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = [TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|im_start|>", "<|im_end|>"]
_MARK = "|".join(f"(?<={re.escape(c[0])}){re.escape(c[1:])}" for c in CONTROL)
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({_MARK})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def expand(conversations: DataFrame) -> DataFrame:
    """conv_id, example (from 0), formatted, loss_start (from 0), loss_length; both in code points."""
    rows = common.only(conversations, "conv_id", "turn", "role", "text")
    empty = F.lit("")
    rows = rows.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    marked = rows.select("conv_id", F.struct("turn", "role", "text", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"), escape(F.col("text")).alias("body")).alias("t"))
    turns = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    last = F.size("turns")
    targets = F.filter(F.sequence(F.lit(1), last), lambda k: (F.element_at("turns", k)["role"] == ASSISTANT) | (k == last))
    whole = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    examples = turns.select("conv_id", "turns", whole.alias("whole"), F.posexplode(targets).alias("example", "k"))
    target = F.element_at("turns", F.col("k"))
    before = F.array_join(F.slice("whole", 1, F.col("k") - 1), "")
    replies = target["role"] == ASSISTANT
    return examples.select(
        "conv_id",
        "example",
        F.concat(before, F.element_at("whole", F.col("k"))).alias("formatted"),
        F.when(replies, F.length(before) + F.length(target["head"])).otherwise(F.lit(0)).cast("bigint").alias("loss_start"),
        F.when(replies, F.length(target["body"])).otherwise(F.lit(0)).cast("bigint").alias("loss_length"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    parts = F.split(formatted, re.escape(END))
    turns = F.filter(parts, lambda p: p != "")

    def turn(p: Column) -> Column:
        at = F.instr(p, TEXT)
        role = p.substr(F.lit(len(TURN) + 1), at - 1 - len(TURN))
        return F.struct(unescape(role).alias("role"), unescape(p.substr(at + len(TEXT), F.length(p))).alias("text"))

    return F.transform(turns, turn)


def masked(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the mask, unescaped."""
    return unescape(formatted.substr((start + 1).cast("int"), length.cast("int")))


def digest(examples: DataFrame) -> DataFrame:
    """What a reader gets back from the examples, a row per conversation."""
    loss = masked(F.col("formatted"), F.col("loss_start"), F.col("loss_length"))
    read = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_sort(F.collect_list(F.struct("example", loss.alias("text")))).alias("losses"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    )
    turns = parse(F.col("longest"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform("losses", lambda x: x["text"]), "")
    return read.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(trained).cast("bigint").alias("loss_chars"),
        F.sha2(trained.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
