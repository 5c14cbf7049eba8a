"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example is the formatted text of all turns up to and including that reply; only the reply is under the loss
mask. Turns that follow the last reply (all turns, if there is none) end in an example without a mask, so that
no turn is lost. The template marks turns by their role:

    user        [INST] text [/INST]
    assistant   <s> text </s>
    system      <<SYS>> text <</SYS>>
    any other   [ROLE] role [/ROLE] text </s>

A control string inside a text gets a backslash behind its first character; one that has backslashes
there already gets one more. Taking one away everywhere gives the text back, and no control string is left in it.
All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\])"
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
ROLE, ROLE_END, TURN_END = "[ROLE] ", " [/ROLE] ", " </s>"
TURN = r"(?s)\[INST\] .*? \[/INST\]|<s> .*? </s>|<<SYS>> .*? <</SYS>>|\[ROLE\] .*? \[/ROLE\] .*? </s>"
TARGET = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def opening(role: Column) -> Column:
    """What stands before a turn's text."""
    other = F.concat(F.lit(ROLE), escaped(role), F.lit(ROLE_END))
    return _by_role(role, 0, other)


def closing(role: Column) -> Column:
    """What stands behind a turn's text."""
    return _by_role(role, 1, F.lit(TURN_END))


def _by_role(role: Column, which: int, other: Column) -> Column:
    return F.coalesce(*[F.when(role == name, F.lit(marks[which])) for name, marks in MARKS.items()], other)


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, formatted, loss_start, loss_length, is_last): one row per assistant turn, and one per loose end.

    place counts the turns of the example; the mask is code points of `formatted` from loss_start (from 0) on,
    empty for a loose end; is_last is the conversation's longest example, which holds all turns.

    Turns are taken by turn, role and text, missing values first; a missing role or text is empty, a missing
    conv_id is a conversation of its own. Repeated rows are turns like others, further columns are not read, and an empty table has
    no examples. Very long texts stay whole. Each reply repeats what precedes it, as the method asks, so
    a conversation must fit into one row, and its output grows with the square of its turns.
    """
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    rows = conversations.select("conv_id", F.struct("turn", blank("role"), blank("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    made = turns.select(
        "conv_id",
        F.transform("turns.role", lambda r: r == TARGET).alias("replies"),
        F.transform("turns", lambda t: opening(t.role)).alias("before"),
        F.transform("turns", lambda t: escaped(t.text)).alias("texts"),
        F.transform("turns", lambda t: closing(t.role)).alias("after"),
    )
    parts = F.arrays_zip("before", "texts", "after")
    made = made.select("conv_id", "replies", "before", "texts", "after", F.transform(parts, lambda p: F.concat(p.before, p.texts, p.after)).alias("whole"))
    each = made.select("*", F.posexplode("replies").alias("at", "reply")).where(F.col("reply") | (F.col("at") == F.size("whole") - 1))
    prefix = F.array_join(F.slice("whole", F.lit(1), F.col("at")), "")
    here = lambda c: F.get(c, F.col("at"))
    return each.select(
        "conv_id",
        (F.col("at") + 1).alias("place"),
        F.concat(prefix, here("whole")).alias("formatted"),
        F.when(F.col("reply"), F.length(prefix) + F.length(here("before"))).otherwise(0).alias("loss_start"),
        F.when(F.col("reply"), F.length(here("texts"))).otherwise(0).alias("loss_length"),
        (F.col("at") == F.size("whole") - 1).alias("is_last"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds, in order."""

    def inner(turn: Column, opened: Column, closed: int) -> Column:
        return unescaped(F.substring(turn, opened + 1, F.length(turn) - opened - closed))

    def parsed(turn: Column) -> Column:
        known = [
            F.when(
                turn.startswith(opened),
                F.struct(F.lit(name).alias("role"), inner(turn, F.lit(len(opened)), len(closed)).alias("text")),
            )
            for name, (opened, closed) in MARKS.items()
        ]
        end = F.instr(turn, ROLE_END)
        role = unescaped(F.substring(turn, F.lit(len(ROLE) + 1), end - len(ROLE) - 1))
        text = inner(turn, end + len(ROLE_END) - 1, len(TURN_END))
        return F.coalesce(*known, F.struct(role.alias("role"), text.alias("text")))

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), 0), parsed)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation: its turns' number and hash, what is under the loss mask, and the length of its examples."""
    masked = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length"))
    turns = F.when(F.col("is_last"), turns_of(F.col("formatted")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    read = examples.select(
        "conv_id", "place", F.length("formatted").alias("chars"), unescaped(masked).alias("loss"), turns.alias("turns")
    )
    read = read.select("conv_id", "place", "chars", "loss", F.size("turns").alias("n"), F.sha2(lines, 256).alias("h"))
    loss = F.array_join(F.array_sort(F.collect_list(F.struct("place", "loss")))["loss"], "")
    return (
        read.groupBy("conv_id")
        .agg(F.max("n").cast("long").alias("n_turns"), F.max("h").alias("turns_sha256"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.col("formatted_chars").cast("long").alias("formatted_chars"),
        )
    )
