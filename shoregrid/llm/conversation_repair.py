"""Repair of conversations: the cheapest edits after which the roles read `(s?(ua)+)?`, by interval parsing.

The grammar is in Chomsky normal form. A nonterminal (p, q) stands for the rows between two states of the
wanted pattern, a state being the last role's initial (0: none yet):

    (p, q) -> (p, r) (r, q)        for every state r
    (p, q) -> one row              kept, given another role, or deleted
    whole  -> (0, 0) | (0, a)

A span of rows has one cell per nonterminal: the least (cost, audit), the audit being the initials of its edits.
Insertions are closed over: the cell of a row also holds what may be inserted on either side of it. Spans are
combined bottom-up by their length, 1, 2, 4 and so on. As the grammar derives a string by any split of it, one split
of a span gives its cell, so a conversation costs as many combinations as it has rows. Of two audits
of equal cost for the same rows neither is the beginning of the other, so the least of a whole is made of the least of its parts.

Rows are put into blocks of at most BLOCK_ROWS neighbours. A block's cells are made in a task of their own, and
only cells are combined per conversation, so a conversation of any length is parsed by many tasks.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.llm.common import ready, written

NEXT = {"0": "su", "s": "u", "u": "a", "a": "u"}
"""The roles that may follow a state; a role's initial is the state it leads to."""
ENDS = "0a"
ROLES = {"u": "user", "a": "assistant"}
"""The roles that an edit can give."""
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL_PAIRS = ("su", "ua", "au")
SPACE = " \t\n\x0b\x0c\r"
MARKS = r"[.!?]"
BLOCK_BITS = 10
BLOCK_ROWS = 1 << BLOCK_BITS

Cells = dict[tuple[str, str], tuple[int, str]]


def combined(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring spans."""
    found: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for (start, q), (more, further) in right.items():
            if start == r:
                whole = (cost + more, audit + further)
                if (p, q) not in found or whole < found[p, q]:
                    found[p, q] = whole
    return found


def _least(cells: Iterator[tuple[tuple[str, str], tuple[int, str]]]) -> Cells:
    found: Cells = {}
    for at, cell in cells:
        found[at] = min(cell, found.get(at, cell))
    return found


@functools.cache
def insertions() -> Cells:
    """The cells of an empty span: what insertions alone can do."""
    once = [((p, q), (INSERT, "I")) for p in NEXT for q in NEXT[p] if q in ROLES]
    found = _least(itertools.chain((((p, p), (0, "")) for p in NEXT), once))
    while (more := combined(found, found)) != found:
        found = more
    return found


@functools.cache
def row_cells(kind: str) -> Cells:
    """The cells of one row. Its kind is its role's initial, in upper case if truncated, o for another, x if it must go."""
    edits = [((p, p), (DELETE, "D")) for p in NEXT]
    if kind != "x":
        price = TRUNCATED if kind.isupper() else 0
        edits += [((p, q), (price, "K")) for p in NEXT for q in NEXT[p] if q == kind.lower()]
        edits += [((p, q), (price + REROLE, "R")) for p in NEXT for q in NEXT[p] if q in ROLES]
    return combined(combined(insertions(), _least(iter(edits))), insertions())


def spanned(cells: list[Cells]) -> Cells:
    """The cells of neighbouring spans taken together, in rounds of twice the length."""
    while len(cells) > 1:
        pairs = [combined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0] if cells else insertions()


@functools.lru_cache(maxsize=4096)
def parsed(kinds: str) -> Cells:
    return spanned([row_cells(k) for k in kinds])


def cheapest(cells: Cells) -> tuple[int, str]:
    return min(cells["0", q] for q in ENDS if ("0", q) in cells)


def steps(audit: str, first: int, place: int, odd: int) -> list[tuple[int | None, int, str, str | None]]:
    """(row, place, edit, role) of every kept or new row of a part of an audit; a kept row keeps its role.

    `place` counts the rows before it; an odd number of rows in all begins with a system row.
    """
    found = []
    for edit in audit:
        if edit != "D":
            role = None if edit == "K" else ROLES["u" if (place + odd) % 2 == 0 else "a"]
            found.append((None if edit == "I" else first, place, edit, role))
            place += 1
        first += edit != "I"
    return found


def parts(audit: str, sizes: list[int]) -> list[tuple[str, int]]:
    """The audit by blocks of so many rows, each with the number of rows that are left or new before it."""
    found, at, place = [], 0, 0
    for block, size in enumerate(sizes):
        start = at
        while size:
            size -= audit[at] != "I"
            at += 1
        if block == len(sizes) - 1:
            at = len(audit)
        part = audit[start:at]
        found.append((part, place))
        place += len(part) - part.count("D")
    return found


def ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, at): all rows, numbered by conversation, turn, role and text, missing values first.

    Numbers grow with the order; neighbours of one partition have consecutive ones. The range partitions
    part a conversation that holds most rows. Written once, so the numbers stay what they are.
    """
    blank = lambda c: F.coalesce(c, F.lit(" ")).alias(c)
    rows = rows.select("conv_id", "turn", blank("role"), blank("text"))
    parted = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    return written(
        parted.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("at", F.monotonically_increasing_id()),
        "ordered-turns",
    )


def marked(turns: DataFrame) -> DataFrame:
    """(conv_id, at, block, initial, fault): the first fault of every row, in so far as it has one.

    The first row of equal ones in a conversation is known by its number, which is unique, so no join meets a large group.
    """
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    seen = turns.select("conv_id", "at", "role", F.sha2("text", 256).alias("key"), last.alias("last"))
    firsts = seen.groupBy("conv_id", "role", "key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    fault = (
        F.when(F.col("last") == "", "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.col("last").rlike(MARKS), "truncated")
        .otherwise("")
    )
    return seen.join(firsts, "at", "left").select(
        "conv_id",
        "at",
        F.shiftright("at", BLOCK_BITS).alias("block"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        fault.alias("fault"),
    )


def block_cells(marks: DataFrame) -> DataFrame:
    """One row per block of a conversation: its cells and what is counted in it."""

    def run(kinds: pd.Series, initials: pd.Series) -> pd.DataFrame:
        illegal = [sum(a + b not in LEGAL_PAIRS for a, b in itertools.pairwise(i)) for i in initials]
        cells = [[(p + q, *cell) for (p, q), cell in parsed(k).items()] for k in kinds]
        return pd.DataFrame({"illegal": illegal, "cells": cells})

    run.__annotations__ = {"kinds": pd.Series, "initials": pd.Series, "return": pd.DataFrame}
    kind = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x")
        .when(F.col("fault") == "truncated", F.upper("initial"))
        .otherwise(F.col("initial"))
    )
    rows = F.array_sort(F.collect_list(F.struct("at", "initial", kind.alias("kind"))))
    counted = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    blocks = marks.groupBy("conv_id", "block").agg(rows.alias("rows"), F.min("at").alias("first"), *counted)
    joined = lambda c: F.array_join(F.col("rows")[c], "")
    found = F.pandas_udf(run, "illegal long, cells array<struct<span: string, cost: long, audit: string>>")
    return blocks.select(
        "conv_id",
        F.struct("block", "first", F.size("rows").alias("size"), joined("initial").alias("initials")).alias("b"),
        found(joined("kind"), joined("initial")).alias("f"),
        "blank",
        "duplicate",
        "truncated",
    )


def solved(blocks: DataFrame) -> DataFrame:
    """One row per conversation: faults, illegal pairs, cost, audit and the parts of the audit by block."""

    def run(spans: pd.Series) -> pd.DataFrame:
        rows = []
        for span in spans:
            cells = [{tuple(c["span"]): (c["cost"], c["audit"]) for c in s["cells"]} for s in span]
            cost, audit = cheapest(spanned(cells))
            odd = (len(audit) - audit.count("D")) % 2
            by_block = [(s["first"], *part, odd) for s, part in zip(span, parts(audit, [s["size"] for s in span]))]
            borders = sum(a["last"] + b["head"] not in LEGAL_PAIRS for a, b in itertools.pairwise(span))
            rows.append((borders, cost, audit, by_block))
        return pd.DataFrame(rows, columns=["borders", "cost", "audit", "parts"])

    run.__annotations__ = {"spans": pd.Series, "return": pd.DataFrame}
    span = F.struct(
        "b.block",
        "b.first",
        "b.size",
        F.substring("b.initials", 1, 1).alias("head"),
        F.substring("b.initials", -1, 1).alias("last"),
        "f.cells",
    )
    spans = F.array_sort(F.collect_list(span))
    counted = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    found = F.pandas_udf(
        run, "borders long, cost long, audit string, parts array<struct<first: long, audit: string, place: long, odd: int>>"
    )
    each = blocks.groupBy("conv_id").agg(*counted, F.sum("f.illegal").alias("inside"), spans.alias("spans"))
    return each.select("conv_id", "blank", "duplicate", "truncated", "inside", found("spans").alias("s")).select(
        "conv_id", "blank", "duplicate", "truncated", (F.col("inside") + F.col("s.borders")).alias("illegal"), "s.cost", "s.audit", "s.parts"
    )


def edited(solutions: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations, row by row."""

    def run(audit: pd.Series, first: pd.Series, place: pd.Series, odd: pd.Series) -> pd.Series:
        return pd.Series([steps(*x) for x in zip(audit, first, place, odd)])

    run.__annotations__ = {"audit": pd.Series, "first": pd.Series, "place": pd.Series, "odd": pd.Series, "return": pd.Series}
    found = F.pandas_udf(run, "array<struct<at: long, place: long, edit: string, role: string>>")
    each = solutions.select("conv_id", F.explode("parts").alias("p"))
    each = each.select("conv_id", F.explode(found("p.audit", "p.first", "p.place", "p.odd")).alias("e")).select("conv_id", "e.*")
    new = each.where("edit = 'I'").select("conv_id", "place", "edit", "role", F.lit("").alias("text"))
    texts = turns.select("at", F.col("role").alias("own"), "text")
    old = each.where("edit <> 'I'").join(texts, "at")
    return old.select("conv_id", "place", "edit", F.coalesce("role", "own").alias("role"), "text").unionByName(new)


def repaired(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows (conv_id, place, edit, role, text) and one row per conversation.

    The second table has conv_id, the counts blank, duplicate, truncated and illegal (longs), cost (long), audit
    (string) and gaps (long): turn numbers missing between the least and the largest.

    Rows are taken by turn, role and text, missing turns first. A missing role or text is one space, so the row is blank or has
    no known role; so has one with an empty role. Missing conv_ids are one conversation. Rows that repeat another
    one of the conversation are duplicates, whatever their turns. Very long texts are judged whole. An empty
    table gives two empty tables. Further columns are not read.
    """
    ready(conversations.sparkSession)
    turns = ordered(conversations)
    solutions = written(solved(block_cells(marked(turns))), "solutions")
    numbers = turns.groupBy("conv_id").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_distinct("turn").alias("n"))
    gaps = numbers.select(F.col("conv_id").alias("id"), F.coalesce(F.expr("hi - lo + 1 - n"), F.lit(0)).alias("gaps"))
    summary = solutions.drop("parts").join(gaps, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
    return edited(solutions, turns), summary


def hashed(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of `role:text` by place, joined by newlines.

    A hash takes its bytes one after the other, so each conversation streams through one task, a batch at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, digest = None, None
        for batch in batches:
            done = []
            for conv_id, line in zip(batch["conv_id"].astype("object"), batch["line"]):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if digest is None or conv_id != held:
                    if digest is not None:
                        done.append((held, digest.hexdigest()))
                    held, digest = conv_id, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
            yield pd.DataFrame(done, columns=["conv_id", "repaired_sha256"]).astype({"conv_id": "Int64"})
        if digest is not None:
            yield pd.DataFrame([(held, digest.hexdigest())], columns=["conv_id", "repaired_sha256"]).astype({"conv_id": "Int64"})

    lines = rows.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    placed = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return placed.select("conv_id", "line").mapInPandas(run, "conv_id long, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that a checksum of conversation and turn deals out: dropped, emptied, stripped of marks, repeated, given to the user."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    number = F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(number) % 20).alias("case")).where("case <> 0")
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", MARKS, "")).otherwise(F.col("text"))
    role = F.when(F.col("case") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("case") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")
