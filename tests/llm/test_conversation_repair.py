"""Repair of conversations against a full chart parse and against the SQL text on odd rows."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shoregrid.llm import conversation_repair as repair
from shoregrid.llm import queries

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def full_chart(kinds):
    """All spans with all their splits, by growing length: the plain form of the parse."""
    if not kinds:
        return repair.insertions()
    cells = {(i, i + 1): repair.row_cells(k) for i, k in enumerate(kinds)}
    for length in range(2, len(kinds) + 1):
        for i in range(len(kinds) - length + 1):
            found = {}
            for k in range(i + 1, i + length):
                for at, cell in repair.combined(cells[i, k], cells[k, i + length]).items():
                    found[at] = min(cell, found.get(at, cell))
            cells[i, i + length] = found
    return cells[0, len(kinds)]


def all_edits(kinds, most=2):
    """The least (cost, audit) of every way to edit, with up to so many insertions in a gap."""
    best = None
    options = {}
    for kind in set(kinds):
        price = 5 if kind.isupper() else 0
        options[kind] = [("D", 2, "")]
        if kind != "x":
            options[kind] += [("K", price, kind.lower()), ("R", price + 1, "u"), ("R", price + 1, "a")]
    gaps = [("I" * n, 5 * n, "".join(r)) for n in range(most + 1) for r in itertools.product("ua", repeat=n)]
    for chosen in itertools.product(gaps, *itertools.chain(*[(options[k], gaps) for k in kinds])):
        roles = "".join(c[2] for c in chosen)
        pairs = roles.removeprefix("s") if roles != "s" else "s"
        if pairs == "ua" * (len(pairs) // 2) and (pairs or not roles):
            found = (sum(c[1] for c in chosen), "".join(c[0] for c in chosen))
            best = min(best or found, found)
    return best


def test_parse_equals_every_edit_and_full_chart():
    for kinds in itertools.chain(*[itertools.product("suaoxSUA", repeat=n) for n in (1, 2)]):
        assert repair.cheapest(repair.parsed("".join(kinds))) == all_edits(kinds), kinds
    for kinds in ("sua", "aua", "uxa", "sss", "aUs", "uuA"):
        assert repair.cheapest(repair.parsed(kinds)) == all_edits(kinds, 1), kinds
    draw = random.Random(5)
    for n in [*range(1, 20), 33, 40]:
        kinds = "".join(draw.choices("suaoxSUAO", k=n))
        assert repair.parsed(kinds) == full_chart(kinds)


def test_spans_may_be_cut_anywhere():
    draw = random.Random(6)
    kinds = "".join(draw.choices("suaoxSUAO", k=90))
    whole = repair.parsed(kinds)
    for size in (1, 7, 32, 89):
        blocks = [repair.parsed(kinds[i : i + size]) for i in range(0, len(kinds), size)]
        assert repair.spanned(blocks) == whole
        audit = repair.cheapest(whole)[1]
        found = repair.parts(audit, [len(kinds[i : i + size]) for i in range(0, len(kinds), size)])
        assert "".join(part for part, _ in found) == audit
        kept = [len(part) - part.count("D") for part, _ in found]
        assert [place for _, place in found] == [sum(kept[:i]) for i in range(len(kept))]


def plain(rows):
    """All digest columns of the contract for the rows of one conversation, in plain Python."""
    name = lambda v: " " if v is None else v
    made = []
    for conv_id, turn, role, text in rows:
        case = zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        text = {1: "", 2: text.replace(".", "").replace("!", "").replace("?", "")}.get(case, text)
        made += [(turn, "user" if case == 4 else role, text)] * {0: 0, 3: 2}.get(case, 1)
    if not made:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    kinds, faults, seen = "", [], set()
    for _, role, text in made:
        last = text.rstrip(SPACE)[-1:]
        fault = "b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        kinds += "x" if fault in ("b", "d") else initial.upper() if fault else initial
    cost, audit = repair.cheapest(full_chart(kinds))
    initials = [r[:1] for _, r, _ in made]
    numbers = [t for t, _, _ in made if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    left, lines = iter(made), []
    odd = (len(audit) - audit.count("D")) % 2
    for edit in audit:
        row = None if edit == "I" else next(left)
        if edit != "D":
            role = row[1] if edit == "K" else "user" if (len(lines) + odd) % 2 == 0 else "assistant"
            lines.append(f"{role}:{row[2] if row else ''}")
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    counts = [faults.count(f) for f in "bdt"]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def odd_rows():
    draw = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "user"]
    texts = ["Yes.", "No!", "Why", "Why?\n ", " \t\n", "", None, "é.", "x" * 50_000 + ".", "a\x0b", "a.\x0c"]
    rows = [
        (c, draw.choice([None, 0, 1, 2, 3, 5, 9, t]), draw.choice(roles), draw.choice(texts))
        for c in [*range(60), None]
        for t in range(draw.randrange(1, 9))
    ]
    return rows + rows[::7] + [(99, t, "user", f"{t}.") for t in range(90)]


def results(spark, rows, tmp_path, monkeypatch):
    made = spark.createDataFrame(rows, SCHEMA)
    made = made.select(F.lit(1).alias("at"), F.lit("x").alias("block"), *made.columns, F.lit(2).alias("place"), F.lit(3).alias("edit"))
    made.write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_conversation_repair(spark, str(tmp_path))
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in found.collect()}


@pytest.mark.parametrize("bits", [10, 2])
def test_query_on_odd_rows(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = odd_rows()
    found = results(spark, rows, tmp_path, monkeypatch)
    assert found == {c: plain([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}


def test_empty_table(spark, tmp_path, monkeypatch):
    assert results(spark, [], tmp_path, monkeypatch) == {}


def test_sql_on_odd_rows(spark, tmp_path, monkeypatch):
    import duckdb

    rows = odd_rows()
    found = results(spark, rows, tmp_path, monkeypatch)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(queries.SQL["op11_conversation_repair"]).fetchall()
    assert found == {r[0]: tuple(r[1:]) for r in want}


def test_repaired_rows_follow_the_pattern(spark):
    rows, summary = repair.repaired(spark.createDataFrame(odd_rows(), SCHEMA))
    roles = {}
    for r in sorted(rows.collect(), key=lambda r: r.place):
        roles.setdefault(r.conv_id, []).append(r.role)
        assert len(roles[r.conv_id]) == r.place + 1
    assert summary.count() == 62
    for found in roles.values():
        tail = found[1:] if found[0][0] == "s" else found
        assert [x[0] for x in tail] == ["u", "a"] * (len(tail) // 2) and tail
