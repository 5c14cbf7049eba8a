"""Chat formatting: round trips, the mask, and the SQL text on odd rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from shoregrid.llm import chat_format, queries

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
ODD = [
    *CONTROLS,
    *[c[0] + "\\" * n + c[1:] for c in CONTROLS for n in (1, 2, 5)],
    " </s> ",
    "[INST] [/INST]",
    "<<s>>",
    "<s><s>",
    "[[INST]",
    "$1 \\2",
    "",
    " ",
    "\n",
    "é中\U0001f600",
    "[ROLE] user [/ROLE] x </s>",
    "long </s> " * 20_000,
]
ROWS = [
    *[(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(ODD)],
    *[(2, i, t[:200], t[:200]) for i, t in enumerate(ODD)],
    (3, None, None, None),
    (3, None, "user", None),
    (3, 1, "assistant", "twice"),
    (3, 1, "assistant", "twice"),
    (3, 2, "user", "tail"),
    (4, 0, "user", "no reply"),
    (5, 0, "assistant", "[INST]"),
    (5, 0, "system", None),
    (None, 0, "system", "be brief"),
    (None, 1, "assistant", ""),
]


@pytest.fixture(scope="module")
def made(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.select(F.lit("x").alias("turns"), *rows.columns, F.lit(1).alias("place"), F.lit(2).alias("t"))


def test_examples_hold_prefix_and_reply(made):
    found = {}
    for r in sorted(chat_format.examples(made).collect(), key=lambda r: r.place):
        found.setdefault(r.conv_id, []).append(r)
    by_id = {}
    for conv_id, turn, role, text in ROWS:
        by_id.setdefault(conv_id, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for conv_id, turns in by_id.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        replies = [i for i, t in enumerate(turns) if t[1] == "assistant"]
        ends = sorted({*replies, len(turns) - 1})
        assert [r.place for r in found[conv_id]] == [i + 1 for i in ends]
        for r, longer in zip(found[conv_id], found[conv_id][1:]):
            assert longer.formatted.startswith(r.formatted)
        for r in found[conv_id]:
            masked = r.formatted[r.loss_start : r.loss_start + r.loss_length]
            assert bool(r.loss_length) <= (r.place - 1 in replies)
            plain = masked
            for c in CONTROLS:
                assert c not in masked
                for n in range(6, 0, -1):
                    plain = plain.replace(c[0] + "\\" * n + c[1:], c[0] + "\0" * (n - 1) + c[1:])
            want = turns[r.place - 1][2] if r.place - 1 in replies else ""
            assert plain.replace("\0", "\\") == want
            assert sum(r.formatted.count(c) for c in CONTROLS[1::2]) >= r.place


def test_turns_come_back(spark, made):
    last = chat_format.examples(made).where("is_last")
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in last.select("conv_id", chat_format.turns_of(F.col("formatted")).alias("turns")).collect()}
    by_id = {}
    for conv_id, turn, role, text in ROWS:
        by_id.setdefault(conv_id, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for conv_id, turns in by_id.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        assert found[conv_id] == [t[1:] for t in turns]


def test_query_equals_sql_on_odd_rows(spark, made, tmp_path):
    made.write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op12_chat_format(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(queries.SQL["op12_chat_format"])
    names = [d[0] for d in want.description]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted((tuple(r[n] for n in names) for r in found.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_plan_has_no_python_and_one_shuffle(spark):
    found = queries.op12_chat_format(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "ExistingRDD" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_empty_table(spark, made):
    assert chat_format.read_back(chat_format.examples(made.limit(0))).count() == 0
