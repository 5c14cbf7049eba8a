"""The filter audit against filters applied one by one."""

import itertools
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from shoregrid.llm import filter_audit, queries

LONG = " ".join(f"word{i}" for i in range(250))
TEXTS = [LONG, LONG + " $", LONG.upper(), "same " * 300, "Short Text", "", None, " \n\t", "é" * 1000, "A" * 3, LONG + "\x0bx\x0cy\rz", "a|b " * 40_000]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def rows():
    found = [(i, TEXTS[i % len(TEXTS)], [None, "", "a", "a", "b"][i % 5]) for i in range(60)]
    return [*found, *found[:9], (None, LONG, "a"), (None, "nobody's", "c"), (None, "nobody's", "c"), (-3, "nobody's", "only")]


LABELS = [(0, 1, 0), (0, 0, 1), (3, None, 1), (4, 1, 1), (7, 1, None), (None, 1, 1), (-3, 1, 0), (500, 1, 1)]


def plain(docs, labels):
    fails, found = [], {}
    for doc_id, text, part in docs:
        text = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
        failed = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs),
        }
        good = any(i == doc_id and q == 1 for i, q, _ in labels if i is not None)
        toxic = any(i == doc_id and t == 1 for i, _, t in labels if i is not None)
        fails.append((part or "", {f for f, x in failed.items() if x}, good, toxic))
    for part, order in itertools.product({p for p, *_ in fails}, itertools.permutations("ABCDE")):
        left = [x for x in fails if x[0] == part]
        gone = []
        for step, f in enumerate(order, 1):
            removed = [x for x in left if f in x[1]]
            redundant = sum(f in x[1] for x in gone)
            left = [x for x in left if f not in x[1]]
            gone += removed
            alone = sum(x[1] == {f} for x in left + gone)
            found[part, "".join(order), step] = [len(left), len(removed), redundant, alone, sum(x[2] for x in removed), sum(x[3] for x in removed)]
    total = {}
    for (part, order, step), c in found.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + c[1]
    return {k: (*c, total[k[0], k[1][k[2] - 1]]) for k, c in found.items()}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    return docs.select(F.lit(1).alias("mask"), *docs.columns, F.lit("x").alias("part"), F.lit(2).alias("key")), labels.withColumn("text", F.lit("x"))


def read(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in df.collect()}


def test_ranks_and_intervals():
    assert [filter_audit.lehmer_rank(o) for o in filter_audit.ORDERS] == list(range(120)) and filter_audit.ORDERS == sorted(filter_audit.ORDERS)
    for beginning in ("B", "CA", "EDC", "ABDC"):
        held = [i for i, o in enumerate(filter_audit.ORDERS) if o.startswith(beginning)]
        assert held[0] == filter_audit.lehmer_rank(beginning) and held == list(range(held[0], held[0] + len(held)))
    for mask in range(32):
        failed = {f for i, f in enumerate("ABCDE") if mask >> i & 1}
        running = {s: [0, 0, 0] for s in range(1, 6)}
        ends = {(s, r): d for s, r, *d in filter_audit.differences(mask)}
        for rank, order in enumerate(filter_audit.ORDERS):
            for step in range(1, 6):
                running[step] = [a + b for a, b in zip(running[step], ends.get((step, rank), (0, 0, 0)))]
                before, here = failed & set(order[: step - 1]), order[step - 1] in failed
                assert running[step] == [not before and not here, here and not before, here and bool(before)]


def test_equals_filters_one_by_one(tables):
    assert read(filter_audit.audited(*tables)) == plain(rows(), LABELS)


def test_query_equals_sql_on_odd_rows(spark, tables, tmp_path):
    con = duckdb.connect()
    for name, df in zip(("documents", "labels"), tables):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = con.execute(queries.SQL["op13_filter_audit"])
    names = [d[0] for d in want.description]
    want = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COUNTS) for r in (dict(zip(names, x)) for x in want.fetchall())}
    assert read(queries.op13_filter_audit(spark, str(tmp_path))) == want


def test_empty_tables(tables):
    docs, labels = tables
    assert read(filter_audit.audited(docs.limit(0), labels)) == {}
    assert len(read(filter_audit.audited(docs, labels.limit(0)))) == 5 * 600
