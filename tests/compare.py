"""Run queries and their SQL counterparts side by side.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return f"timestamp{'_tz' if t.tz else ''}"
    return {"large_string": "string", "string_view": "string"}.get(str(t), str(t))


def _rows(result: pa.Table) -> list[tuple]:
    names = sorted(result.column_names)
    columns = []
    for name in names:
        column = result.column(name)
        if pa.types.is_timestamp(column.type):
            column = column.cast(pa.timestamp("us", tz=column.type.tz))
        columns.append(column.to_pylist())
    clean = lambda v: 0.0 if isinstance(v, float) and v == 0 else v
    return sorted((tuple(clean(v) for v in row) for row in zip(*columns)), key=repr)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when columns, types and all values agree, else what differs."""
    got = contract.queries()[name](spark, sf_dir).toArrow()
    want = con.execute(contract.oracle_sql()[name]).to_arrow_table()
    types = [
        f"{n}: {_kind(got.schema.field(n).type)} / {_kind(want.schema.field(n).type)}"
        for n in sorted(set(got.column_names) & set(want.column_names))
        if _kind(got.schema.field(n).type) != _kind(want.schema.field(n).type)
    ]
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} / {sorted(want.column_names)}"
    if types:
        return "types " + ", ".join(types)
    a, b = _rows(got), _rows(want)
    if a == b:
        return None if a else "both empty"
    only_a = [r for r, other in zip(a, b) if r != other][:2]
    only_b = [other for r, other in zip(a, b) if r != other][:2]
    return f"rows {len(a)} / {len(b)}; first differences {only_a} / {only_b}"


def main() -> int:
    from shoregrid.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("PARTITIONS", "8"),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for setting in os.environ.get("SETTINGS", "").split():
        spark.conf.set(*setting.split("=", 1))
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as err:  # noqa: BLE001
            problem = "".join(traceback.format_exception(err))[-1500:]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s", problem or "", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
