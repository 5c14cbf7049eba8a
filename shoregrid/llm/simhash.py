"""SimHash fingerprints, and the groups they form, found by tables of distances to reference fingerprints.

Fingerprints are deduplicated first: the search sees each distinct value once, so copies never make
pairs. The table of a fingerprint holds its Hamming distances to REFERENCES fixed fingerprints, in
all and split by byte. Two fingerprints that differ in at most two bits agree in at least six of
eight bytes, hence in all distances there. So each fingerprint is filed once for every choice of
two bytes to leave out, under the distances of the other six; within a file, pairs whose distances to
any reference differ by more than two are discarded (triangle inequality), survivors are verified.

A file holds at most 2^16 distinct fingerprints (two free bytes) and a fingerprint has at most 2,080
others within two bits, whatever the number of documents: neither grows with a group of copies.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.llm.common import ready, words, written
from shoregrid.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
REFERENCES = 15
_BYTES = 8


def _bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, most significant first."""
    big = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(big), 1 << 14):
        total += np.unpackbits(big[start : start + (1 << 14)], axis=1).sum(axis=0, dtype=np.int32)
    return total


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles (repeats count) of a text; zero for a text without words."""
    w = words(text)
    if not w:
        return 0
    if len(w) <= shingle:
        parts = [b" ".join(w)]
    else:
        parts = map(b" ".join, zip(*(itertools.islice(w, i, None) for i in range(shingle))))
    n = max(1, len(w) - shingle + 1)
    return of_hashes(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n))


def of_hashes(hashes: np.ndarray) -> int:
    """The fingerprint of shingles given as unsigned hashes: a bit is 1 if it is set in over half of them."""
    return int.from_bytes(np.packbits(2 * _bits(hashes) > len(hashes)).tobytes(), "big", signed=True)


def references(n: int = REFERENCES) -> list[int]:
    """The reference fingerprints: hashes of their numbers, as signed longs."""
    return [
        int.from_bytes(xxhash.xxh64(i.to_bytes(4, "little"), seed=SEED).digest(), "big", signed=True)
        for i in range(n)
    ]


def byte_distances(byte: int, refs: list[int]) -> str:
    """SQL: distances of one byte of fp to that byte of the references, four bits each."""
    at = f"shiftrightunsigned(fp, {8 * byte})"
    return " | ".join(
        f"shiftleft(CAST(bit_count(({at} ^ {(r >> (8 * byte)) & 255}L) & 255L) AS BIGINT), {4 * i})"
        for i, r in enumerate(refs)
    )


def whole_distances(refs: list[int]) -> list[str]:
    """SQL: distances of fp to all references, eight to a long."""
    return [
        " | ".join(
            f"shiftleft(CAST(bit_count(fp ^ ({r}L)) AS BIGINT), {8 * j})"
            for j, r in enumerate(refs[i : i + 8])
        )
        for i in range(0, len(refs), 8)
    ]


def within_bound(n: int, bound: int) -> str:
    """SQL: do the distances packed in ta0, ta1.. and tb0, tb1.. all differ by at most the bound?"""
    return " AND ".join(
        f"abs((shiftrightunsigned(ta{i // 8}, {8 * (i % 8)}) & 255L)"
        f" - (shiftrightunsigned(tb{i // 8}, {8 * (i % 8)}) & 255L)) <= {bound}"
        for i in range(n)
    )


def links(
    fingerprints: DataFrame, fp: str = "fp", written: Callable[[DataFrame, str], DataFrame] = written
) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints that differ in at most MAX_BITS bits. `written` writes a copy."""
    refs = references()
    base = fingerprints.select(F.col(fp).alias("fp")).where("fp IS NOT NULL").distinct()
    whole = [f"t{i}" for i in range(len(whole_distances(refs)))]
    keys = [
        f"xxhash64({8 * out[0] + out[1]}, {', '.join(f'd{k}' for k in range(_BYTES) if k not in out)})"
        for out in itertools.combinations(range(_BYTES), MAX_BITS)
    ]
    rows = base.selectExpr(
        "fp",
        *[f"{e} AS {t}" for e, t in zip(whole_distances(refs), whole)],
        *[f"{byte_distances(k, refs)} AS d{k}" for k in range(_BYTES)],
    )
    filed = written(rows, "pivots").selectExpr("fp", *whole, f"explode(array({', '.join(keys)})) AS key")
    left = filed.withColumnsRenamed({"fp": "a", **{t: f"ta{t[1:]}" for t in whole}})
    right = filed.withColumnsRenamed({"fp": "b", "key": "key_b", **{t: f"tb{t[1:]}" for t in whole}})
    near = f"key = key_b AND a < b AND {within_bound(len(refs), MAX_BITS)} AND bit_count(a ^ b) <= {MAX_BITS}"
    # pivots take a few bytes each in their files, their 28 filed rows over a kilobyte: by the planner's size they would be broadcast
    return left.hint("merge").join(right.hint("merge"), F.expr(near)).select("a", "b").distinct()


def fingerprints(column: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t or "") for t in column], dtype="int64")


def fingerprinted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(row, _fp, _row): the named columns as a struct, the fingerprint, a row number; written once.

    The number is stored, so what refers to it later stays right when tasks run again.
    """
    ready(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    made = docs.select(row, F.pandas_udf(fingerprints, "long")("text").alias("_fp"))
    return written(made.withColumn("_row", F.monotonically_increasing_id()), "fingerprints")


def roots(marked: DataFrame) -> DataFrame:
    """(_fp, _root): the smallest fingerprint reachable from each distinct one."""
    linked = components(links(marked, "_fp")).select(F.col("node").alias("_fp"), F.col("root").alias("_root"))
    return (
        marked.select("_fp")
        .distinct()
        .join(linked, "_fp", "left")
        .select("_fp", F.coalesce("_root", "_fp").alias("_root"))
    )


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links of at most MAX_BITS differing bits reach, the
    document's own included. Null texts count as empty; all texts without words share fingerprint
    zero. Rows with a null doc_id take part; a component of nothing else has a null component_id.
    Repeated rows stay, with equal results. Other columns of the input are not read.
    """
    marked = fingerprinted(docs, ["doc_id"])
    classes = marked.groupBy("_fp").agg(F.min("row.doc_id").alias("_first"))
    rooted = written(classes.join(roots(marked), "_fp"), "rooted")
    least = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = written(rooted.join(least, "_root").select("_fp", "component_id"), "named")
    return marked.join(named, "_fp").select(
        F.col("row.doc_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each group with all its columns: the one of smallest doc_id (null ids last).

    Of rows that repeat this id in the group one is kept. Further columns, whatever their names,
    are carried along.
    """
    marked = fingerprinted(docs, docs.columns)
    ids = marked.select("_fp", "_row", F.col("row.doc_id").alias("doc_id")).join(roots(marked), "_fp")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row")
    kept = ids.groupBy("_root").agg(F.min(order).alias("first")).select(F.col("first._row").alias("_row"))
    # the dropped rows are the smaller side of the last join, the only one that meets the texts
    dropped = written(marked.select("_row").join(written(kept, "kept"), "_row", "left_anti"), "dropped")
    return marked.join(dropped, "_row", "left_anti").select("row.*")
