"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and the groups they form.

SimHash comes first: sets whose 64-bit fingerprints over these shingles differ in at most two bits, found by the
tables of `simhash`, are compared in full and grouped if they are similar. Similar sets can differ in more
bits than tables can look up (11 on sf0.1, where 2 bits reach 1 of 48 links), so an exact join with a
prefix filter finds the links that are left. All shingles are put into one order, those common in a sample last; two sets
this similar share one of the first fifth of either. Texts that share such a shingle are candidates if their
sizes and its places leave room for enough common shingles (length and positional filters), if their prefixes share
as many as that takes, and if the sketches of their sets, counts by hash bucket, differ by no more than sets so
similar can. Parities of smaller buckets, four longs, go with each shingle, so sets that share a passage
but little else are parted inside the join already. What is left is compared in full.
The order decides only how many candidates there are, so the sample loses no link.

Texts with equal sets are folded first. Before all candidates are listed, fingerprints link sets, every shingle links the texts that hold
it to one of them, then every set to the best ones outside its group, and what is thereby in one group is not paired
again: a large group of near copies is mostly joined before its pairs are listed. Sets that share much of their prefixes
without being similar, or that are linked in none of these turns, are still compared pair by pair, as the result is exact.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoregrid.llm import simhash
from shoregrid.llm.common import Scratch, ready, release, words, written
from shoregrid.llm.components import components

SEED = 42
SHINGLE_WORDS = 5
SAMPLED = 64
"""One text of so many (by hash) is sampled for common shingles."""
MAX_COMMON = 100_000
BUCKETS = 128
PARITIES = tuple(f"p{i}" for i in range(4))
"""Longs that hold whether a set has an odd number of shingles in each of 64 buckets."""
BEST = 8
TURNS = ("simhash", "star", "best", "all")
"""How candidates are chosen, one turn after the other; the last one takes all that are left."""
PAIR_ROWS = 16
"""Pairs of one Arrow batch: each has two whole sets."""


def shingles(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; a shorter text is one shingle, one without words has none."""
    w = words(text)
    if not w:
        return np.zeros(0, np.int64)
    parts = [b" ".join(w)] if len(w) <= size else map(b" ".join, zip(*(itertools.islice(w, i, None) for i in range(size))))
    n = max(1, len(w) - size + 1)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n).view(np.int64))


def similar(shared: int, a: int, b: int) -> bool:
    """Is the Jaccard similarity of sets of sizes a and b that share so many 0.8 or more? In whole numbers."""
    return 9 * shared >= 4 * (a + b)


def prefix_length(size: int) -> int:
    return size - (4 * size + 4) // 5 + 1 if size else 0


def prefix(found: np.ndarray, common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first shingles of a set; `common` is sorted, `ranks` has the places of its values at the order's end."""
    rank = np.zeros(len(found), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        rank = np.where(common[at] == found, ranks[at], 0)
    return found[np.lexsort((found, rank))][: prefix_length(len(found))]


def sketch(found: np.ndarray) -> bytes:
    """How many of a set's shingles fall in each bucket, 255 at most: two sets differ in at least what these differ by."""
    return np.minimum(np.bincount(found & (BUCKETS - 1), minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def parities(found: np.ndarray) -> list[int]:
    """Is the number of a set's shingles in each bucket odd? Two sets differ in at least as many as these bits do."""
    n = 64 * len(PARITIES)
    odd = np.bincount(found >> 8 & (n - 1), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of three or more sampled texts, and their ranks from 1 on, the most common last; at most MAX_COMMON."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t or "") for t in texts])

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).select("text").distinct()
    each = sample.select(F.explode(F.pandas_udf(run, "array<long>")("text")).alias("shingle"))
    counted = each.groupBy("shingle").count().where("count > 2").orderBy(F.desc("count"), "shingle").limit(MAX_COMMON)
    found = np.array([r.shingle for r in counted.collect()], np.int64)
    order = np.argsort(found)
    return found[order], (len(found) - np.arange(len(found)))[order]


def marked_rows(docs: DataFrame) -> DataFrame:
    """(row, _class, _size, _sketch, _fp, p0.., _row): the row, a hash of its set, what is known of the set, a number; written once."""
    ready(docs.sparkSession)

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = shingles(text or "")
            of = int.from_bytes(xxhash.xxh64(found.tobytes(), seed=SEED).digest(), "big", signed=True)
            fp = simhash.of_hashes(found.view(np.uint64))
            rows.append((of, len(found), sketch(found), fp, *parities(found)))
        return pd.DataFrame(rows, columns=["_class", "_size", "_sketch", "_fp", *PARITIES])

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    schema = "_class long, _size int, _sketch binary, _fp long, " + ", ".join(f"{p} long" for p in PARITIES)
    found = F.pandas_udf(run, schema)("text").alias("_f")
    made = docs.select(row, found).select("row", "_f.*")
    return written(made.withColumn("_row", F.monotonically_increasing_id()), "shingled")


def prefixes(marked: DataFrame) -> DataFrame:
    """(c, prefix): the prefix of the set of every row whose text has words; not written."""
    common, ranks = common_shingles(marked.select("row.text"))

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([prefix(shingles(t or ""), common, ranks) for t in texts])

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    found = F.pandas_udf(run, "array<long>")("row.text").alias("prefix")
    return marked.where("_size > 0").select(F.col("_class").alias("c"), found)


def shared_entries(marked: DataFrame) -> DataFrame:
    """(token, c, n, at, p0..): the prefix shingles that two or more sets have in their prefixes; a row for each set."""
    scratch = Scratch(marked.sparkSession)
    # prefixes are a third of the input and needed here only, so they do not lie with the rows until the end
    made = scratch.written(prefixes(marked), "prefixes")
    entry = ["c", F.posexplode("prefix").alias("at", "token")]
    # copies need not be folded here: they have the same set
    seen = made.select(*entry).groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    held = scratch.written(seen.where("lo <> hi").select("token"), "held")
    release(marked.sparkSession)
    # most shingles are in one set only, so what else is known of a set is joined to the entries that are left
    entries = made.dropDuplicates(["c"]).select(*entry)
    left = scratch.written(entries.join(held, "token").select("token", "c", "at"), "left")
    release(marked.sparkSession)
    sets = marked.where("_size > 0").select(F.col("_class").alias("c"), F.col("_size").alias("n"), *PARITIES).dropDuplicates(["c"])
    found = written(left.join(sets, "c").select("token", "c", "n", "at", *PARITIES), "entries")
    scratch.clear()
    return found


SIDE = ("c", "n", "at", *PARITIES, "g")


def room() -> Column:
    """Can sets a and b that share a shingle at these places still be similar enough, by their parities too?"""
    most = "least(at_a, at_b) + 1 + least(n_a - at_a - 1, n_b - at_b - 1)"
    apart = " + ".join(f"bit_count({p}_a ^ {p}_b)" for p in PARITIES)
    return F.expr(
        f"5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b) AND 9 * ({most}) >= 4 * (n_a + n_b) AND 9 * ({apart}) <= n_a + n_b"
    )


def parted(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The entries with the group `g` of each set, of shingles that two or more groups still hold."""
    if labels is None:
        return entries.withColumn("g", F.col("c"))
    named = entries.join(labels.select(F.col("node").alias("c"), "root"), "c", "left")
    named = named.select("token", *SIDE[:-1], F.coalesce("root", "c").alias("g"))
    held = named.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("token")
    return named.join(held, "token").select("token", *SIDE)


def _side(entries: DataFrame, of: str) -> DataFrame:
    """One side of a join of entries, never broadcast: what is known of a set repeats, so files are a tenth of the rows in memory."""
    return entries.select("token", *[F.col(x).alias(f"{x}_{of}") for x in SIDE]).hint("merge")


def enough(shared: str) -> Column:
    """Can sets a and b be similar enough that share so many shingles of their prefixes?

    What else they share lies behind the end of the prefix that ends first, so in the rest of that set.
    """
    rest = "(4 * n_{0} + 4) div 5 - 1"
    return F.expr(f"9 * ({shared} + greatest({rest.format('a')}, {rest.format('b')})) >= 4 * (n_a + n_b)")


def fingerprint_pairs(marked: DataFrame, written: Callable[[DataFrame, str], DataFrame] = written) -> DataFrame:
    """(a, b): sets whose SimHash fingerprints differ in at most `simhash.MAX_BITS` bits, by one set of each fingerprint."""
    sets = marked.select("_class", "_fp").where("_size > 0").dropDuplicates(["_class"])
    firsts = written(sets.groupBy("_fp").agg(F.min("_class").alias("first")), "fingerprints")
    same = sets.join(firsts, "_fp").where("_class <> first").select(F.col("first").alias("a"), F.col("_class").alias("b"))
    near = simhash.links(firsts, "_fp", written)
    for of in ("a", "b"):
        near = near.join(firsts.select(F.col("_fp").alias(of), F.col("first").alias(f"c_{of}")), of)
    return same.union(near.select(F.least("c_a", "c_b"), F.greatest("c_a", "c_b")))


def star_pairs(entries: DataFrame) -> DataFrame:
    """(a, b): every set with one that leads enough of its shingles in its band of sizes, that of the most such shingles.

    The leaders are few, the same for many shingles.
    """
    band = F.floor(F.log("n") / F.log(F.lit(1.25))).alias("band")
    banded = entries.select("*", band)
    pick = F.min(F.struct(F.xxhash64("c").alias("o"), *[F.col(x) for x in SIDE])).alias("l")
    led = banded.groupBy("token", "band").agg(pick)
    led = led.select("token", "band", *[F.col(f"l.{x}").alias(f"{x}_b") for x in SIDE])
    left = banded.select("token", "band", *[F.col(x).alias(f"{x}_a") for x in SIDE])
    met = left.hint("merge").join(led.hint("merge"), ["token", "band"]).where(F.expr("g_a <> g_b") & room())
    shared = met.groupBy("c_a", "c_b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("shared"))
    best = shared.where(enough("shared")).groupBy("c_a").agg(F.max(F.struct("shared", "c_b")).alias("l"))
    return best.select(F.least("c_a", "l.c_b").alias("a"), F.greatest("c_a", "l.c_b").alias("b")).distinct()


def met(entries: DataFrame) -> DataFrame:
    """The entries of two sets of different groups that share a shingle and have room to be similar."""
    return _side(entries, "a").join(_side(entries, "b"), "token").where(F.expr("c_a < c_b AND g_a <> g_b") & room())


def all_pairs(entries: DataFrame) -> DataFrame:
    """(a, b, share), a < b: all sets of different groups whose prefixes share enough, with room to be similar."""
    shared = met(entries).groupBy("c_a", "c_b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("shared"))
    share = (F.col("shared") / (F.col("n_a") + F.col("n_b"))).alias("share")
    return shared.where(enough("shared")).select(F.col("c_a").alias("a"), F.col("c_b").alias("b"), share)


def best_pairs(entries: DataFrame) -> DataFrame:
    """(a, b): every set with the BEST ones outside its group that share the largest parts of both prefixes."""
    pairs = all_pairs(entries)
    both = pairs.select("a", "b", "share").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "share"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("share"), "b"))
    best = both.withColumn("place", place).where(F.col("place") <= BEST)
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def set_table(marked: DataFrame) -> DataFrame:
    """(c, r, n, k): every distinct set with its first row, its size and its sketch."""
    sets = marked.select(F.col("_class").alias("c"), F.struct(F.col("_row").alias("r"), F.col("_size").alias("n"), F.col("_sketch").alias("k")).alias("f"))
    return written(sets.groupBy("c").agg(F.min("f").alias("f")).select("c", "f.*"), "sets")


def near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, r_a, r_b): the pairs, and their rows, whose sketches leave it open that they are similar enough."""

    def run(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(k), np.uint8).reshape(-1, BUCKETS).astype(np.int16) for k in (a, b))
        return pd.Series(9 * np.abs(x - y).sum(axis=1, dtype=np.int64) <= n.to_numpy())

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "n": pd.Series, "return": pd.Series}
    met = pairs
    for of in ("a", "b"):
        met = met.join(sets.select(F.col("c").alias(of), *[F.col(x).alias(f"{x}_{of}") for x in ("r", "n", "k")]), of)
    # of n_a + n_b shingles at most a ninth may be in one set only
    open_ = F.pandas_udf(run, "boolean")("k_a", "k_b", F.expr("n_a + n_b"))
    return met.where(open_).select("a", "b", "r_a", "r_b")


def verified(pairs: DataFrame, sets: DataFrame, marked: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): the pairs whose whole sets are similar enough."""

    def whole(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t or "").tobytes() for t in texts])

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        both = ((np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)) for x, y in zip(a, b))
        return pd.Series([similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in both], dtype=bool)

    whole.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    left = scratch.written(near(pairs, sets), "near")
    needed = left.select(F.col("r_a").alias("_row")).union(left.select("r_b")).distinct()
    texts = marked.select("_row", F.col("row.text").alias("text")).join(scratch.written(needed, "needed"), "_row")
    held = scratch.written(texts.select("_row", F.pandas_udf(whole, "binary")("text").alias("s")), "whole")
    release(marked.sparkSession)
    ready(marked.sparkSession, PAIR_ROWS)
    for of in ("a", "b"):
        left = left.join(held.select(F.col("_row").alias(f"r_{of}"), F.col("s").alias(f"s_{of}")), f"r_{of}")
    found = written(left.where(F.pandas_udf(run, "boolean")("s_a", "s_b")).select("a", "b"), "verified")
    ready(marked.sparkSession)
    return found


def candidates(turn: str, marked: DataFrame, entries: DataFrame, labels: DataFrame | None, scratch: Scratch) -> DataFrame:
    """(a, b): the pairs of sets that a turn compares."""
    if turn == "simhash":
        return fingerprint_pairs(marked, scratch.written)
    left = scratch.written(parted(entries, labels), "parted")
    if turn == "all":
        return all_pairs(left).select("a", "b")
    return star_pairs(left) if turn == "star" else best_pairs(left)


def grouped(marked: DataFrame) -> DataFrame:
    """(node, root) for every set that is linked to another, directly or through further ones.

    What a turn writes is deleted when its links and the groups they make are known.
    """
    spark = marked.sparkSession
    entries, sets = shared_entries(marked), set_table(marked)
    links, labels = None, None
    for turn in TURNS:
        scratch = Scratch(spark)
        pairs = scratch.written(candidates(turn, marked, entries, labels, scratch), "pairs")
        more = verified(pairs, sets, marked, scratch)
        links = more if links is None else links.unionByName(more)
        labels = written(components(links, written=scratch.written), "groups")
        scratch.clear()
    return labels


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each group with all its columns: the one of smallest doc_id (null ids last).

    A group is what links of similarity 0.8 or more reach; texts without words are one group. Of rows that
    repeat the smallest id in the group one is kept. Further columns, whatever their names, are carried along.
    """
    marked = marked_rows(docs)
    order = F.struct(F.col("row.doc_id").isNull().alias("n"), F.col("row.doc_id").alias("doc_id"), "_row")
    firsts = marked.groupBy(F.col("_class").alias("node")).agg(F.min(order).alias("first"))
    rooted = firsts.join(grouped(marked), "node", "left").select(F.coalesce("root", "node").alias("root"), "first")
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first._row").alias("_row"))
    # the dropped rows are the smaller side of the last join, the only one that meets all texts
    dropped = written(marked.select("_row").join(written(kept, "kept"), "_row", "left_anti"), "dropped")
    return marked.join(dropped, "_row", "left_anti").select("row.*")
