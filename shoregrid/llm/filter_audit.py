"""Filter interaction audit: what each of five filters removes in every one of their 120 orders.

Documents with the same failures (a mask of filters) fare alike, so only the counts of masks per part matter. The
orders are ranked lexicographically by their Lehmer code. All orders that begin with the same filters have
consecutive ranks; where the last of these filters is the first that a mask fails, the mask is removed at that
step in exactly that interval of ranks. So each mask adds its count at the first rank of each of its intervals and
takes it off behind the last one, and a running sum over the 120 ranks gives the totals of all orders at once.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoregrid.llm.common import written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
"""By rank: permutations of a sorted string come in lexicographic order."""

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SYMBOLS = r"[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"


def lehmer_rank(beginning: str) -> int:
    """Rank of the first order that begins with these filters."""
    left, rank = list(FILTERS), 0
    for f in beginning:
        at = left.index(f)
        left.pop(at)
        rank += at * math.factorial(len(left))
    return rank


def differences(mask: int) -> list[tuple[int, int, int, int, int]]:
    """(step, rank, kept, removed, redundant): what a document of this mask adds at a rank, where that is not zero.

    Each is +1 at the first rank of an interval and -1 behind its last one; ends that meet cancel out.
    """
    failed = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
    ends: dict[tuple[int, int], Counter] = {}
    for step in range(1, len(FILTERS) + 1):
        for beginning in itertools.permutations(FILTERS, step):
            before = failed.intersection(beginning[:-1])
            if beginning[-1] in failed:
                kind = "redundant" if before else "removed"
            elif not before:
                kind = "kept"
            else:
                continue
            first = lehmer_rank("".join(beginning))
            for rank, change in ((first, 1), (first + math.factorial(len(FILTERS) - step), -1)):
                if rank < len(ORDERS):
                    ends.setdefault((step, rank), Counter())[kind] += change
    rows = ((*at, c["kept"], c["removed"], c["redundant"]) for at, c in sorted(ends.items()))
    return [r for r in rows if any(r[2:])]


def difference_table(spark: SparkSession) -> DataFrame:
    """The differences of all 32 masks: at most 32 * 600 rows, whatever the data."""
    rows = [(mask, *d) for mask in range(1 << len(FILTERS)) for d in differences(mask)]
    return spark.createDataFrame(rows, "mask int, step int, rank int, kept int, removed int, redundant int")


def text_mask(text: Column) -> Column:
    """Bits of the filters that judge a text by itself (A to D)."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [
        n < MIN_WORDS,
        100 * distinct < MIN_DISTINCT_PERCENT * n,
        100 * capitals > MAX_CAPITAL_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each mask in each part, and those of them labelled so.

    Whether a smaller id has the same text is known from the text's smallest id, which is joined back by id and
    text: both are unique there, so a group of copies of any size is spread over all tasks.
    """
    text = F.coalesce("text", F.lit(""))
    seen = written(
        docs.select(
            "doc_id",
            F.coalesce("source", F.lit("")).alias("part"),
            text_mask(text).alias("mask"),
            F.unhex(F.sha2(text, 256)).alias("key"),
        ),
        "masks",
    )
    known = seen.where("doc_id IS NOT NULL")
    firsts = known.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    repeats = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    judged = known.join(firsts, ["doc_id", "key"], "left").join(marks, "doc_id", "left")
    judged = judged.select("part", (F.col("mask") + repeats).alias("mask"), "good", "toxic")
    nameless = seen.where("doc_id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(c)
    return judged.unionByName(nameless).groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("good"), total("toxic"))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with what the step's filter does there.

    docs needs doc_id, text and source, labels doc_id, quality and toxic; further columns are not read. A part is
    a source, a missing one counts as the empty text, as a missing text does. A document without an id is
    never a repeat, makes none and has no labels. Rows that repeat an id and its text count each, but not as
    repeats of each other; of labels that repeat an id any 1 counts. Very long texts are judged whole. Without documents there are no parts.
    """
    counts = masked(docs, labels)
    ends = counts.join(F.broadcast(difference_table(docs.sparkSession)), "mask")
    of_one = F.when(F.bit_count("mask") == 1, F.col("n")).otherwise(0)
    totals = {
        "kept": F.col("n") * F.col("kept"),
        "removed": F.col("n") * F.col("removed"),
        "redundant": F.col("n") * F.col("redundant"),
        "unique_fails": of_one * F.col("removed"),
        "good_lost": F.col("good") * F.col("removed"),
        "toxic_lost": F.col("toxic") * F.col("removed"),
    }
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    grid = counts.select("part").distinct().withColumn("step", F.explode(steps))
    grid = grid.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))))
    grid = grid.select("*", *[F.lit(0).cast("long").alias(c) for c in totals])
    ends = ends.select("part", "step", "rank", *[e.cast("long").alias(c) for c, e in totals.items()])
    # by part alone, so that the grouping and both windows need no further shuffle; a part has 600 ranks and steps
    summed = ends.unionByName(grid).repartition("part").groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in totals])
    running = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    order = F.element_at(F.array(*[F.lit(o) for o in ORDERS]), F.col("rank") + 1)
    by_order = summed.select("part", order.alias("filter_order"), "step", *[F.sum(c).over(running).alias(c) for c in totals])
    its_filter = F.substring("filter_order", F.col("step"), F.lit(1))
    return by_order.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", its_filter)))
