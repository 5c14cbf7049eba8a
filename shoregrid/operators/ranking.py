"""Numbering, even splits and batches without one task seeing a whole large group."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoregrid.operators.sized import written


def _parted(df: DataFrame, keys: list[str], order: Column, tie: str) -> DataFrame:
    """The rows with their order value `_x` and range partition `_part`, written once.

    One range sort by key, order value, tie and content: a group that holds most rows, and many rows of one order
    value, fall into several partitions. Spark draws the bounds anew whenever it plans, so they are fixed by writing.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith(("map", "variant"))])
    rows = df.withColumn("_x", order)
    parted = rows.repartitionByRange(*keys, F.col("_x").asc_nulls_first(), tie, content)
    return written(parted.withColumn("_part", F.spark_partition_id()), "parted")


def _carried(rows: DataFrame, keys: list[str]) -> Column:
    """An array by partition: the group that began in an earlier one, and how many of its rows lie there.

    Only the first group of a partition can have begun before it, so there are fewer entries than partitions.
    """
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    begun = counts.withColumn("_before", F.sum("_rows").over(before)).where("_before IS NOT NULL")
    entry = F.struct(F.struct(F.lit(0).alias("_"), *keys).alias("group"), F.col("_before").alias("rows"))
    made = begun.agg(
        F.map_from_entries(F.collect_list(F.struct("_part", entry.alias("entry")))).alias("of"),
        F.coalesce(F.max("_part"), F.lit(0)).alias("last"),
    )
    by_part = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.try_element_at(F.col("of"), i))
    return made.select(by_part.alias("entries")).scalar()


def numbered(df: DataFrame, keys: list[str], order: Column, tie: str, name: str = "position") -> DataFrame:
    """`row_number` per key by a number or time, then by `tie`; NULLs first.

    A position is the rank in the row's range partition plus the rows of its group in earlier ones: a
    running sum over partitions, not rows. No task sees more of a group than a partition holds.
    """
    rows = _parted(df, keys, order, tie)
    local = Window.partitionBy(*keys, "_part").orderBy(F.col("_x").asc_nulls_first(), F.col(tie).asc_nulls_first())
    carried = F.get(_carried(rows, keys), F.col("_part"))
    own = F.struct(F.lit(0).alias("_"), *keys)
    before = F.when(carried["group"].eqNullSafe(own), carried["rows"]).otherwise(0)
    placed = rows.withColumn("_local", F.row_number().over(local))
    return placed.withColumn(name, F.col("_local") + before).select(*df.columns, name)


def even_split(df: DataFrame, parts: int, order: Column, tie: str, name: str = "tile") -> DataFrame:
    """`ntile` over the whole table: consecutive rows, part sizes differing by at most one."""
    placed = numbered(df, [], order, tie, "_pos")
    total = placed.agg(F.count(F.lit(1)).alias("n")).scalar()
    pos = F.col("_pos") - 1
    size = F.floor(F.col("_total") / parts)
    longer = F.col("_total") % parts
    edge = longer * (size + 1)
    tile = F.when(pos < edge, F.floor(pos / (size + 1))).otherwise(
        longer + F.floor(F.try_divide(pos - edge, size))
    )
    return (
        placed.withColumn("_total", total)
        .withColumn(name, (tile + 1).cast("int"))
        .select(*df.columns, name)
    )


def batches(df: DataFrame, size: int, order: Column, tie: str, columns: list[str]) -> DataFrame:
    """Consecutive batches of `size` rows as (batch, items); a list holds at most `size` rows."""
    placed = numbered(df, [], order, tie, "_pos")
    item = F.struct("_pos", *columns)
    return (
        placed.withColumn("batch", F.floor((F.col("_pos") - 1) / size))
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list(item)).alias("_items"))
        .select(
            "batch",
            F.transform(
                "_items", lambda i: F.struct(*[i[c].alias(c) for c in columns])
            ).alias("items"),
        )
    )


def chunked_lists(df: DataFrame, keys: list[str], order: Column, value: str, chunk: int = 1000) -> DataFrame:
    """Sorted lists of a key's values, at most `chunk` long: (keys, chunk, values), nothing dropped."""
    placed = numbered(df, keys, order, value, "_pos")
    return (
        placed.withColumn("chunk", F.floor((F.col("_pos") - 1) / chunk))
        .groupBy(*keys, "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", value))).alias("_items"))
        .select(*keys, "chunk", F.col(f"_items.{value}").alias("values"))
    )


def skip_first(df: DataFrame, order: str, n: int = 1) -> DataFrame:
    """All rows but the first n by a unique order column (a small fixed n)."""
    first = df.select(order).orderBy(order).limit(n)
    return df.join(F.broadcast(first), order, "left_anti")


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Range-partition and sort by the columns, so that file statistics skip well."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def interleaved(parts: list[Column], bits: int = 16) -> Column:
    """One number from the bits of several whole numbers below 2^bits, taken in turn: near in all of them is near in it."""
    n = len(parts)
    spread_bits = [
        F.shiftleft(F.shiftright(part.cast("long"), bit).bitwiseAND(F.lit(1)), bit * n + k)
        for k, part in enumerate(parts)
        for bit in range(bits)
    ]
    return functools.reduce(Column.bitwiseOR, spread_bits)


def clustered_by_all(df: DataFrame, columns: list[str], bits: int = 16, parts: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by all number or time columns at once, so files are narrow in each of them.

    A sort by the columns one after the other serves filters on the first only. Each column is scaled to its
    extent (a scalar subquery); missing values come first.
    """
    number = lambda c: F.unix_micros(F.col(c).cast("timestamp")) if "timestamp" in dict(df.dtypes)[c] else F.col(c)
    ends = df.agg(F.struct(*[f(number(c).cast("double")).alias(f"{e}{i}") for i, c in enumerate(columns) for e, f in (("lo", F.min), ("hi", F.max))]).alias("e"))
    rows = df.withColumn("_ends", ends.scalar())

    def scaled(i: int, c: str) -> Column:
        low, high = F.col(f"_ends.lo{i}"), F.col(f"_ends.hi{i}")
        share = F.try_divide(number(c).cast("double") - low, high - low)
        return F.floor(F.coalesce(share, F.lit(0.0)) * ((1 << bits) - 1)).cast("long")

    key = interleaved([scaled(i, c) for i, c in enumerate(columns)], bits)
    placed = rows.withColumn("_key", key).drop("_ends")
    return placed.repartitionByRange(*([parts] if parts else []), "_key").sortWithinPartitions("_key").drop("_key")


def files_touched(stored: DataFrame, ranges: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(files, touched): of the files behind a table, those whose extents do not rule out rows inside all ranges."""
    extent = [f(c).alias(f"{e}_{c}") for c in ranges for e, f in (("least", F.min), ("most", F.max))]
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(*extent)
    meets = functools.reduce(
        Column.__and__, [(F.col(f"least_{c}") <= high) & (F.col(f"most_{c}") >= low) for c, (low, high) in ranges.items()]
    )
    return files.agg(F.count(F.lit(1)).alias("files"), F.count_if(meets).alias("touched"))
