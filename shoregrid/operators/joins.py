"""Temporal and incremental joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoregrid.functions.moments import micros
from shoregrid.operators.sized import join_dimension

LEVEL_BITS = 5
"""Time cells grow by 32 times from one level to the next."""
BEYOND = -1
"""The level of what is asked for at or after the newest time of the history."""
SCD_GROWTH = 3
"""How many copies of a history row `scd_join` makes at most."""
SHORT_ROWS = 2**LEVEL_BITS + 2
"""A history of so many rows at most need not be told apart by level: a fact may meet as many on one level alone."""
BUCKETS = 4096
"""Keys are hashed into so many buckets to tell facts whose histories are short; an array of them goes to every task."""


def _cell(us: Column, level: Column) -> Column:
    return F.when(level == BEYOND, F.lit(0)).otherwise(
        F.call_function("shiftright", us, F.least(F.greatest(level, F.lit(0)) * LEVEL_BITS, F.lit(63)))
    )


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def short_buckets(history: DataFrame, key: str) -> Column:
    """For each bucket of keys, is the history of all of them short? An array as a scalar subquery."""
    rows = history.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    longest = rows.groupBy(_bucket(key).alias("_bucket")).agg(F.max("_rows").alias("_rows"))
    long_ones = longest.where(F.col("_rows") > SHORT_ROWS).agg(F.collect_set("_bucket").alias("_long"))
    every = F.sequence(F.lit(0), F.lit(BUCKETS - 1))
    return long_ones.select(F.transform(every, lambda b: ~F.array_contains("_long", b)).alias("short")).scalar()


def newest_time(history: DataFrame, start: str, end: str) -> Column:
    """The latest start or end of the history, in microseconds, as a scalar subquery."""
    from_us, to_us = micros(F.col(start)), micros(F.col(end))
    return history.agg(F.max(F.greatest(from_us, to_us)).alias("newest")).scalar()


def filed_by_length(
    history: DataFrame, start: str, end: str, top: Column | None = None, short: Column | None = None
) -> DataFrame:
    """History rows once for each time cell they lie in, as `_level` and `_cell`.

    A row is filed on the lowest level whose cells are as long as it is, so it lies in two cells at most. An open
    row ends, for this, just before the newest time of all; it is also filed beyond it, as is a row that ends there.
    Rows for which `short` holds go to level `top`, the highest of all: their cells there are two at most as well.
    """
    rows = _levelled(history, start, end)
    if short is not None:
        rows = rows.withColumn("_own", F.when(F.col("_own").isNotNull() & short, top).otherwise(F.col("_own")))
    from_us, to_us, level = micros(F.col(start)), micros(F.col(end)), F.col("_own")
    place = lambda n, cell: F.struct(n.alias("_level"), cell.cast("long").alias("_cell"))
    none = F.array().cast("array<struct<_level: int, _cell: bigint>>")
    cells = F.array_distinct(F.array(*[place(level, _cell(us, level)) for us in (from_us, F.col("_last"))]))
    reaches = from_us.isNotNull() & (to_us.isNull() | ((to_us == F.col("_newest")) & level.isNotNull()))
    beyond = F.when(reaches, F.array(place(F.lit(BEYOND), F.lit(0))))
    placed = rows.withColumn(
        "_at", F.explode(F.concat(F.when(level.isNotNull(), cells).otherwise(none), F.coalesce(beyond, none)))
    )
    return placed.select(*history.columns, "_at.*")


def _levelled(history: DataFrame, start: str, end: str) -> DataFrame:
    """History rows with the time they count up to (`_last`) and their level (`_own`, missing for reversed rows)."""
    rows = history.withColumn("_newest", newest_time(history, start, end))
    rows = rows.withColumn("_last", F.coalesce(micros(F.col(end)), F.col("_newest") - 1))
    length = F.col("_last") - micros(F.col(start))
    bits = F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))
    return rows.withColumn("_own", F.when(length >= 0, F.ceil(bits / LEVEL_BITS).cast("int")))


def levels_of(history: DataFrame, start: str, end: str) -> Column:
    """The levels that rows of the history are filed on, as a scalar subquery."""
    return _levelled(history, start, end).agg(F.collect_set("_own").alias("levels")).scalar()


def asked_by_level(
    fact: DataFrame, ts: str, newest: Column, levels: Column, top: Column | None = None, short: Column | None = None
) -> DataFrame:
    """Fact rows once for each level, with the cell of their time; at or after the newest time just once.

    Where `short` holds, all rows of the key are filed on level `top`, and a fact asks there only.
    """
    us = micros(F.col(ts))
    timed = fact.withColumn("_newest", newest).withColumn("_levels", levels)
    each = F.when(us >= F.col("_newest"), F.array(F.lit(BEYOND)))
    if short is not None:
        each = each.when(short, F.array(top))
    each = each.otherwise(F.col("_levels"))
    asked = timed.withColumn("_level", F.explode(each))
    return asked.withColumn("_cell", _cell(us, F.col("_level"))).drop("_newest", "_levels")


def scd_join(
    fact: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    start: str = "start_time",
    end: str = "end_time",
    residual: Column | None = None,
) -> DataFrame:
    """Fact rows with the history rows of their key that hold at their time (both ends included).

    An open end (NULL) holds forever. History rows are filed in time cells as long as they are, and a fact asks for
    one cell on each level that the history has (13 at most): it meets rows of one cell that are longer than a part in
    2^LEVEL_BITS of it. Where rows of a key do not overlap, these are 2^LEVEL_BITS + 2 a level at most, however they
    cluster; where they do, a fact meets no more than lie in the neighbourhood of its time, of their own length.
    Keys with SHORT_ROWS rows at most have them on the highest level alone, so their facts are sent once and not once a
    level; all keys of a bucket must be so, as facts know their bucket without being joined to anything.
    A key's rows that are asked for by very many facts are split by the adaptive skew join.
    """
    levels = levels_of(history, start, end)
    top = short = None
    kind = dict(history.dtypes)[key]
    if kind == dict(fact.dtypes)[key] and "collate" not in kind:  # equal keys hash alike
        top, short = F.array_max(levels), F.coalesce(F.get(short_buckets(history, key), _bucket(key)), F.lit(False))
    filed = filed_by_length(history, start, end, top, short)
    asked = asked_by_level(fact, ts, newest_time(history, start, end), levels, top, short)
    holds = F.col(ts).between(F.col(start), F.coalesce(F.col(end), F.col(ts)))
    if residual is not None:
        holds = holds & residual
    found = join_dimension(asked, filed, [key, "_level", "_cell"], residual=holds, growth=SCD_GROWTH, even=True)
    return found.drop("_level", "_cell")


def nearest_in_time(
    points: DataFrame,
    series: DataFrame,
    key: str,
    ts: str,
    tie: str,
    series_ts: str,
    within_minutes: int,
) -> DataFrame:
    """Each point with the series row of its key that is nearest in time, if one is close enough.

    Nearest by absolute difference, then the earlier one, then the smallest `tie`. Points without
    a match are left out. Series columns other than the key must not clash with point columns.

    No pairs are formed. Copies of a time collapse first. Within one second the neighbours come
    from a running minimum/maximum over that second; across seconds from a running one over
    per-second extremes of one time block. Groups are bounded by the number of microseconds in a
    second and of seconds in a block, so a key that holds most rows is still split.
    """
    reach = within_minutes * 60
    payload = [c for c in series.columns if c != key]
    per_time = series.groupBy(key, micros(F.col(series_ts)).alias("_s_us")).agg(
        F.min_by(F.struct(*payload), F.col(tie)).alias("_row")
    )
    second = lambda us: F.floor(us / F.lit(1_000_000))
    times = points.select(key, micros(F.col(ts)).alias("_us")).distinct()

    mixed = times.select(
        key, "_us", second(F.col("_us")).alias("_sec"), F.lit(None).cast("long").alias("_s_us")
    ).unionByName(
        per_time.select(
            key, F.col("_s_us").alias("_us"), second(F.col("_s_us")).alias("_sec"), "_s_us"
        )
    )
    in_second = Window.partitionBy(key, "_sec")
    upto = (Window.unboundedPreceding, Window.currentRow)
    same_second = (
        mixed.withColumn("_prev", F.max("_s_us").over(in_second.orderBy("_us").rangeBetween(*upto)))
        .withColumn(
            "_next", F.min("_s_us").over(in_second.orderBy(F.desc("_us")).rangeBetween(*upto))
        )
        .where(F.col("_s_us").isNull())
        .drop("_s_us")
    )

    block = F.floor(F.col("_sec") / F.lit(reach))
    extremes = (
        per_time.groupBy(key, second(F.col("_s_us")).alias("_sec"))
        .agg(F.min("_s_us").alias("_first"), F.max("_s_us").alias("_last"))
        .withColumn("_block", F.explode(F.sequence(block - 1, block + 1)))
    )
    seconds = (
        times.select(key, second(F.col("_us")).alias("_sec"))
        .distinct()
        .withColumn("_block", block)
        .withColumn("_first", F.lit(None).cast("long"))
        .withColumn("_last", F.lit(None).cast("long"))
        .withColumn("_asks", F.lit(True))
    )
    in_block = Window.partitionBy(key, "_block")
    before = (Window.unboundedPreceding, -1)
    other_seconds = (
        extremes.withColumn("_asks", F.lit(False))
        .unionByName(seconds)
        .withColumn(
            "_prev_far", F.max("_last").over(in_block.orderBy("_sec").rangeBetween(*before))
        )
        .withColumn(
            "_next_far", F.min("_first").over(in_block.orderBy(F.desc("_sec")).rangeBetween(*before))
        )
        .where("_asks")
        .select(key, "_sec", "_prev_far", "_next_far")
    )

    limit = F.lit(reach * 1_000_000)
    back = F.col("_us") - F.coalesce("_prev", "_prev_far")
    ahead = F.coalesce("_next", "_next_far") - F.col("_us")
    back_ok, ahead_ok = F.coalesce(back <= limit, F.lit(False)), F.coalesce(ahead <= limit, F.lit(False))
    choice = F.when(back_ok & (~ahead_ok | (back <= ahead)), F.col("_us") - back).when(
        ahead_ok, F.col("_us") + ahead
    )
    matched = (
        same_second.join(other_seconds, [key, "_sec"])
        .withColumn("_s_us", choice)
        .where(F.col("_s_us").isNotNull())
        .select(key, "_us", "_s_us")
        .join(per_time, [key, "_s_us"])
        .select(key, "_us", "_row")
    )
    found = join_dimension(points.withColumn("_us", micros(F.col(ts))), matched, [key, "_us"])
    return found.select(*points.columns, "_row.*")


def newer_than(df: DataFrame, loaded: DataFrame, key: str, ts: str, compat: bool = False) -> DataFrame:
    """Rows later than the newest loaded row of their key, and all rows of keys never loaded.

    `compat=True` leaves keys never loaded out, as the old model did.
    """
    newest = loaded.groupBy(key).agg(F.max(ts).alias("_newest"))
    if compat:
        return join_dimension(df, newest, [key], residual=F.col(ts) > F.col("_newest")).drop("_newest")
    found = join_dimension(df, newest, [key], "left")
    return found.where(F.col("_newest").isNull() | (F.col(ts) > F.col("_newest"))).drop("_newest")


def pair_components(
    df: DataFrame, keys: list[str], label: str, value: str, first: str, second: str
) -> DataFrame:
    """Averages of two labelled components per key, for keys that have both.

    One pass and one shuffle with map-side combine, in place of joining the components row by row.
    """
    return (
        df.where(F.col(label).isin(first, second) & F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(
            F.avg(F.when(F.col(label) == first, F.col(value))).alias("first_avg"),
            F.avg(F.when(F.col(label) == second, F.col(value))).alias("second_avg"),
        )
        .where(F.col("first_avg").isNotNull() & F.col("second_avg").isNotNull())
    )
