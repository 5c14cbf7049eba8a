"""Hourly means and inverse-distance weighting onto cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoregrid.functions import grid
from shoregrid.functions.moments import micros, nearest_hour
from shoregrid.functions.numbers import round_half_away, sentinel_to_null
from shoregrid.operators.sized import broadcast_limit, fits_broadcast, join_dimension, settled


NEAR_GROWTH = 25
"""A station is near up to this many cells; planner estimates do not see that."""
CHUNK_DAYS = 8
CHUNK_ROWS = 256
"""`by_tiles` sends up to so many readings of a station and chunk of days together."""


def hourly_mean(
    df: DataFrame,
    keys: list[str],
    ts: str,
    channels: dict[str, tuple[float, ...]],
    circular: tuple[str, ...] = (),
) -> DataFrame:
    """Mean of each channel per key over the half hours before and after each full hour.

    `channels` maps a column to its missing-value markers. Channels named in `circular` are
    averaged as compass directions, all others arithmetically.
    """

    zoneless = dict(df.dtypes)[ts] == "timestamp_ntz"

    def mean(name: str) -> Column:
        value = sentinel_to_null(F.col(name), *channels[name])
        if name not in circular:
            return F.avg(value).alias(name)
        return compass_mean(F.avg(F.sin(F.radians(value))), F.avg(F.cos(F.radians(value)))).alias(name)

    return df.groupBy(*keys, nearest_hour(F.col(ts), zoneless).alias(ts)).agg(
        *[mean(name) for name in channels]
    )


def compass_mean(mean_sin: Column, mean_cos: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(mean_sin, mean_cos)) + 360.0, F.lit(360.0))


def idw(
    near: DataFrame,
    readings: DataFrame,
    station: str,
    ts: str,
    channels: list[str],
    digits: int = 2,
    prefix: str = "idw_",
    unique: bool = False,
    weigh_missing: bool = False,
) -> DataFrame:
    """Inverse-square-distance mean of station readings per cell and time.

    `near` holds (cell, station, dist, weight) with a NULL weight where dist is 0; a station in
    the exact centre decides alone. `weigh_missing=True` also counts the weights of readings
    that are missing, which biases sparse channels low.

    Readings of one station and time are summed up before they are handed to the up to 25 cells
    around it (sums commute with the weights), then laid out by time. As the final grouping
    contains the time, the 25-fold rows are aggregated where they arise and never shuffled.
    If the station table cannot be broadcast, `by_tiles` hands the sums to the tiles around a station instead.
    """
    parts: list[Column] = []
    for c in channels:
        parts += [
            F.sum(c).cast("double").alias(f"_sum_{c}"),
            F.count(c).alias(f"_n_{c}"),
            F.max(c).alias(f"_max_{c}"),
        ]
    if unique:
        slim = readings.select(
            station,
            ts,
            F.lit(1).alias("_all"),
            *[F.col(c).cast("double").alias(f"_sum_{c}") for c in channels],
            *[F.col(c).isNotNull().cast("int").alias(f"_n_{c}") for c in channels],
            *[F.col(c).alias(f"_max_{c}") for c in channels],
        )
    else:
        slim = readings.groupBy(station, ts).agg(F.count(F.lit(1)).alias("_all"), *parts)
    links = near.select(station, "cell", "dist", "weight")
    if broadcast_limit(near.sparkSession) > 0:
        links = settled(links, "near", growth=NEAR_GROWTH)
    keys = ["cell", ts]
    if fits_broadcast(links):
        spread_out = join_dimension(slim.repartition(ts), links, [station])
    else:
        spread_out = by_tiles(slim, links, station, ts)
        keys = ["_tile", "_chunk", *keys]

    def result(c: str) -> Column:
        exact = F.max(F.when(F.col("dist") == 0, F.col(f"_max_{c}")))
        counted = F.col("_all") if weigh_missing else F.col(f"_n_{c}")
        weights = F.sum(F.when(counted > 0, F.col("weight") * counted))
        mean = F.try_divide(F.sum(F.col("weight") * F.col(f"_sum_{c}")), weights)
        return round_half_away(F.coalesce(exact, mean), digits).alias(f"{prefix}{c}")

    return spread_out.groupBy(*keys).agg(*[result(c) for c in channels]).drop("_tile", "_chunk")


def in_lists(slim: DataFrame, station: str, ts: str) -> DataFrame:
    """(station, _chunk, _rows): the readings of a station and chunk of days in lists of CHUNK_ROWS at most."""
    chunk = F.floor(micros(F.col(ts)) / F.lit(CHUNK_DAYS * 86_400_000_000)).alias("_chunk")
    place = F.row_number().over(Window.partitionBy(station, "_chunk").orderBy(ts))
    parts = slim.select("*", chunk).withColumn("_part", F.floor((place - 1) / F.lit(CHUNK_ROWS)))
    rows = F.collect_list(F.struct(*[c for c in slim.columns if c != station])).alias("_rows")
    return parts.groupBy(station, "_chunk", "_part").agg(rows).drop("_part")


def by_tiles(slim: DataFrame, links: DataFrame, station: str, ts: str) -> DataFrame:
    """The readings of `slim` at every cell of `links`, laid out by (`_tile`, `_chunk`).

    A tile is a square of cells (other ids than whole numbers: the cell itself). A station's links are packed into one
    row per tile, its own and those within two cells of it, so a reading is sent to 1.6 tiles on average and four
    at most, in place of 25 cells, and unfolds where its tile is aggregated: grouping by (`_tile`, `_chunk`, cell, time)
    needs no further shuffle, and there are as many groups of work as tiles times chunks of CHUNK_DAYS days. A packed row
    is longer than many readings, so readings travel as lists, up to CHUNK_ROWS of a station and chunk with one packed
    row. Nothing is counted or written beforehand. A station with very many times is split by the adaptive skew
    join, as the lists of a station meet no more than its few packed rows.
    """
    whole = dict(links.dtypes)["cell"] in ("tinyint", "smallint", "int", "bigint")
    tile = grid.tile(F.col("cell")) if whole else F.col("cell")
    packed = links.groupBy(station, tile.alias("_tile")).agg(
        F.collect_list(F.struct("cell", "dist", "weight")).alias("_links")
    )
    handed = join_dimension(in_lists(slim, station, ts), packed, [station], even=True).repartition("_tile", "_chunk")
    each = handed.select("_tile", "_chunk", station, "_links", F.inline("_rows"))
    return each.select("_tile", "_chunk", *slim.columns, F.inline("_links"))
