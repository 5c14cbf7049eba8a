"""Indexes of source files: which file holds which station or time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoregrid.fixed_values import EARLIEST_ARCHIVE_TIME
from shoregrid.functions import grid, moments, text
from shoregrid.operators.sized import join_dimension


def _landing(url: Column, folder: str) -> Column:
    return F.concat(F.lit(folder), text.part(url, "/", -1))


def buoy_index(
    past: DataFrame,
    this_year: DataFrame,
    stations: DataFrame,
    past_base: str,
    this_year_base: str,
    landing: str,
) -> DataFrame:
    """Yearly buoy files of known stations.

    `past(name)` lists files named station(5) + letter + year(4) + suffix; `this_year(name,
    modified)` lists current files, whose year is that of their modification.
    """
    name = F.col("name")
    old = past.where(~name.like("%Dir%")).select(
        text.left(name, 5).alias("station_id"),
        F.concat(F.lit(past_base), name).alias("archive_url"),
        text.between_positions(name, 7, 10).try_cast("int").alias("year"),
    )
    current = this_year.select(
        text.left(name, 5).alias("station_id"),
        F.concat(F.lit(this_year_base), name).alias("archive_url"),
        F.year(F.col("modified").try_cast("timestamp")).alias("year"),
    )
    known = stations.select("station_id").distinct()
    return join_dimension(old.unionByName(current), known, ["station_id"]).select(
        F.try_make_timestamp(
            "year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")
        ).alias("timestamp_tz"),
        "station_id",
        "archive_url",
        _landing(F.col("archive_url"), landing).alias("s3_url"),
    )


def loadable(index: DataFrame, after: str = EARLIEST_ARCHIVE_TIME) -> DataFrame:
    """Index rows late enough to be parsed."""
    return index.where(F.col("timestamp_tz") > F.lit(after).cast("timestamp"))


def tide_index(listings: DataFrame, landing: str) -> DataFrame:
    """Tide files from directory listings `(base_url, href)`: id and version end the file name."""
    url = F.concat("base_url", "href")
    return listings.where(F.col("href") != "../").select(
        text.tail_slice(url, -8, -6).alias("uh_id"),
        text.tail_slice(url, -5, -5).alias("version"),
        url.alias("archive_url"),
        _landing(url, landing).alias("s3_url"),
    )


def wind_index(keys: DataFrame, bucket: str, landing: str) -> DataFrame:
    """Wind files from object keys ending in `_yyyyMMddHH_yyyyMMddHH.nc`."""
    key = F.col("key")
    target = text.replace_first(text.part(key, "/", -1), "nc", "parquet")
    return keys.where(key.contains("_10v") | key.contains("_10u")).select(
        moments.compact_hour(text.tail_slice(key, -24, -15)).alias("start_timestamp_tz"),
        moments.compact_hour(text.tail_slice(key, -13, -4)).alias("end_timestamp_tz"),
        F.concat(F.lit(bucket), key).alias("archive_url"),
        F.concat(F.lit(landing), target).alias("s3_url"),
    )


def wind_component(url: Column) -> Column:
    """Which wind component a file holds, from its name."""
    return F.when(url.rlike("(?i)10v"), F.lit("VAR_10V")).otherwise(F.lit("VAR_10U"))


def land_index(keys: DataFrame, stations: DataFrame, bucket: str, zoom: int = 6) -> DataFrame:
    """Land-station files from keys `year/station.csv`, with the tile of the station.

    `stations` has `usaf_id`, `wban_num`, `lon` and `lat`.
    """
    known = stations.select(
        F.concat("usaf_id", "wban_num").alias("station"),
        grid.quadkey(F.col("lon"), F.col("lat"), zoom).alias("quadkey"),
    )
    key = F.col("key")
    files = keys.select(
        F.expr("substring(key, 6, length(key) - 9)").alias("station"), "key"
    )
    return join_dimension(files, known, ["station"]).select(
        F.try_to_timestamp(F.concat(text.left(key, 4), F.lit("-01-01")), F.lit("yyyy-MM-dd")).alias(
            "timestamp_tz"
        ),
        "quadkey",
        F.concat(F.lit(bucket), key).alias("archive_url"),
    )


def realtime_index(
    listing: DataFrame, stations: DataFrame, base: str, now: Column
) -> DataFrame:
    """Realtime files of known stations, available for the last days; `listing(name, description)`."""
    from shoregrid.streaming.ingest import availability

    name = F.col("name")
    files = listing.where(F.col("description") == "Standard Meteorological Data").select(
        text.left(name, 5).alias("station_id"),
        F.concat(F.lit(base), name).alias("realtime_url"),
        *availability(now),
    )
    return join_dimension(files, stations.select("station_id").distinct(), ["station_id"])
