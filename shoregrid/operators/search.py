"""Feature vectors and radius search over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoregrid.fixed_values import MATCH_WINDOW_MINUTES, SEARCH_RADIUS
from shoregrid.functions import grid
from shoregrid.functions.arrays import l2_distance, l2_distance_unrolled, slice_from
from shoregrid.functions.numbers import round_half_away
from shoregrid.operators.joins import nearest_in_time
from shoregrid.operators.sized import join_dimension, written

COMPASS_DIMS = (4, 7)
"""The two directions of a tag (elements counted from 1): they span far more than the radius."""

BAND_ROWS = 1_000
"""Rows of one band from which on it is worth a task more: each of them meets all queries of the band."""


def make_vector(cell: Column, *features: Column) -> Column:
    """Cell and features as one array of doubles; keep the cell as a column of its own as well."""
    return F.array(cell.cast("double"), *[f.cast("double") for f in features])


def vector_search(
    rows: DataFrame, vector: str, query: DataFrame, radius: float, first: int = 1, digits: int = 2
) -> DataFrame:
    """Rows closer than `radius` to the single vector in the one-column, one-row `query`.

    Distances run over elements first.. of both. The query vector is a scalar subquery: it is
    computed once and reaches the scan as a value, so nothing is joined or shuffled.
    """
    found = rows.withColumn("_query", query.scalar())
    distance = l2_distance(
        slice_from(F.col(vector).cast("array<double>"), first),
        slice_from(F.col("_query").cast("array<double>"), first),
    )
    return (
        found.withColumn("_dist", distance)
        .where(F.col("_dist") < radius)
        .withColumn("l2_dist", round_half_away(F.col("_dist"), digits))
        .drop("_query", "_dist")
    )


def similar_vectors(
    queries: DataFrame,
    rows: DataFrame,
    query_id: list[str],
    vector: str,
    radius: float = SEARCH_RADIUS,
    size: int = 7,
    cut: tuple[int, ...] = COMPASS_DIMS,
    digits: int = 2,
) -> DataFrame:
    """For many query vectors at once: all rows closer than `radius` over elements 2..size.

    The elements named in `cut` are cut into bands as wide as the radius. Close vectors are at
    most one band apart in each, so a query asks in its own and the adjacent bands only (it is
    repeated 3 times per named element, the rows are not), and no row is compared with every
    query. Exact: the bands only preselect. Name elements that spread widely.
    """
    elements = range(2, size + 1)
    keys = [f"_band{i}" for i in cut]
    band = lambda c: F.floor(F.col(c) / radius).cast("long")
    # Elements become plain columns: reading them out of arrays for each pair costs far more.
    ask = queries.select(*query_id, *[F.get(vector, i - 1).alias(f"_q{i}") for i in elements])
    for key, i in zip(keys, cut):
        ask = ask.withColumn(
            key, F.explode(F.sequence(band(f"_q{i}") - 1, band(f"_q{i}") + 1))
        )
    placed = rows.withColumns({f"_x{i}": F.get(vector, i - 1) for i in elements})
    placed = placed.withColumns({k: band(f"_x{i}") for k, i in zip(keys, cut)})
    squares = [(F.col(f"_x{i}"), F.col(f"_q{i}")) for i in elements]
    distance = l2_distance_unrolled(squares)
    near = join_dimension(placed, ask, keys, residual=distance < radius, growth=3 ** len(cut), hot_rows=BAND_ROWS)
    helpers = [*keys, *[f"_x{i}" for i in elements], *[f"_q{i}" for i in elements]]
    return near.withColumn("l2_dist", round_half_away(distance, digits)).drop(*helpers)


def search_by_media(
    media: DataFrame,
    tags: DataFrame,
    media_id: str,
    media_ts: str,
    tag_ts: str,
    vector: str,
    radius: float = SEARCH_RADIUS,
    within_minutes: int = MATCH_WINDOW_MINUTES,
    cut: tuple[int, ...] = COMPASS_DIMS,
    digits: int = 2,
) -> DataFrame:
    """Past hours with conditions like those where and when each photo or clip was taken.

    `media` has an id, `lon`, `lat` and a time. The nearest tag of its cell within the window is
    the query; media that share a tag share one search.
    """
    points = media.select(
        media_id, F.col(media_ts), grid.cell_of(F.col("lon"), F.col("lat")).alias("cell")
    )
    series = tags.select(
        "cell", F.col(tag_ts).alias("matched_ts"), F.col(vector).alias("matched_vector")
    )
    matched = nearest_in_time(
        points, series, "cell", media_ts, "matched_ts", "matched_ts", within_minutes
    )
    matched = written(matched, "matched")
    key = ["cell", "matched_ts"]
    queries = matched.groupBy(*key).agg(F.first("matched_vector").alias(vector))
    similar = similar_vectors(
        written(queries, "queries"),
        tags.select(F.col("cell").alias("similar_cell"), F.col(tag_ts).alias("similar_ts"), vector),
        key,
        vector,
        radius,
        cut=cut,
        digits=digits,
    )
    asked = matched.select(*key, media_id, "matched_vector")
    return similar.join(asked, key)
