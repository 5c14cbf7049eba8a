"""A stored index of feature vectors: rows in tiles of two widely spread elements, tiles with the extent of every element.

A search first asks the small table of tiles which of them can hold a vector within the radius of any query, by
the distance to their extents; only their folders are read, and only their rows are compared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.fixed_values import SEARCH_RADIUS
from shoregrid.operators.joins import nearest_in_time
from shoregrid.operators.search import COMPASS_DIMS, similar_vectors
from shoregrid.operators.sized import join_dimension

TILE = "_tile"


@dataclass(frozen=True)
class VectorIndex:
    """Where an index lies and how it is cut: elements `cut` (counted from 1) into `bands` bands of `width`, round and round.

    A value's band is taken modulo `bands`, so there are at most bands^len(cut) tiles whatever the values are.
    """

    path: str
    vector: str
    size: int = 7
    cut: tuple[int, ...] = COMPASS_DIMS
    width: float = 30.0
    bands: int = 12

    @property
    def elements(self) -> range:
        """The elements that count for distances; the first one is the cell."""
        return range(2, self.size + 1)

    def band(self, value: Column) -> Column:
        return F.pmod(F.floor(value / self.width), F.lit(self.bands)).cast("int")

    def tile(self, bands: list[Column]) -> Column:
        return reduce(lambda whole, band: whole * self.bands + band, bands).cast("int")

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def tiles(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/tiles")


def build(tags: DataFrame, index: VectorIndex, sort: list[str]) -> None:
    """Write the rows by tile, sorted, and the extent of every element in each tile. Rows lacking a cut element are left out."""
    spark = tags.sparkSession
    bands = [index.band(F.get(index.vector, i - 1)) for i in index.cut]
    placed = tags.withColumn(TILE, index.tile(bands)).where(F.col(TILE).isNotNull())
    balanced = placed.hint("rebalance", TILE).sortWithinPartitions(TILE, *sort)
    balanced.write.mode("overwrite").partitionBy(TILE).parquet(f"{index.path}/rows")
    value = lambda i: F.get(index.vector, i - 1)
    extent = [f(value(i)).alias(f"{n}{i}") for i in index.elements for n, f in (("least", F.min), ("most", F.max))]
    tiles = spark.read.schema(placed.schema).parquet(f"{index.path}/rows").groupBy(TILE).agg(*extent)
    tiles.coalesce(1).write.mode("overwrite").parquet(f"{index.path}/tiles")


def tiles_for(index: VectorIndex, queries: DataFrame, radius: float) -> DataFrame:
    """The tiles that can hold a vector closer than `radius` to a query: (_tile)."""
    spark, vector = queries.sparkSession, F.col(index.vector)
    asked = queries.select(vector)
    near = []
    for n, i in enumerate(index.cut):
        low, high = (F.floor((F.get(vector, i - 1) + d) / index.width) for d in (-radius, radius))
        span = F.sequence(low, F.least(high, low + index.bands - 1))
        asked = asked.withColumn(f"_b{n}", F.explode(F.transform(span, lambda b: F.pmod(b, F.lit(index.bands)).cast("int"))))
        near.append(F.col(f"_b{n}"))
    asked = asked.withColumn(TILE, index.tile(near))
    known = index.tiles(spark)
    gap = lambda i: F.greatest(F.col(f"least{i}") - F.get(vector, i - 1), F.get(vector, i - 1) - F.col(f"most{i}"), F.lit(0.0))
    distance = reduce(add, [gap(i) * gap(i) for i in index.elements])
    # a row that lacks an element is no match, so a tile without any value of one has no extent and is not read
    return join_dimension(asked, known, [TILE], residual=distance < radius * radius).select(TILE).distinct()


def similar(
    index: VectorIndex,
    queries: DataFrame,
    key: list[str],
    radius: float = SEARCH_RADIUS,
    digits: int = 2,
    renamed: dict[str, str] | None = None,
) -> DataFrame:
    """All rows of the index closer than `radius` to each of many query vectors, with the query's key and `l2_dist`.

    `renamed` names columns of the index anew, where they clash with the key. The numbers of the tiles to read come to the driver; there are at most bands^len(cut) of them.
    """
    spark = queries.sparkSession
    wanted = [r[TILE] for r in tiles_for(index, queries, radius).collect()]
    rows = index.rows(spark).where(F.col(TILE).isin(wanted) if wanted else F.lit(False)).drop(TILE)
    rows = rows.withColumnsRenamed(renamed or {})
    return similar_vectors(queries, rows, key, index.vector, radius, index.size, index.cut, digits)


def photo_search(
    index: VectorIndex,
    photos: DataFrame,
    photo: str,
    taken: str,
    tag_ts: str,
    within_minutes: int,
    radius: float = SEARCH_RADIUS,
    digits: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Two answers: each photo with the hour it was taken in, and each such hour with the hours like it.

    `photos` has an id, `cell` and a time. They are kept apart, as photos of one hour share one search: joined, the
    answer would repeat all similar hours for every photo. (photo, cell, matched_ts), (cell, matched_ts, similar_cell,
    similar_ts, l2_dist).
    """
    rows = index.rows(photos.sparkSession)
    margin = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(within_minutes))
    first, last = (photos.agg(f(taken).alias("t")).scalar() for f in (F.min, F.max))
    spanned = rows.where(F.col(tag_ts).between(first - margin, last + margin))
    series = spanned.select("cell", F.col(tag_ts).alias("matched_ts"), F.col(index.vector))
    matched = nearest_in_time(photos.select(photo, taken, "cell"), series, "cell", taken, "matched_ts", "matched_ts", within_minutes)
    key = ["cell", "matched_ts"]
    queries = matched.groupBy(*key).agg(F.any_value(index.vector).alias(index.vector))
    found = similar(index, queries, key, radius, digits, {"cell": "similar_cell", tag_ts: "similar_ts"})
    return matched.select(photo, *key), found.select(*key, "similar_cell", "similar_ts", "l2_dist")
