"""What the operators of this subpackage share: session settings, text rules and folder access."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.operators.sized import written  # noqa: F401  (re-exported)
from shoregrid.session import prepare, work_path  # noqa: F401  (re-exported)
from shoregrid.sinks.tables import remove_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BATCH_ROWS = 200
"""Rows of one Arrow batch: a worker holds that many texts at a time, however long a partition is."""

READ_BATCH_ROWS = 512
"""Rows of one batch of the columnar Parquet reader, so that very long texts stay bounded too."""


def ready(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> SparkSession:
    """The settings that the operators rely on: UTC and small Arrow batches."""
    prepare(spark)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:  # where Python workers find this package, if it is not installed
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_BATCH_ROWS))
    return spark


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps now, not when the driver's memory is full."""
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Copies in the shared folder that are deleted together once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = work_path(self.spark, name)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            remove_folder(self.spark, path)
        self.paths = []
        release(self.spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text with A-Z lower-cased, as UTF-8.

    `bytes.lower` changes ASCII letters only and `bytes.split` knows exactly these six separators.
    """
    return text.encode().lower().split()


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo a number; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def map_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(fn, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column of a batch; null reads as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def crc32_words(ids: bytes) -> int:
    return zlib.crc32(ids)
