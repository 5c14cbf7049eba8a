"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(master: str | None = None, app: str = "shoregrid", **conf: str) -> SparkSession:
    """A session with the settings the library expects; cluster sizing stays with the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant settings to a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as named in `spark.checkpoint.dir`.

    Only in local mode, where driver and executors are one process, is one made where none is named.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="shoregrid-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
