"""Connected components of a link table, by contraction in rounds that are written to the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.llm.common import written


def components(
    links: DataFrame, a: str = "a", b: str = "b", written: Callable[[DataFrame, str], DataFrame] = written
) -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node that can be reached.

    Each round points every node at its smallest neighbour (or itself), follows the pointers once
    more and replaces the ends of all links by what they point at, until no link is left. The
    smallest node of a component always stays, so it is the last one. A round is one grouping with
    map-side minima and joins on node ids that the adaptive skew join can split; a node's links are
    never gathered. `written` writes a copy and reads it again. Null ends and loops are ignored; an empty table gives an empty result.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    links = written(links.distinct(), "links")
    labels: DataFrame | None = None
    while links.take(1):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        parent = written(parent.select("node", F.least("node", "least").alias("parent")), "parents")
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        roots = written(parent.join(up, "parent").select("node", "root"), "roots")
        if labels is None:
            labels = roots
        else:
            step = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = labels.join(step, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")
            )
            labels = written(labels, "labels")
        for end in ("a", "b"):
            to = roots.select(F.col("node").alias(end), F.col("root").alias("_to"))
            links = links.join(to, end).withColumn(end, F.col("_to")).drop("_to")
        links = written(links.where("a <> b").distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
