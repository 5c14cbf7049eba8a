"""Rows out of stored HTML, XML and GeoJSON documents."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.functions import grid, text

STATION_XML = """
    _id string, _name string, _owner string, _pgm string, _type string,
    history array<struct<_start string, _stop string, _lat string, _lng string, _elev string,
                         _met string, _hull string, _anemom_height string>>
"""

INVENTORY_XML = """
    Body struct<DataInventory struct<station struct<
        _ID string,
        metadata struct<location struct<lat string, long string>>,
        parameter array<struct<_name string, _first string, _last string>>>>>
"""

FEATURES_JSON = """
    features array<struct<
        id string, properties map<string,string>,
        geometry struct<type string, coordinates array<double>>>>
"""


def extract_links(pages: DataFrame, html: str) -> DataFrame:
    """One row per link target of each page, in column `href`."""
    return pages.withColumn("href", F.explode(text.links(F.col(html)))).drop(html)


class _TableCells(HTMLParser):
    """Cell texts of the n-th table, row by row; tables inside its cells are not mixed in."""

    def __init__(self, wanted: int) -> None:
        super().__init__(convert_charrefs=True)
        self.wanted, self.seen = wanted, 0
        self.open: list[int] = []
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def _inside(self) -> bool:
        return bool(self.open) and self.open[-1] == self.wanted

    def _close_cell(self) -> None:
        if self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.seen += 1
            self.open.append(self.seen)
        elif self._inside() and tag == "tr":
            self._close_cell()
            self.rows.append([])
        elif self._inside() and tag in ("td", "th") and self.rows:
            self._close_cell()
            self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            if self._inside():
                self._close_cell()
            self.open.pop()
        elif self._inside() and tag in ("td", "th", "tr"):
            self._close_cell()

    def handle_data(self, data: str) -> None:
        if self.cell is not None and self._inside():
            self.cell.append(data)


def _rows_of(html: str | None, n: int) -> Iterator[dict[str, str]]:
    parser = _TableCells(n)
    parser.feed(html or "")
    parser.close()
    rows = [r for r in parser.rows if r]
    for row in rows[1:]:
        yield dict(zip(rows[0], row))


def extract_table(
    pages: DataFrame, key: str, html: str, columns: list[str], n: int = 1
) -> DataFrame:
    """Rows of the n-th table of each page: key, row number, and the named header columns as text.

    Pages are independent, so this runs on the scan's partitions without a shuffle.
    """
    key_type = dict(pages.dtypes)[key]
    named = ", ".join(f"`{c}` string" for c in columns)

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [
                [k, i, *[cells.get(c) for c in columns]]
                for k, page in zip(frame[key], frame[html])
                for i, cells in enumerate(_rows_of(page, n), start=1)
            ]
            yield pd.DataFrame(found, columns=[key, "row_no", *columns])

    return pages.select(key, html).mapInPandas(parse, f"`{key}` {key_type}, row_no long, {named}")


def read_station_xml(spark: SparkSession, path: str, schema: str = STATION_XML) -> DataFrame:
    """Station elements with their repeated history elements; large files are split by row tag."""
    return spark.read.format("xml").option("rowTag", "station").schema(schema).load(path)


def parse_station_xml(docs: DataFrame, xml: str) -> DataFrame:
    """Station elements held one per row."""
    return docs.select(F.from_xml(F.col(xml), STATION_XML).alias("s")).select("s.*")


def parse_inventory(docs: DataFrame, xml: str) -> DataFrame:
    """Stored inventory answers as (station_id, lon, lat, parameters)."""
    tree = F.from_xml(F.col(xml), INVENTORY_XML, {"ignoreNamespace": "true"})
    station = F.col("_tree.Body.DataInventory.station")
    return docs.withColumn("_tree", tree).select(
        station["_ID"].alias("station_id"),
        station["metadata"]["location"]["long"].try_cast("double").alias("lon"),
        station["metadata"]["location"]["lat"].try_cast("double").alias("lat"),
        station["parameter"].alias("parameters"),
    )


def parse_features(docs: DataFrame, json: str) -> DataFrame:
    """Point features of GeoJSON documents as (id, name, geom)."""
    feature = F.explode(F.from_json(F.col(json), FEATURES_JSON)["features"])
    return docs.select(feature.alias("f")).select(
        F.coalesce(F.col("f.properties")["id"], F.col("f.id")).alias("id"),
        F.col("f.properties")["name"].alias("name"),
        F.when(
            F.col("f.geometry.type") == "Point",
            grid.point(
                F.get("f.geometry.coordinates", 0), F.get("f.geometry.coordinates", 1)
            ),
        ).alias("geom"),
    )
