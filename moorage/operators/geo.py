"""Maritime areas: polygons as edge lists, and points in them."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.storage import cut

UNASSIGNED = "Unassigned"
AREA = "country string, edges array<struct<x1:double,y1:double,x2:double,y2:double>>"


def rings_of(geometry: dict) -> Iterable[list]:
    if geometry["type"] == "Polygon":
        yield from geometry["coordinates"]
    elif geometry["type"] == "MultiPolygon":
        for polygon in geometry["coordinates"]:
            yield from polygon
    elif geometry["type"] == "GeometryCollection":
        for part in geometry["geometries"]:
            yield from rings_of(part)


def edges_of(geometry: dict) -> list[tuple[float, float, float, float]]:
    """Edges of all rings; holes need no mark, since parity counts them."""
    out = []
    for ring in rings_of(geometry):
        closed = ring if ring[0] == ring[-1] else [*ring, ring[0]]
        out += [(float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(closed, closed[1:], strict=False)]
    return out


def areas_from_geojson(spark: SparkSession, payload: dict) -> DataFrame:
    """(country, edges) of a FeatureCollection whose features have a country."""
    rows = [(f["properties"]["country"], edges_of(f["geometry"])) for f in payload["features"]]
    return spark.createDataFrame(rows, AREA)


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return areas_from_geojson(spark, json.loads(text))


def covers(edges: Column, x: Column, y: Column) -> Column:
    """Whether the point is inside by even-odd parity, or on an edge."""
    crossing = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"])
    on = lambda e: (
        ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"]))
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )
    parity = F.aggregate(edges, F.lit(0), lambda n, e: n + F.when(crossing(e), 1).otherwise(0))
    return (parity % 2 == 1) | F.exists(edges, on)


def cells_with_edges(areas: DataFrame) -> DataFrame:
    """(cx, cy, country, edges): of each area and one-degree cell, the edges that decide whether a point of the cell is
    inside: those in the cell's rows that don't end left of it. Cells without any are outside."""
    held = cut(areas.withColumn("area", F.monotonically_increasing_id()))
    edges = held.select("area", "country", F.explode("edges").alias("e"))
    low, high = lambda a, b: F.floor(F.least(a, b)), lambda a, b: F.floor(F.greatest(a, b))
    west = edges.groupBy("area").agg(F.min(low("e.x1", "e.x2")).alias("west"))
    rows = edges.join(west, "area").withColumn("cy", F.explode(F.sequence(low("e.y1", "e.y2"), high("e.y1", "e.y2"))))
    cells = rows.withColumn("cx", F.explode(F.sequence("west", high("e.x1", "e.x2"))))
    return cells.groupBy("area", "country", "cx", "cy").agg(F.collect_list("e").alias("edges")).drop("area")


def assign_countries(rows: DataFrame, areas: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``rows`` with ``country``: the sorted distinct names, split at `` / ``, of all areas that cover the point, boundary
    included; ``Unassigned`` without any.

    Only distinct positions are tested, and each against the edges that its one-degree cell needs.
    """
    places = rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    places = places.withColumns({"cx": F.floor("_lon"), "cy": F.floor("_lat")})
    inside = places.join(cells_with_edges(areas), ["cx", "cy"]).where(covers(F.col("edges"), F.col("_lon"), F.col("_lat")))
    names = inside.select("_lat", "_lon", F.explode(F.split("country", " / ")).alias("name")).groupBy("_lat", "_lon").agg(F.array_join(F.array_sort(F.collect_set("name")), " / ").alias("_country"))
    joined = rows.drop("country").join(names, (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "left")
    return joined.withColumn("country", F.coalesce("_country", F.lit(UNASSIGNED))).drop("_lat", "_lon", "_country")
