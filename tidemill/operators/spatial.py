"""Nearest-place and point-in-polygon joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import EARTH_KM, unit_sphere
from ..session import cut_lineage
from .neighbors import knn_join


def nearest_join(left: DataFrame, right: DataFrame, left_xy: tuple[str, str], right_xy: tuple[str, str], right_id: str,
                 name: str = "nearest", radius_km: float = EARTH_KM, **plan) -> DataFrame:
    """Attach the id of the great-circle nearest right row and its distance in metres (ties: smallest id).

    ``*_xy`` are (lon, lat) columns. Equal coordinates are collapsed on both sides
    first, so any number of rows at one place costs one search. On the unit sphere the
    straight-line distance orders places as the great circle does, which makes this a
    nearest-neighbour join of three-dimensional vectors; filter the right side to restrict it.
    """
    place = F.concat_ws("|", *[F.col(c).cast("double").cast("string") for c in left_xy])
    spots = left.where(F.col(left_xy[0]).isNotNull() & F.col(left_xy[1]).isNotNull()) \
        .select(place.alias("_spot"), unit_sphere(*[F.col(c) for c in left_xy]).alias("_v")).dropDuplicates(["_spot"])
    sites = cut_lineage(right.groupBy(*right_xy).agg(F.min(right_id).alias("_id"))
                        .select("_id", unit_sphere(*[F.col(c) for c in right_xy]).alias("_v")))
    chord = F.least(F.col("dist") / 2, F.lit(1.0))
    found = knn_join(spots, sites, 1, "l2", **plan).select(
        F.col("qid").alias("_spot"), F.col("rid").alias(name),
        (F.asin(chord) * (2 * radius_km * 1000)).alias(f"{name}_m"))
    return left.withColumn("_spot", place).join(found, "_spot", "left").drop("_spot")


def inside_ring(lon: Column, lat: Column, edges: Column) -> Column:
    """Even-odd ray crossing against ``edges``, an array of struct<x1, y1, x2, y2>."""
    crossed = F.filter(edges, lambda e: ((e["y1"] > lat) != (e["y2"] > lat)) & F.coalesce(
        lon < e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (lat - e["y1"]), e["y2"] - e["y1"]), F.lit(False)))
    return F.size(crossed) % 2 == 1


def _cell(c: str) -> Column:
    return F.floor(F.col(c) / F.pow(F.lit(2.0), "_level")).cast("bigint")


def cell_list(shapes: DataFrame) -> DataFrame:
    """Boxes ``_x0, _x1, _y0, _y1`` with ``_level, _cx, _cy``: one row for each cell they touch on the grid of their size."""
    extent = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"), F.lit(1e-9))
    return (shapes.withColumn("_level", F.ceil(F.log2(extent)).cast("int"))
            .withColumn("_cx", F.explode(F.sequence(_cell("_x0"), _cell("_x1"))))
            .withColumn("_cy", F.explode(F.sequence(_cell("_y0"), _cell("_y1")))))


def point_in_polygon(points: DataFrame, polygons: DataFrame, xy: tuple[str, str], polygon_id: str, ring: str,
                     label: str, default: str | None = "not available", name: str = "area") -> DataFrame:
    """Label of the first polygon (by id) holding each point, else ``default``.

    ``ring`` is an ``array<struct<lon, lat>>``, closed implicitly. Polygons are listed under the grid cells their bounding box
    touches, on the grid whose cells are the smallest power of two as wide as the box: at most four, however
    the sizes are mixed. A point meets the polygons of its own cell on each grid in use, and equal points are tested once.
    """
    corner = lambda fn, axis: fn(F.transform(F.col(ring), lambda p: p[axis]))
    n = F.size(ring)
    following = F.concat(F.slice(ring, 2, n - 1), F.slice(ring, 1, 1))
    shapes = polygons.select(
        F.col(polygon_id).alias("_pid"), F.col(label).alias("_label"),
        corner(F.array_min, "lon").alias("_x0"), corner(F.array_max, "lon").alias("_x1"),
        corner(F.array_min, "lat").alias("_y0"), corner(F.array_max, "lat").alias("_y1"),
        F.zip_with(F.col(ring), following, lambda a, b: F.struct(
            a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2"))).alias("_edges"))
    listed = cell_list(shapes)
    levels = [r[0] for r in listed.select("_level").distinct().collect()]      # powers of two between the sizes of boxes
    spots = points.select(*xy).where(F.col(xy[0]).isNotNull() & F.col(xy[1]).isNotNull()).distinct()
    spots = spots.withColumn("_level", F.explode(F.array(*[F.lit(v).cast("int") for v in levels]) if levels else F.array().cast("array<int>")))
    spots = spots.withColumns({"_cx": _cell(xy[0]), "_cy": _cell(xy[1])})
    boxed = F.col(xy[0]).between(F.col("_x0"), F.col("_x1")) & F.col(xy[1]).between(F.col("_y0"), F.col("_y1"))
    hits = spots.join(listed, ["_level", "_cx", "_cy"]).where(boxed & inside_ring(F.col(xy[0]), F.col(xy[1]), F.col("_edges")))
    first = hits.groupBy(*xy).agg(F.min(F.struct("_pid", "_label")).alias("_hit"))
    return points.join(first, list(xy), "left").withColumn(
        name, F.coalesce(F.col("_hit._label"), F.lit(default))).drop("_hit")
