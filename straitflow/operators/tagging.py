"""Tagging events with the boxes that hold them.

Three ways with one result, a row per (event, box): expressions over a literal box
list, an equi-join on latitude bands, and an equi-join on grid cells. The joins
re-check the exact box, and since an event lies in a single band or cell, they make
no duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from straitflow.config import CHOKEPOINT_BOXES, Box
from straitflow.functions.geo import LAT, LON, box_names, in_any_box, in_box, near_any_box
from straitflow.session import staged


def keep_any_box(events: DataFrame, boxes: Sequence[Box] = CHOKEPOINT_BOXES) -> DataFrame:
    return events.filter(in_any_box(boxes))


def with_box_flags(events: DataFrame, boxes: Sequence[Box] = CHOKEPOINT_BOXES) -> DataFrame:
    """One boolean ``near_<box>`` per box, false where the point is unknown."""
    return events.withColumns({f"near_{b.name}": F.coalesce(in_box(b), F.lit(False)) for b in boxes})


def tag_by_expression(events: DataFrame, boxes: Sequence[Box] = CHOKEPOINT_BOXES) -> DataFrame:
    """Explode the names of the boxes around each point; no join, stays in one stage.

    The filter ahead reads each coordinate once. With the inner form of explode the
    optimizer would put a test of the whole array ahead as well.
    """
    tagged = events.filter(near_any_box(boxes)).withColumn("_boxes", box_names(boxes))
    return (
        tagged.withColumn("chokepoint", F.explode_outer("_boxes"))
        .filter(F.col("chokepoint").isNotNull())
        .drop("_boxes")
    )


def boxes_frame(spark: SparkSession, boxes: Sequence[Box] = CHOKEPOINT_BOXES) -> DataFrame:
    """The box list as a table ``name, lat_min, lat_max, lon_min, lon_max``."""
    rows = [
        F.struct(
            F.lit(b.name).alias("name"),
            *[
                F.lit(float(getattr(b, c))).alias(c)
                for c in ("lat_min", "lat_max", "lon_min", "lon_max")
            ],
        )
        for b in boxes
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def _bin(c: Column, step: float) -> Column:
    return F.floor(c.cast("double") / F.lit(float(step)))


def _bins(low: str, high: str, step: float) -> Column:
    return F.explode(F.sequence(_bin(F.col(low), step), _bin(F.col(high), step)))


def tag_by_bins(
    events: DataFrame,
    boxes: Sequence[Box] | DataFrame = CHOKEPOINT_BOXES,
    lat_step: float = 2.0,
    lon_step: float | None = 2.0,
) -> DataFrame:
    """Equi-join of points and boxes on latitude bands, or on cells if ``lon_step`` is given.

    The cells are staged, so their true size decides: a small table is broadcast by the session's
    threshold, a large one joined by shuffle. One cell may hold a large share of all events (places
    are geocoded to a few centroids); in a shuffle join AQE splits it.
    """
    table = boxes if isinstance(boxes, DataFrame) else boxes_frame(events.sparkSession, boxes)
    cells = table.withColumn("_lat_bin", _bins("lat_min", "lat_max", lat_step))
    points = events.withColumn("_lat_bin", _bin(F.col(LAT), lat_step))
    on = ["_lat_bin"]
    if lon_step is not None:
        cells = cells.withColumn("_lon_bin", _bins("lon_min", "lon_max", lon_step))
        points = points.withColumn("_lon_bin", _bin(F.col(LON), lon_step))
        on.append("_lon_bin")
    inside = F.col(LAT).between(F.col("lat_min"), F.col("lat_max")) & F.col(LON).between(
        F.col("lon_min"), F.col("lon_max")
    )
    return (
        points.join(staged(cells, "cells"), on)
        .filter(inside)
        .select(*events.columns, F.col("name").alias("chokepoint"))
    )


def tag_by_range(events: DataFrame, boxes: Sequence[Box] | DataFrame = CHOKEPOINT_BOXES) -> DataFrame:
    """Range join over one dimension: latitude bands, longitude checked after."""
    return tag_by_bins(events, boxes, lon_step=None)


def tag_by_grid(events: DataFrame, boxes: Sequence[Box] | DataFrame = CHOKEPOINT_BOXES) -> DataFrame:
    """Range join over two dimensions: grid cells."""
    return tag_by_bins(events, boxes)
