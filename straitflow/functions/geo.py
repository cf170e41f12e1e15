"""Point-in-box expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from straitflow.config import Box

LAT, LON = "ActionGeo_Lat", "ActionGeo_Long"


def in_box(box: Box, lat: str = LAT, lon: str = LON) -> Column:
    return F.col(lat).between(box.lat_min, box.lat_max) & F.col(lon).between(box.lon_min, box.lon_max)


def in_any_box(boxes: Sequence[Box], lat: str = LAT, lon: str = LON) -> Column:
    return reduce(or_, (in_box(b, lat, lon) for b in boxes))


def _floor(value: float, step: float) -> int:
    return math.floor(value / step)


def near_any_box(boxes: Sequence[Box], lat: str = LAT, lon: str = LON, step: float = 2.0) -> Column:
    """Whether the point lies on a grid cell that some box touches: a superset of the boxes.

    Looks one number up in a set, however many boxes there are. Coordinates that are no
    places on earth make null, not an overflow.
    """
    width = 100_000
    cells = {
        x * width + y
        for b in boxes
        for x in range(_floor(b.lat_min, step), _floor(b.lat_max, step) + 1)
        for y in range(_floor(b.lon_min, step), _floor(b.lon_max, step) + 1)
    }
    row = F.floor(F.col(lat).cast("double") / step)
    column = F.floor(F.col(lon).cast("double") / step)
    cell = F.try_add(F.try_multiply(row, F.lit(width).cast("long")), column)
    return cell.isin(*sorted(cells))


def box_names(boxes: Sequence[Box], lat: str = LAT, lon: str = LON) -> Column:
    """Array with the name of every box that holds the point.

    Concatenated from one-element arrays, which is compiled; filtering an array of
    nulls would call an interpreted lambda per element.
    """
    none = F.array().cast("array<string>")
    return F.concat(
        *[F.when(in_box(b, lat, lon), F.array(F.lit(b.name))).otherwise(none) for b in boxes]
    )
