from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from straitflow.config import CHOKEPOINT_BOXES, Box
from straitflow.operators.tagging import (
    boxes_frame,
    keep_any_box,
    tag_by_bins,
    tag_by_expression,
    tag_by_grid,
    tag_by_range,
    with_box_flags,
)

POINTS = "id int, ActionGeo_Lat double, ActionGeo_Long double"
OVERLAPPING = (Box("a", 0.0, 10.0, 0.0, 10.0), Box("b", 5.0, 15.0, 5.0, 15.0), Box("n", -3.5, -0.5, -7.0, -2.0))


def pairs(df):
    return sorted((r.id, r.chokepoint) for r in df.collect())


def random_points(n=2000, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((i, 26.0, 56.0))
        elif i % 7 == 0:
            rows.append((i, None, rng.uniform(-180, 180)))
        else:
            b = rng.choice(CHOKEPOINT_BOXES)
            rows.append((i, rng.uniform(b.lat_min - 2, b.lat_max + 2), rng.uniform(b.lon_min - 2, b.lon_max + 2)))
    return rows


def brute(rows, boxes):
    return sorted(
        (i, b.name)
        for i, lat, lon in rows
        for b in boxes
        if lat is not None and b.lat_min <= lat <= b.lat_max and b.lon_min <= lon <= b.lon_max
    )


WAYS = {
    "expression": tag_by_expression,
    "range": tag_by_range,
    "grid": tag_by_grid,
    "box table": lambda e, b: tag_by_grid(e, boxes_frame(e.sparkSession, b)),
    "fine grid": lambda e, b: tag_by_bins(e, b, 0.7, 0.3),
}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("boxes", [CHOKEPOINT_BOXES, OVERLAPPING])
def test_all_ways_agree_with_brute_force(spark, way, boxes):
    rows = random_points() + [(9001, 7.0, 7.0), (9002, 5.0, 10.0), (9003, -0.5, -7.0), (9004, 10.0, 0.0)]
    df = spark.createDataFrame(rows, POINTS)
    assert pairs(WAYS[way](df, boxes)) == brute(rows, boxes)


def test_edges_are_inclusive_for_doubles_but_not_for_rounded_floats(spark):
    rows = [(1, 25.06, 54.75), (2, 28.06, 57.75), (3, 28.07, 56.0), (4, 25.05, 56.0)]
    doubles = spark.createDataFrame(rows, POINTS)
    assert pairs(tag_by_expression(doubles)) == [(1, "hormuz"), (2, "hormuz")]
    floats = doubles.withColumn("ActionGeo_Lat", F.col("ActionGeo_Lat").cast("float"))
    # 25.06 and 28.06 as 32-bit floats are 25.0599995 and 28.0599995
    assert pairs(tag_by_expression(floats)) == [(2, "hormuz")]
    assert pairs(tag_by_grid(floats)) == [(2, "hormuz")]


def test_flags_and_any_box(spark):
    df = spark.createDataFrame([(1, 26.0, 56.0), (2, None, 56.0), (3, 0.0, 0.0)], POINTS)
    flagged = {r.id: r for r in with_box_flags(df).collect()}
    assert flagged[1].near_hormuz and not flagged[1].near_suez
    assert flagged[2].near_hormuz is False
    assert [r.id for r in keep_any_box(df).collect()] == [1]
