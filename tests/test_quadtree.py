"""Boxes of all sizes against brute force, and how many boxes a point is compared with."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from straitflow.operators import quadtree
from straitflow.operators.tagging import tag_by_grid

POINTS = "id long, ActionGeo_Lat double, ActionGeo_Long double, name string, box string, x0 long, level int"
BOXES = "name string, lat_min double, lat_max double, lon_min double, lon_max double"


def points_frame(spark, points):
    return spark.createDataFrame([(i, lat, lon, "n", "b", 1, 2) for i, (lat, lon) in enumerate(points)], POINTS)


def slow_tags(points, boxes):
    out = []
    for i, (lat, lon) in enumerate(points):
        for name, a, b, c, d in boxes:
            if None not in (lat, lon, a, b, c, d) and a <= lat <= b and c <= lon <= d:
                out.append((i, name))
    return out


@pytest.mark.parametrize("crowd, work", [(64, 100_000), (2, 1), (0, 0)])
def test_tags_equal_brute_force(spark, crowd, work):
    rng = random.Random(crowd)
    points = [(rng.choice([26.5, rng.uniform(-90, 90)]), rng.choice([56.0, rng.uniform(-180, 180)])) for _ in range(300)]
    points += [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (None, 1.0), (1.0, None), (float("nan"), 0.0), (95.0, 200.0), (45.0, 90.0)]
    boxes = []
    for i in range(150):
        h, w = 10 ** rng.uniform(-2, 2), 10 ** rng.uniform(-2, 2.5)
        lat, lon = rng.choice(points[:300])
        boxes.append((f"b{i}", lat - rng.random() * h, lat + h, lon - w, lon + rng.random() * w))
    boxes += [("world", -90.0, 90.0, -180.0, 180.0), ("point", 26.5, 26.5, 56.0, 56.0), ("edge", 0.0, 45.0, 0.0, 90.0),
              ("turned", 10.0, 5.0, 0.0, 1.0), ("null", None, 1.0, 0.0, 1.0), ("nan", float("nan"), 1.0, 0.0, 1.0),
              ("beyond", 89.0, 99.0, 170.0, 220.0), ("world", -90.0, 90.0, -180.0, 180.0), (None, 20.0, 30.0, 50.0, 60.0)]
    frame = points_frame(spark, points)
    got = quadtree.tag_by_quadtree(frame, spark.createDataFrame(boxes, BOXES), crowd, work)
    assert got.columns == [*frame.columns, "chokepoint"]
    key = lambda r: (r[0], r[1] or "")
    assert sorted(((r.id, r.chokepoint) for r in got.collect()), key=key) == sorted(slow_tags(points, boxes), key=key)


def test_empty_inputs(spark):
    frame, boxes = points_frame(spark, [(1.0, 1.0)]), spark.createDataFrame([("b", 0.0, 2.0, 0.0, 2.0)], BOXES)
    assert quadtree.tag_by_quadtree(frame.limit(0), boxes).count() == 0
    assert quadtree.tag_by_quadtree(frame, boxes.limit(0)).count() == 0
    assert quadtree.tag_by_quadtree(frame, boxes).count() == 1


def test_same_tags_as_the_grid(spark):
    rng = random.Random(3)
    frame = points_frame(spark, [(rng.uniform(-60, 60), rng.uniform(-100, 100)) for _ in range(400)]).drop("name")
    rows = [(f"b{i}", -50.0 + i, -45.0 + i, -90.0 + 2 * i, -80.0 + 2 * i) for i in range(90)]
    boxes = spark.createDataFrame(rows, BOXES)
    pick = lambda t: sorted((r.id, r.chokepoint) for r in t.collect())
    assert pick(quadtree.tag_by_quadtree(frame, boxes, 1, 1)) == pick(tag_by_grid(frame, boxes))


def test_a_hundred_thousand_boxes(spark):
    """From 0.01 to 180 degrees, crowded at a few places: cells stay few, and points meet few boxes that do not hold them."""
    rng = np.random.default_rng(5)
    n, m = 100_000, 3_000
    towns = np.stack([rng.uniform(-70, 70, 12), rng.uniform(-170, 170, 12)])
    at = towns[:, rng.integers(0, 12, n)] + rng.normal(0, 2, (2, n))
    side = np.minimum(180.0, 0.01 * 10 ** (4.26 * rng.random(n) ** 3))
    boxes = np.stack([at[0] - side / 4, at[0] + side / 4, at[1] - side / 2, at[1] + side / 2])
    points = np.concatenate([towns[:, rng.integers(0, 12, m)] + rng.normal(0, 2, (2, m)), np.tile(towns[:, :1], m)], axis=1)
    frame = points_frame(spark, [tuple(p) for p in points.T.tolist()])
    table = spark.createDataFrame([(f"b{i}", *b) for i, b in enumerate(boxes.T.tolist())], BOXES)
    inside = np.array([
        ((boxes[0] <= lat) & (lat <= boxes[1]) & (boxes[2] <= lon) & (lon <= boxes[3])).sum() for lat, lon in points.T
    ])
    groups = quadtree.box_groups(table)
    places = quadtree.with_places(frame)
    entries = quadtree.cover(places.select("_x", "_y"), groups).persist()
    try:
        assert entries.count() < 12 * n
        met = quadtree.candidates(places.select("_event.id", "_x", "_y"), entries)
        counts = met.groupBy("id").agg(F.count("*").alias("met"), F.count_if("whole").alias("whole")).collect()
        met_of = {r.id: r.met for r in counts}
        over = [met_of.get(i, 0) - k for i, k in enumerate(inside.tolist())]
        assert min(over) >= 0
        assert sum(met_of.values()) < 4 * inside.sum() + 200 * len(over)
    finally:
        entries.unpersist()
    tagged = quadtree.tag_by_quadtree(frame, table).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in tagged} == {i: k for i, k in enumerate(inside.tolist()) if k}


def test_counts_equal_those_of_the_tags(spark):
    rng = random.Random(5)
    points = [(rng.choice([26.5, rng.uniform(20, 30)]), rng.choice([56.0, rng.uniform(50, 60)])) for _ in range(200)]
    points += [points[0]] * 5 + [(None, 1.0), (float("nan"), 0.0), (-0.0, 0.0), (0.0, -0.0)]
    boxes = [(f"b{i % 25}", lat - 1, lat + i, lon - 2, lon) for i, (lat, lon) in enumerate(points[:40])]
    boxes += [boxes[0], (None, 20.0, 30.0, 50.0, 60.0), ("zero", 0.0, 0.0, 0.0, 0.0), ("none", 70.0, 71.0, 0.0, 1.0)]
    found = quadtree.count_by_quadtree(points_frame(spark, points), spark.createDataFrame(boxes, BOXES), 2, 1)
    assert found.columns == ["name", "event_count"]
    want = {}
    for _, name in slow_tags(points, boxes):
        want[name] = want.get(name, 0) + 1
    assert {r.name: r.event_count for r in found.collect()} == want


def test_events_at_a_place_and_names_of_a_box_are_not_multiplied(spark):
    place = spark.range(200_000).selectExpr("id", "26.5D AS ActionGeo_Lat", "56D AS ActionGeo_Long")
    boxes = spark.range(50_000).selectExpr("concat('b', id) AS name", "26D AS lat_min", "27D AS lat_max", "55D AS lon_min", "57D AS lon_max")
    found = quadtree.count_by_quadtree(place, boxes).agg(F.count("*"), F.min("event_count"), F.max("event_count"))
    assert tuple(found.first()) == (50_000, 200_000, 200_000)  # of 10**10 tags
