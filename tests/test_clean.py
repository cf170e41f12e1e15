from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from straitflow.config import DEDUP_KEYS, DEDUP_ORDER, FeatureSettings
from straitflow.functions.dates import date_from_int
from straitflow.operators.clean import (
    count_keys,
    dedup_any,
    dedup_events,
    dedup_matching,
    keep_roots,
    with_date_parts,
    with_event_date,
)
from straitflow.operators.features import clean_events

EVENT = (
    "GLOBALEVENTID long, SQLDATE int, SOURCEURL string, Actor1Code string, Actor2Code string, "
    "EventRootCode string, GoldsteinScale double, AvgTone double, NumMentions int, "
    "ActionGeo_Lat double, ActionGeo_Long double"
)


def event(i, sqldate=20240101, url="u", a1="A", a2="B", root="19", lat=26.0, lon=56.0):
    return (i, sqldate, url, a1, a2, root, 1.0, 2.0, 1, lat, lon)


@pytest.mark.parametrize(
    "value, expected",
    [
        (20240229, date(2024, 2, 29)),
        (20230229, None),
        (20241301, None),
        (20240100, None),
        (20240431, None),
        (20241231, date(2024, 12, 31)),
        (991231, None),
        (0, None),
        (-20240101, None),
        (None, None),
        (10000101, date(1000, 1, 1)),
        (99991231, date(9999, 12, 31)),
        (2147483647, None),
    ],
)
def test_dates(spark, value, expected):
    row = spark.createDataFrame([(value,)], "d int").select(date_from_int("d").alias("x")).first()
    assert row.x == expected


def test_date_parts_replace_the_raw_year(spark):
    df = spark.createDataFrame([(20240502, 1900)], "SQLDATE int, Year int")
    out = with_date_parts(with_event_date(df))
    assert [c.lower() for c in out.columns].count("year") == 1
    assert out.select("year", "month").first() == (2024, 5)


def test_survivor_may_have_another_code(spark):
    rows = [event(1, root="01"), event(2, root="19"), event(3, url="v", root="19")]
    df = spark.createDataFrame(rows, EVENT)
    assert [r.GLOBALEVENTID for r in clean_events(df).collect()] == [3]
    late = FeatureSettings(dedup_after_filter=True)
    assert sorted(r.GLOBALEVENTID for r in clean_events(df, late).collect()) == [2, 3]


def test_null_keys_are_equal(spark):
    rows = [event(1, a1=None), event(2, a1=None), event(3, a1="")]
    df = spark.createDataFrame(rows, EVENT)
    assert sorted(r.GLOBALEVENTID for r in dedup_events(df).collect()) == [1, 3]
    assert dedup_any(df).count() == 2
    counted = count_keys(df).first()
    assert (counted.row_count, counted.key_count) == (3, 2)


def hot_events(n=3000, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append(event(rng.randrange(n), url="hot", root=rng.choice(["01", "19"])))
        else:
            rows.append(
                event(
                    rng.randrange(n),
                    20240101 + rng.randrange(5),
                    f"u{rng.randrange(300)}",
                    rng.choice(["A", "B", None]),
                    rng.choice(["C", None]),
                    rng.choice(["01", "14", "18", "19"]),
                    rng.choice([26.0, 10.0]),
                )
            )
    return rows


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dedup_matches_brute_force_with_a_hot_key(spark):
    rows = hot_events()
    df = spark.createDataFrame(rows, EVENT)
    names = df.columns
    keys = [names.index(c) for c in DEDUP_KEYS]
    order = [names.index(c) for c in DEDUP_ORDER]
    best = {}
    for r in rows:
        k = tuple(r[i] for i in keys)
        if k not in best or tuple(r[i] for i in order) < tuple(best[k][i] for i in order):
            best[k] = r
    assert as_set(dedup_events(df)) == sorted(best.values(), key=repr)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_pruned_dedup_equals_dedup_then_filter(spark, threshold):
    df = spark.createDataFrame(hot_events(), EVENT).repartition(8)
    wanted = F.col("EventRootCode").isin("19") & (F.col("ActionGeo_Lat") > 20)
    expected = as_set(dedup_events(df).filter(wanted))
    assert expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        pruned = dedup_matching(df, wanted)
        assert as_set(pruned) == expected
        joined = "BroadcastHashJoin" if threshold == "10m" else "SortMergeJoin"
        assert joined in pruned._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_twice_changes_nothing(spark):
    once = dedup_events(spark.createDataFrame(hot_events(900), EVENT))
    assert as_set(dedup_events(once)) == as_set(once)


def test_roots_compare_as_text(spark):
    df = spark.createDataFrame([event(1, root="14"), event(2, root="014"), event(3, root=None)], EVENT)
    assert [r.GLOBALEVENTID for r in keep_roots(df).collect()] == [1]
