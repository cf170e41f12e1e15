"""Streams over several micro-batches against the batch answer."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from straitflow.functions.dates import utc_date, utc_midnight, utc_timestamp
from straitflow.operators.panel import daily_panel
from straitflow.operators.tagging import tag_by_expression
from straitflow.streaming import sources, steps

EVENT = (
    "GLOBALEVENTID long, event_date date, SQLDATE int, EventRootCode string, GoldsteinScale double, "
    "AvgTone double, NumMentions int, ActionGeo_Lat double, ActionGeo_Long double"
)


def event(i, day, root="19", mentions=1, lat=26.0):
    d = date(2024, 1, 1) + timedelta(days=day)
    return (i, d, int(d.strftime("%Y%m%d")), root, float(i % 5), 1.0, mentions, lat, 56.0)


def write_batches(spark, path, schema, *batches):
    """One file per batch, read in the order written."""
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("append").parquet(path)


def event_stream(spark, path):
    schema = spark.read.parquet(path).schema
    return sources.file_stream(spark, path, schema, files_per_trigger=1)


def as_set(df):
    return sorted(map(tuple, df.collect()))


def test_daily_panel_over_batches_equals_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(
        spark,
        path,
        EVENT,
        [event(1, 0), event(2, 1, "18", 3), event(3, 0, "01")],
        [event(4, 1, "14"), event(5, 2), event(6, 1, lat=-80.0)],
        [event(7, 2, "17", 5), event(8, 3)],
    )
    stream = steps.tagged_stream(event_stream(spark, path))
    got = sources.run_update(
        steps.daily_panel_stream(stream, delay="10 days"), "panel", ["event_date", "chokepoint"]
    )
    coded = spark.read.parquet(path).filter("EventRootCode != '01'")
    batch = daily_panel(tag_by_expression(coded))
    assert as_set(got.select(*batch.columns)) == as_set(batch)


def test_late_rows_are_dropped_and_open_days_held_back(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = "event_time timestamp, kind string"
    at = lambda day, hour=12: datetime(2024, 1, 1 + day, hour)
    write_batches(
        spark,
        path,
        schema,
        [(at(0), "a"), (at(1), "a")],
        [(at(0, 13), "a"), (at(6), "a")],  # late by a day: within the delay
        [(at(6, 13), "b")],
        # behind the watermark; rows are tested against that of the batch before
        [(at(1, 1), "a"), (at(7), "b")],
    )
    stream = event_stream(spark, path)
    got = sources.run_append(steps.count_by_day(stream, "kind", delay="2 days"), "late")
    # the watermark ends at day 7 12:00 minus two days, so days 6 and 7 stay open
    assert as_set(got) == [(date(2024, 1, 1), "a", 2), (date(2024, 1, 2), "a", 1)]


def test_dedup_over_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = "event_time timestamp, user string, day int"
    at = lambda day, hour: datetime(2024, 1, 1 + day, hour)
    write_batches(
        spark,
        path,
        schema,
        [(at(0, 1), "u", 0), (at(0, 2), "u", 0), (at(0, 2), None, 0)],
        [(at(0, 20), "u", 0), (at(1, 1), "u", 1), (at(0, 3), None, 0)],
        [(at(1, 9), "u", 1), (at(2, 9), "v", 2)],
    )
    got = sources.run_append(
        steps.dedup_stream(event_stream(spark, path), ["user", "day"]).select("user", "day"), "dedup"
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("u", 0), (None, 0), ("u", 1), ("v", 2)], key=repr
    )


def test_rolling_over_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(
        spark, path, EVENT, [event(1, 0), event(2, 0)], [event(3, 1, mentions=4)], [event(4, 20)], [event(5, 21)]
    )
    stream = steps.tagged_stream(event_stream(spark, path))
    got = {r.last_date.day: (r.event_count, r.total_mentions) for r in
           sources.run_append(steps.rolling_stream(stream, days=3), "rolling").collect()}
    assert {k: v for k, v in got.items() if k < 10} == {1: (2, 2), 2: (3, 6), 3: (3, 6), 4: (1, 4)}


def test_enrichment_and_alerts(spark, tmp_path):
    path = str(tmp_path / "in")
    write_batches(spark, path, EVENT, [event(1, 0), event(2, 0)], [event(3, 1, "14"), event(4, 1, "14")], [event(5, 9)])
    prices = spark.createDataFrame(
        [(date(2024, 1, 1), 70.0, 0.1, 0.2)], "price_date date, close double, return_5d double, volatility_20d double"
    )
    stream = steps.tagged_stream(event_stream(spark, path))
    enriched = steps.enrich_stream(stream, prices).select("GLOBALEVENTID", "close")
    assert as_set(sources.run_append(enriched, "enriched")) == [(1, 70.0), (2, 70.0)]
    alerts = steps.alert_rows(steps.daily_panel_stream(stream)).select("event_date", "event_count")
    assert as_set(sources.run_append(alerts, "alerts")) == [(date(2024, 1, 1), 2)]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_days_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:15.25' AS t, DATE'2024-03-10' AS d").select(
            F.unix_micros(utc_timestamp("t")).alias("micros"),
            utc_date(utc_timestamp("t")).alias("day"),
            F.unix_seconds(utc_midnight("d")).alias("midnight"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.micros == 1710037815250000
    assert row.day == date(2024, 3, 10)
    assert row.midnight == 1710028800
