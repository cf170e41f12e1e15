"""What is kept over deliveries: event history, refreshed features, retired months."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from straitflow.config import Box, FeatureSettings
from straitflow.operators.clean import dedup_events
from straitflow.operators.features import feature_table
from straitflow.plans import refresh
from straitflow.sources import catalog, events, sample
from straitflow.sources.history import EventHistory
from straitflow.sources.schemas import EVENT_SCHEMA

KEYED = (
    "GLOBALEVENTID long, SQLDATE int, SOURCEURL string, Actor1Code string, Actor2Code string, EventRootCode string, "
    "GoldsteinScale double, AvgTone double, NumMentions int, ActionGeo_Lat double, ActionGeo_Long double"
)


def random_events(rng, n, hot=False):
    rows = []
    for _ in range(n):
        url = "hot" if hot and rng.random() < 0.4 else rng.choice(["u1", "u2", "u3", None])
        day = rng.choice([20240101, 20240131, 20240215, 20230101, None])
        rows.append((rng.randrange(60), day, url, rng.choice(["A", None]), rng.choice(["B", "C"]), rng.choice(["14", "19"]),
                     rng.choice([None, 1.0, 2.5]), rng.choice([0.5, 1.5]), rng.randrange(3), rng.choice([None, 26.0]), 56.0))
    return rows


def counted(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture
def history(spark, tmp_path, request):
    names = []

    def open_at(folder="history", name=None):
        name = name or f"history_{len(names)}_{re.sub('[^a-z]', '_', request.node.name.lower())}"
        names.append(name)
        return EventHistory(spark, name, str(tmp_path / folder), KEYED, buckets=4)

    yield open_at
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("seed", [1, 2])
def test_history_holds_the_survivors_of_all_deliveries(spark, history, seed):
    rng = random.Random(seed)
    deliveries = [random_events(rng, n, hot=True) for n in (120, 1, 80, 200)]
    known, seen = history(), []
    for part in (deliveries[0], deliveries[1], deliveries[0], [], deliveries[2], deliveries[3]):
        seen += part
        known.add(spark.createDataFrame(part, KEYED))
        expected = counted(dedup_events(spark.createDataFrame(seen, KEYED)).select(*known.columns))
        assert counted(known.survivors()) == expected
    assert known.add(spark.createDataFrame(seen, KEYED)) == 0
    folded = known.fold("folded_history", known.spark.conf.get("spark.checkpoint.dir") + f"/folded-{seed}")
    assert counted(folded.survivors()) == expected == counted(spark.table("folded_history").select(*known.columns))
    spark.sql("DROP TABLE folded_history")


def test_history_is_opened_again(spark, history):
    rng = random.Random(4)
    first, second = random_events(rng, 100), random_events(rng, 100)
    history(name="history_once").add(spark.createDataFrame(first, KEYED))
    spark.sql("DROP TABLE history_once")  # another session knows the folder only
    again = history(name="history_again")
    again.add(spark.createDataFrame(second, KEYED))
    assert counted(again.survivors()) == counted(dedup_events(spark.createDataFrame(first + second, KEYED)).select(*again.columns))
    january = again.survivors(months=[202401])
    assert {r.SQLDATE for r in january.collect()} <= {20240101, 20240131}


def test_history_is_not_shuffled(spark, history):
    known = history()
    known.add(spark.createDataFrame(random_events(random.Random(5), 300), KEYED))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = known.gains(spark.createDataFrame(random_events(random.Random(6), 50), KEYED))._jdf.queryExecution().executedPlan().toString()
        survivors = known.survivors()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in survivors and "Bucketed: true" in survivors
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan" in line)
    depth = re.search(r"[A-Z]", plan.splitlines()[scan]).start()
    above = [line for line in plan.splitlines()[:scan] if re.search(r"[A-Z]", line).start() < depth]
    ancestors, least = [], depth
    for line in reversed(above):
        at = re.search(r"[A-Z]", line).start()
        if at < least:
            ancestors.append(line)
            least = at
        if "Join" in line:
            break
    assert any("Join" in a for a in ancestors) and not any("Exchange" in a for a in ancestors)
    assert "Bucketed: true" in plan


# --- refresh ----------------------------------------------------------------

BOXES = (Box("hormuz", 25.0, 28.0, 54.0, 58.0), Box("suez", 29.0, 31.0, 31.0, 34.0))
SETTINGS = FeatureSettings(boxes=BOXES, scope=("hormuz", "suez"), commodity="oil")
STORED = "event_date date, " + KEYED


def stored(i, day, url, root="19", lat=26.0):
    return (day, i, int(day.strftime("%Y%m%d")), url, "A", "B", root, float(i % 5), 1.0, 1 + i % 3, lat, 56.0 if lat < 29 else 32.0)


@pytest.fixture
def markets(spark):
    start = date(2023, 11, 1)
    days = [start + timedelta(days=i) for i in range(200)]
    prices = [(d.isoformat(), 50.0 + (i * 37 % 23) + i / 10, "oil") for i, d in enumerate(days) if d.weekday() < 5]
    macro = [(d, 1.0 + i, 100.0 - i) for i, d in enumerate(days) if i % 7 == 0]
    return (
        spark.createDataFrame(prices, "date string, close double, commodity string").withColumn("date", F.col("date").cast("date")),
        spark.createDataFrame(macro, "date date, treasury_10y double, usd_index double"),
    )


def table_rows(frame, columns):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.select(*columns).collect()), key=repr)


def test_refresh_equals_a_full_build(spark, tmp_path, markets):
    rng = random.Random(7)
    days = [date(2023, 12, 1) + timedelta(days=i) for i in range(110)]
    all_rows = [stored(i + 10, rng.choice(days), f"u{i % 150}", rng.choice(["19", "14", "01"]), rng.choice([26.0, 30.0])) for i in range(500)]
    base = [r for r in all_rows if r[0] not in days[40:44] and r[0] != days[-1]]
    gone = next(r for r in base if sum(x[0] == r[0] and x[10] == r[10] for x in base) == 1 and r[6] != "01")
    lonely = stored(900, date(2024, 4, 20), "lonely")
    base.append(lonely)
    steps = [
        [r for r in all_rows if r[0] in days[40:44]],  # missing days
        [r for r in all_rows if r[0] == days[-1]] + [stored(777, days[3], "late")],  # the newest day and a late row
        # copies that come first, with a code nobody wants: rows of two days and one month vanish
        [(gone[0], 1, *gone[2:6], "01", *gone[7:]), (lonely[0], 1, *lonely[2:6], "01", *lonely[7:])],
        [],
    ]
    prices, macro = markets
    paths = str(tmp_path / "panel"), str(tmp_path / "features")
    seen = list(base)
    refresh.build(spark, spark.createDataFrame(seen, STORED), prices, macro, *paths, SETTINGS)
    for part in steps:
        seen += part
        frame = spark.createDataFrame(seen, STORED)
        touched = refresh.touched_days(spark.createDataFrame(part, STORED))
        for _ in range(2):  # repeating a refresh changes nothing
            done = refresh.refresh(spark, frame, touched, prices, macro, *paths, SETTINGS)
        full = feature_table(frame, prices, macro, SETTINGS)
        assert table_rows(spark.read.parquet(paths[1]), full.columns) == table_rows(full, full.columns)
        assert done.event_rows == sum(r[0] in touched for r in seen)
        assert done.panel_rows <= 2 * len(BOXES) * (max(SETTINGS.windows) + 1) * max(1, len(touched))


# --- retention --------------------------------------------------------------


def loaded(spark, store, ids, month, delivery):
    fields = spark.createDataFrame([], EVENT_SCHEMA).schema.fields
    columns = {"GLOBALEVENTID": F.col("id"), "SQLDATE": F.lit(20240001 + month * 100) + F.col("id") % 28}
    rows = spark.range(*ids).select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    events.write_event_store(rows, store, delivery=delivery)


def ids(spark, path):
    return sorted(r.GLOBALEVENTID for r in spark.read.parquet(path).select("GLOBALEVENTID").collect())


def test_late_rows_of_a_retired_month_are_kept(spark, tmp_path):
    store, archive = str(tmp_path / "store"), str(tmp_path / "archive")
    for month in (1, 2, 3):
        loaded(spark, store, (month * 100, month * 100 + 30), month, "in time")
    cutoff = date(2024, 3, 1)
    assert catalog.retire_before(spark, store, archive, cutoff) == [(2024, 1), (2024, 2)]
    loaded(spark, store, (1000, 1005), 1, "late")
    assert catalog.retire_before(spark, store, archive, cutoff) == [(2024, 1)]
    loaded(spark, store, (100, 131), 1, "in time")  # a delivery again, one row longer: it replaces itself
    assert catalog.retire_before(spark, store, archive, cutoff) == [(2024, 1)]
    assert ids(spark, archive) == sorted([*range(100, 131), *range(200, 230), *range(1000, 1005)])
    assert ids(spark, store) == list(range(300, 330))
    assert not list((tmp_path / "store").glob("year=2024/month=1")) and not list((tmp_path / "store" / "_retiring").glob("*"))


def test_retiring_deletes_the_copied_files_only(spark, tmp_path, monkeypatch):
    store, archive = str(tmp_path / "store"), str(tmp_path / "archive")
    loaded(spark, store, (0, 20), 1, "a")
    loaded(spark, store, (500, 510), 2, "a")
    write = catalog._write_archive

    def and_meanwhile(old, path):
        write(old, path)
        loaded(spark, store, (100, 110), 1, "b")

    monkeypatch.setattr(catalog, "_write_archive", and_meanwhile)
    catalog.retire_before(spark, store, archive, date(2024, 2, 1))
    assert ids(spark, archive) == list(range(20)) and ids(spark, store) == [*range(100, 110), *range(500, 510)]


def test_a_broken_off_retirement_is_finished(spark, tmp_path, monkeypatch):
    store, archive = str(tmp_path / "store"), str(tmp_path / "archive")
    loaded(spark, store, (0, 40), 1, "a")
    loaded(spark, store, (500, 510), 2, "a")
    finish, calls = catalog._finish_retiring, []

    def broken(spark, path):
        calls.append(path)
        if len(calls) > 1:  # after the list was written: one file goes, then the driver dies
            file = next((tmp_path / "store" / "year=2024" / "month=1" / "delivery=load-a").glob("part-*"))
            file.unlink()
            file.with_name(f".{file.name}.crc").unlink()
            raise RuntimeError("lost")
        finish(spark, path)

    monkeypatch.setattr(catalog, "_finish_retiring", broken)
    with pytest.raises(RuntimeError, match="lost"):
        catalog.retire_before(spark, store, archive, date(2024, 2, 1))
    monkeypatch.setattr(catalog, "_finish_retiring", finish)
    assert catalog.retire_before(spark, store, archive, date(2024, 2, 1)) == []
    assert ids(spark, archive) == list(range(40)) and ids(spark, store) == list(range(500, 510))


@pytest.mark.skipif(not __import__("pathlib").Path("/root/testdata/sf0.001").exists(), reason="no tables")
def test_no_row_is_lost_over_three_calls(spark, tmp_path):
    store, archive = str(tmp_path / "store"), str(tmp_path / "archive")
    rows = sample.as_event_rows(sample.table(spark, "/root/testdata/sf0.001", "lineitem"))
    late = F.col("NumMentions") == 7
    events.write_event_store(rows.filter(~late), store, delivery="in time")
    catalog.retire_before(spark, store, archive, date(1997, 1, 1))
    events.write_event_store(rows.filter(late), store, delivery="late")
    catalog.retire_before(spark, store, archive, date(1997, 1, 1))
    assert spark.read.parquet(store).count() + spark.read.parquet(archive).count() == rows.count() == 6000
