"""Stream results that depend on more than a batch: change log, rolling rows, as-of join, deliveries."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from straitflow.operators.panel import daily_panel, rolling_means
from straitflow.operators.series import asof_join
from straitflow.streaming import asof, rolling, sources
from straitflow.streaming.changes import ChangeLog

TAGGED = (
    "event_date date, chokepoint string, EventRootCode string, GoldsteinScale double, AvgTone double, NumMentions int"
)
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rounded(frame, columns):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.select(*columns).collect()), key=repr
    )


def test_change_log_gives_last_versions(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v long").schema
    log = ChangeLog(spark, str(tmp_path / "log"), schema, ["k"], fold_every=3)
    expected = {}
    assert log.current().count() == 0
    for batch in range(8):
        rows = {f"k{(batch * 7 + j) % 10}": batch * 100 + j for j in range(3)} | {None: batch}
        log.write(spark.createDataFrame(list(rows.items()), schema), batch)
        log.write(spark.createDataFrame(list(rows.items()), schema), batch)  # repeated
        before = dict(expected)
        expected |= rows
        assert dict(map(tuple, log.current().collect())) == expected
        assert dict(map(tuple, log.current(batch).collect())) == before
    assert log._written("snapshot") == [2, 5]


def test_incomplete_batches_are_not_read(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v long").schema
    log = ChangeLog(spark, str(tmp_path / "log"), schema, ["k"])
    log.write(spark.createDataFrame([("a", 1)], schema), 0)
    log.write(spark.createDataFrame([("a", 2)], schema), 1)
    (tmp_path / "log" / "change" / "batch=1" / "_SUCCESS").unlink()
    assert [tuple(r) for r in log.current().collect()] == [("a", 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rolling_rows_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        day = date(2024, 1, 1) + timedelta(days=int(rng.random() ** 2 * 120))
        tone = rng.choice([None, 1.5, -2.25, 0.0])
        rows.append((day, rng.choice(["hormuz", "hormuz", "suez"]), rng.choice(["14", "19"]), rng.uniform(-9, 9), tone, rng.randrange(5)))
    rows += [(None, "suez", "19", 1.0, 1.0, 1), (date(2023, 1, 1), "panama", "18", None, None, None)]
    deliveries = [rows[i::6] for i in range(6)]
    rng.shuffle(deliveries)
    kept = rolling.RollingRows(spark, str(tmp_path / "state"), windows=(3, 8), fold_every=2)
    for number, part in enumerate([*deliveries[:4], [], *deliveries[4:]]):
        kept.add(spark.createDataFrame(part, TAGGED), number)
        if number == 2:
            kept.add(spark.createDataFrame(part, TAGGED), number)  # a batch that was repeated
    batch = rolling_means(daily_panel(spark.createDataFrame(rows, TAGGED)), (3, 8))
    assert rounded(kept.current(), batch.columns) == rounded(batch, batch.columns)


def test_rolling_rows_write_changes_only(spark, tmp_path):
    kept = rolling.RollingRows(spark, str(tmp_path / "state"), windows=(3,))
    days = [(date(2024, 1, 1) + timedelta(days=i), b, "19", 1.0, 1.0, 1) for i in range(50) for b in ("suez", "hormuz")]
    kept.add(spark.createDataFrame(days, TAGGED), 0)
    kept.add(spark.createDataFrame([(date(2024, 1, 10), "suez", "19", 1.0, 1.0, 1)], TAGGED), 1)
    written = {p: spark.read.parquet(str(tmp_path / "state" / p / "change" / "batch=1")).count() for p in ("days", "rows")}
    assert written == {"days": 1, "rows": 3}


def test_deliveries_are_batches_of_several_files(spark, tmp_path):
    path = str(tmp_path / "in")
    parts = [spark.range(n).select("id", F.lit(i).alias("part")) for i, n in enumerate([1000, 1, 0, 7])]
    sources.deliver(parts, path, files=3)
    assert len(list((tmp_path / "in").glob("part-*"))) == 12
    seen = []
    stream = sources.file_stream(spark, path, parts[0].schema, files_per_trigger=3)
    sources.run_batches(stream, lambda b, i: seen.append(sorted({r.part for r in b.collect()})), str(tmp_path / "check"))
    assert seen == [[0], [1], [], [3]]


LEFT, RIGHT = "k string, at timestamp, id long, note string", "k string, at timestamp, value double"


def asof_over(spark, tmp_path, left, right, delay, salts):
    for name, batches, schema in (("left", left, LEFT), ("right", right, RIGHT)):
        sources.deliver([spark.createDataFrame(b, schema) for b in batches], str(tmp_path / name), files=2)
    streams = [
        sources.file_stream(spark, str(tmp_path / n), spark.createDataFrame([], s).schema, files_per_trigger=2)
        for n, s in (("left", LEFT), ("right", RIGHT))
    ]
    return sources.run_append(asof.asof_stream(*streams, ["k"], "at", "value", delay, salts), "asof")


@pytest.mark.parametrize("salts", [1, 5])
def test_asof_stream_equals_the_batch_join(spark, tmp_path, salts):
    rng = random.Random(salts)
    hour = timedelta(hours=1)
    left = [("hot" if rng.random() < 0.7 else rng.choice("ab"), START + rng.randrange(400) * hour, i, rng.choice([None, "x", 'q"'])) for i in range(300)]
    right = list({(k, t): (k, t, rng.choice([None, 1.5, 2.0, -3.0])) for k, t in
                  ((rng.choice(["hot", "a", "c"]), START + rng.randrange(20, 400) * hour) for _ in range(90))}.values())
    # Rows arrive by time in four batches; reports up to 30 hours later than they are dated.
    def batches(rows, lag):
        out = [[] for _ in range(4)]
        for r in rows:
            out[min(3, int(((r[1] - START) / hour + lag()) // 100))].append(r)
        return out

    got = asof_over(spark, tmp_path, batches(left, lambda: 0), batches(right, lambda: rng.randrange(30)), "40 hours", salts)
    closed = max(r[1] for r in left + right) - 40 * hour
    known = spark.createDataFrame(right, RIGHT).where("value IS NOT NULL")
    batch = asof_join(spark.createDataFrame(left, LEFT), known, "k", "at", "value").where(F.col("at") < F.lit(closed))
    columns = ["k", "at", "id", "note", "value"]
    assert rounded(got, columns) == rounded(batch, columns)
    assert got.where("value IS NULL AND reported_at IS NOT NULL OR reported_at > at").count() == 0
    assert got.where("reported_at IS NOT NULL").count() > 50


def test_asof_stream_edge_cases(spark, tmp_path):
    at = [START + timedelta(days=i) for i in range(10)]
    left = [[("a", at[1], 1, "x"), ("a", at[1], 1, "x"), ("a", None, 2, None), (None, at[2], 3, "n"), ("b", at[3], 4, None)], [("z", at[9], 5, None)]]
    right = [[("a", at[1], 1.0), ("a", at[1], 7.0), ("a", None, 9.0), ("a", at[0], None), (None, at[1], 2.5)], []]
    got = asof_over(spark, tmp_path, left, right, "1 day", 3)
    assert rounded(got, ["k", "id", "value"]) == sorted([("a", 1, 7.0), ("a", 1, 7.0), (None, 3, 2.5), ("b", 4, None)], key=repr)


def test_files_of_a_delivery_grow_with_its_rows(spark):
    parts = [spark.range(n) for n in (3, 95, 0)]
    assert sources.files_for(parts, rows_per_file=10) == 10
    assert sources.files_for(parts) == sources.DELIVERY_FILES
