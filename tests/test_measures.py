"""Closeness, stored sketches, validation that walks forward, the forest's matrix, malformed lines."""

from __future__ import annotations

import random
from collections import Counter, deque
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from straitflow.config import MODEL_INPUTS
from straitflow.operators import graph, sketches, training
from straitflow.plans import jobs, registry
from straitflow.sources import sample

# --- closeness --------------------------------------------------------------


def slow_closeness(edges):
    out = {}
    following = {}
    for a, b in edges:
        following.setdefault(a, set()).add(b)
        following.setdefault(b, set())
    for start in following:
        far, queue = {start: 0}, deque([start])
        while queue:
            at = queue.popleft()
            for to in following[at]:
                if to not in far:
                    far[to] = far[at] + 1
                    queue.append(to)
        out[start] = (len(far) - 1, sum(1 / d for d in far.values() if d))
    return out


@pytest.mark.parametrize("per_salt", [1_000_000, 3])
def test_closeness_of_small_graphs_is_exact(spark, per_salt):
    rng = random.Random(per_salt)
    edges = [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(70)] + [("n1", "n1"), ("far", "away")]
    edges += [(f"leaf{i}", "hub") for i in range(20)] + edges[:5]
    found = graph.harmonic_closeness(spark.createDataFrame(edges, "src string, dst string"), edges_per_salt=per_salt)
    got = {r.node: (r.reached, round(r.closeness, 6)) for r in found.collect()}
    assert got == {n: (k, round(c, 6)) for n, (k, c) in slow_closeness(edges).items()}


def test_closeness_within_the_error_of_the_sketch(spark):
    rng = random.Random(2)
    edges = list({(rng.randrange(1500), rng.randrange(1500)) for _ in range(4000)}) + [(i, 7) for i in range(300)]
    found = graph.harmonic_closeness(spark.createDataFrame(edges, "src long, dst long"), lg_size=12)
    exact = slow_closeness(edges)
    for r in found.collect():
        reached, closeness = exact[r.node]
        assert abs(r.reached - reached) <= 0.08 * reached + 1 and abs(r.closeness - closeness) <= 0.08 * closeness + 1


def test_closeness_of_no_edges(spark):
    assert graph.harmonic_closeness(spark.createDataFrame([], "src string, dst string")).count() == 0


# --- sketches ---------------------------------------------------------------

VALUES = "commodity string, day date, value double"


def test_range_quantiles_have_their_ranks(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["oil", "oil", "gas"]), date(2020, 1, 1) + timedelta(days=rng.randrange(1400)), rng.choice([rng.gauss(0, 5), 1.0])) for _ in range(60_000)]
    rows += [("oil", None, 1.0), ("oil", date(2020, 1, 5), None), ("oil", date(2020, 1, 5), float("nan")), (None, date(2020, 1, 9), 3.0)]
    frame = spark.createDataFrame(rows, VALUES)
    halves = [sketches.monthly_sketches(frame.where(F.col("value") < 0), "commodity", "day", "value"),
              sketches.monthly_sketches(frame.where(~(F.col("value") < 0)), "commodity", "day", "value")]
    ranges = [(f"r{i}", date(2020, 1, 1) + timedelta(days=31 * i), date(2020, 1, 1) + timedelta(days=31 * i + 90 * (i + 1))) for i in range(12)]
    ranges += [("none", date(1990, 1, 1), date(1990, 5, 1)), ("turned", date(2021, 1, 1), date(2020, 1, 1)), ("all", date(2020, 1, 20), date(2024, 1, 1))]
    table = spark.createDataFrame(ranges, "range_id string, first_month date, last_month date")
    got = sketches.range_quantiles(halves[0].unionByName(halves[1]), table, "commodity", (0.1, 0.33, 0.66)).collect()
    assert {r.range_id for r in got} == {r[0] for r in ranges} - {"none", "turned"}
    for r in got:
        first, last = next(x[1:] for x in ranges if x[0] == r.range_id)
        inside = [v for c, d, v in rows if c == r.commodity and d and v is not None and v == v
                  and (first.year, first.month) <= (d.year, d.month) <= (last.year, last.month)]
        assert r.n == len(inside)
        for q, cut in zip((0.1, 0.33, 0.66), r.cuts):
            below, upto = sum(v < cut for v in inside), sum(v <= cut for v in inside)
            assert below <= (q + 0.01) * len(inside) + 1 and upto >= (q - 0.01) * len(inside) - 1


# --- validation -------------------------------------------------------------


def feature_rows(spark, days):
    rng = random.Random(4)
    columns = ", ".join(f"{c} double" for c in MODEL_INPUTS)
    rows = [(d, b, *[rng.random() for _ in MODEL_INPUTS], rng.randrange(3)) for d in days for b in ("suez", "hormuz")]
    return spark.createDataFrame(rows, f"event_date date, chokepoint string, {columns}, label int")


def test_folds_walk_forward_and_are_purged(spark):
    rng = random.Random(5)
    days = sorted(rng.sample([date(2024, 1, 1) + timedelta(days=i) for i in range(300)], 83))
    rows = feature_rows(spark, days)
    for folds, purge in ((1, 0), (3, 5), (5, 9)):
        got = training.walk_forward_folds(rows, folds, purge).select("fold", "role", "event_date").distinct().collect()
        for fold in range(1, folds + 1):
            train = [days.index(r.event_date) for r in got if r.fold == fold and r.role == "train"]
            later = [days.index(r.event_date) for r in got if r.fold == fold and r.role == "validation"]
            start, stop = 83 * fold // (folds + 1), 83 * (fold + 1) // (folds + 1)
            assert sorted(later) == list(range(start, stop)) and sorted(train) == list(range(start - purge))
    assert training.walk_forward_folds(rows.limit(0)).count() == 0


def test_scores_of_folds_that_walk_forward(spark):
    rows = feature_rows(spark, [date(2024, 1, 1) + timedelta(days=i) for i in range(60)])
    rows = rows.withColumn("label", (F.col("return_5d") > 0.5).cast("int"))
    model, scores = training.train_walk_forward(spark, rows, trees=(5,), depths=(1, 4))
    got = scores.collect()
    assert len(got) == 6 and all(r.validation_rows == 30 and r.train_rows == 30 * r.fold - 10 for r in got)
    fold = training.walk_forward_folds(rows).where("fold = 2")
    fitted = training.fit_forest(fold.where("role = 'train'"), num_trees=5, max_depth=4)
    judged = fitted.transform(fold.where("role = 'validation'")).collect()
    hits = sum(r.label == r.prediction for r in judged) / len(judged)
    assert next(r.accuracy for r in got if (r.fold, r.max_depth) == (2, 4)) == pytest.approx(hits)
    assert model.transform(rows).where("label = prediction").count() > 90
    with pytest.raises(ValueError, match="fold 1"):
        training.walk_forward_scores(spark, rows.where("event_date < '2024-01-08'"), trees=(2,), depths=(1,))


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no tables")
def test_forest_matrix_counts_predicted_rows(spark, monkeypatch):
    seen = []
    real = training.confusion_matrix
    monkeypatch.setattr(training, "confusion_matrix", lambda rows, *by: seen.append(rows) or real(rows, *by))
    got = {(r.split, r.label, r.prediction): r.row_count for r in registry.QUERIES["forest_confusion_matrix"](spark, "/root/testdata/sf0.001").collect()}
    expected = Counter((r.split, r.label, int(r.prediction)) for r in seen[0].select("split", "label", "prediction").collect())
    assert got == expected and len({p for _, _, p in got}) > 1


# --- malformed lines --------------------------------------------------------


def line(i, fields=58, day="20240105"):
    values = [str(i), day, "202401", "2024", "2024.01", *[""] * 53]
    values[26], values[30], values[57] = "190", "-5.5", f'http://x/{i}"'
    return "\t".join((values + ["extra"] * 5)[:fields])


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    raw, store, bad = (str(tmp_path / n) for n in ("raw", "store", "bad"))
    Path(raw).mkdir()
    good = [line(i) for i in range(40)] + [line(40, day=""), line(41, day="20249999")]
    spoilt = {line(50, 57): "too few fields", line(51, 60): "too many fields", "stray text": "too few fields", line(52, day="soon"): "bad value", line(53, day="20240105").replace("-5.5", "low"): "bad value"}
    (Path(raw) / "a.CSV").write_text("\n".join(good[:20] + list(spoilt)[:2]) + "\n\n")
    (Path(raw) / "b.CSV").write_text("\n".join(list(spoilt)[2:] + good[20:]))
    for _ in range(2):
        assert jobs.ingest_checked(spark, raw, store, bad, "day", max_bad_share=0.2) == (len(good), len(spoilt))
    kept = spark.read.parquet(bad)
    assert {r.line: r.reason for r in kept.collect()} == spoilt and kept.count() == len(spoilt)
    assert {r.file_name for r in kept.where("line = 'stray text'").collect()} == {"b.CSV"}
    assert sorted(r.GLOBALEVENTID for r in spark.read.parquet(store).collect()) == list(range(42))
    with pytest.raises(ValueError, match="5 of 47"):
        jobs.ingest_checked(spark, raw, str(tmp_path / "other"), str(tmp_path / "more"), "day", max_bad_share=0.1)
    assert not (tmp_path / "other").exists() and not (tmp_path / "more").exists()
    for name in ("a.CSV", "b.CSV"):  # the delivery again, in order now
        (Path(raw) / name).write_text("\n".join(good[:20] if name[0] == "a" else good[20:]))
    assert jobs.ingest_checked(spark, raw, store, bad, "day") == (len(good), 0)
    assert spark.read.parquet(bad).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no tables")
def test_good_and_bad_lines_are_all_lines(spark, tmp_path):
    rows = sample.as_event_rows(sample.table(spark, "/root/testdata/sf0.001", "lineitem"))
    sample.as_event_lines(rows).write.text(str(tmp_path / "raw"))
    good, bad = jobs.ingest_checked(spark, str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "b"), max_bad_share=1.0)
    assert good + bad == rows.count() and bad == rows.where("NumMentions > 4").count()
