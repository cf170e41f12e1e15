from __future__ import annotations

import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from straitflow.config import MACRO_SERIES
from straitflow.operators import labels, panel, series

D0 = date(2024, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def prices(spark, closes, commodity="x"):
    return spark.createDataFrame(
        [(day(i), commodity, c) for i, c in enumerate(closes)], "price_date date, commodity string, close float"
    )


def by_day(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_rows_and_calendar_windows_differ_over_a_gap(spark):
    rows = [(day(0), "h", 1.0), (day(1), "h", 3.0), (day(20), "h", 8.0), (day(5), "single", 4.0)]
    df = spark.createDataFrame(rows, "event_date date, chokepoint string, event_count double")
    observed = panel.rolling_means(df, (7,), ("event_count",)).filter("chokepoint='h'")
    assert by_day(observed, "event_date", "event_count_7d") == {day(0): 1.0, day(1): 2.0, day(20): 4.0}
    calendar = panel.rolling_means(df, (7,), ("event_count",), mode="days")
    assert by_day(calendar.filter("chokepoint='h'"), "event_date", "event_count_7d")[day(20)] == 8.0
    assert by_day(calendar.filter("chokepoint='single'"), "event_date", "event_count_7d") == {day(5): 4.0}


def test_null_dates_form_no_group(spark):
    rows = [(None, "h", "19"), (day(0), "h", "19"), (day(0), "h", "14")]
    df = spark.createDataFrame(rows, "event_date date, chokepoint string, EventRootCode string").selectExpr(
        "*", "1.0D AS GoldsteinScale", "2.0D AS AvgTone", "3 AS NumMentions"
    )
    out = panel.daily_panel(df).collect()
    assert len(out) == 1 and out[0].event_count == 2 and out[0].conflict_ratio == 0.5


def test_returns_with_zero_and_negative_prices(spark):
    closes = [10.0, 0.0, -5.0, 5.0, None, 20.0]
    out = by_day(series.with_daily_return(prices(spark, closes)), "price_date", "daily_return")
    assert out == {day(0): None, day(1): -1.0, day(2): None, day(3): -2.0, day(4): None, day(5): None}


def test_volatility_of_one_value_is_null(spark):
    out = by_day(series.with_volatility(prices(spark, [1.0, 2.0, 3.0])), "price_date", "volatility_20d")
    assert out[day(0)] is None and out[day(1)] is None
    assert out[day(2)] == pytest.approx(pd.Series([1.0, 0.5]).std())


def test_last_rows_have_no_label_and_ties_are_middle(spark):
    rows = [(day(i), "x", r) for i, r in enumerate([-1.0, 0.0, 0.0, 0.0, 1.0])] + [(day(9), "x", None)]
    df = spark.createDataFrame(rows, "price_date date, commodity string, fwd_return_5d double")
    got = by_day(labels.tercile_labels(df, (0.25, 0.75)), "price_date", "label")
    assert got == {day(0): 0, day(1): 1, day(2): 1, day(3): 1, day(4): 2, day(9): None}


def test_thresholds_can_leave_out_the_test_period(spark):
    rows = [(day(i), "x", float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "price_date date, commodity string, fwd_return_5d double")
    early = by_day(labels.tercile_labels(df, (0.33, 0.66), fit_before=day(3)), "price_date", "label")
    assert [early[day(i)] for i in range(4)] == [0, 1, 2, 2]


def test_each_commodity_has_its_own_thresholds(spark):
    rows = [(day(i), c, float(i) * k) for c, k in (("x", 1), ("y", 100)) for i in range(9)]
    df = spark.createDataFrame(rows, "price_date date, commodity string, fwd_return_5d double")
    counts = labels.tercile_labels(df).groupBy("commodity", "label").count().collect()
    assert {(r.commodity, r.label): r["count"] for r in counts} == {
        (c, k): 3 for c in "xy" for k in (0, 1, 2)
    }


def test_approximate_quantiles_stay_within_their_error(spark):
    df = spark.range(10_001).select((F.col("id") / 10_000).alias("fwd_return_5d"))
    got = labels.return_quantiles(df, approximate=True).first()
    assert abs(got.low - 0.33) <= 0.011 and abs(got.high - 0.66) <= 0.011


def macro_frame(spark, rows):
    return spark.createDataFrame(rows, "date date, treasury_10y double, usd_index double")


def test_values_before_the_spine_are_carried_in_only_on_request(spark):
    macro = macro_frame(spark, [(day(-3), 1.0, 9.0), (day(2), None, 5.0), (day(3), 2.0, None)])
    bounds = spark.createDataFrame([(day(0), day(4))], "min_date date, max_date date")
    plain = series.macro_daily(macro, bounds, MACRO_SERIES).orderBy("date").collect()
    assert [(r.treasury_10y, r.usd_index) for r in plain] == [
        (None, None),
        (None, None),
        (None, 5.0),
        (2.0, 5.0),
        (2.0, 5.0),
    ]
    carried = series.macro_daily(macro, bounds, MACRO_SERIES, carry_in=True).orderBy("date").collect()
    assert [(r.treasury_10y, r.usd_index) for r in carried] == [
        (1.0, 9.0),
        (1.0, 9.0),
        (1.0, 5.0),
        (2.0, 5.0),
        (2.0, 5.0),
    ]


@pytest.mark.parametrize("bucket", [None, "month", "day"])
def test_forward_fill_in_buckets_equals_plain(spark, bucket):
    rng = random.Random(1)
    rows = [
        (s, day(i), rng.random() if rng.random() < 0.03 else None) for s in "ab" for i in range(400)
    ]
    df = spark.createDataFrame(rows, "s string, d date, v double")
    expr = {None: None, "month": F.trunc("d", "month"), "day": F.col("d")}[bucket]
    got = {(r.s, r.d): r.v for r in series.forward_fill(df, "s", "d", ["v"], expr).collect()}
    last, want = {}, {}
    for s, d, v in sorted(rows, key=lambda r: (r[0], r[1])):
        last[s] = v if v is not None else last.get(s)
        want[(s, d)] = last[s]
    assert got == want


@pytest.mark.parametrize("bucket", [None, "month"])
def test_asof_join_with_a_hot_day(spark, bucket):
    rng = random.Random(2)
    left = [("a" if i % 4 else "b", day(100) if i % 3 == 0 else day(rng.randrange(300)), i) for i in range(900)]
    right = [(s, day(n), rng.random()) for s in "ab" for n in rng.sample(range(20, 300), 25)]
    joined = series.asof_join(
        spark.createDataFrame(left, "s string, d date, i int"),
        spark.createDataFrame(right, "s string, d date, v double"),
        "s",
        "d",
        "v",
        F.trunc("d", "month") if bucket else None,
    )
    lf = pd.DataFrame(left, columns=["s", "d", "i"]).assign(d=lambda x: pd.to_datetime(x.d)).sort_values("d")
    rf = pd.DataFrame(right, columns=["s", "d", "v"]).assign(d=lambda x: pd.to_datetime(x.d)).sort_values("d")
    want = pd.merge_asof(lf, rf, on="d", by="s").set_index("i").v
    got = {r.i: r.v for r in joined.collect()}
    assert len(got) == 900
    assert all((got[i] is None and pd.isna(v)) or got[i] == v for i, v in want.items())


def test_plan_has_no_single_partition_window_over_series(spark):
    macro = macro_frame(spark, [(day(2), 1.0, 5.0)])
    filled = series.forward_fill(series.long_series(macro, MACRO_SERIES), "series_id", "date", ["value"])
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
