"""Price features, date spine, forward fill and as-of join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from straitflow.functions.returns import relative_change
from straitflow.operators.panel import trailing
from straitflow.session import staged


def _by_date() -> WindowSpec:
    return Window.partitionBy("commodity").orderBy("price_date")


def with_lags(prices: DataFrame, lags: Sequence[int] = (1, 5, 20)) -> DataFrame:
    return prices.withColumns({f"close_lag{k}": F.lag("close", k).over(_by_date()) for k in lags})


def with_lead(prices: DataFrame, horizon: int = 5) -> DataFrame:
    return prices.withColumn(f"close_fwd{horizon}", F.lead("close", horizon).over(_by_date()))


def _change_since(k: int) -> Column:
    return relative_change(F.col("close"), F.lag("close", k).over(_by_date()))


def with_returns(prices: DataFrame, periods: Sequence[int] = (5, 20)) -> DataFrame:
    """``return_<k>d``: change against the close k rows earlier."""
    return prices.withColumns({f"return_{k}d": _change_since(k) for k in periods})


def with_daily_return(prices: DataFrame) -> DataFrame:
    return prices.withColumn("daily_return", _change_since(1))


def with_volatility(prices: DataFrame, size: int = 20) -> DataFrame:
    """Sample deviation of the daily return over the last ``size`` rows."""
    return with_daily_return(prices).withColumn(
        f"volatility_{size}d",
        F.stddev("daily_return").over(trailing("commodity", "price_date", size)),
    )


def with_forward_return(prices: DataFrame, horizon: int = 5) -> DataFrame:
    """``fwd_return_<h>d``: change to the close h rows later, null for the last h rows."""
    ahead = F.lead("close", horizon).over(_by_date())
    return prices.withColumn(f"fwd_return_{horizon}d", relative_change(ahead, F.col("close")))


def price_features(prices: DataFrame) -> DataFrame:
    """Returns, volatility and forward return of every commodity in ``prices``.

    Partitioned by commodity: one row per trading day, so a partition is bounded by
    the calendar.
    """
    return with_forward_return(with_volatility(with_returns(prices)))


def date_bounds(df: DataFrame, on: str) -> DataFrame:
    return df.agg(F.min(on).alias("min_date"), F.max(on).alias("max_date"))


def date_spine(bounds: DataFrame, name: str = "date") -> DataFrame:
    """One row per calendar day between the two dates of a one-row frame."""
    return bounds.select(F.explode(F.sequence("min_date", "max_date")).alias(name))


def long_series(wide: DataFrame, series: Sequence[str], on: str = "date") -> DataFrame:
    """``date, series_id, value`` without the days on which a series does not report."""
    return (
        wide.select(F.col(on).alias("date"), *[F.col(s).cast("double").alias(s) for s in series])
        .unpivot("date", list(series), "series_id", "value")
        .filter(F.col("date").isNotNull() & F.col("value").isNotNull())
    )


def forward_fill(
    df: DataFrame,
    by: str,
    on: str,
    columns: Sequence[str],
    bucket: Column | None = None,
) -> DataFrame:
    """Last known value at or before each row, per ``by``.

    With ``bucket``, an expression that grows with ``on`` (a year, say), one long series
    is filled bucket by bucket in parallel: a first pass takes the last value of every
    bucket, a window over these few rows gives what each bucket inherits, and the second
    pass fills inside the buckets.
    """
    if bucket is None:
        upto = Window.partitionBy(by).orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in columns})

    df = df.withColumn("_bucket", bucket)
    last_known = df.groupBy(by, "_bucket").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(on))).alias(f"_in_{c}") for c in columns]
    )
    before = Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inherited = last_known.withColumns(
        {f"_in_{c}": F.last(f"_in_{c}", ignorenulls=True).over(before) for c in columns}
    )
    inside = Window.partitionBy(by, "_bucket").orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
    filled = df.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    return (
        filled.join(inherited, [by, "_bucket"], "left")
        .withColumns({c: F.coalesce(c, f"_in_{c}") for c in columns})
        .select(*[c for c in df.columns if c != "_bucket"])
    )


def spine_join(spine: DataFrame, wide: DataFrame, series: Sequence[str]) -> DataFrame:
    """Sparse series on the spine: null where nothing was reported."""
    return spine.join(wide.select("date", *series), "date", "left")


def macro_daily(
    macro: DataFrame,
    bounds: DataFrame,
    series: Sequence[str],
    carry_in: bool = False,
) -> DataFrame:
    """Forward-filled macro values for every day of the spine, one column per series.

    Filled per series, not in one un-keyed window. A value reported before the spine
    begins is not carried in unless ``carry_in`` is set.
    """
    days = date_spine(bounds).withColumn(
        "series_id", F.explode(F.array(*[F.lit(s) for s in series]))
    )
    reported = long_series(macro, series)
    if carry_in:
        filled = asof_join(days, reported, "series_id", "date", "value", stage_lookup=False)
    else:
        filled = forward_fill(
            days.join(reported, ["series_id", "date"], "left"), "series_id", "date", ["value"]
        )
    return filled.groupBy("date").agg(
        *[F.max(F.when(F.col("series_id") == s, F.col("value"))).alias(s) for s in series]
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    on: str,
    value: str,
    bucket: Column | None = None,
    stage_lookup: bool = True,
) -> DataFrame:
    """Adds to each left row the last ``value`` of the same ``by`` at or before ``on``.

    No range join: the distinct (by, on) pairs of the left side, which a hot day or
    series cannot inflate, are stacked with the right side, filled forward, and looked
    up again by equality. ``bucket`` splits long series, as in ``forward_fill``.
    """
    wanted = left.select(by, on).distinct().withColumn(value, F.lit(None))
    known = right.select(by, on, value)
    # max() drops the null of a wanted row that coincides with a known one
    points = wanted.unionByName(known).groupBy(by, on).agg(F.max(value).alias(value))
    lookup = forward_fill(points, by, on, [value], bucket)
    if stage_lookup:
        lookup = staged(lookup, "asof")
    return left.join(lookup, [by, on], "left")
