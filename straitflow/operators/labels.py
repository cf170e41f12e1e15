"""Quantile thresholds and labels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from straitflow.functions.returns import three_way_label


def return_quantiles(
    prices: DataFrame,
    quantiles: Sequence[float] = (0.33, 0.66),
    column: str = "fwd_return_5d",
    approximate: bool = False,
    accuracy: int = 100,
) -> DataFrame:
    """One row ``low, high``: interpolated quantiles, or the sketch with error 1/accuracy.

    The exact form keeps the distinct values in one task. That is one value per
    trading day here; on a column without such a bound use the sketch.
    """
    q = F.array(*[F.lit(float(x)) for x in quantiles])
    cut = F.percentile_approx(column, q, accuracy) if approximate else F.percentile(column, q)
    known = prices.filter(F.col(column).isNotNull())
    return known.agg(cut.alias("q")).select(
        F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(1)).alias("high")
    )


def tercile_labels(
    prices: DataFrame,
    quantiles: Sequence[float] = (0.33, 0.66),
    fit_before: date | None = None,
) -> DataFrame:
    """Adds ``label`` 0/1/2 by the quantiles of the commodity's forward returns.

    The thresholds are taken over the partition the return windows already made, so they
    cost no second scan and no driver round trip. They cover the whole price range;
    ``fit_before`` restricts them to earlier dates, so that labels of a test period do
    not shape them.
    """
    basis = F.col("fwd_return_5d")
    if fit_before is not None:
        basis = F.when(F.col("price_date") < F.lit(fit_before), basis)
    q = F.array(*[F.lit(float(x)) for x in quantiles])
    cut = F.percentile(basis, q).over(Window.partitionBy("commodity"))
    low, high = F.get("_cut", F.lit(0)), F.get("_cut", F.lit(1))
    return (
        prices.withColumn("_cut", cut)
        .withColumn("label", three_way_label(F.col("fwd_return_5d"), low, high))
        .drop("_cut")
    )


def high_volatility_labels(prices: DataFrame, quantile: float = 0.66) -> DataFrame:
    """Adds ``high_volatility``: 1 above the commodity's quantile of ``volatility_20d``, else 0."""
    cut = F.percentile("volatility_20d", F.lit(float(quantile))).over(Window.partitionBy("commodity"))
    return prices.withColumn("_cut", cut).select(
        *prices.columns, (F.col("volatility_20d") > F.col("_cut")).cast("int").alias("high_volatility")
    )


def label_histogram(df: DataFrame, column: str = "label") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("row_count")).orderBy(column)
