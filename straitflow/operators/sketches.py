"""Quantile sketches that are stored per month and merged for any range of months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches: a rank error of about 1.3 % at 200, 0.33 % at 800.
SIZE = 800


def monthly_sketches(rows: DataFrame, by: str, on: str, value: str, size: int = SIZE) -> DataFrame:
    """by, month_start, sketch: the values of each month. Null dates and values are left out; so are NaN, which have no rank.

    Sketches add up: those of a late delivery are appended as further rows of their months. They are filled on the map side, so a
    month or key with most of the rows moves one sketch per task.
    """
    known = rows.filter(F.col(on).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return known.groupBy(by, F.trunc(F.col(on), "month").alias("month_start")).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch")
    )


def range_quantiles(
    sketches: DataFrame, ranges: DataFrame, by: str, quantiles: Sequence[float] = (0.33, 0.66), size: int = SIZE
) -> DataFrame:
    """range_id, by, n, cuts: quantiles of the values in ranges of months (range_id, first_month, last_month), ends included.

    Only sketches are read: a row per key and month, however many values they stand for. Ranges may overlap. A
    range without values has no row.
    """
    # A range is spelt out as its months, so that the join is by equality.
    months = F.sequence(F.trunc("first_month", "month"), F.trunc("last_month", "month"), F.expr("INTERVAL 1 MONTH"))
    wanted = ranges.filter("first_month <= last_month").select("range_id", F.explode(months).alias("month_start"))
    merged = (
        sketches.join(wanted, "month_start")
        .groupBy("range_id", by)
        .agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))
    )
    cuts = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for q in quantiles])
    return merged.select("range_id", by, F.kll_sketch_get_n_double("sketch").alias("n"), cuts.alias("cuts"))
