"""Return and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def relative_change(new: Column, old: Column) -> Column:
    """(new - old) / old, null where the base is zero or missing."""
    return F.try_divide(new - old, old)


def three_way_label(value: Column, low: Column, high: Column) -> Column:
    """2 above ``high``, 0 below ``low``, 1 between (ties included), null stays null."""
    return (
        F.when(value.isNull(), F.lit(None).cast("int"))
        .when(value > high, F.lit(2))
        .when(value < low, F.lit(0))
        .otherwise(F.lit(1))
    )
