"""Date projections, code filter and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from straitflow.config import DEDUP_KEYS, DEDUP_ORDER, SUPPLY_CHAIN_ROOTS
from straitflow.functions.dates import date_from_int
from straitflow.session import staged


def with_event_date(events: DataFrame) -> DataFrame:
    """Adds ``event_date``. Done once at ingest; the store holds the result."""
    return events.withColumn("event_date", date_from_int("SQLDATE"))


def with_date_parts(events: DataFrame) -> DataFrame:
    """Adds ``year`` and ``month``; a raw ``Year`` column is replaced, names being case-insensitive."""
    return events.withColumns({"year": F.year("event_date"), "month": F.month("event_date")})


def keep_roots(events: DataFrame, roots: Sequence[str] = SUPPLY_CHAIN_ROOTS) -> DataFrame:
    return events.filter(F.col("EventRootCode").isin(*roots))


def dedup_events(
    events: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    order: Sequence[str] = DEDUP_ORDER,
) -> DataFrame:
    """One row per key, nulls being equal: the first by ``order``.

    The default order tells any two different rows of the analysis columns apart; for wider rows,
    give an order over their columns too, or the survivor of a tie is not fixed.

    The rank filter is pushed into the sort on both sides of the shuffle, so a key
    that holds a third of all rows sends one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return events.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_matching(
    events: DataFrame,
    predicate: Column,
    keys: Sequence[str] = DEDUP_KEYS,
    order: Sequence[str] = DEDUP_ORDER,
) -> DataFrame:
    """``dedup_events(events).filter(predicate)`` for a predicate that few rows pass.

    Only keys with a passing row can come out. The 8-byte hashes of those keys are staged, and a
    semi-join on them drops the other rows ahead of the de-duplication; rows whose hash is shared by
    accident only travel in vain. The staged size tells the planner whether it can broadcast the
    hashes, so that the other rows need no shuffle at all, or joins by shuffle, where AQE splits a
    hot key. The input is scanned twice: worth it over a stored table, not over an expensive plan.
    """
    key = F.xxhash64(*keys)
    passing = staged(events.filter(predicate).select(key.alias("_key")).distinct(), "keys")
    near = events.withColumn("_key", key).join(passing, "_key", "left_semi")
    return dedup_events(near.select(*events.columns), keys, order).filter(predicate)


def dedup_any(events: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """One arbitrary row per key: for callers that need no repeatable survivor."""
    return events.dropDuplicates(list(keys))


def count_keys(events: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Rows, distinct keys and the share of rows that de-duplication removes."""
    per_key = events.groupBy(*keys).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.sum("copies").alias("row_count"), F.count("*").alias("key_count")
    ).withColumn(
        "removed_ratio", 1 - F.try_divide(F.col("key_count").cast("double"), F.col("row_count"))
    )
