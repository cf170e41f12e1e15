"""Stream steps. Times are instants; days are days in UTC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from straitflow.config import CHOKEPOINT_BOXES, CONFLICT_ROOTS, SUPPLY_CHAIN_ROOTS, Box
from straitflow.functions.dates import utc_date, utc_midnight
from straitflow.operators.clean import keep_roots, with_event_date
from straitflow.operators.panel import panel_aggregates
from straitflow.operators.tagging import tag_by_expression


def dedup_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time: str = "event_time",
    delay: str = "2 days",
    salts: int = 16,
) -> DataFrame:
    """First arrival of each key; a key is remembered for ``delay`` past its time.

    Put the day into ``keys`` to match the batch form, whose key holds the date. A stream
    has no map-side step for this, so each key is first reduced per salt, the number of
    the reading task, and then over the salts: a hot key is spread over ``salts`` tasks.
    """
    salted = stream.withWatermark(time, delay).withColumn("_salt", F.spark_partition_id() % salts)
    return (
        salted.dropDuplicatesWithinWatermark([*keys, "_salt"])
        .drop("_salt")
        .dropDuplicatesWithinWatermark(list(keys))
    )


def tagged_stream(
    stream: DataFrame,
    boxes: Sequence[Box] = CHOKEPOINT_BOXES,
    roots: Sequence[str] = SUPPLY_CHAIN_ROOTS,
) -> DataFrame:
    """Code filter and tags on an event stream, with ``event_time`` at the start of the day."""
    dated = stream if "event_date" in stream.columns else with_event_date(stream)
    tagged = tag_by_expression(keep_roots(dated, roots), boxes)
    return tagged.filter(F.col("event_date").isNotNull()).withColumn(
        "event_time", utc_midnight("event_date")
    )


def daily_panel_stream(
    tagged: DataFrame, delay: str = "1 day", conflict_roots: Sequence[str] = CONFLICT_ROOTS
) -> DataFrame:
    """Tumbling day by box: the stream form of the daily panel."""
    return (
        tagged.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 day"), "chokepoint")
        .agg(*panel_aggregates(conflict_roots))
        .withColumn("event_date", utc_date("window.start"))
        .drop("window")
    )


def count_by_day(stream: DataFrame, by: str, time: str = "event_time", delay: str = "1 day") -> DataFrame:
    """Tumbling day by ``by``: rows per group. In append mode only closed days come out."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day"), by)
        .agg(F.count("*").alias("event_count"))
        .select(utc_date("window.start").alias("event_date"), by, "event_count")
    )


def rolling_stream(tagged: DataFrame, days: int = 7, delay: str = "1 day") -> DataFrame:
    """Sliding window of ``days`` days, a day at a time, by box.

    Events are summed to days first and the sliding window runs over the daily sums;
    sliding over events would multiply every event by ``days`` ahead of the shuffle.
    """
    daily = (
        tagged.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 day"), "chokepoint")
        .agg(F.count("*").alias("event_count"), F.sum("NumMentions").alias("total_mentions"))
    )
    return (
        daily.groupBy(F.window(F.window_time("window"), f"{days} days", "1 day"), "chokepoint")
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("total_mentions").alias("total_mentions"),
        )
        .select(
            F.date_sub(utc_date("window.end"), 1).alias("last_date"),
            "chokepoint",
            "event_count",
            "total_mentions",
        )
    )


def enrich_stream(tagged: DataFrame, prices: DataFrame) -> DataFrame:
    """Stream-static join with the price features of the day.

    Pass a stored table: one row per trading day, small enough to be broadcast by its
    file size, so the stream needs no shuffle and a hot day no single task.
    """
    wanted = prices.select(F.col("price_date").alias("event_date"), "close", "return_5d", "volatility_20d")
    return tagged.join(wanted, "event_date")


def alert_rows(panel: DataFrame, min_events: int = 2, min_conflict: float = 0.75) -> DataFrame:
    """Days on which most of several events near a box were violent."""
    return panel.filter(
        (F.col("event_count") >= min_events) & (F.col("conflict_ratio") >= min_conflict)
    )


def score_stream(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions of a saved model for feature rows as they arrive."""
    return model.transform(features).select("event_date", "chokepoint", "prediction")
