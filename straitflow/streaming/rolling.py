"""Means over the last rows of each box, kept up to date by a stream of events in any order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from straitflow.config import CONFLICT_ROOTS, PANEL_METRICS
from straitflow.operators.panel import rolling_means
from straitflow.session import staged
from straitflow.streaming.changes import ChangeLog

#: Sums of a day from which its panel row follows; unlike means, they add up over batches.
SUMS = (
    "event_count long, sum_goldstein double, n_goldstein long, sum_tone double, n_tone long, "
    "total_mentions long, conflict_events long"
)
DAY_KEYS = ("chokepoint", "event_date")
SUM_NAMES = [field.split()[0] for field in SUMS.split(", ")]


def day_sums(tagged: DataFrame, conflict_roots: Sequence[str] = CONFLICT_ROOTS) -> DataFrame:
    """Sums per box and day."""
    return (
        tagged.filter(F.col("event_date").isNotNull())
        .groupBy("event_date", "chokepoint")
        .agg(
            F.count("*").alias("event_count"),
            F.sum("GoldsteinScale").cast("double").alias("sum_goldstein"),
            F.count("GoldsteinScale").alias("n_goldstein"),
            F.sum("AvgTone").cast("double").alias("sum_tone"),
            F.count("AvgTone").alias("n_tone"),
            F.sum("NumMentions").cast("long").alias("total_mentions"),
            F.count_if(F.col("EventRootCode").isin(*conflict_roots)).alias("conflict_events"),
        )
    )


def panel_from_sums(days: DataFrame) -> DataFrame:
    """The daily panel."""
    return days.select(
        "event_date",
        "chokepoint",
        "event_count",
        F.try_divide("sum_goldstein", "n_goldstein").alias("avg_goldstein"),
        F.try_divide("sum_tone", "n_tone").alias("avg_tone"),
        "total_mentions",
        F.try_divide("conflict_events", "event_count").alias("conflict_ratio"),
    )


def rolled_schema(windows: Sequence[int]) -> str:
    kinds = {"event_count": "long", "total_mentions": "long"}
    own = [f"{m} {kinds.get(m, 'double')}" for m in PANEL_METRICS]
    means = [f"{m}_{n}d double" for m in PANEL_METRICS for n in windows]
    return ", ".join(["event_date date, chokepoint string", *own, *means])


class RollingRows:
    """Panel rows with means over the last rows of their box, for events that arrive in any order.

    Two change logs are kept below `path`: the sums of each day, and the panel rows with their means. A batch adds
    its sums to those of the days that it touches, reads the days of the boxes that it touches, and writes the rows
    that changed: those of touched days and as many rows behind each as a window reaches. A late day changes the rows
    behind it, and no event is dropped for being late. All of it is bounded by boxes and calendar days, not by events.
    """

    def __init__(self, spark: SparkSession, path: str, windows: Sequence[int] = (7, 30), fold_every: int = 16):
        self.windows = tuple(windows)
        self.days = ChangeLog(spark, f"{path}/days", f"event_date date, chokepoint string, {SUMS}", DAY_KEYS, fold_every)
        self.rows = ChangeLog(spark, f"{path}/rows", rolled_schema(windows), DAY_KEYS, fold_every)

    def add(self, tagged: DataFrame, batch_id: int) -> None:
        """Takes in a batch of tagged events; repeating one changes nothing."""
        new = staged(day_sums(tagged), "touched-days")
        touched = new.select(*DAY_KEYS).withColumn("touched", F.lit(True))
        before = self.days.current(batch_id).join(new.select("chokepoint").distinct(), "chokepoint", "left_semi")
        summed = [F.sum(c).alias(c) for c in SUM_NAMES]
        days = staged(before.unionByName(new).groupBy(*DAY_KEYS).agg(*summed), "box-days")
        self.days.write(days.join(touched, list(DAY_KEYS), "left_semi"), batch_id)
        rolled = rolling_means(panel_from_sums(days), self.windows)
        reach = Window.partitionBy("chokepoint").orderBy("event_date").rowsBetween(1 - max(self.windows), 0)
        changed = rolled.join(touched, list(DAY_KEYS), "left").withColumn("_near", F.max("touched").over(reach))
        self.rows.write(changed.filter("_near").drop("touched", "_near"), batch_id)

    def current(self) -> DataFrame:
        return self.rows.current()


def writer(rolling: RollingRows, tag: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """What a stream of raw events calls for every micro-batch."""
    return lambda batch, batch_id: rolling.add(tag(batch), batch_id)
