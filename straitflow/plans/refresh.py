"""Refresh of a written feature table with the days that a delivery touches."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from straitflow.config import FeatureSettings
from straitflow.operators.features import complete_rows, event_panel, panel_features
from straitflow.plans.jobs import write_panel
from straitflow.session import hadoop_path, staged

KEYS = ["event_date", "chokepoint"]


@dataclass(frozen=True)
class Refreshed:
    """What a refresh read and wrote: days touched, rows of events read, panel rows and feature rows recomputed."""

    days: int
    event_rows: int
    panel_rows: int
    feature_rows: int


def build(
    spark: SparkSession,
    events: DataFrame,
    prices: DataFrame,
    macro: DataFrame,
    panel_path: str,
    out: str,
    settings: FeatureSettings = FeatureSettings(),
) -> None:
    """Panel and feature table of all events, both by month."""
    write_panel(event_panel(events, settings), panel_path)
    panel = spark.read.parquet(panel_path).drop("year", "month")
    write_panel(complete_rows(panel_features(panel, prices, macro, settings)), out)


def touched_days(delivery: DataFrame) -> list[date]:
    """The days of a delivery's rows. Copies share their day, so no other day can change."""
    rows = delivery.select("event_date").distinct().where("event_date IS NOT NULL").collect()  # bounded by the calendar
    return sorted(r["event_date"] for r in rows)


def refresh(
    spark: SparkSession,
    events: DataFrame,
    days: Iterable[date],
    prices: DataFrame,
    macro: DataFrame,
    panel_path: str,
    out: str,
    settings: FeatureSettings = FeatureSettings(),
) -> Refreshed:
    """Brings panel and feature table up to date after events of some days were added; equals a full `build`.

    `events` are all events, the new ones included; only those of the days are read, and of a store only the files of
    their months. A day's panel rows are computed anew. They change the means of their box as far as the longest window reaches
    from them, so those rows of the panel are rolled and joined anew, and the months that hold any are written again.
    Prices, macro series and settings have to be those of the build: other ones move labels everywhere. Means over
    calendar days reach no further than means over as many rows, so they are refreshed alike.
    A refresh that broke off can be repeated.
    """
    days = sorted(set(days))
    if not days:
        return Refreshed(0, 0, 0, 0)
    read = Observation()
    rows = _of_days(events, days).observe(read, F.count(F.lit(1)).alias("rows"))
    fresh = staged(event_panel(rows, settings), "fresh-days")
    on_days = F.col("event_date").isin(days)
    old = spark.read.parquet(panel_path).drop("year", "month")
    # Rows that the days had before matter too: a row may have gone.
    _merge(spark, panel_path, old.filter(~on_days), fresh, {(d.year, d.month) for d in days})
    panel = spark.read.parquet(panel_path).drop("year", "month")
    changed = staged(_reached(panel, days, max(settings.windows)), "reached")
    features = staged(
        complete_rows(panel_features(changed.drop("_wanted"), prices, macro, settings)).join(
            changed.filter("_wanted").select(*KEYS), KEYS, "left_semi"
        ),
        "fresh-features",
    )
    wanted = changed.filter("_wanted")
    months = {tuple(r) for r in wanted.select(F.year("event_date"), F.month("event_date")).distinct().collect()}
    # The rows of the days themselves may have no panel row any more.
    stale = spark.read.parquet(out).drop("year", "month").filter(~on_days).join(wanted.select(*KEYS), KEYS, "left_anti")
    _merge(spark, out, stale, features, months | {(d.year, d.month) for d in days})
    return Refreshed(len(days), read.get["rows"], wanted.count(), features.count())


def _of_days(events: DataFrame, days: list[date]) -> DataFrame:
    if {"year", "month"} <= set(events.columns):
        months = sorted({d.year * 12 + d.month for d in days})
        events = events.filter((F.col("year") * 12 + F.col("month")).isin(months))
    return events.filter(F.col("event_date").isin(days))


def _reached(panel: DataFrame, days: list[date], size: int) -> DataFrame:
    """The panel rows within `size` rows behind a touched day of their box, marked `_wanted`, and those that their windows need."""
    marks = panel.select("chokepoint").distinct().select(
        "chokepoint", F.explode(F.array(*[F.lit(d) for d in days])).alias("event_date"), F.lit(True).alias("_mark")
    )
    box = Window.partitionBy("chokepoint").orderBy("event_date", F.col("_mark").isNull())
    rows = (
        panel.withColumn("_mark", F.lit(None).cast("boolean"))
        .unionByName(marks, allowMissingColumns=True)
        .withColumn("_touched", F.max(F.when(F.col("_mark"), F.col("event_date"))).over(box))
        .filter("_mark IS NULL")
        .drop("_mark")
    )
    order = Window.partitionBy("chokepoint").orderBy("event_date")
    # A row that has gone is not counted, so the row of one step more is looked at too.
    first = F.coalesce(F.lag("event_date", size).over(order), F.col("_touched"))
    reached = rows.withColumn("_wanted", F.coalesce(F.col("_touched") >= first, F.lit(False)))
    ahead = order.rowsBetween(0, size - 1)
    return reached.withColumn("_needed", F.max("_wanted").over(ahead)).filter("_needed").drop("_touched", "_needed")


def _merge(
    spark: SparkSession, path: str, kept: DataFrame, fresh: DataFrame, months: set[tuple[int, int]]
) -> None:
    """Writes months of a table anew: the rows kept and the fresh ones; a month without any goes."""
    numbers = [y * 12 + m for y, m in months]
    inside = (F.year("event_date") * 12 + F.month("event_date")).isin(numbers)
    merged = staged(kept.filter(inside).unionByName(fresh), "merged")
    write_panel(merged, path)
    left = {tuple(r) for r in merged.select(F.year("event_date"), F.month("event_date")).distinct().collect()}
    root = hadoop_path(spark, path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for year, month in months - left:
        fs.delete(hadoop_path(spark, f"{path}/year={year}/month={month}"), True)
