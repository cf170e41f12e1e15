"""End-to-end jobs: ingest, feature build, training."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from straitflow.config import FeatureSettings
from straitflow.functions.geo import box_names
from straitflow.operators.features import (
    complete_rows,
    event_panel,
    keep_from,
    panel_features,
)
from straitflow.operators.training import confusion_matrix, importances, metrics, time_split, train_best
from straitflow.session import staged
from straitflow.sources.events import (
    read_event_store,
    scan_checked_events,
    scan_events,
    write_event_store,
    write_quarantine,
)
from straitflow.sources.market import coalesce_close, scan_macro, scan_wide_prices


def ingest(
    spark: SparkSession,
    raw: str,
    store: str,
    delivery: str | None = None,
    rebuild: bool = False,
    rebalance: bool = True,
) -> int:
    """Event files to the store in one pass; returns the rows loaded, counted along the way.

    A named delivery can be repeated; without a name every call adds one of its own. With ``rebuild``
    these files become the whole store. The counter is for progress: a task that had to be
    repeated may be counted twice.
    """
    loaded = Observation("loaded")
    rows = scan_events(spark, raw, lineage=True).observe(loaded, F.count(F.lit(1)).alias("rows"))
    write_event_store(rows, store, delivery or uuid.uuid4().hex, rebuild=rebuild, rebalance=rebalance)
    return loaded.get["rows"]


def ingest_checked(
    spark: SparkSession,
    raw: str,
    store: str,
    quarantine: str,
    delivery: str | None = None,
    max_bad_share: float = 0.01,
    rebuild: bool = False,
) -> tuple[int, int]:
    """As ``ingest``, with malformed lines kept apart; returns the rows stored and the lines quarantined.

    The parsed rows are staged, and lines counted along the way. If more than ``max_bad_share`` of them are malformed
    the load is given up before store or quarantine are touched: a file in another format is not a file with
    some bad lines.
    """
    lines = Observation("lines")
    parsed = scan_checked_events(spark, raw).observe(
        lines, F.count(F.lit(1)).alias("all"), F.count("bad_line").alias("bad")
    )
    parsed = staged(parsed, "parsed")
    counts = lines.get
    if counts["bad"] > max_bad_share * counts["all"]:
        raise ValueError(f"{counts['bad']} of {counts['all']} lines are malformed; nothing was loaded")
    delivery = delivery or uuid.uuid4().hex
    write_quarantine(parsed.filter("bad_line IS NOT NULL"), quarantine, delivery)
    write_event_store(parsed.filter("bad_line IS NULL").drop("bad_line"), store, delivery, rebuild=rebuild)
    return counts["all"] - counts["bad"], counts["bad"]


def build_panel(
    spark: SparkSession,
    store: str,
    out: str,
    settings: FeatureSettings = FeatureSettings(),
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """The daily panel of a range of days, written by month; returns the panel of all months written so far.

    A day depends on its own events only, so a long history may be built range by range. A range has
    to cover whole months, since a month is replaced as a whole.
    """
    if (start and start.day != 1) or (end and (end + timedelta(days=1)).day != 1):
        raise ValueError("a range of the panel begins and ends with a month")
    write_panel(event_panel(read_event_store(spark, store, start, end), settings), out)
    return spark.read.parquet(out).drop("year", "month")


def write_panel(panel: DataFrame, out: str) -> None:
    """A daily panel by month; the months that it has replace those written before."""
    (
        panel.filter("event_date IS NOT NULL")
        .withColumns({"year": F.year("event_date"), "month": F.month("event_date")})
        .repartition("year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(out)
    )


def build_features(
    spark: SparkSession,
    store: str,
    prices: str,
    macro: str,
    out: str,
    settings: FeatureSettings = FeatureSettings(),
    start: date | None = None,
    end: date | None = None,
    panel: DataFrame | None = None,
) -> DataFrame:
    """Store and market files to the written feature table, restricted to ``start`` .. ``end``.

    The restriction follows the rolling means, which see all earlier days. With a panel from
    ``build_panel`` no event is read again.
    """
    if panel is None:
        panel = event_panel(read_event_store(spark, store, end=end), settings)
    closes = coalesce_close(scan_wide_prices(spark, prices))
    table = complete_rows(panel_features(panel, closes, scan_macro(spark, macro), settings))
    if start is not None:
        table = keep_from(table, start)
    if end is not None:
        table = table.filter(F.col("event_date") <= F.lit(end))
    table.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def train(
    spark: SparkSession,
    features: DataFrame,
    model_path: str,
    start: date | None = None,
    **grid,
) -> tuple[PipelineModel, DataFrame, DataFrame, DataFrame]:
    """Fit on the training range and save; returns model, held-out metrics, importances and the confusion matrix."""
    rows = features if start is None else keep_from(features, start)
    split = time_split(rows).persist()
    try:
        model = train_best(split.filter(F.col("split") == "train"), **grid)
        model.write().overwrite().save(model_path)
        # A handful of rows each: evaluated here, while the split is still cached.
        held_out = model.transform(split.filter(F.col("split") != "train"))
        matrix = spark.createDataFrame(
            confusion_matrix(held_out, "split").collect(),
            "split string, label int, prediction int, row_count long",
        )
        scores = spark.createDataFrame(
            metrics(held_out, "split").collect(),
            "split string, row_count long, accuracy double, f1 double",
        )
    finally:
        split.unpersist()
    return model, scores, importances(spark, model), matrix


def preprocessing_funnel(
    events: DataFrame,
    unique: DataFrame,
    features: DataFrame,
    settings: FeatureSettings = FeatureSettings(),
) -> DataFrame:
    """Rows left after each step: ``position, step, row_count``.

    ``unique`` is ``dedup_events(analysis_rows(events))``: pass a stored frame and build the
    features from it too, so that events are de-duplicated once.
    Exact aggregates in one plan. Counters that ride along with a write are cheaper but
    may count a repeated task twice, so they only serve for progress.
    """
    # One pass: a row per event and box, the first of each event standing for the event.
    event = F.coalesce(F.col("_at"), F.lit(0)) == 0
    coded = F.col("EventRootCode").isin(*settings.roots)
    daily = (
        unique.select(
            "event_date",
            "EventRootCode",
            F.posexplode_outer(box_names(settings.boxes)).alias("_at", "chokepoint"),
        )
        .groupBy("event_date", "chokepoint")
        .agg(
            F.count_if(event).alias("unique"),
            F.count_if(event & coded).alias("coded"),
            F.count_if(coded & F.col("chokepoint").isNotNull()).alias("tagged"),
        )
    )
    steps = daily.agg(
        F.sum("unique").alias("unique"),
        F.sum("coded").alias("coded"),
        F.sum("tagged").alias("tagged"),
        F.count_if((F.col("tagged") > 0) & F.col("event_date").isNotNull()).alias("days"),
    )
    named = {
        "unique": (2, "without copies"),
        "coded": (3, "wanted codes"),
        "tagged": (4, "near a box"),
        "days": (5, "daily panel"),
    }

    def rows(frame: DataFrame, names: dict[str, tuple[int, str]]) -> DataFrame:
        return frame.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(position).alias("position"),
                            F.lit(step).alias("step"),
                            F.coalesce(F.col(c), F.lit(0)).cast("long").alias("row_count"),
                        )
                        for c, (position, step) in names.items()
                    ]
                )
            )
        )

    return (
        rows(events.agg(F.count("*").alias("raw")), {"raw": (1, "raw events")})
        .unionByName(rows(steps, named))
        .unionByName(rows(features.agg(F.count("*").alias("f")), {"f": (6, "feature rows")}))
    )
