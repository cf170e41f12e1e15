"""The feature table: events, prices and macro series on one daily grid."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from straitflow.config import MODEL_INPUTS, PANEL_METRICS, FeatureSettings
from straitflow.functions.geo import near_any_box
from straitflow.operators.clean import (
    dedup_events,
    dedup_matching,
    keep_roots,
    with_event_date,
)
from straitflow.operators.labels import tercile_labels
from straitflow.operators.panel import daily_panel, rolling_means
from straitflow.operators.series import date_bounds, macro_daily, price_features
from straitflow.operators.tagging import tag_by_expression
from straitflow.sources.market import normalise_prices
from straitflow.sources.schemas import ANALYSIS_COLUMNS


def analysis_rows(events: DataFrame) -> DataFrame:
    """The columns the analysis needs; dates are parsed if the input does not carry them."""
    dated = events if "event_date" in events.columns else with_event_date(events)
    return dated.select(*ANALYSIS_COLUMNS)


def clean_events(events: DataFrame, settings: FeatureSettings = FeatureSettings()) -> DataFrame:
    """De-duplicate, then keep the wanted root codes.

    The order matters: a copy with another code may displace one with a wanted code.
    ``dedup_after_filter`` turns it round.
    """
    slim = analysis_rows(events)
    if settings.dedup_after_filter:
        return dedup_events(keep_roots(slim, settings.roots))
    return keep_roots(dedup_events(slim), settings.roots)


def tagged_events(events: DataFrame, settings: FeatureSettings = FeatureSettings()) -> DataFrame:
    """Clean events near a box of the scope, one row per event and box.

    Few events pass the code and cell filters, so with ``prune_keys`` the others are kept
    out of the de-duplication shuffle; the result is the same.
    """
    boxes = settings.scoped_boxes()
    if not settings.prune_keys or settings.dedup_after_filter:
        return tag_by_expression(clean_events(events, settings), boxes)
    slim = analysis_rows(events)
    wanted = F.col("EventRootCode").isin(*settings.roots) & near_any_box(boxes)
    return tag_by_expression(dedup_matching(slim, wanted), boxes)


def keep_boxes(panel: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return panel.filter(F.col("chokepoint").isin(*names))


def join_prices(panel: DataFrame, prices: DataFrame) -> DataFrame:
    """Inner join on the day: days without trading drop out, after the rolling means."""
    wanted = prices.select(
        F.col("price_date").alias("event_date"),
        "return_5d",
        "return_20d",
        "volatility_20d",
        "label",
    )
    return panel.join(wanted, "event_date")


def join_macro(features: DataFrame, macro: DataFrame) -> DataFrame:
    return features.join(macro.withColumnRenamed("date", "event_date"), "event_date", "left")


def complete_rows(features: DataFrame) -> DataFrame:
    """Rows with all model inputs and a label."""
    return features.na.drop(subset=[*MODEL_INPUTS, "label"])


def keep_from(features: DataFrame, start: date) -> DataFrame:
    return features.filter(F.col("event_date") >= F.lit(start))


def labelled_prices(prices: DataFrame, settings: FeatureSettings = FeatureSettings()) -> DataFrame:
    return tercile_labels(
        price_features(normalise_prices(prices, settings.commodity)), settings.quantiles
    )


def event_panel(events: DataFrame, settings: FeatureSettings = FeatureSettings()) -> DataFrame:
    """The daily panel of the scope's boxes. Copies share their day, so a day's rows depend on no other day."""
    return daily_panel(tagged_events(events, settings), settings.conflict_roots)


def panel_features(
    panel: DataFrame,
    prices: DataFrame,
    macro: DataFrame,
    settings: FeatureSettings = FeatureSettings(),
) -> DataFrame:
    """Rolling means, prices and macro series on a daily panel, before incomplete rows are dropped."""
    rolled = rolling_means(panel, settings.windows, mode=settings.window_mode)
    oil = labelled_prices(prices, settings)
    spine_ends = date_bounds(normalise_prices(prices, settings.commodity), "price_date")
    daily = macro_daily(macro, spine_ends, settings.macro_series, settings.carry_in)
    joined = join_macro(join_prices(rolled, oil), daily)
    return joined.select(
        "event_date",
        "chokepoint",
        *PANEL_METRICS,
        *[f"{m}_{n}d" for m in PANEL_METRICS for n in settings.windows],
        "return_5d",
        "return_20d",
        "volatility_20d",
        "label",
        *settings.macro_series,
    )


def feature_rows(
    events: DataFrame,
    prices: DataFrame,
    macro: DataFrame,
    settings: FeatureSettings = FeatureSettings(),
) -> DataFrame:
    """Joined rows before the incomplete ones are dropped."""
    return panel_features(event_panel(events, settings), prices, macro, settings)


def feature_table(
    events: DataFrame,
    prices: DataFrame,
    macro: DataFrame,
    settings: FeatureSettings = FeatureSettings(),
) -> DataFrame:
    """One plan from raw rows to model input; nothing runs until the result is written."""
    return complete_rows(feature_rows(events, prices, macro, settings))
