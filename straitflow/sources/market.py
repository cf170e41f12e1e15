"""Price and macro files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from straitflow.sources.schemas import MACRO_SCHEMA, PRICE_SCHEMA


def scan_prices(spark: SparkSession, path: str) -> DataFrame:
    """Price CSV with header under a fixed schema: no inference job."""
    df = spark.read.schema(PRICE_SCHEMA).option("header", True).csv(path)
    return df.select(
        F.try_to_date("date").alias("date"),
        F.col("close").try_cast("double").alias("close"),
        "commodity",
        "symbol",
    )


def scan_wide_prices(spark: SparkSession, path: str) -> DataFrame:
    """Price CSV that repeats ``close`` once per symbol; the reader numbers the copies."""
    return spark.read.option("header", True).csv(path)


def scan_macro(spark: SparkSession, path: str) -> DataFrame:
    """Macro CSV with header under a fixed schema; '.' and other non-numbers become null."""
    df = spark.read.schema(MACRO_SCHEMA).option("header", True).option("nullValue", ".").csv(path)
    return df.select(
        F.try_to_date("date").alias("date"),
        *[F.col(c).try_cast("double").alias(c) for c in ("treasury_10y", "usd_index", "cpi")],
    )


def coalesce_close(prices: DataFrame) -> DataFrame:
    """One ``close`` out of ``close``, ``close1``, ``close4``, ...: each row fills one of them."""
    copies = [c for c in prices.columns if re.fullmatch(r"close\d*", c)]
    kept = [c for c in prices.columns if c not in copies]
    return prices.select(*kept, F.coalesce(*[F.col(c) for c in copies]).alias("close"))


def select_commodity(prices: DataFrame, commodity: str) -> DataFrame:
    return prices.filter(F.col("commodity") == commodity)


def one_report(value: Column, what: str) -> Column:
    """The value of a group whose rows must agree; two different ones are an error, nulls aside."""
    clash = F.min(value) != F.max(value)
    return F.when(clash, F.raise_error(F.lit(f"different values of {what} on one day"))).otherwise(F.max(value))


def normalise_prices(prices: DataFrame, commodity: str | None = None) -> DataFrame:
    """``price_date, commodity, close``: dates parsed, close as 32-bit float, as in the source feed.

    What is no date becomes null. A day has one row per commodity: repeated reports are merged, and
    reports of one day that differ are an error, since nothing tells which is right.
    """
    if commodity is not None:
        prices = select_commodity(prices, commodity)
    parsed = prices.select(
        F.try_to_date(F.col("date").cast("string")).alias("price_date"),
        F.col("commodity"),
        F.col("close").try_cast("float").alias("close"),
    )
    dated = parsed.filter("price_date IS NOT NULL").groupBy("price_date", "commodity")
    merged = dated.agg(one_report(F.col("close"), "close").alias("close"))
    # Rows without a day have nothing to be merged by.
    return merged.unionByName(parsed.filter("price_date IS NULL"))


def union_prices(frames: Mapping[str, DataFrame], symbols: Mapping[str, str]) -> DataFrame:
    """Stack one frame per symbol, tagged with commodity and symbol."""
    tagged = [
        df.withColumn("commodity", F.lit(symbols[symbol])).withColumn("symbol", F.lit(symbol))
        for symbol, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, for exchange; between jobs use Parquet."""
    df.write.mode("overwrite").option("header", True).csv(path)


def scan_series(spark: SparkSession, path: str, series: str) -> DataFrame:
    """A CSV file of one reported series, read by position: the header line is skipped, whatever it says."""
    raw = spark.read.schema("date STRING, value STRING").option("header", True).option("enforceSchema", True).csv(path)
    return normalise_macro(raw, series)


def normalise_macro(raw: DataFrame, series: str) -> DataFrame:
    """``date, <series>`` from text columns ``date, value``; what is no date or number becomes null."""
    return raw.select(
        F.try_to_date(F.trim("date")).alias("date"), F.trim("value").try_cast("double").alias(series)
    )


def merge_series(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Full outer merge on ``date`` of any number of series with a single shuffle.

    Each frame is ``date, <series>``. The rows are stacked in long form and one
    grouping by date spreads them again; the result is in the order of dates.
    """
    long = reduce(
        DataFrame.unionByName,
        (
            df.select("date", F.lit(name).alias("series_id"), F.col(name).alias("value"))
            for name, df in frames.items()
        ),
    )
    return spread_series(long, list(frames)).orderBy("date")


def spread_series(long: DataFrame, series: Sequence[str]) -> DataFrame:
    """Long ``date, series_id, value`` to one column per series; reports of one day must agree."""
    return long.groupBy("date").agg(
        *[one_report(F.when(F.col("series_id") == s, F.col("value")), s).alias(s) for s in series]
    )
