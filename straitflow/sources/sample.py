"""The test tables seen as event, price and macro inputs.

``lineitem`` plays the event feed, ``orders`` the price file with the priorities as
commodities, and ``lineitem`` by day the macro file. Plain column arithmetic, so the
same rows can be stated in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from straitflow.config import CHOKEPOINT_BOXES
from straitflow.functions.dates import int_from_date
from straitflow.sources.schemas import EVENT_SCHEMA

# Centres in hundredths of a degree, by l_partkey % 12: of the boxes, then of a place in none of them.
_CENTRES = [
    (round(50 * (b.lat_min + b.lat_max)), round(50 * (b.lon_min + b.lon_max))) for b in CHOKEPOINT_BOXES
] + [(6000, 1000)] * (12 - len(CHOKEPOINT_BOXES))
LAT_CENTRES, LON_CENTRES = zip(*_CENTRES)

# Plays crude oil.
SAMPLE_COMMODITY = "1-URGENT"
COMMODITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _coordinate(centres: Sequence[int], a: int, b: int) -> Column:
    centre = F.get(F.array(*[F.lit(c) for c in centres]), (F.col("l_partkey") % 12).cast("int"))
    jitter = (F.col("l_orderkey") * a + F.col("l_linenumber") * b) % 600 - 300
    return (centre + jitter).cast("double") / F.lit(100.0)


def _event_columns() -> dict[str, Column]:
    day = F.col("l_shipdate").cast("date")
    return {
        "event_date": day,
        "GLOBALEVENTID": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "SQLDATE": int_from_date(day),
        "SOURCEURL": F.concat(F.lit("u"), F.col("l_suppkey").cast("string")),
        "Actor1Code": F.col("l_returnflag"),
        "Actor2Code": F.col("l_linestatus"),
        "EventRootCode": F.lpad((1 + F.col("l_partkey") % 20).cast("string"), 2, "0"),
        "GoldsteinScale": F.col("l_discount") * 100 - F.col("l_tax") * 100,
        "AvgTone": F.col("l_quantity"),
        "NumMentions": F.col("l_linenumber"),
        "ActionGeo_Lat": _coordinate(LAT_CENTRES, 7919, 104729),
        "ActionGeo_Long": _coordinate(LON_CENTRES, 6131, 15485863),
    }


def as_analysis_rows(lineitem: DataFrame) -> DataFrame:
    """The analysis columns of the event store."""
    return lineitem.select(*[c.alias(n) for n, c in _event_columns().items()])


def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_analysis_rows(table(spark, sf_dir, "lineitem"))


def as_event_lines(rows: DataFrame) -> DataFrame:
    """Event rows as lines of an event file, some malformed: cut short, with a field too many, with a date that is none."""
    line = F.to_csv(F.struct(*rows.columns), {"sep": "\t", "quote": "", "emptyValue": "", "nullValue": ""})
    spoilt = (
        F.when(F.col("NumMentions") == 7, F.substring_index(line, "\t", 30))
        .when(F.col("NumMentions") == 6, F.concat(line, F.lit("\tmore")))
        .when(F.col("NumMentions") == 5, F.regexp_replace(line, "^([^\t]*)\t[^\t]*", "$1\tnone"))
        .otherwise(line)
    )
    return rows.select(spoilt.alias("value"))


def crowded_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box per customer around the places of the events, its longer side from 0.01 to 163.84 degrees."""
    key = F.col("c_custkey")
    lat, lon = (
        (F.get(F.array(*[F.lit(c) for c in centres]), (key % 12).cast("int")) + (key * a) % 600 - 300).cast("double") / F.lit(100.0)
        for centres, a in ((LAT_CENTRES, 7919), (LON_CENTRES, 6131))
    )
    side = F.lit(0.01) * F.call_function("shiftleft", F.lit(1), (key % 15).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), key.cast("string")).alias("name"),
        (lat - side / 4).alias("lat_min"),
        (lat + side / 4).alias("lat_max"),
        (lon - side / 2).alias("lon_min"),
        (lon + side / 2).alias("lon_max"),
    )


def as_event_rows(lineitem: DataFrame) -> DataFrame:
    """All 58 fields of an event file; the ones without a counterpart stay null."""
    columns = _event_columns()
    fields = T.StructType.fromDDL(EVENT_SCHEMA).fields
    return lineitem.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def sample_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, commodity, close``: mean order value by day and priority."""
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderpriority").alias("commodity"))
        .agg((total / F.count("*")).alias("close"))
    )


def wide_sample_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price file with a ``close`` column per commodity, numbered by position."""
    prices = sample_prices(spark, sf_dir)
    copies = {f"close{i}": F.when(F.col("commodity") == c, F.col("close")) for i, c in enumerate(COMMODITIES, 1)}
    return prices.select("date", "commodity", *[c.alias(n) for n, c in copies.items()])


def sample_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, treasury_10y, usd_index``: one series reported on Mondays, the mean of the week that
    begins there, and one on the first of the month, the mean of the month."""
    day = F.col("l_shipdate").cast("date")
    reports = table(spark, sf_dir, "lineitem").select(
        F.inline(
            F.array(
                F.struct(
                    F.date_trunc("week", day).cast("date").alias("date"),
                    (F.col("l_discount") * 100).cast("decimal(18,2)").alias("weekly"),
                    F.lit(None).cast("decimal(18,2)").alias("monthly"),
                ),
                F.struct(
                    F.trunc(day, "month").alias("date"),
                    F.lit(None).cast("decimal(18,2)").alias("weekly"),
                    F.col("l_quantity").cast("decimal(18,2)").alias("monthly"),
                ),
            )
        )
    )

    def mean(c: str) -> Column:
        return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))

    return reports.groupBy("date").agg(mean("weekly").alias("treasury_10y"), mean("monthly").alias("usd_index"))


def nation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src, dst``, both ways: nations and the commodities that their customers ordered, nations and their regions."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    traded = nation_commodity_orders(spark, sf_dir).select("nation", F.col("commodity").alias("other")).distinct()
    placed = nation.select(F.col("n_name").alias("nation"), F.concat(F.lit("region "), "r_name").alias("other"))
    pairs = traded.unionByName(placed)
    return pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("nation").alias("src"), F.col("other").alias("dst")),
                F.struct(F.col("other").alias("src"), F.col("nation").alias("dst")),
            )
        )
    )


def nation_commodity_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation, commodity, value``: orders summed per customer before they meet the customers."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.col("o_orderpriority").alias("commodity"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("nation", "commodity", "value")
    )


def supplier_part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and parts linked by line items, both ways: ``src, dst, weight``."""
    s = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    p = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    pairs = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.count("*").alias("weight"))
    )
    return pairs.select(
        F.inline(
            F.array(
                F.struct(s.alias("src"), p.alias("dst"), F.col("weight")),
                F.struct(p.alias("src"), s.alias("dst"), F.col("weight")),
            )
        )
    )
