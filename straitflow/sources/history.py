"""De-duplication of a delivery against everything delivered before, without a shuffle of what is there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from straitflow.config import DEDUP_KEYS, DEDUP_ORDER
from straitflow.operators.clean import dedup_events
from straitflow.session import hadoop_path, staged

#: Hash of the key, by which the table is cut into buckets, and the month of the event, which is part of the key.
BUCKET, MONTH = "_bucket_hash", "_month"


class EventHistory:
    """A table of the rows that have survived de-duplication, kept over deliveries.

    Rows lie in partitions by month and in buckets by a hash of the de-duplication key. A delivery is de-duplicated by
    itself, then joined with the months that it has: its side is shuffled to the buckets, the table is read as it
    lies. Rows are added if nothing as early in the order is known for their key; so a survivor may be
    displaced, and of the few rows that a key has by then, `survivors` takes the first, bucket by bucket.
    After any number of deliveries these are the rows of `dedup_events` over all of them, and a repeated delivery adds
    nothing. The key holds the day, or this would have to read all months.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        path: str,
        schema: str,
        buckets: int = 256,
        keys: Sequence[str] = DEDUP_KEYS,
        order: Sequence[str] = DEDUP_ORDER,
        day: str = "SQLDATE",
    ):
        """Opens the table at a path, under a name for this session; `schema` is that of its rows, in SQL."""
        self.spark, self.name, self.buckets = spark, name, buckets
        self.keys, self.order, self.day = tuple(keys), tuple(order), day
        root = hadoop_path(spark, path)
        there = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)
        spark.sql(
            f"CREATE TABLE {name} ({schema}, {BUCKET} BIGINT, {MONTH} INT) USING parquet PARTITIONED BY ({MONTH}) "
            f"CLUSTERED BY ({BUCKET}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        if there:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        self.columns = [c for c in spark.table(name).columns if c not in (BUCKET, MONTH)]

    def _keyed(self, rows: DataFrame) -> DataFrame:
        month = F.coalesce(F.floor(F.col(self.day) / 100).cast("int"), F.lit(0))
        return rows.select(*self.columns, F.xxhash64(*self.keys).alias(BUCKET), month.alias(MONTH))

    def gains(self, delivery: DataFrame) -> DataFrame:
        """The rows of a delivery that are first of their key, within it and against the table."""
        own = self._keyed(dedup_events(delivery.select(*self.columns), self.keys, self.order))
        months = [r[MONTH] for r in own.select(MONTH).distinct().collect()]  # bounded by the calendar
        known = self.spark.table(self.name).filter(F.col(MONTH).isin(months))
        ours, theirs = F.struct(*[own[c] for c in self.keys]), F.struct(*[known[c] for c in self.keys])
        # Rows compare field by field, nulls being equal. As equalities, the planner would join by them too, and
        # would not find the table placed by all that it joins by.
        same = (ours <= theirs) & (ours >= theirs)
        earlier = F.struct(*[known[c] for c in self.order]) <= F.struct(*[own[c] for c in self.order])
        return own.join(known, (own[BUCKET] == known[BUCKET]) & same & earlier, "left_anti")

    def add(self, delivery: DataFrame) -> int:
        """Takes a delivery in; returns the rows added."""
        new = staged(self.gains(staged(delivery.select(*self.columns), "delivery")), "gains")
        # One task, and so one file, per bucket.
        new.repartition(self.buckets, BUCKET).write.insertInto(self.name)
        return new.count()

    def survivors(self, months: Sequence[int] | None = None) -> DataFrame:
        """The rows of `dedup_events` over all deliveries; of some months (yyyymm, 0 for undated rows), if they are given."""
        rows = self.spark.table(self.name)
        if months is not None:
            rows = rows.filter(F.col(MONTH).isin(list(months)))
        return dedup_events(rows, (BUCKET, *self.keys), self.order).select(*self.columns)

    def fold(self, name: str, path: str) -> EventHistory:
        """A new table of the survivors alone, each bucket and month in one file, in place of many deliveries' files."""
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.table(self.name).select(*self.columns).schema)
        out = EventHistory(self.spark, name, path, schema, self.buckets, self.keys, self.order, self.day)
        out._keyed(self.survivors()).repartition(self.buckets, BUCKET).write.insertInto(name)
        return out
