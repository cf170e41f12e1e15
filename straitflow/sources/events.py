"""Event files and the partitioned event store."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from straitflow.operators.clean import with_date_parts, with_event_date
from straitflow.sources.schemas import EVENT_SCHEMA


def scan_events(spark: SparkSession, path: str, quote: str = "", lineage: bool = False) -> DataFrame:
    """Tab-separated event files without header, under the fixed schema.

    Quoting is off by default: a stray leading quote would swallow the next tab
    and shift the row. ``lineage`` adds the name of the file each row came from.
    """
    df = (
        spark.read.schema(EVENT_SCHEMA)
        .option("sep", "\t")
        .option("quote", quote)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return df.withColumn("file_name", F.col("_metadata.file_name")) if lineage else df


def scan_checked_events(spark: SparkSession, path: str, quote: str = "") -> DataFrame:
    """As ``scan_events`` with ``lineage``, and the text of each malformed line in ``bad_line``, null for a good one.

    Malformed is a line with more or fewer fields than the schema, or with a value that is not of its field's type.
    Empty lines are no lines.
    """
    return (
        spark.read.schema(f"{EVENT_SCHEMA}, bad_line STRING")
        .option("sep", "\t")
        .option("quote", quote)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "bad_line")
        .csv(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def write_quarantine(bad: DataFrame, path: str, delivery: str) -> None:
    """file_name, line, n_fields and reason of malformed lines, by delivery; a repeated delivery replaces its own."""
    fields = F.size(F.split("bad_line", "\t", -1))
    wanted = len(T.StructType.fromDDL(EVENT_SCHEMA).fields)
    reason = F.when(fields < wanted, "too few fields").when(fields > wanted, "too many fields").otherwise("bad value")
    (
        bad.select("file_name", F.col("bad_line").alias("line"), fields.alias("n_fields"), reason.alias("reason"))
        .write.mode("overwrite")
        .parquet(f"{path}/delivery=load-{delivery}")
    )


def _day_and_code() -> Column:
    """A number that orders rows by day and the first four characters of the code; undated rows come first."""
    marks = [F.ascii(F.substring("EventRootCode", k + 1, 1)).bitwiseAND(255) * (1 << 8 * (3 - k)) for k in range(4)]
    code = F.coalesce(sum((m.cast("long") for m in marks[1:]), marks[0].cast("long")), F.lit(0).cast("long"))
    return F.coalesce(F.unix_date("event_date").cast("long") * (1 << 32), F.lit(-1 << 62)) + code


@contextlib.contextmanager
def _writer_per_month(spark: SparkSession) -> Iterator[None]:
    """Up to 64 months are open at once in a task; Spark sorts what lies beyond. A setting of the session's own stays."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if before == "0":  # Spark's default
        spark.conf.set(name, "64")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_event_store(
    events: DataFrame,
    path: str,
    delivery: str = "all",
    rebuild: bool = False,
    rows_per_file: int = 20_000_000,
    rebalance: bool = True,
) -> None:
    """Parquet by year, month and delivery; rows without a valid date go to year 0, month 0.

    A delivery is what one load brings. Writing it again replaces its own rows in the months
    that it has and touches no others, so a repeated load adds nothing twice, and late or
    undated rows never displace those of other loads. ``rebuild`` replaces the whole store.

    The rebalance hint lets AQE split a month that is far larger than the rest over
    many tasks and merge small ones, so no task has to write a whole hot month. Without
    it every task writes its own file per month: no shuffle, and few files as long as the
    input is split by day. Rows are sorted by day and code, which lets readers skip row
    groups by either. The sort has one number as its key, so rows of 58 fields are not compared
    with one another; a month's rows follow one another in it, and each month has a writer, as a
    sort by month ahead of the writers would undo it.
    """
    dated = with_date_parts(with_event_date(events))
    if "file_name" not in dated.columns:
        dated = dated.withColumn("file_name", F.lit(None).cast("string"))
    dated = dated.withColumns(
        {
            "year": F.coalesce("year", F.lit(0)),
            "month": F.coalesce("month", F.lit(0)),
            # Never a number, so that readers find a string.
            "delivery": F.lit(f"load-{delivery}"),
        }
    )
    if rebalance:
        dated = dated.hint("rebalance", F.col("year"), F.col("month"))
    with _writer_per_month(dated.sparkSession):
        (
            dated.sortWithinPartitions(_day_and_code())
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if rebuild else "dynamic")
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy("year", "month", "delivery")
            .parquet(path)
        )


def read_event_store(
    spark: SparkSession, path: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """The store, restricted to ``start <= event_date <= end``; without a range, undated rows too.

    The range is restated on the partition columns, so that whole months outside it
    are never listed, and on ``event_date`` for the rows of the border months.
    """
    df = spark.read.parquet(path)
    month_no = F.col("year") * 12 + F.col("month")
    if start is not None:
        df = df.filter(month_no >= start.year * 12 + start.month).filter(F.col("event_date") >= F.lit(start))
    if end is not None:
        df = df.filter(month_no <= end.year * 12 + end.month).filter(F.col("event_date") <= F.lit(end))
    return df


def append_new_files(
    spark: SparkSession, landing: str, store: str, checkpoint: str, files_per_batch: int = 64
) -> None:
    """Load the event files that earlier calls have not seen, then stop.

    The checkpoint of the file source is the list of loaded files. Every batch is a delivery
    of the store, named after the checkpoint's own id and the batch, so that a batch that had to be
    repeated replaces itself, and other loaders can write to the same store.
    """
    files = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("sep", "\t")
        .option("quote", "")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(landing)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_event_store(batch, store, delivery=f"{query_id}-{batch_id:08d}")

    query = (
        files.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def files_not_loaded(listing: DataFrame, store: DataFrame) -> DataFrame:
    """Names in ``listing`` that the store holds no row of."""
    return listing.join(store.select("file_name").distinct(), "file_name", "left_anti")
