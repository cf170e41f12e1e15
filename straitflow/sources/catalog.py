"""The event store as a catalog table, and tiering of old months."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from straitflow.session import hadoop_path
from straitflow.sources.schemas import ANALYSIS_COLUMNS

#: What stores and archives are partitioned by.
STORE_KEYS = ("year", "month", "delivery")

#: Folder of a store, hidden from readers, with the lists of files to be deleted.
RETIRING = "_retiring"


def create_event_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An external table over a partitioned store; its partitions are found on disk."""
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name not in STORE_KEYS]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, year INT, month INT, delivery STRING) USING parquet "
        f"PARTITIONED BY (year, month, delivery) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def _before(cutoff: date) -> Column:
    """The dated months before a cutoff, which has to be the first of a month: stores are cut by month."""
    if cutoff.day != 1:
        raise ValueError("stores are cut between months: the cutoff must be the first of one")
    return (F.col("year") > 0) & (F.col("year") * 12 + F.col("month") < cutoff.year * 12 + cutoff.month)


def archive_before(spark: SparkSession, store: str, archive: str, cutoff: date) -> None:
    """Copy the months before ``cutoff`` to an archive: analysis columns only, zstd.

    The archive is cut like the store, by year, month and delivery, so late rows of a month that it has are
    added, and only a delivery that comes again replaces itself. Undated rows stay in the store, which is left alone.
    """
    _write_archive(spark.read.parquet(store).filter(_before(cutoff)), archive)


def _write_archive(old: DataFrame, archive: str) -> None:
    (
        old.select(*ANALYSIS_COLUMNS, *STORE_KEYS)
        .hint("rebalance", F.col("year"), F.col("month"))
        .sortWithinPartitions(*STORE_KEYS, "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*STORE_KEYS)
        .parquet(archive)
    )


def retire_before(spark: SparkSession, store: str, archive: str, cutoff: date) -> list[tuple[int, int]]:
    """Archive the months before ``cutoff``, then delete them from the store; returns the months.

    Nothing is deleted unless the archive holds as many rows of each month and delivery as were copied, and only the
    files that were copied are: rows that another load adds meanwhile stay for the next call. The files are listed in
    the store before the first one goes, and a later call begins with such a list, so a call that broke off is
    finished before what it left could be taken for all there is.
    """
    _finish_retiring(spark, store)
    # One listing of files serves for copy, counts and deletion.
    old = spark.read.parquet(store).filter(_before(cutoff))

    def counts(rows: DataFrame) -> dict[tuple[int, int, str], int]:
        return {tuple(r)[:3]: r["count"] for r in rows.groupBy(*STORE_KEYS).count().collect()}  # a row per delivery

    here = counts(old)
    if not here:
        return []
    _write_archive(old, archive)
    there = counts(spark.read.parquet(archive).filter(_before(cutoff)))
    missing = [k for k, n in here.items() if there.get(k) != n]
    if missing:
        raise RuntimeError(f"the archive is not complete for {missing}; nothing was deleted")
    listed = old.select(F.col("_metadata.file_path").alias("file")).distinct()
    listed.write.parquet(f"{store}/{RETIRING}/{uuid.uuid4().hex}")
    _finish_retiring(spark, store)
    return sorted({(year, month) for year, month, _ in here})


def _finish_retiring(spark: SparkSession, store: str) -> None:
    """Delete the files on complete lists, the folders that are empty then, and the lists."""
    root = hadoop_path(spark, f"{store}/{RETIRING}")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    for status in fs.listStatus(root):
        name = status.getPath().toString()
        if fs.exists(hadoop_path(spark, f"{name}/_SUCCESS")):
            folders = set()
            for row in spark.read.schema("file string").parquet(name).toLocalIterator():
                file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(row["file"]))
                fs.delete(file, False)
                folders.add(file.getParent().toString())
            for folder in folders:
                here = hadoop_path(spark, folder)
                for _ in range(3):  # delivery, month, year
                    if not fs.exists(here) or len(fs.listStatus(here)):
                        break
                    fs.delete(here, False)
                    here = here.getParent()
        fs.delete(hadoop_path(spark, name), True)
