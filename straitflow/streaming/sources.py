"""Stream inputs and the way bounded runs are written and read back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from straitflow.session import hadoop_path, scratch_path
from straitflow.streaming.changes import ChangeLog


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Replay of Parquet files in order of arrival."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType) -> DataFrame:
    """The same rows as JSON messages of a topic; needs the Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Run over everything available in append mode; returns the rows written."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def run_update(stream: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Run over everything available in update mode; returns the last state of every key.

    A micro-batch writes the keys that it changed, and reading takes the last version of each.
    """
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    log = ChangeLog(spark, f"{out}/state", stream.schema, keys)
    run_batches(stream, log.write, f"{out}/checkpoint", mode="update")
    return log.current()


def run_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Run a function on every micro-batch of what is available."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


#: Files of a delivery, each written and read by a task of its own, and rows of a file when there are more than so many.
DELIVERY_FILES = 4
FILE_ROWS = 500_000


def files_for(parts: Sequence[DataFrame], rows_per_file: int = FILE_ROWS) -> int:
    """Files that each of these deliveries takes, so that tasks are more and not longer when the largest one grows."""
    return max(DELIVERY_FILES, *(-(-part.count() // rows_per_file) for part in parts))


def deliver(parts: Sequence[DataFrame], path: str, files: int = DELIVERY_FILES) -> None:
    """Write frames to one folder one after another, as deliveries arrive, each as so many files.

    A file stream reads by time of arrival; with as many files per trigger every part is a batch. Parts with
    fewer rows than files are filled up with empty files.
    """
    for part in parts:
        spark = part.sparkSession
        root = hadoop_path(spark, path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

        def held() -> int:
            return sum(s.getPath().getName().startswith("part-") for s in fs.listStatus(root)) if fs.exists(root) else 0

        before = held()
        part.repartition(files).write.mode("append").parquet(path)
        empty = spark.createDataFrame([], part.schema).coalesce(1)
        while held() < before + files:
            empty.write.mode("append").parquet(path)
