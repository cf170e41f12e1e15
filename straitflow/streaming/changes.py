"""Keyed rows that streams keep: each micro-batch adds the rows that it changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from straitflow.session import hadoop_path


class ChangeLog:
    """The last version of every key, from the rows that batches have changed.

    A batch writes its changed rows to a folder of its own, so a repeated batch replaces what it wrote, and what
    is written grows with the changes, not with the state. Every `fold_every` batches the state is folded into a
    snapshot, from which reading starts, so it does not grow with the number of batches either. Readers take
    a batch number and see only batches before it.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], fold_every: int = 16
    ):
        self.spark, self.path, self.keys, self.fold_every = spark, path, tuple(keys), fold_every
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _written(self, kind: str) -> list[int]:
        """The batches whose folders are complete."""
        root = hadoop_path(self.spark, f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        numbers = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root)]
        return sorted(n for n in numbers if fs.exists(hadoop_path(self.spark, f"{self.path}/{kind}/batch={n}/_SUCCESS")))

    def current(self, before: int | None = None) -> DataFrame:
        """One row per key: its last version ahead of a batch, or of all."""
        return self._state(before, before)

    def _state(self, before: int | None, snapshots_before: int | None) -> DataFrame:
        snapshots = [n for n in self._written("snapshot") if snapshots_before is None or n < snapshots_before]
        start = snapshots[-1] if snapshots else -1
        changes = [n for n in self._written("change") if n > start and (before is None or n < before)]
        folders = [(n, f"{self.path}/change/batch={n}") for n in changes]
        if snapshots:
            folders.append((start, f"{self.path}/snapshot/batch={start}"))
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = None
        for number, folder in folders:
            part = self.spark.read.schema(self.schema).parquet(folder).withColumn("_batch", F.lit(number))
            rows = part if rows is None else rows.unionAll(part)
        if len(folders) == 1:
            return rows.drop("_batch")
        newest = F.row_number().over(Window.partitionBy(*self.keys).orderBy(F.desc("_batch")))
        return rows.withColumn("_age", newest).filter("_age = 1").drop("_batch", "_age")

    def write(self, changed: DataFrame, batch_id: int) -> None:
        """The new versions of keys, one row each."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        changed.select(*columns).write.mode("overwrite").parquet(f"{self.path}/change/batch={batch_id}")
        if (batch_id + 1) % self.fold_every == 0:
            # Not from the snapshot that an earlier attempt at this batch may have left.
            self._state(batch_id + 1, batch_id).write.mode("overwrite").parquet(f"{self.path}/snapshot/batch={batch_id}")
