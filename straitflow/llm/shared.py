"""What several operators need: staging in the shared folder, and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import tempfile
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import straitflow
from straitflow.session import scratch_root

_shipped: set[str] = set()

#: Whether Spark removes the shuffle files of a plan that has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Edges of a partition in `components`, as far as the session's partitions are not larger anyway.
EDGES = 100_000


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, as --py-files would."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(straitflow.__file__).parent
        name = f"{tempfile.mkdtemp(prefix='straitflow-')}/{root.name}"
        sc.addPyFile(shutil.make_archive(name, "zip", root.parent, root.name))
        _shipped.add(sc.applicationId)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Sends whole texts to the Python workers in small batches, unless the session has a setting of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":  # Spark's default
        spark.conf.set(name, str(rows))


def give_back() -> None:
    """Returns what a worker has freed to the system: workers live on, beside others and the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # elsewhere than on glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def staged(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the folder of spark.checkpoint.dir, so that it outlives executors.

    What it has shuffled is removed as soon as it is kept, not when the driver happens to collect its garbage. Only the run
    made here does so: a plan takes the setting when it is made, and this one is not run again.
    """
    spark = frame.sparkSession
    scratch_root(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return frame.select("*").checkpoint()
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node and component, the smallest node reachable, for every node of the edges: distributed union-find.

    Each round points every node and its neighbours to the smallest of them, first from the side of the larger
    nodes and then from the smaller ones, which halves the depth of the trees; it ends when all trees are
    stars. Minima are taken ahead of the shuffle; in the joins the edges of a hub stream past one row, and
    are never gathered. A shuffle leaves files for every task that writes to it, so what little edges there are lie
    in few partitions, one per EDGES of them. Rounds over a single partition take minima by window and neither shuffle
    nor broadcast: the driver keeps a thread for a minute for each of these, and short rounds would start hundreds in it.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where(
        F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))
    )
    pairs = staged(
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    few = 1 + pairs.count() // EDGES
    pairs = pairs.coalesce(few)
    before = None
    while True:
        pairs = staged(_round_of_few(pairs) if few == 1 else _round(pairs, few)).coalesce(few)
        now = pairs.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")
        ).first()
        if now == before:
            break
        before = now
    out = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct().coalesce(few)
    return out.unionAll(roots)


def _round(pairs: DataFrame, few: int) -> DataFrame:
    both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Large star: larger neighbours point to the smallest one.
    large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.unionAll(least.where("u > m").select("u", F.col("m").alias("v"))).coalesce(2 * few).distinct().coalesce(2 * few)
    # Small star: a node and its smaller neighbours point to the smallest of them.
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return small.unionAll(lowest.select("u", F.col("m").alias("v"))).coalesce(few).distinct().coalesce(few)


def _round_of_few(pairs: DataFrame) -> DataFrame:
    """The same of edges in a single partition, EDGES at most."""
    least = F.min("v").over(Window.partitionBy("u"))
    ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
    both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(1)
    near = both.select("u", F.greatest("u", "v").alias("v"), F.least("u", least).alias("m"))
    large = near.select(ends.alias("x")).select("x.u", "x.v").where("u > v").distinct()
    small = large.select("u", "v", least.alias("m")).select(ends.alias("x")).select("x.u", "x.v")
    return small.where("u > v").distinct()


def marked_by(frame: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The frame and `marked`: true for every row whose key is among the keys, and for few others.

    The keys set bits of a table of 16 bits a key, 2**27 at most; its words, 2**21 at most, are broadcast. So
    a join needs to shuffle the marked rows only; with more keys than bits it shuffles more, and stays right.
    """
    bits = min(1 << 27, max(1 << 12, 1 << (16 * max(1, keys.count())).bit_length()))
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    words = (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("set"))
    )
    placed = frame.withColumn("slot", slot).withColumn("word", F.shiftright("slot", 6))
    marked = F.expr("coalesce((shiftrightunsigned(set, CAST(slot & 63 AS INT)) & 1L) = 1L, false)")
    return placed.join(F.broadcast(words), "word", "left").withColumn("marked", marked).drop("slot", "word", "set")


def keyed(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text, h (a hash of the text, 42 for null) and the named columns of the rows in a struct, `carried`."""
    carried = F.struct(*[docs[c] for c in carry]) if carry else F.lit(None).cast("string")
    text = docs["text"].cast("string")
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), carried.alias("carried")
    )


def attached(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of `keyed` with what was found, by doc_id and h, on some of them; null on others.

    Only rows whose hash is likely among the found ones are shuffled.
    """
    extra = [c for c in found.columns if c not in ("doc_id", "h")]
    likely = marked_by(rows, "h", found.select("h")).select(*rows.columns, "marked")
    touched = likely.where("marked").alias("t").join(
        found.alias("f"), (F.col("t.h") == F.col("f.h")) & F.col("t.doc_id").eqNullSafe(F.col("f.doc_id")), "left"
    ).select(*[f"t.{c}" for c in rows.columns], *[f"f.{c}" for c in extra])
    types = dict(found.dtypes)
    none = [F.lit(None).cast(types[c]).alias(c) for c in extra]
    return touched.unionAll(likely.where("NOT marked").select(*rows.columns, *none))
