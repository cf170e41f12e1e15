"""Measures on a weighted edge table ``src, dst, weight``."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from straitflow.session import scratch_path, scratch_root, staged


def edge_list(df: DataFrame, src: Column, dst: Column, weight: Column) -> DataFrame:
    """One row per (src, dst): pre-aggregated, so repeated pairs never reach the iterations."""
    return (
        df.select(src.alias("src"), dst.alias("dst"), weight.alias("weight"))
        .groupBy("src", "dst")
        .agg(F.sum("weight").alias("weight"), F.count("*").alias("edge_count"))
    )


def degrees(edges: DataFrame) -> DataFrame:
    """Distinct neighbours and summed weight of every node, in and out."""
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("out"), F.col("weight").alias("w")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("out"), F.col("weight").alias("w")),
    )
    e = edges.select(F.explode(ends).alias("e")).select("e.*")
    return e.groupBy("node").agg(
        F.sum("out").alias("out_degree"),
        F.sum(1 - F.col("out")).alias("in_degree"),
        F.sum(F.when(F.col("out") == 1, F.col("w")).otherwise(0)).alias("out_weight"),
        F.sum(F.when(F.col("out") == 0, F.col("w")).otherwise(0)).alias("in_weight"),
    )


def page_rank(
    edges: DataFrame,
    iterations: int = 10,
    damping: float = 0.85,
    checkpoint_every: int = 4,
    edges_per_salt: int = 1_000_000,
) -> DataFrame:
    """Weighted PageRank, a fixed number of rounds; ranks start at 1 and average about 1.

    ``rank = (1 - d) + d * sum(rank(src) * weight / out_weight(src))``

    The edges are written once with their share of the source and a salt. A source with
    many edges has them spread over ``degree / edges_per_salt`` salts and its rank is
    repeated as often, so a hot node is not one task. Sums over the target combine on the
    map side. Ranks are checkpointed every few rounds to cut lineage.
    """
    spark = edges.sparkSession
    scratch_root(spark)
    edges = staged(edges, "edge-list")
    # Staged on its own, so that the join shuffles both sides itself and AQE can split a hub.
    out = staged(
        edges.groupBy("src").agg(
            F.sum("weight").cast("double").alias("out_weight"),
            F.ceil(F.count("*") / edges_per_salt).cast("int").alias("salts"),
        ),
        "out-weights",
    )
    path = scratch_path(spark, "edges")
    (
        edges.join(out, "src")
        .select(
            "src",
            "dst",
            (F.col("weight") / F.col("out_weight")).alias("share"),
            F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int").alias("salt"),
            "salts",
        )
        .write.parquet(path)
    )
    stored = spark.read.parquet(path)
    # Placed and sorted once; every round then shuffles ranks only. A lost block is
    # read again from the written edges.
    links = (
        stored.select("src", "dst", "share", "salt")
        .repartition("src", "salt")
        .sortWithinPartitions("src", "salt")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    links.count()  # or else the rounds of the first job would each place them
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.col("salts")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("salts")),
    )
    nodes = (
        stored.select(F.explode(ends).alias("e"))
        .groupBy(F.col("e.node").alias("node"))
        .agg(F.max("e.salts").alias("salts"))
        .checkpoint()
    )
    ranks = nodes.withColumn("rank", F.lit(1.0))
    for step in range(1, iterations + 1):
        spread = ranks.filter(F.col("salts") > 0).select(
            F.col("node").alias("src"),
            "rank",
            F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        )
        received = links.join(spread, ["src", "salt"]).select(
            F.col("dst").alias("node"),
            F.lit(0).alias("salts"),
            (F.col("rank") * F.col("share")).alias("received"),
        )
        # Every node contributes a zero, so nodes without incoming edges stay.
        ranks = (
            received.unionByName(nodes.withColumn("received", F.lit(0.0)))
            .groupBy("node")
            .agg(
                F.max("salts").alias("salts"),
                (F.lit(1 - damping) + F.lit(damping) * F.sum("received")).alias("rank"),
            )
        )
        if step % checkpoint_every == 0 or step == iterations:
            ranks = ranks.checkpoint()
    links.unpersist()
    return ranks.select("node", "rank")


def harmonic_closeness(
    edges: DataFrame, max_rounds: int = 64, lg_size: int = 12, edges_per_salt: int = 1_000_000
) -> DataFrame:
    """node, reached, closeness: about how many other nodes a node reaches, and the sum of 1 / distance over them.

    Distances count edges along their direction. Each node holds a HyperLogLog sketch of the nodes that it has reached;
    in a round it takes in those of its successors, and what its estimate grows by in round t is at distance t.
    Only nodes whose sketch changed pass it on, and rounds end when none does, or after `max_rounds`. The error
    is that of the sketch, about 1.04 / sqrt(2 ** lg_size). A node that many point to is spread over salts like
    in `page_rank`; unions combine on the map side.
    """
    spark = edges.sparkSession
    links = staged(edges.select("src", "dst").where("src <> dst").distinct(), "links")
    sizes = staged(
        links.groupBy("dst").agg(F.ceil(F.count("*") / edges_per_salt).cast("int").alias("salts")), "in-degrees"
    )
    salted = F.pmod(F.xxhash64("src"), F.col("salts")).cast("int").alias("salt")
    links = staged(links.join(sizes, "dst").select("src", "dst", salted), "salted-links")
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).where("node IS NOT NULL").distinct()
    own = ends.groupBy("node").agg(F.hll_sketch_agg("node", lg_size).alias("sketch"))
    state = own.join(sizes.withColumnRenamed("dst", "node"), "node", "left").select(
        "node", F.coalesce("salts", F.lit(0)).alias("salts"), "sketch",
        F.hll_sketch_estimate("sketch").alias("size"), F.lit(0.0).alias("closeness"), F.lit(True).alias("changed"),
    )
    state = staged(state, "closeness")
    for step in range(1, max_rounds + 1):
        sent = state.filter("changed AND salts > 0").select(
            F.col("node").alias("dst"), "sketch", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
        )
        received = links.join(sent, ["dst", "salt"]).select(F.col("src").alias("node"), "sketch")
        taken = received.groupBy("node").agg(F.hll_union_agg("sketch", True).alias("more"))
        union = F.when(F.col("more").isNotNull(), F.hll_union("sketch", "more", True)).otherwise(F.col("sketch"))
        grown = state.join(taken, "node", "left").select(
            "node", "salts", union.alias("sketch"), "size", "closeness"
        )
        now = F.greatest(F.hll_sketch_estimate("sketch"), "size")
        state = staged(
            grown.withColumn("_now", now).select(
                "node", "salts", "sketch", F.col("_now").alias("size"),
                (F.col("closeness") + (F.col("_now") - F.col("size")) / F.lit(float(step))).alias("closeness"),
                (F.col("_now") > F.col("size")).alias("changed"),
            ),
            "closeness",
        )
        if state.filter("changed").isEmpty():
            break
    return state.select("node", (F.col("size") - 1).alias("reached"), "closeness")
