from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from straitflow.operators import graph


def hub_edges(seed=1):
    """A hub with edges to every node, a third of the total, and random others."""
    rng = random.Random(seed)
    pairs = {("hub", f"n{i}") for i in range(60)}
    while len(pairs) < 180:
        a, b = rng.sample(range(60), 2)
        pairs.add((f"n{a}", rng.choice([f"n{b}", "hub"])))
    return [(a, b, rng.randrange(1, 5)) for a, b in sorted(pairs)]


@pytest.mark.parametrize("per_salt", [1_000_000, 7])
def test_page_rank_equals_brute_force(spark, per_salt):
    edges = hub_edges()
    out = {}
    for a, _, w in edges:
        out[a] = out.get(a, 0) + w
    nodes = {n for a, b, _ in edges for n in (a, b)}
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(6):
        got = dict.fromkeys(nodes, 0.0)
        for a, b, w in edges:
            got[b] += rank[a] * w / out[a]
        rank = {n: 0.15 + 0.85 * got[n] for n in nodes}
    df = spark.createDataFrame(edges, "src string, dst string, weight long")
    result = graph.page_rank(df, iterations=6, checkpoint_every=2, edges_per_salt=per_salt)
    ranks = {r.node: r["rank"] for r in result.collect()}
    assert ranks.keys() == rank.keys()
    assert all(ranks[n] == pytest.approx(rank[n]) for n in nodes)


def test_edges_and_degrees(spark):
    raw = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("a", "c", 5)], "s string, d string, w long")
    edges = graph.edge_list(raw, F.col("s"), F.col("d"), F.col("w"))
    assert {(r.src, r.dst): (r.weight, r.edge_count) for r in edges.collect()} == {
        ("a", "b"): (3, 2),
        ("a", "c"): (5, 1),
    }
    got = {r.node: tuple(r)[1:] for r in graph.degrees(edges).collect()}
    assert got == {"a": (2, 0, 8, 0), "b": (0, 1, 0, 3), "c": (0, 1, 0, 5)}
