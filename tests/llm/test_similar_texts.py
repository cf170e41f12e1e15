"""Near duplicates by the similarity of word shingles, against the exact similarity of all pairs."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from straitflow.llm import line_minhash, shared, simhash_trie
from straitflow.llm.shared import components, ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def similarity(x, y):
    a, b = (simhash_trie.shingle_set(t) for t in (x, y))
    return len(a & b) / len(a | b) if a | b else 1.0


def near_copies(seed, n, words):
    """Texts and copies of them with some words changed, cut or added, so that similarities spread around 0.8."""
    rng = random.Random(seed)
    token = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    texts = []
    for _ in range(n):
        base = [token() for _ in range(rng.randint(*words))]
        texts.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = token()
            if rng.random() < 0.3:
                copy = copy[rng.randrange(1 + len(copy) // 12) :]
            texts.append(" ".join(copy).replace(" a", "\n A"))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("words", [(15, 40), (100, 400)])
def test_recall_of_near_copies(spark, words):
    texts = near_copies(words[0], 120, words)
    sets = [simhash_trie.shingle_set(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash_trie.grouped_by_similarity(docs).collect()}
    found = sum(got[i] == got[j] for i, j in near)
    assert len(near) > 150 and found >= 0.95 * len(near)
    low = [(i, j) for i, j in near if similarity(texts[i], texts[j]) < 0.87]
    assert sum(got[i] == got[j] for i, j in low) >= 0.9 * len(low)
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in near:
        parent[max(root(i), root(j))] = min(root(i), root(j))
    for i, c in got.items():  # nothing is linked that is not alike
        assert root(i) == root(c) and c <= i


def test_similar_texts_of_messy_rows(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(30_000))
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(5, text), (3, text + " more"), (9, text.upper()), (None, text), (7, None), (8, ""), (8, ""), (11, " \n\t"), (1, "one two"), (2, "One  two"),
            (4, "one two three"), (20, long), (21, long + " end"), (3, text + " more"), (None, "nobody is like this"), (30, "ä b"), (31, "Ä b")]
    docs = spark.createDataFrame([(*r, 1, 2, "c") for r in rows], "doc_id long, text string, h int, fps int, carried string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash_trie.grouped_by_similarity(docs.repartition(3)).collect()), key=repr)
    groups = {5: 3, 3: 3, 9: 3, 7: 7, 8: 7, 11: 7, 1: 1, 2: 1, 4: 4, 20: 20, 21: 20, 30: 30, 31: 31}
    expected = [(i, groups[i]) for i, _ in rows if i is not None] + [(None, 3), (None, None)]
    assert got == sorted(expected, key=repr)
    kept = simhash_trie.keep_first_similar(docs, carry=["h", "carried"]).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == sorted([1, 3, 4, 7, 20, 30, 31, None], key=repr)
    assert {tuple(r.carried) for r in kept} == {(1, "c")}
    assert simhash_trie.keep_first_similar(docs.limit(0)).count() == 0


def test_many_copies_cost_a_pair_each(spark):
    """A group of near copies names about one pair per text and table, not all its pairs."""
    text = [f"w{i}" for i in range(200)]
    docs = spark.createDataFrame([(k, " ".join([*text, f"tail{k}"])) for k in range(800)], "doc_id long, text string")
    assert simhash_trie.grouped_by_similarity(docs).select("component_id").distinct().count() == 1
    fps = [(k, simhash_trie.wide_fingerprint(" ".join([*text, f"tail{k}"]))) for k in range(800)]
    pairs = simhash_trie.similar_pairs(spark.createDataFrame(fps, "h long, fps array<long>"))
    assert 799 <= pairs.count() <= 800 * simhash_trie.TABLES
    assert pairs.where(F.col("a") >= F.col("b")).count() == 0


@pytest.mark.parametrize("often", [4, 1])
def test_no_pair_that_meets_the_threshold_is_left_out(spark, often, monkeypatch):
    """Pairs of texts just alike enough, and others just not, beside a passage that all texts have."""
    monkeypatch.setattr(simhash_trie, "OFTEN", often)
    rng, passage = random.Random(11), [f"p{i}" for i in range(10)]
    texts, links = [], 0
    for k in range(300):
        common, own = 60 + k % 40, 3 + k % 9  # words, and words at the end that the two do not share
        base = [*passage, *(f"w{k}x{i}" for i in range(common))]
        texts += [" ".join([*base, *(f"{side}{k}x{i}" for i in range(own))]) for side in "lr"]
        links += similarity(*texts[-2:]) >= 0.8
    low = [similarity(texts[2 * k], texts[2 * k + 1]) for k in range(300)]
    assert links > 150 and sum(0.8 <= x < 0.84 for x in low) > 30 and min(low) < 0.8
    rng.shuffle(order := list(range(600)))
    docs = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash_trie.grouped_by_similarity(docs).collect()}
    assert [got[2 * k] == got[2 * k + 1] for k in range(300)] == [x >= 0.8 for x in low]
    assert len(set(got.values())) == 600 - links


def test_a_bucket_of_many_texts_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash_trie, "BLOCK", 7)
    keys = [(h, 10, [5, h], [h % 3] + [0] * 15) for h in range(100)]
    texts = spark.createDataFrame(keys, "h long, size long, keys array<long>, sketch array<long>")
    groups = spark.createDataFrame([(h, 0) for h in range(50)], "node long, component long")
    got = {tuple(r) for r in simhash_trie.missed_pairs(texts, groups, 0.8).collect()}
    assert got == {(a, b) for b in range(50, 100) for a in range(b)}


def test_texts_without_links_are_not_shuffled(spark):
    texts = spark.range(20_000).select(F.col("id").alias("h"), F.array("id").alias("keys")).repartition(3)
    groups = spark.createDataFrame([(5, 5), (7, 5), (9, 9), (30_000, 9)], "node long, component long")
    got = simhash_trie.with_groups(texts, groups)
    assert {(r.h, r.g) for r in got.where("h <> g").collect()} == {(7, 5)}
    assert got.count() == 20_000 and all(list(r["keys"]) == [r.h] for r in got.take(50))
    # The rows that a join meets are those marked; the others come by the second part of a union.
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joined = next(k for k, row in enumerate(plan) if "Join LeftOuter" in row and "node" in row or "Join LeftOuter, (h" in row)
    assert plan[0].startswith("Union") and any("Filter" in row for row in plan[joined : joined + 4])
    few = simhash_trie.with_groups(texts, groups.limit(0))
    assert few.where("h = g").count() == 20_000


def test_few_edges_lie_in_few_partitions(spark, monkeypatch):
    """Else each of a round's shuffles leaves a file for every one of the session's partitions."""
    edges = [(k, k + 1) for k in range(300) if k % 10 != 9] + [(500, 299), (7, 7), (None, 3)]
    monkeypatch.setattr("straitflow.llm.shared.EDGES", 200)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "50"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = components(spark.createDataFrame(edges, "a long, b long"))
        assert found.rdd.getNumPartitions() <= 6
        got = {(r.node, r.component) for r in found.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == {(k, k // 10 * 10) for k in range(300)} | {(500, 290)}


def test_rounds_over_few_edges_neither_shuffle_nor_broadcast(spark, monkeypatch):
    """Else the driver starts a thread for each of them, hundreds within a minute on small tables."""
    plans, real = [], shared.staged

    def staged(frame):
        out = real(frame)
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(shared, "staged", staged)
    edges = [(k, k + 1) for k in range(300) if k % 10 != 9] + [(500, 299), (7, 7), (None, 3)]
    got = {(r.node, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, k // 10 * 10) for k in range(300)} | {(500, 290)}
    assert len(plans) > 2 and not [p for p in plans[1:] if "Exchange" in p]


def test_shingles_of_many_lines_are_those_of_each(monkeypatch):
    monkeypatch.setattr(line_minhash, "CHUNK", 64)
    rng = random.Random(7)
    lines = ["".join(rng.choice("abé\U0001f600 ") for _ in range(rng.choice([0, 1, 7, 8, 9, 40, 200]))) for _ in range(300)]
    found = list(line_minhash.shingle_sets(lines))
    brute = [{line[i : i + 8] for i in range(max(1, len(line) - 7))} for line in lines]
    assert [len(x) for x in found] == [len(x) for x in brute]
    for k in range(1, len(lines)):
        assert len(set(found[k].tolist()) & set(found[k - 1].tolist())) == len(brute[k] & brute[k - 1])


def connected(n, edges):
    """For each of n places, the smallest one that the edges reach."""
    least = list(range(n))
    for _ in range(n):
        before = list(least)
        for i, j in edges:
            least[i] = least[j] = min(least[i], least[j])
        if least == before:
            return least
    return least


def test_blocks_of_a_table_name_all_that_the_budget_links():
    rng = random.Random(8)
    base, fps = [rng.getrandbits(32) for _ in range(30)], set()
    for _ in range(500):
        x = rng.choice(base)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(32)
        fps.add(x)
    rows = np.zeros(len(fps), simhash_trie.ROW)
    rows["fp"], rows["h"] = sorted(fps), range(len(fps))
    assert all((simhash_trie.turned(rows["fp"], b) != rows["fp"]).any() == (b > 0) for b in range(3))
    edges = [e for b in range(3) for e in zip(*(x.tolist() for x in simhash_trie.near_leaves(rows, b)), strict=True)]
    fps = sorted(fps)
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    assert len(near) > 300 and connected(len(fps), edges) == connected(len(fps), near)


def test_pairs_are_the_same_in_few_cells_and_many(spark, monkeypatch):
    texts = near_copies(9, 100, (40, 120))
    fps = spark.createDataFrame([(h, simhash_trie.wide_fingerprint(t)) for h, t in enumerate(texts)], "h long, fps array<long>").repartition(3)
    few = [tuple(r) for r in simhash_trie.similar_pairs(fps).collect()]
    monkeypatch.setattr(simhash_trie, "CELL", 1)
    many = [tuple(r) for r in simhash_trie.similar_pairs(fps).collect()]
    assert len(few) > 150 and connected(400, few) == connected(400, many)
    assert simhash_trie.similar_pairs(fps.limit(0)).count() == 0


def test_few_texts_alike_in_one_table_by_chance_are_a_pair(spark):
    """The more texts there are, the more of such pairs, each of which would take both texts along."""
    rng = random.Random(12)
    word = lambda: rng.getrandbits(64) - (1 << 63)
    rows = [(h, [h % 40 << 34 | 7, *(word() for _ in range(9))]) for h in range(200)]
    alike = [(1000 + h, [fps[0], *(x ^ 1 << 40 for x in fps[1:])]) for h, fps in rows[:50]]
    got = {tuple(r) for r in simhash_trie.similar_pairs(spark.createDataFrame(rows + alike, "h long, fps array<long>")).collect()}
    named = {(h, 1000 + h) for h in range(50)}
    assert named <= got and len(got - named) < 10  # without the other tables, hundreds


def test_long_texts_with_a_few_keys_in_common_are_no_pair(spark):
    """The sketches of long texts tell nothing; texts of the similarity have hundreds of their keys in common."""
    size, kept = 5000, 1001
    least = -(-8 * 2 * size // 18) - (size - kept)  # keys that two such texts share, if what is no key of theirs is all the same
    own = lambda h, n: [10_000 * (h + 1) + k for k in range(n)]
    shared = {0: [1], 1: [1], 2: [1, *range(100, 99 + least)], 3: range(100, 99 + least), 4: range(99, 99 + least), 5: range(99, 99 + least)}
    keys = [(h, size, [*x, *own(h, kept - len(x))], [0x5555555555555555] * 16) for h, x in shared.items()]
    texts = spark.createDataFrame(keys, "h long, size long, keys array<long>, sketch array<long>")
    groups = spark.createDataFrame([], "node long, component long")
    assert {tuple(r) for r in simhash_trie.missed_pairs(texts, groups, 0.8).collect()} == {(4, 5)}


def test_shuffle_files_go_when_a_frame_is_kept(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in (f.getName() for f in _seq(disk.getAllFiles())) if x.startswith("shuffle_")}
    before, set_to = files(), spark.conf.get(shared.CLEANUP, None)
    kept = shared.staged(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    for _ in range(50):  # they go in the background
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(shared.CLEANUP, None) == set_to
    assert sorted(tuple(r) for r in kept.collect()) == [(k, 100) for k in range(10)]


def _seq(scala):
    return [scala.apply(k) for k in range(scala.length())]
