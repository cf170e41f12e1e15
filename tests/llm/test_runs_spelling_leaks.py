"""Periodic runs, spelling variants and benchmark leaks against brute force, and on messy rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from straitflow.llm import periodic_runs, spelling_trie, suffix_leaks
from straitflow.llm.registry import ORACLE, QUERIES
from straitflow.llm.shared import ship
from compare import connect, differences

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")
DOCS = "doc_id long, text string"
CLASHING = "doc_id long, text string, h long, n long, word string, carried string, marked int, ranges int, start int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@needs_tables
@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_spelling_trie", "op13_suffix_leaks"])
def test_queries_equal_their_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


# --- periodic runs ----------------------------------------------------------


def slow_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_range_queries_of_the_wavelet_tree():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        lo = rng.integers(0, n, 200)
        hi = np.minimum(n, lo + rng.integers(1, n + 1, 200))
        at = rng.integers(0, n, 200)
        ranges = [np.sort(values[a:b]) for a, b in zip(lo, hi)]
        assert tree.below(lo, hi, at).tolist() == [int((r < x).sum()) for r, x in zip(ranges, at)]
        k = np.array([rng.integers(0, len(r)) for r in ranges])
        assert tree.smallest(lo, hi, k).tolist() == [int(r[i]) for r, i in zip(ranges, k)]


def test_suffix_array_and_block_intervals():
    rng = random.Random(4)
    for _ in range(50):
        ids = np.array([rng.randrange(1, 4) for _ in range(rng.randrange(1, 60))])
        order, blocks = periodic_runs.dyadic_blocks(ids)
        assert order.tolist() == sorted(range(len(ids)), key=lambda i: ids[i:].tolist())
        for length, at, lo, hi in blocks:
            for i, a, b in zip(at.tolist(), lo.tolist(), hi.tolist()):
                same = [j for j in range(len(ids)) if ids[j : j + length].tolist() == ids[i : i + length].tolist()]
                assert i % length == 0 and sorted(order[a:b].tolist()) == same and len(same) > 1


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(600):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            n, letters = rng.choice([0, 1, 5, 6, 7, 20, 60, 150]), rng.choice([1, 2, 3, 10])
            words = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if n > 20 and rng.random() < 0.7:
                a, p = rng.randrange(n // 2), rng.randrange(1, 10)
                words = words[:a] + (words[a : a + p] * n)[: n - a]
            texts.append(words)
        assert periodic_runs.runs_of(texts) == [slow_runs(t) for t in texts]


def test_long_texts_of_runs():
    for text in ([b"a"] * 300_000, b"a b c d e f g".split() * 40_000, [b"a", b"b"] * 9 + [b"%d" % i for i in range(200_000)]):
        runs = periodic_runs.runs_of([text])[0]
        assert runs and runs[0] == ((0, len(text), len(set(text))) if len(set(text)) < 9 else (0, 18, 2))


def slow_report(doc_id, text):
    words = periodic_runs.planted((text or "").encode().split(), doc_id)
    runs = slow_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join("%d,%d,%d\n" % r for r in runs)
    return (doc_id, len(runs), *told, sha256(listed.encode()).hexdigest(), sha256(kept).hexdigest())


def messy_texts():
    rng = random.Random(6)
    words = ["a", "b", "é", " ", "a b", "x" * 5000]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 9, 40, 200])))) for i in range(150)]
    rows += [(None, None), (None, "a b " * 9), (7, None), (8, ""), (9, " \t\n\x0b\x0c\r "), (10, "go go go go go go"), (10, "go go go go go go")]
    return rows + [(i, "one two three four five six seven eight nine ten " * 30) for i in range(200, 260)]


def test_run_report_on_messy_rows(spark):
    rows = messy_texts()
    frame = spark.createDataFrame(rows, DOCS).withColumns({"start": F.lit(1), "period": F.lit("p"), "h": F.lit(2)})
    got = Counter(map(tuple, periodic_runs.planted_report(frame.repartition(5)).collect()))
    assert got == Counter(slow_report(*r) for r in rows)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None)
    for empty in (periodic_runs.planted_report, periodic_runs.runs, periodic_runs.collapse):
        assert empty(frame.limit(0)).count() == 0


def test_runs_and_collapsed_texts(spark):
    frame = spark.createDataFrame([(1, "say  ha ha ha ha ha ha ha now"), (2, "as  it is "), (3, None)], DOCS)
    assert [tuple(r) for r in periodic_runs.runs(frame).collect()] == [(1, 1, 7, 1, "ha")]
    assert {tuple(r) for r in periodic_runs.collapse(frame).collect()} == {(1, "say ha now", 6), (2, "as  it is ", 0), (3, None, 0)}


# --- spelling ---------------------------------------------------------------


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def slow_groups(counted):
    out = {}
    near = {w: [v for v in counted if one_apart(w, v)] for w in counted}
    form = {}
    for w, n in counted.items():
        best = min(near[w], key=lambda v: (-counted[v], v), default=None)
        form[w] = best if best is not None and counted[best] >= 2 * n else None
    for w, n in counted.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n, len(near[w]), counted.get(form[w]))
    return sorted(out.values())


def some_words():
    rng = random.Random(8)
    words = {"".join(rng.choice(k) for _ in range(n)) for k in ("ab", "abcé", "abcdefÿà×") for n in (5, 6, 7, 12) for _ in range(40)}
    for n in (30, 31, 32, 33, 34, 60):
        base = "".join(rng.choice("abc") for _ in range(n))
        words.add(base)
        for _ in range(8):
            i = rng.randrange(n)
            words |= {base[:i] + rng.choice("abcx") + base[i + 1 :], base[:i] + base[i + 1 :], base[:i] + "z" + base[i:]}
    return words | {"a" * n for n in (1, 2, 5, 6, 31, 32, 33, 34)}


@pytest.mark.parametrize("node_words", [spelling_trie.NODE_WORDS, 3])
def test_spelling_groups_equal_brute_force(spark, node_words):
    rng = random.Random(9)
    counted = {w: rng.choice([3, 3, 4, 6, 8, 50, 400]) for w in some_words()}
    rows = [(w, n) for w, n in counted.items()] + [(None, 5)]
    got = spelling_trie.group(spark.createDataFrame(rows, "word string, n long"), node_words=node_words)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(slow_groups(counted), key=repr)


def test_words_of_messy_texts(spark):
    rng = random.Random(10)
    vocabulary = ["Straße", "strasse", "ÉCOLE", "école", "naïve", "hello", "help", "x" * 3000, "a×b÷c", "Zürich", "don't"]
    rows = [(rng.choice([1, 2, 3, None, 96, 97]), " ".join(rng.choice(vocabulary) for _ in range(60))) for _ in range(40)]
    rows += [(5, None), (6, ""), (7, "123 -- 45")] + rows[:3]
    expected = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            expected[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    frame = spark.createDataFrame([(*r, 1, 2, "w", "c", 3, 4, 5) for r in rows], CLASHING)
    got = dict(map(tuple, spelling_trie.count_words(frame.repartition(4), planted=True).collect()))
    assert got == {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}
    assert spelling_trie.group(spelling_trie.count_words(frame.limit(0))).count() == 0


def test_long_chains_of_forms(spark):
    chain = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(130)]
    got = dict(map(tuple, spelling_trie.roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {w: "w130" for w, _ in chain}


# --- leaks ------------------------------------------------------------------


def fold(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lowered)


def slow_leaks(docs, items, width=10):
    windows = defaultdict(set)
    for item_id, text in items:
        words = fold(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows[tuple(words[i : i + width])].add(item_id)
    out = []
    for doc_id, text in docs:
        words, hit, ids = fold(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (key := tuple(words[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    ids |= windows[key]
        listed = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(words), len(hit), len(listed), sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return out


def leaky(seed=11):
    rng = random.Random(seed)
    words = ["one", "Two", "drei", "Éa", "x1", "été", "一二"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 9, 10, 11, 30])))) for i in range(25)]
    items += [(3, "Another text of item three, which is given twice and long enough."), (None, "an item of no id, with ten words or so in it here")]
    items += [(90, None), (91, ""), (92, "-- !!"), (93, items[5][1]), (94, items[5][1])]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(items)[1] or "", "filler, " * rng.randrange(3)]
        docs.append((i, "\n".join(parts)))
    docs += [(None, items[7][1]), (70, None), (71, ""), (72, "?"), (5, docs[5][1]), (5, docs[5][1]), (5, docs[6][1])]
    return docs + [(80, " ".join([items[-1][1]] * 400))] + [(100 + i, docs[8][1]) for i in range(50)], items


@pytest.mark.parametrize("shard_bytes, block_bytes", [(suffix_leaks.SHARD_BYTES, suffix_leaks.BLOCK_BYTES), (600, 700), (1, 10**6)])
def test_leaks_equal_brute_force(spark, shard_bytes, block_bytes):
    docs, items = leaky()
    frame = spark.createDataFrame([(*r, 1, 2, "w", "c", 3, 4, 5) for r in docs], CLASHING).repartition(3)
    bench = spark.createDataFrame([(i, t, "h") for i, t in items], "item_id long, text string, piece string")
    sizes = {"shard_bytes": shard_bytes, "block_bytes": block_bytes}
    got = Counter(map(tuple, suffix_leaks.report(frame, bench, **sizes).collect()))
    expected = slow_leaks(docs, items)
    assert got == Counter(expected) and 0 < sum(e[5] for e in expected) < len(expected)
    kept = suffix_leaks.clean(frame, bench, carry=["h", "marked"], **sizes).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(d for d, e in zip(docs, expected) if not e[5])
    assert {tuple(r.carried) for r in kept} == {(1, 3)}


def test_leaks_of_empty_tables(spark):
    docs, items = leaky()
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert suffix_leaks.report(frame.limit(0), bench).count() == 0
    assert suffix_leaks.report(frame, bench.limit(0)).where("contaminated OR n_hit > 0").count() == 0
    assert suffix_leaks.longest_matches(frame, bench.limit(0)).count() == 0


def test_items_in_pieces(spark):
    rng = random.Random(12)
    words = [f"w{rng.randrange(500)}" for _ in range(suffix_leaks.PIECE_WORDS * 2 + 40)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert suffix_leaks.pieces(bench).count() == 3
    cut = suffix_leaks.PIECE_WORDS
    docs = [(0, " ".join(words[cut - 5 : cut + 5])), (1, " ".join(words[cut - 5 : cut + 4])), (2, " ".join(words))]
    got = {r.doc_id: r.n_hit for r in suffix_leaks.report(spark.createDataFrame(docs, DOCS), bench).collect()}
    assert got == {0: 10, 1: 0, 2: len(words)}


@pytest.mark.parametrize("shard_bytes", [suffix_leaks.SHARD_BYTES, 500])
def test_longest_matches_equal_brute_force(spark, shard_bytes):
    docs, items = leaky(13)
    docs, items = [d for d in docs if d[0] is not None][:40], [(i, t) for i, t in items if i is not None]
    best = {}
    for item_id, text in items:
        a = fold(text)
        for _, other in docs:
            b = fold(other)
            for i in range(len(a)):
                for j in range(len(b)):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                        k += 1
                    if k:
                        best[str(item_id)] = max(best.get(str(item_id), 0), k)
    frame = spark.createDataFrame(docs, DOCS)
    got = suffix_leaks.longest_matches(frame, spark.createDataFrame(items, "item_id long, text string"), shard_bytes=shard_bytes).collect()
    assert {r.item_id: r.length for r in got} == best
    texts, of = dict(docs), defaultdict(list)
    for i, t in items:
        of[str(i)].append(fold(t))
    for r in got:
        there = fold(texts[r.doc_id])[r.doc_start : r.doc_start + r.length]
        assert any(w[r.item_start : r.item_start + r.length] == there for w in of[r.item_id])


@pytest.mark.parametrize("depth", [1, 2, 3, 8, 100])
def test_suffixes_sorted_to_a_depth(depth):
    rng = random.Random(depth)
    for letters in (2, 5, 10**6):
        ids = np.array([rng.randrange(letters) for _ in range(300)] + [letters])
        order = suffix_leaks.suffix_array(ids, depth).tolist()
        assert sorted(order) == list(range(len(ids)))
        keys = [ids[i : i + depth].tolist() for i in order]
        assert keys == sorted(keys)
