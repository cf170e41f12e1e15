"""Operators over a whole corpus against brute force: search, near duplicates, lines, pages, the pipeline."""

from __future__ import annotations

import random
import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from straitflow.llm import html_paths, line_minhash, simhash_trie, topk_segments
from straitflow.llm.registry import QUERIES
from straitflow.llm.shared import components, marked_by, ship

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


def grouped(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in edges:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


# --- shared -----------------------------------------------------------------


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 200)] + [(7, 7), (300, 301)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(150)],
        "none": [],
    }[kind]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    expected = grouped(400, edges)
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: expected[x] for x in touched}


def test_marked_rows_include_all_wanted_ones(spark):
    frame = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("slot_like"))
    keys = spark.range(0, 20_000, 97).select(F.col("id").alias("k"))
    marked = {r.k for r in marked_by(frame, "k", keys).where("marked").collect()}
    assert set(range(0, 20_000, 97)) <= marked and len(marked) < 3000
    assert marked_by(frame, "k", keys.limit(0)).where("marked").count() == 0


# --- search -----------------------------------------------------------------


def brute_top(vectors, is_query, k):
    out = []
    for qi, q in vectors:
        if is_query(qi):
            scores = [(-int(np.dot(q, c)), ci) for ci, c in vectors if ci != qi and len(c) == len(q)]
            out += [(qi, r, ci, -s) for r, (s, ci) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("dims", [1, 3, 64])
def test_top_k(spark, dims):
    ship(spark)
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(6, dims))
    rows = [(i, (base[i % 6] + 0.05 * rng.normal(size=dims)).round(2).tolist()) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(9)] + [(300, [1.0, float("nan")]), (301, None), (302, [None])]
    rows += [(303, [float("inf")] * dims), (None, [1.0] * dims), (304, [0.5] * (dims + 1)), (305, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    vectors = topk_segments.usable(df)
    got = topk_segments.top_k(vectors.where("id % 10 = 0"), vectors, query_block=5, candidate_block=30)
    kept = [
        (i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64))
        for i, v in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all()
    ]
    assert sorted(map(tuple, got.collect())) == brute_top(kept, lambda i: i % 10 == 0, 5)


def test_top_k_of_few_none_and_huge(spark):
    schema = "vec_id long, embedding array<double>"
    few = topk_segments.usable(spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0])], schema))
    assert [tuple(r) for r in topk_segments.top_k(few, few).orderBy("query_id").collect()] == [
        (0, 1, 1, 256 * 256),
        (1, 1, 0, 256 * 256),
    ]
    none = few.limit(0)
    assert topk_segments.top_k(none, few).count() == 0 and topk_segments.top_k(few, none).count() == 0
    big = [(0, [1e12, 1.0]), (1, [1e12, 3.0]), (2, [-1e12, 0.0]), (3, [1.0, 1e5])]
    huge = topk_segments.usable(spark.createDataFrame(big, schema))
    got = sorted(map(tuple, topk_segments.top_k(huge.where("id = 3"), huge).collect()))
    assert got == brute_top([(i, np.array([int(256 * x) for x in v], object)) for i, v in big], lambda i: i == 3, 5)


# --- SimHash ----------------------------------------------------------------


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("depth", [0, 3])
def test_trie_walk(spark, depth):
    ship(spark)
    rng = random.Random(depth)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = set()
    for _ in range(400):
        x = rng.choice(base)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    df = spark.createDataFrame(signed, "fp long")
    edges = simhash_trie.links(df, 2, leaf_rows=len(fps) >> depth).collect()
    place = {x & (2**64 - 1): i for i, x in enumerate(fps)}
    got = grouped(len(fps), [(place[e.a & (2**64 - 1)], place[e.b & (2**64 - 1)]) for e in edges])
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    assert got == grouped(len(fps), near)


def test_near_duplicates(spark):
    ship(spark)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for k in range(40):
        text = [rng.choice(words) for _ in range(300)]
        rows.append((k, " ".join(text)))
        if k % 4 == 0:
            rows += [(100 + 5 * k + c, " ".join([*text[:c], "Other", *text[c + 1 :]])) for c in range(3)]
    rows += [(900, "A  b\tC"), (901, "a b c"), (902, "one"), (903, ""), (904, None), (905, " \n "), (None, "a b c")]
    rows += [(906, "x y z " * 20_000), (900, "A  b\tC")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(0))
    got = simhash_trie.near_duplicates(df).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    n = len(rows)
    near = [(i, j) for i in range(n) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    groups = grouped(n, near)
    least = defaultdict(lambda: None)
    for (doc_id, _), g in zip(rows, groups):
        if doc_id is not None:
            least[g] = doc_id if least[g] is None else min(least[g], doc_id)
    expected = Counter((i, f"{f:016x}", least[g]) for (i, _), f, g in zip(rows, fps, groups))
    assert Counter(map(tuple, got)) == expected
    kept = simhash_trie.keep_first(df, carry=["fingerprint"]).collect()
    assert sorted(r.doc_id for r in kept) == sorted({x for x in least.values()})
    assert simhash_trie.near_duplicates(df.limit(0)).count() == 0


# --- lines ------------------------------------------------------------------


def has_word(line):
    return re.search("[^\\x20\\x09-\\x0D]", line) is not None


def brute_lines(rows):
    """The text of each row after line de-duplication, by the exact similarity of all pairs of lines."""
    places = defaultdict(list)
    for doc_id, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            line = line.strip(" ").lower()
            if has_word(line):
                places[line].append((doc_id is not None, doc_id or 0, k))
    lines = sorted(places)
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in lines]
    near = [
        (i, j) for i in range(len(lines)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    groups = dict(zip(lines, grouped(len(lines), near)))
    first = {}
    for line, at in places.items():
        first[groups[line]] = min([*at, first.get(groups[line], (2, 0, 0))])
    out = []
    for doc_id, text in rows:
        kept = None
        if text is not None:
            kept = [
                x
                for k, x in enumerate(text.split("\n"))
                if not has_word(y := x.strip(" ").lower()) or first[groups[y]] == (doc_id is not None, doc_id or 0, k)
            ]
        out.append((doc_id, None if kept is None else "\n".join(kept)))
    return Counter(out)


def test_line_dedup(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    common = [" ".join(word() for _ in range(30)) for _ in range(12)]
    rows = []
    for k in range(60):
        lines = [" ".join(word() for _ in range(25)) for _ in range(3)]
        for _ in range(3):
            line = rng.choice(common).split(" ")
            if rng.random() < 0.5:
                line[rng.randrange(30)] = word()
            lines.append("  " * (k % 2) + " ".join(line).capitalize())
        rows.append((k, "\n".join(rng.sample(lines, len(lines)))))
    rows += [(100, None), (101, ""), (102, "short\nshort"), (None, common[0] + "\nmine alone, it is said here"), (103, common[0])]
    rows += [(104, "东京都千代田区丸之内一丁目九番一号东京车站站前广场大厦南口"), (105, "东京都千代田区丸之内一丁目九番一号东京车站站前广场大厦南口侧")]
    rows += [(106, common[1]), (106, common[1]), (107, "z" * 100_000), (108, "z" * 100_001)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash"))
    out = line_minhash.dedup_lines(df, carry=["id"])
    assert Counter((r.doc_id, r.text) for r in out.collect()) == brute_lines(rows)
    assert {r.carried.id for r in out.collect()} == {"clash"}
    assert line_minhash.dedup_lines(df.limit(0)).count() == 0


def test_candidates_are_verified_exactly(spark):
    rows = [(1, "q" * 30), (2, "abcdefghij klmnopqrst uvwxyz"), (3, "abcdefghij klmnopqrst uvwxyz1"), (4, "abcdefghij klm opqrst uvwxyz")]
    texts = spark.createDataFrame(rows, "id long, line string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (2, 4), (3, 4)], "a long, b long")
    assert [tuple(r) for r in line_minhash.verified(pairs, texts, 0.8).collect()] == [(2, 3)]


def test_a_large_bucket_costs_its_size(spark):
    """Templated lines share their buckets: one component, from few pairs a line."""
    line = "the quick brown fox jumps over the lazy dog and runs away from number %d while the other animals watch it go"
    docs = spark.createDataFrame([(k, line % (1000 + k)) for k in range(1500)], "doc_id long, text string")
    edges = line_minhash.links(docs)
    assert edges.count() <= 1500 * line_minhash.LEADERS * line_minhash.BANDS
    left = line_minhash.dedup_lines(docs).where("n_removed = 0").count()
    assert left == 1


@pytest.mark.parametrize("kind", ["short", "log", "url"])
def test_banding_finds_alike_lines_of_any_shape(spark, kind):
    """The share of pairs with a common bucket is what banding promises for the similarity over all shingles."""
    rng = random.Random(kind)
    token = lambda lo, hi: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(lo, hi)))
    pairs = []
    while len(pairs) < 400:
        if kind == "short":
            words = [token(4, 9) for _ in range(rng.randint(5, 9))]
            pair = " ".join(words), " ".join([*words[:-1], token(2, 5)])
        elif kind == "log":
            tail = " ".join(token(4, 9) for _ in range(rng.randint(5, 8)))
            pair = f"{rng.randrange(100)} {tail}", f"{rng.randrange(100)} {tail}"
        else:
            tail = "/".join(token(9, 9) for _ in range(7))
            pair = tuple(" ".join([*(str(rng.randrange(10)) for _ in range(5)), tail]) for _ in range(2))
        x, y = ({line[i : i + 8] for i in range(len(line) - 7)} for line in pair)
        if pair[0] != pair[1] and len(x & y) >= 0.8 * len(x | y):
            pairs.append((*pair, len(x & y) / len(x | y)))
    flat = [(2 * k + side, p[side]) for k, p in enumerate(pairs) for side in (0, 1)]
    keys = defaultdict(set)
    signed = line_minhash.signatures(spark.createDataFrame(flat, "id long, line string"))
    for r in line_minhash.bands(signed).collect():
        keys[r.id].add(r.key)
    found = sum(bool(keys[2 * k] & keys[2 * k + 1]) for k in range(len(pairs)))
    promised = sum(1 - (1 - s**line_minhash.ROWS) ** line_minhash.BANDS for *_, s in pairs)
    assert found >= promised - 4


def test_pairs_inside_large_families_are_found(spark):
    """Two templates, each with many unlike lines and few alike pairs that only share what is not the template."""
    rng = random.Random(21)
    token = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    lines = []
    for head in (" ".join(token(7) for _ in range(9)), " ".join(token(7) for _ in range(9))):
        for _ in range(120):
            shared = token(9)
            lines += [f"{shared} {head} {token(3)}" for _ in range(2)]
            lines.append(f"{token(9)} {head} {token(3)}")
    rng.shuffle(lines)
    rows = list(enumerate(lines))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in line_minhash.dedup_lines(docs).collect())
    expected = brute_lines(rows)
    assert 200 <= sum(n for (_, text), n in expected.items() if text == "") <= 280
    assert sum((got - expected).values()) <= 0.01 * len(rows)


@needs_tables
def test_line_dedup_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Counter((r.doc_id, r.text) for r in QUERIES["op8_line_minhash"](spark, SF).collect())
    assert got == brute_lines([(r.doc_id, r.text) for r in docs.collect()])


# --- pages ------------------------------------------------------------------

ARTICLE = "First of all, there is a long paragraph here. It has commas, and full stops."
PAGES = [
    (f"<html><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{ARTICLE}<p>Short.</article><footer>f</footer>", f"Title\n\n{ARTICLE}\n\nShort."),
    (f'<div class="sidebar"><p>{ARTICLE}</p></div><div id=main><p>{ARTICLE} &amp; more&nbsp;&eacute;\n\n x</p></div>', f"{ARTICLE} & more é x"),
    (f"<main><p>{ARTICLE}</p><div class='user-comments'><p>{ARTICLE} I agree, really.</p></div><script>if (a<b) x('</p>')</script></main>", ARTICLE),
    (f"<article><p>a<b>b</b> <i>c</i><br>d {ARTICLE}</p><form>Name <input></form><ul><li>One, item.<li>Two, items.</ul>", f"ab c d {ARTICLE}\n\nOne, item.\n\nTwo, items."),
    (f"<body class='has-sidebar'><header>Site</header><article><p>{ARTICLE}</p><aside>Ad</aside><!-- <p>no</p> --><p hidden>no</p>", ARTICLE),
    ("", ""),
    (None, ""),
    ("<<< not & a <page", None),
    ("<article><p>" + "word, " * 50_000, "word, " * 49_999 + "word,"),
    ("<article><p>" + "<div>" * 3000 + ARTICLE, ARTICLE),
    (f'<div class="content with-sidebar"><p>{ARTICLE}</p><p>{ARTICLE}</p></div>', f"{ARTICLE}\n\n{ARTICLE}"),
    (f'<div class="no-header single"><p>{ARTICLE}</div>', ARTICLE),
    (f'<section class="entry social-policy"><p>{ARTICLE}</section>', ARTICLE),
    (f'<div class="search-results-article"><p>{ARTICLE}</div>', ARTICLE),
    (f"<div><article><p>Next: more.</article><p>{ARTICLE}</p><p>{ARTICLE} {ARTICLE}</p></div>", f"Next: more.\n\n{ARTICLE}\n\n{ARTICLE} {ARTICLE}"),
    (f'<div class="sidebar"><p>{ARTICLE}</div>', ARTICLE),  # all there is
    (f'<div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><div class="reader-comments"><p>{ARTICLE} I agree, really.</p></div>', f"{ARTICLE}\n\n{ARTICLE}"),
    (f"<div><div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><ul>{'<li>News' * 9}</ul></div>", f"{ARTICLE}\n\n{ARTICLE}"),
    (f"<div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><div><span><a href=x>One, two, three.</a></span></div>", f"{ARTICLE}\n\n{ARTICLE}"),
]


def test_ratios_decide():
    """With the threshold off, what has few characters and marks comes out too."""
    for page, expected in PAGES[-3:]:
        found = html_paths.blocks(page)
        assert "\n\n".join(b.text for b in html_paths.selected(found)) == expected
        assert len(html_paths.selected(found, share=0.0)) >= len(html_paths.selected(found))
    menu, comments = html_paths.blocks(PAGES[-2][0]), html_paths.blocks(PAGES[-3][0])
    assert len(html_paths.selected(menu, share=0.0)) == 11 and len(html_paths.selected(comments, share=0.0)) == 3


@pytest.mark.parametrize("piece", ["<div>word word. ", "<p><b>word word. ", "<table><tr><td>word, ", "<span class=x>word ", "</p><li>word "])
def test_deep_nesting_costs_its_length(piece):
    start = time.monotonic()
    assert "word" in html_paths.main_text(piece * (1_000_000 // len(piece)))
    assert time.monotonic() - start < 30


@needs_tables
def test_pages_without_markers(spark):
    """The article element may be missing, and telling classes nearly always may: paths give the same text."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    names = r"(?i)\s(class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]*)"
    plain = lambda x: re.sub(r"(?i)<(/?)(?:article|main)\b[^>]*>", r"<\1div>", x)
    unnamed = 0
    for page in pages:
        text, found = html_paths.main_text(page), html_paths.blocks(plain(page))
        assert html_paths.main_text(plain(page)) == text
        assert len(html_paths.selected(found, share=0.0)) > len(html_paths.selected(found))
        unnamed += html_paths.main_text(re.sub(names, "", page)) == text
    assert unnamed >= 0.95 * len(pages)


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_main_text(k):
    page, expected = PAGES[k]
    got = html_paths.main_text(page)
    assert expected is None or got == expected


def test_extract(spark):
    ship(spark)
    rows = [(k, f"u{k}", p[0]) for k, p in enumerate(PAGES)] + [(None, None, PAGES[0][0]), (0, "u0", PAGES[0][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_paths.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert Counter(r.text for r in got)[PAGES[0][1]] == 3
    assert html_paths.extract(df.limit(0)).count() == 0


@needs_tables
def test_pages_of_the_table(spark):
    """Every paragraph of the article, and nothing of the menu, the advert or the footer."""
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    clean = lambda x: " ".join(unescape(re.sub("<[^>]*>?", " ", x)).split())
    for r in QUERIES["op9_html_paths"](spark, SF).collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)[1]
        parts = [clean(x) for x in re.split("</?(?:p|h1)>", inside)]
        assert r.text == "\n\n".join(x for x in parts if x)


# --- pipeline ---------------------------------------------------------------


@needs_tables
def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == corpus_pipeline.COLUMNS, name
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(docs)
    quality, lines, unique, redacted, pieces = kept
    scores = {r.doc_id: r.predicted for r in QUERIES["op2_quality_ftrl"](spark, SF).collect()}
    assert {r.doc_id for r in quality.collect()} == {i for i, p in scores.items() if p}
    rows = [(r.doc_id, r.text) for r in quality.collect()]
    expected = Counter({k: n for k, n in brute_lines(rows).items() if k[1] or dict(rows)[k[0]] == k[1]})
    assert Counter((r.doc_id, r.text) for r in lines.collect()) == expected
    sets = {r.doc_id: simhash_trie.shingle_set(r.text) for r in lines.collect()}
    ids = sorted(sets)
    pairs = [(i, j, sets[ids[i]], sets[ids[j]]) for i in range(len(ids)) for j in range(i)]
    near = [(i, j) for i, j, x, y in pairs if len(x & y) >= 0.8 * len(x | y)]
    assert {r.doc_id for r in unique.collect()} == {ids[g] for g in grouped(len(ids), near)}
    assert redacted.count() == unique.count() and all(r.n_chars == len(r.text) for r in redacted.collect())
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in redacted.collect()}
    run = corpus_pipeline.run(spark, SF)
    total = pieces.agg(F.sum("length")).first()[0]
    assert run.agg(F.sum("length")).first()[0] == total


def test_pipeline_stages_on_messy_and_empty_rows(spark):
    rows = [(1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (None, None, None, None, None), (2, "", None, "s", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema).withColumn("extra", F.lit(1)).withColumn("h", F.lit(2))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF) if Path(SF).exists() or name != "quality classifier" else docs
            assert out.count() >= (1 if data else 0), name
            if name != "packing":
                docs = out
