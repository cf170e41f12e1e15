"""Operators on texts against brute force, with nulls, empty and long texts, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from straitflow.llm import bpe, packing, quality_cascade, quality_ftrl, secrets, token_counts
from straitflow.llm.registry import ORACLE, QUERIES, VOCABULARY
from straitflow.llm.shared import ship

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")
SECRET = "password = 'hunter2hunter2' AKIA" + "Q7" * 9 + " é中 " + "ab12" * 8

MESSY = [
    (1, "Plain words, and some more of them.\nA second line\twith a tab."),
    (2, ""),
    (3, None),
    (None, "no id at all"),
    (4, "   \n\n \t"),
    (5, "ein zwei drei " * 3000),
    (6, SECRET),
    (6, SECRET),
    (7, "x" * 5000 + "<|endoftext|>" + "y  z\x85\x1c 'll 're'"),
    (8, "Secret: token: abcdefgh\nSecret: token: abcdefgh"),
    (9, "a b c a b c d"),
]


@pytest.fixture(scope="module")
def messy(spark):
    """Documents with columns whose names the operators use themselves."""
    ship(spark)
    rows = spark.createDataFrame(MESSY, "doc_id long, text string")
    clashing = ["h", "ids", "kind", "n_tokens", "score", "words", "line", "id", "fp", "carried", "held_out", "start"]
    return rows.select("*", *[F.lit(-1).alias(c) for c in clashing])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ALPHABET = ["a", "b", "'s", "'re", "'", "r", " ", "  ", "\n", "\t", "\xa0", "1", "é", "中", "!", "%%", "<|endoftext|>"]
ALPHABET += ["<|endof", "\x1c", "\x85", "ing", "the", "tion", "hel", "lo"]
texts = st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join) | st.text(max_size=20).filter(
    lambda s: not any(0xD800 <= ord(c) < 0xE000 for c in s)
)
BPE = bpe.ByteBpe(bpe.read_spec(VOCABULARY))
ENCODERS = [bpe.CachedEncoder(BPE), packing.RankedEncoder(BPE)]
COUNTER = token_counts.PrefixCounter(BPE)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_encoders_equal_the_library(text):
    library = test_encoders_equal_the_library.library = getattr(
        test_encoders_equal_the_library, "library", None
    ) or Tokenizer.from_file(VOCABULARY)
    expected = ids_of(library, text)
    for encoder in ENCODERS:
        coded = np.frombuffer(encoder.encode(text), "<u4")
        assert coded.tolist() == expected
        assert BPE.decode(coded) == library.decode(expected, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=9).map("".join), st.integers(0, 6))
def test_prefix_counts_equal_encoding_every_prefix(text, budget):
    library = Tokenizer.from_file(VOCABULARY) if not hasattr(COUNTER, "library") else COUNTER.library
    COUNTER.library = library
    expected = [len(ids_of(library, text[:k])) for k in range(len(text) + 1)]
    assert COUNTER.prefix_counts(text).tolist() == expected
    assert COUNTER.count(text) == expected[-1]
    assert COUNTER.longest_within(text, budget) == max(k for k, n in enumerate(expected) if n <= budget)


def test_round_trip(spark, messy, empty, library):
    got = sorted(map(tuple, bpe.round_trip_digests(spark, messy, VOCABULARY).collect()), key=repr)
    expected = []
    for doc_id, text in MESSY:
        ids = ids_of(library, text)
        coded = np.array(ids, "<u4").tobytes()
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x).hexdigest() for x in (coded, decoded.encode())]
        expected.append((doc_id, len(ids), *digests))
    assert got == sorted(expected, key=repr)
    back = bpe.decode_documents(spark, bpe.encode_documents(spark, messy, VOCABULARY), VOCABULARY)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t in MESSY), key=repr)
    assert bpe.round_trip_digests(spark, empty, VOCABULARY).count() == 0


def test_token_counts_and_truncation(spark, messy, empty, library):
    rows = token_counts.count_documents(spark, messy, VOCABULARY, limit=20).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows), key=repr)
    counts = [(i, len((t or "").encode()), len(ids_of(library, t))) for i, t in MESSY]
    assert got == sorted(((i, b, n, n > 20) for i, b, n in counts), key=repr)
    small = messy.where("doc_id IN (1, 9)")
    cut = token_counts.truncate_documents(token_counts.prefix_table(spark, small, VOCABULARY), small, 5)
    for r in cut.collect():
        whole = dict(MESSY)[r.doc_id]
        assert r.text == whole[: len(r.text)] and len(ids_of(library, r.text)) <= 5
        assert all(len(ids_of(library, whole[:k])) > 5 for k in range(len(r.text) + 1, len(whole) + 1))
    assert token_counts.count_documents(spark, empty, VOCABULARY, 1).count() == 0


@pytest.mark.parametrize("window", [7, 2048])
def test_packing(spark, messy, empty, library, window):
    pieces = packing.pack_documents(spark, messy.repartition(3), VOCABULARY, window).collect()
    stream = {}
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        for k in range(p.length):
            place = (p.sequence_id * window + p.offset + k)
            assert place not in stream
            stream[place] = (p.doc_id, p.start + k, int.from_bytes(p.ids[4 * k : 4 * k + 4], "little"), p.doc_tokens)
    assert sorted(stream) == list(range(len(stream)))
    expected = Counter()
    for doc_id, text in MESSY:
        ids = [*ids_of(library, text), 1]
        expected.update((doc_id, k, x, len(ids)) for k, x in enumerate(ids))
    assert Counter(stream.values()) == expected
    assert packing.pack_documents(spark, empty, VOCABULARY, window).count() == 0


def base_spans(text):
    text = text or ""
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def written(spans):
    return ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in spans)


def test_secrets_base(spark, messy, empty):
    got = sorted(map(tuple, secrets.report(messy).drop("spans").collect()), key=repr)
    expected = []
    for doc_id, text in MESSY:
        spans = base_spans(text)
        counts = [sum(k == x[1] for x in spans) for k in range(3)]
        expected.append((doc_id, *counts, hashlib.sha256(written(spans).encode()).hexdigest()))
    assert got == sorted(expected, key=repr)
    assert secrets.report(empty).count() == 0


def test_weak_parts_are_linked_within_the_scope_only(spark):
    random_part = "Abcdefghijklmnopqrstuvwxyz0123456789XYZ"
    cases = [
        (1, f"user=bob and {random_part} at host: db.example.com", {"linked_access", "linked_secret", "linked_endpoint"}),
        (2, f"user=bob {'. ' * 150}{random_part}", set()),
        (3, random_part + " host: db.example.com", set()),
        (4, "user=bob at https://example.com/login", set()),
        (5, "login: alice\ntoken = abcdef123456", {"linked_access", "assign"}),
        (6, f"{random_part} {'. ' * 80}client_id=abc", {"linked_access", "linked_secret"}),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string")
    for r in secrets.report(df).collect():
        kinds = {x.split(":")[0] for x in r.spans.split(",")} - {""}
        assert kinds == cases[r.doc_id - 1][2], r


def test_a_text_full_of_candidates(spark):
    text = "user=bob Abcdefghijklmnopqrstuvwxyz0123456789XYZ\n" * 3000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert len(secrets.report(df).first().spans.split(",")) == 6000


def test_redaction(spark, messy):
    got = Counter(map(tuple, secrets.redact_documents(messy).select("doc_id", "text").collect()))
    expected = Counter()
    for doc_id, text in MESSY:
        out, at = "", 0
        for a, _, b in base_spans(text):
            if a >= at:
                out += text[at:a] + "[REDACTED]"
            at = max(at, b)
        expected[doc_id, None if text is None else out + text[at:]] += 1
    assert got == expected


def rule_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def test_rule_counts(spark, messy, empty):
    rng = random.Random(3)
    more = [(100 + k, " ".join(rng.choice("ab cd e\n".split(" ")) for _ in range(k))) for k in range(60)]
    df = messy.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted((tuple(r)[:7] for r in quality_cascade.judge(df).collect()), key=repr)
    assert got == sorted(((i, *rule_counts(t)) for i, t in MESSY + more), key=repr)
    assert quality_cascade.judge(empty).count() == 0


def test_the_order_of_rules_changes_no_verdict(spark, messy):
    rules = quality_cascade.default_rules()
    measured = quality_cascade.measure(messy)
    ways = [rules, rules[::-1], quality_cascade.ordered_rules(measured, rules, sample_rows=5)]
    assert sorted(r.name for r in ways[2]) == sorted(r.name for r in rules)
    kept = [
        sorted(map(tuple, measured.select("doc_id", quality_cascade.cascade(w).isNull()).collect()), key=repr) for w in ways
    ]
    assert kept[0] == kept[1] == kept[2]


@needs_tables
def test_clean_documents_pass_the_rules_and_junk_does_not(spark):
    d = "/root/testdata/sf0.01"
    verdict = {r.doc_id: r for r in QUERIES["op5_rule_cascade"](spark, d).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    long = [i for i in labels if not verdict[i].base_failed]
    assert all(verdict[i].kept for i in long if labels[i] == 1)
    assert not any(verdict[i].kept for i in long if labels[i] == 0)


@needs_tables
def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op2_quality_ftrl"](spark, d).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(rows) == 1000
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    held = [(labels[i], rows[i].score) for i in labels if rows[i].held_out]
    good, bad = ([s for y, s in held if y == k] for k in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.98 and np.mean([(s >= 0.7) == y for y, s in held]) > 0.95


def test_training_takes_one_row_of_each_id(spark):
    ship(spark)
    rows = [(k, f"word{k} of a text") for k in range(40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame(rows + rows[:20] * 30, "doc_id long, text string")
    assert quality_ftrl.train(often, labels) == quality_ftrl.train(once, labels)


def test_classifier_edge_cases(spark, messy, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_ftrl.train(messy, labels) is None
    assert {r.score for r in quality_ftrl.score(spark, messy, None).collect()} == {1.0}
    assert quality_ftrl.keep_good(spark, messy, None).count() == len(MESSY)
    some = spark.createDataFrame([(1, 1), (5, 0), (7, 0), (8, 1), (9, None), (None, 1)], "doc_id long, quality int")
    weights = quality_ftrl.train(messy, some)
    scored = quality_ftrl.score(spark, messy, weights).collect()
    assert len(scored) == len(MESSY) and len({r.score for r in scored if r.doc_id in (2, 3, 4)}) == 1
    kept = quality_ftrl.keep_good(spark, messy, weights)
    assert kept.columns == messy.columns and kept.count() == sum(r.predicted for r in scored)
    assert quality_ftrl.score(spark, empty, weights).count() == 0
    held = spark.createDataFrame([(3, 0)], "doc_id long, quality int").where(quality_ftrl.held_out())
    assert held.count() == (zlib.crc32(b"3") % 4 == 2)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    from compare import connect, differences

    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


@needs_tables
def test_tokenizer_queries_equal_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    counts = {i: len(ids_of(library, t)) for i, t in docs.items()}
    for name in ("op6_bpe_round_trip", "op10_token_counts"):
        assert {r.doc_id: r.n_tokens for r in QUERIES[name](spark, SF).collect()} == counts
    pieces = QUERIES["op7_packing"](spark, SF).collect()
    assert {p.doc_id: p.doc_tokens - 1 for p in pieces} == counts
    assert sum(p.length for p in pieces) == sum(counts.values()) + len(counts)


def test_vocabulary_is_the_public_file():
    assert VOCABULARY == public_tokenizers.path("byte_bpe_50k.json")
