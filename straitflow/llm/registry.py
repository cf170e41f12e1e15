"""The registered queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from straitflow.llm import (
    bpe,
    html_paths,
    line_minhash,
    packing,
    periodic_runs,
    quality_cascade,
    quality_ftrl,
    secrets,
    simhash_trie,
    spelling_trie,
    suffix_leaks,
    token_counts,
    topk_segments,
)
from straitflow.llm.shared import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_bpe_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return bpe.round_trip_digests(spark, _table(spark, d, "documents"), VOCABULARY)


@query
def op7_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(spark, _table(spark, d, "documents"), VOCABULARY, with_ids=False)


@query
def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.count_documents(spark, _table(spark, d, "documents"), VOCABULARY, limit=1024)


@query
def op1_top_k_segments(spark: SparkSession, d: str) -> DataFrame:
    vectors = topk_segments.usable(_table(spark, d, "embeddings"))
    return topk_segments.top_k(vectors.where("id % 50 = 0"), vectors, k=5, scale=256.0)


ORACLE["op1_top_k_segments"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
WHERE k <= 5
"""


@query
def op4_simhash_trie(spark: SparkSession, d: str) -> DataFrame:
    return simhash_trie.near_duplicates(_table(spark, d, "documents"), width=3, budget=2)


@query
def op3_secret_links(spark: SparkSession, d: str) -> DataFrame:
    return secrets.report(_table(spark, d, "documents"))


@query
def op5_rule_cascade(spark: SparkSession, d: str) -> DataFrame:
    return quality_cascade.judge(_table(spark, d, "documents"))


@query
def op2_quality_ftrl(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    return quality_ftrl.score(spark, docs, quality_ftrl.train(docs, _table(spark, d, "labels")), threshold=0.7)


@query
def op9_html_paths(spark: SparkSession, d: str) -> DataFrame:
    return html_paths.extract(_table(spark, d, "pages"))


@query
def op8_line_minhash(spark: SparkSession, d: str) -> DataFrame:
    return line_minhash.dedup_lines(_table(spark, d, "documents")).drop("carried")


@query
def op13_suffix_leaks(spark: SparkSession, d: str) -> DataFrame:
    return suffix_leaks.report(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


ORACLE["op13_suffix_leaks"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), i AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), sized AS (
    SELECT item_id, words, least(len(words), 10) AS size FROM i WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[p:p + size - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS p FROM sized)
), grams AS (
    SELECT r, p, size, array_to_string(words[p:p + size - 1], ' ') AS g
    FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS p
          FROM d, (SELECT DISTINCT size FROM sized))
), hits AS (
    SELECT DISTINCT r, p, g.size, item_id FROM grams g JOIN windows w ON g.g = w.g AND g.size = w.size
), hit AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS q FROM hits) GROUP BY r
), listed AS (
    SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit ON d.r = hit.r LEFT JOIN listed ON d.r = listed.r
"""


@query
def op11_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return periodic_runs.planted_report(_table(spark, d, "documents"))


#: The unsigned crc32 of a list of bytes, `bytes`, with the table `crc` of the CTE below.
_CRC_TABLE = """crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
               lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS t
)"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bytes}),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""
_ID_BYTES = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"

ORACLE["op11_periodic_runs"] = rf"""
WITH {_CRC_TABLE}, d AS (
    SELECT row_number() OVER () AS r, doc_id, {_CRC.format(bytes=_ID_BYTES)} AS h,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents, crc
), told AS (
    SELECT *, len(w) AS n, coalesce(h % 10 = 0 AND len(w) > 0, false) AS planted,
           CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d
), words AS (
    SELECT r, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END] AS x, n
    FROM (SELECT *, unnest(range(n)) AS i FROM told)
), same AS (
    SELECT a.r, a.i, b.i - a.i AS q
    FROM words a JOIN words b ON a.r = b.r AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), stretches AS (
    SELECT r, q, min(i) AS s, count(*) + q AS l
    FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same)
    GROUP BY r, q, island
), runs AS (
    SELECT r, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY r, s, l
), best AS (
    SELECT r, s, l, q FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) = 1
), listed AS (
    SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM runs GROUP BY r
), dropped AS (
    SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs
), kept AS (
    SELECT r, string_agg(x, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period,
       CAST(1000 * l // q AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM told LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


@query
def op12_spelling_trie(spark: SparkSession, d: str) -> DataFrame:
    return spelling_trie.group(spelling_trie.count_words(_table(spark, d, "documents"), planted=True))


_RUN_BYTES = """list_transform(list_filter(string_split(hex(encode(doc_id || ':' || x)), ''), lambda c, i: i % 2 = 1),
        lambda c, i: CAST(('0x' || substr(hex(encode(doc_id || ':' || x)), 2 * i - 1, 2)) AS BIGINT))"""

ORACLE["op12_spelling_trie"] = rf"""
WITH RECURSIVE {_CRC_TABLE}, found AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{{C0}}-\x{{FF}}]+')) AS x FROM documents
), told AS (
    SELECT x, length(x) AS l, n, {_CRC.format(bytes=_RUN_BYTES)} AS h
    FROM (SELECT doc_id, x, count(*) AS n FROM found GROUP BY ALL), crc
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(x, 1, h % l) || substr(x, h % l + 2) ELSE x END AS word, n FROM told)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
    SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word
), best AS (
    SELECT p.word, count(*) AS n_near, max(n) AS m, arg_min(near, (-n, near)) AS near
    FROM pairs p JOIN words w ON p.near = w.word GROUP BY p.word
), forms AS (
    SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN near END AS form,
           CASE WHEN m >= 2 * n THEN m END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
), chain AS (
    SELECT word, word AS root FROM words
    UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
), ends AS (
    SELECT c.word, c.root FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN ends e ON f.word = e.word
"""


ORACLE["op5_rule_cascade"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d
), grams AS (
    SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), repeated AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS t(k) GROUP BY 1
), counted AS (
    SELECT w.r, doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words,
           len(regexp_extract_all(text, '\p{L}')) AS letters, len(regexp_extract_all(text, '\p{Lu}')) AS capitals,
           len(regexp_extract_all(text, '[!?]{2,}')) AS shouts
    FROM w LEFT JOIN covered c ON w.r = c.r
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed
       AND CAST(word_chars AS DOUBLE) / greatest(n_words, 1) BETWEEN 2 AND 15
       AND n_symbols * 5 <= n_words
       AND NOT (n_dup_lines >= 3 AND n_dup_lines * 10 > n_lines * 3)
       AND n_repeat_words * 10 <= n_words * 3
       AND capitals * 2 <= letters
       AND letters * 2 >= word_chars
       AND shouts * 10 <= n_words AS kept
FROM judged
"""
