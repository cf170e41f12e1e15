"""Spelling variants: groups words one edit apart by walking a trie that is a table.

A node of the trie is a prefix; its row lists the characters that follow it, and what lies below each. A state is (word,
position, node, edits). Level by level, the states are joined with the nodes: without an edit so far, a state
goes on along the word's own character, tries the other ones (replacement), or skips a character of the word (deletion); with its edit
spent it can only follow the word. A state at the word's end on a node that ends a word is a pair of neighbours.

Both ends of a pair would find it, so replacements only go to higher characters, and insertions are left to the
longer word. Near the root almost every character follows, so no edit is tried there: a second trie
holds the words backwards, and each word takes edits in its second half in the one, those in its first half in the
other. A subtree that holds one word is not walked: the hash of what is left of it is in the row of its parent.

Words of more than LEVELS characters (pasted data, mostly) would need as many joins. They meet by the
hashes of what a deletion leaves of them, one per character, and are compared as they are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from straitflow.llm.shared import staged

#: Fixed value: the characters of a run, once A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")

#: Characters of the longest words that walk the trie.
LEVELS = 32

#: Different words that a task counts before it passes the counts on.
COUNTED = 200_000

#: States on one node that one key may hold; a node with more words below is split over salts.
NODE_WORDS = 100_000

#: Modulus and base of the rolling hash of long words; equal hashes are compared.
PRIME, BASE = (1 << 61) - 1, 1_000_003


# --- words ------------------------------------------------------------------


def misspelt(word: str, doc_id: int | None) -> str:
    """A word of the contract of the registered query: one in 97 loses a character, by a hash of document and word."""
    h = zlib.crc32(f"{doc_id}:{word}".encode()) if doc_id is not None else 1
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, least_chars: int = 5, least_count: int = 3, planted: bool = False) -> DataFrame:
    """word and n, its occurrences, of the words of at least so many code points and occurrences.

    Words are runs of Latin letters with A-Z lower-cased; null texts have none. `planted` changes them by `misspelt`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            words = [w for w in total if len(w) >= least_chars]
            counts = [total[w] for w in words]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = Counter(RUN.findall((text or b"").lower().decode()))  # of bytes, lower() changes A-Z only
                if planted:
                    for word, n in found.items():
                        total[misspelt(word, doc_id)] += n
                else:
                    total.update(found)
                if len(total) > COUNTED:
                    yield out()
        yield out()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").cast("binary").alias("text"))
    counted = rows.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- the trie ---------------------------------------------------------------


def _char(word: Column | str, at: Column | str) -> Column:
    return F.substring(word, F.col(at) + 1 if isinstance(at, str) else at + 1, F.lit(1))


def _bit(char: Column) -> Column:
    """A bit for a character; others may share it."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(char), F.lit(64)))


def _sides(words: DataFrame) -> DataFrame:
    """Each word as side > (forwards) and side < (backwards), and the position from which it is to be edited there."""
    size = F.char_length("word")
    half = F.floor(size / 2).cast("int")
    both = F.array(
        F.struct(F.lit(">").alias("side"), F.col("word"), half.alias("start")),
        F.struct(F.lit("<").alias("side"), F.reverse("word").alias("word"), (size - half).alias("start")),
    )
    return words.select(F.explode(both).alias("s")).select("s.*")


def trie_nodes(sides: DataFrame) -> DataFrame:
    """node, n (words below), terminal and kids, a row for each prefix from where a word is edited that several words share.

    A kid is a character `c`, a mask `next` of the characters behind it, whether a word ends there, and, if one word is
    below only, `tail`, the hash of what is left of that word.
    """
    spelt = sides.select(
        "side", "word", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("depth")
    )
    ends = F.col("depth") == F.char_length("word")
    rest = F.substring("word", F.col("depth") + 1, F.char_length("word"))
    prefixes = (
        spelt.select(
            F.concat("side", F.substring("word", F.lit(1), F.col("depth"))).alias("node"),
            F.when(ends, F.lit(0).cast("long")).otherwise(_bit(_char("word", "depth"))).alias("bit"),
            ends.cast("int").alias("ends"),
            F.xxhash64(rest).alias("tail"),
        )
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_or("bit").alias("next"), F.max("ends").alias("ends"), F.max("tail").alias("tail"))
    )
    depth = F.char_length("node")
    as_kid = F.struct(
        F.substring("node", depth, F.lit(1)).alias("c"),
        "next",
        (F.col("ends") == 1).alias("terminal"),
        F.when(F.col("n") == 1, F.col("tail")).alias("tail"),
    )
    none = F.lit(None).cast("struct<c: string, next: bigint, terminal: boolean, tail: bigint>")
    parts = F.array(
        F.struct(F.substring("node", F.lit(1), depth - 1).alias("node"), "n", F.lit(0).alias("ends"), as_kid.alias("kid")),
        F.struct("node", F.col("ends").cast("long").alias("n"), "ends", none.alias("kid")),
    )
    wanted = F.slice(parts, F.lit(1), F.when((F.col("ends") == 1), F.lit(2)).otherwise(F.lit(1)))
    return (
        prefixes.select(F.explode(wanted).alias("p"))
        .select("p.*")
        .groupBy("node")
        .agg(F.sum("n").alias("n"), (F.max("ends") == 1).alias("terminal"), F.collect_list("kid").alias("kids"))
        .where((F.col("n") > 1) & (F.char_length("node") > 1))
    )


#: What follows from a state, in SQL. `rest_from(p)` is the word behind position p.
_REST = "substring(word, {0} + 1)"
#: A kid `k` reached with the edit spent: 2 ends there, 1 goes on, 0 is lost. `{0}` is the position behind the kid.
_FATE = """CASE
    WHEN k.tail IS NOT NULL THEN IF(k.tail = xxhash64(substring(word, {0} + 1)), 2, 0)
    WHEN {0} >= char_length(word) THEN IF(k.terminal, 2, 0)
    WHEN k.next & shiftleft(1L, ascii(substring(word, {0} + 1, 1)) % 64) <> 0 THEN 1
    ELSE 0 END"""


def _step(at: str, kept: str) -> str:
    """The states reached over those kids that fulfil `kept`, with the edit spent."""
    return f"""transform(filter(kids, k -> {kept}), k -> named_struct(
        'node', concat(node, k.c), 'pos', {at}, 'edits', 1, 'fate', {_FATE.format(at)}))"""


def _next_states() -> str:
    follow = _step("pos + 1", "k.c = substring(word, pos + 1, 1)")
    replace = _step("pos + 1", "k.c > substring(word, pos + 1, 1)")
    skip = _step("pos + 2", "k.c = substring(word, pos + 2, 1)")
    # Of equal characters in a row, the first in reading order is the one to delete.
    first = """substring(word, pos + 1, 1) <>
        IF(startswith(node, '>'), substring(word, pos, 1), substring(word, pos + 2, 1))"""
    last = "IF(terminal, array(named_struct('node', node, 'pos', pos + 1, 'edits', 1, 'fate', 2)), array())"
    ahead = """transform(filter(kids, k -> k.c = substring(word, pos + 1, 1) AND k.tail IS NULL), k -> named_struct(
        'node', concat(node, k.c), 'pos', pos + 1, 'edits', 0, 'fate', 1))"""
    return f"""CASE
        WHEN edits = 1 THEN {follow}
        WHEN pos >= char_length(word) THEN array()
        ELSE concat({ahead}, {replace},
                    CASE WHEN NOT ({first}) THEN array()
                         WHEN pos + 1 = char_length(word) THEN {last}
                         ELSE {skip} END)
        END"""


def _turned(side: Column, word: Column) -> Column:
    return F.when(side == ">", word).otherwise(F.reverse(word))


def walked_pairs(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """a and b: each pair of words one edit apart, once, and some pairs whose b is no word. For words of at most LEVELS."""
    spark = words.sparkSession
    sides = _sides(words)
    nodes = staged(trie_nodes(sides))
    held = nodes.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    # Nodes with many words below; the limit grows with the words, so these are a few thousand rows at most.
    limit = max(node_words, held[1] // 1000) if node_words == NODE_WORDS else node_words
    heavy = staged(
        nodes.where(F.col("n") > limit).select("node", F.ceil(F.col("n") / limit).cast("int").alias("splits"))
    )
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Placed once; every level then shuffles its states only.
    trie = staged(
        nodes.join(F.broadcast(heavy), "node", "left")
        .select("node", "terminal", "kids", salts.alias("salt"))
        .repartition(parts, "node", "salt")
    )
    first = sides.where("start < char_length(word)").select(
        F.concat("side", F.substring("word", F.lit(1), F.col("start"))).alias("node"),
        "word",
        F.col("start").alias("pos"),
        F.lit(0).alias("edits"),
    )
    found = []
    states = first
    while True:
        salted = states.join(F.broadcast(heavy), "node", "left").select(
            "node", F.pmod(F.xxhash64("word"), F.coalesce("splits", F.lit(1)).cast("long")).cast("int").alias("salt"), "word", "pos", "edits"
        )
        after = (
            salted.repartition(parts, "node", "salt")
            .join(trie.hint("shuffle_hash"), ["node", "salt"])
            .select("node", "word", F.explode(F.expr(_next_states())).alias("s"))
            .where("s.fate > 0")
            .select("s.*", "word")
        )
        after = staged(after)
        side = F.substring("node", 1, 1)
        # Whichever way the end was reached, what is behind the node is the rest of the word.
        b = F.concat(F.substring("node", F.lit(2), F.char_length("node")), F.expr(_REST.format("pos")))
        found.append(
            after.where("fate = 2").select(_turned(side, F.col("word")).alias("a"), _turned(side, b).alias("b"))
        )
        states = after.where("fate = 1").select("node", "word", "pos", "edits")
        if states.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    return pairs


# --- long words -------------------------------------------------------------


def _left_hashes(word: str) -> Iterator[tuple[int, int]]:
    """For each position: it, and the hash of the word without the character there; -1 and the hash of the word itself."""
    codes = [ord(c) for c in word]
    ahead = list(accumulate(codes, lambda h, c: (h * BASE + c) % PRIME, initial=0))
    behind, power = 0, 1
    for i in range(len(codes) - 1, -1, -1):
        yield (i, (ahead[i] * power + behind) % PRIME)
        behind = (codes[i] * power + behind) % PRIME
        power = power * BASE % PRIME
    yield (-1, ahead[-1])


def long_pairs(words: DataFrame) -> DataFrame:
    """a and b: each pair of words one edit apart of which one has more than LEVELS characters, both ways.

    Words that a deletion makes equal share a hash: both lose the character at one place (replacement), or one of them none.
    Rows hold numbers only; the words are joined to the pairs of equal ones and compared.
    """
    rows = words.where(F.char_length("word") >= LEVELS).select("word", F.xxhash64("word").alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, left = zip(*_left_hashes(word), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array(left, pa.int64())], ["w", "at", "rest"]
                )

    keys = staged(rows.mapInArrow(run, "w long, at long, rest long"))
    same = keys.alias("x").join(keys.alias("y"), ["at", "rest"]).where("x.w <> y.w AND at >= 0").select("x.w", F.col("y.w").alias("v"))
    cut = (
        keys.where("at >= 0").alias("x").join(keys.where("at < 0").alias("y"), "rest").where("x.w <> y.w")
        .select("x.w", F.col("y.w").alias("v"))
    )
    near = same.unionAll(cut).unionAll(cut.select(F.col("v").alias("w"), F.col("w").alias("v"))).distinct()
    a, b = rows.select("w", F.col("word").alias("a")), rows.select(F.col("w").alias("v"), F.col("word").alias("b"))
    joined = near.join(a, "w").join(b, "v").where(F.greatest(F.char_length("a"), F.char_length("b")) > LEVELS)
    return joined.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


# --- groups -----------------------------------------------------------------


def neighbours(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """word and near: all pairs of words one inserted, deleted or replaced code point apart, both ways.

    `words` holds each word once. Null and empty words have no neighbours here.
    """
    words = words.select("word").where("word <> ''")
    walked = walked_pairs(words.where(F.char_length("word") <= LEVELS), node_words)
    turned = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"))))
    both = walked.select(turned.alias("p")).select("p.*")
    return both.unionAll(long_pairs(words).select(F.col("a").alias("word"), F.col("b").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for rows of word and form: the last word that forms lead to. Forms make no cycles.

    Every round doubles how far a word points, so a chain of n words takes log n rounds.
    """
    now = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        # Aggregated first, so that a form that many words share is looked up once.
        targets = now.select("root").distinct().join(now.select(F.col("word").alias("root"), F.col("root").alias("beyond")), "root")
        ahead = staged(targets)
        if ahead.isEmpty():
            return now
        now = staged(now.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))


def group(counted: DataFrame, times: int = 2, node_words: int = NODE_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for rows of word and n.

    A word's form is its neighbour of largest n (of equal ones, the smallest in code-point order), if that is at
    least `times` the word's own n, else null; its root is the word that forms lead to in the end, itself if it has
    none. A repeated word is one word with the sum of its n; null words are left out.
    """
    words = staged(counted.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")))
    # The inner join also drops pairs whose other end is no word.
    pairs = neighbours(words, node_words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    )
    good = -F.col("best.m") >= times * F.col("n")
    told = staged(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(good, F.col("best.near")).alias("form"),
            F.when(good, -F.col("best.m")).alias("form_n"),
        )
    )
    found = roots(told.where("form IS NOT NULL").select("word", "form"))
    return told.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
