"""Fuzzy line de-duplication by MinHash: one line of every group of near-equal lines stays.

A line is normalised to lower case without outer blanks. Its signature is taken over character shingles, bands
of it are bucket keys, and every candidate pair is verified by the exact Jaccard similarity of all its shingles.
Links go through distributed union-find, and each component keeps its first line.

* Equal lines are one row from the first aggregation on, so copies cost a row per task, not a row each. Lines shorter
  than a shingle only meet their copies.
* Signatures take all shingles of a line, as verification does. They are made of numpy arrays, all lines of a batch at
  once: in DataFrame functions, 21 hashes of each shingle alone take the budget of the whole operator.
* Keys are counted first. Only those that two lines have get their members, which a bit table of bounded size tells
  ahead of the shuffle.
* A bucket's lines first meet its most central lines, those with most neighbours over all buckets. A line with
  many variants is central to their buckets, and links them. Then all pairs of the bucket that are not linked yet
  meet by sketches, which tell unlike lines apart without a miss; so every pair of a bucket is judged exactly.
* Texts are shuffled only for lines that are candidates and documents that lose a line; which these may be is
  told by a bit table too.

Everything but signatures and verification is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from straitflow.llm.shared import attached, components, give_back, keyed, marked_by, staged

#: Characters of a shingle, and so of the shortest line that is looked at for more than copies.
SHINGLE = 8

#: Fixed value: a character that is no white space, as every line has that is looked at.
WORD = "[^\\x20\\x09-\\x0D]"

#: Seven bands of three: 99.3 % of pairs at a similarity of 0.8 share a bucket of all shingles, 99.99 % at 0.9.
BANDS, ROWS = 7, 3
SIMILARITY = 0.8

#: Central lines of a bucket that its other lines meet first.
LEADERS = 8

#: 64-bit words of a line's sketch, and lines of a block of a bucket.
WORDS = 16
BLOCK = 1024

#: Characters that are hashed at a time, so that arrays stay in the processor's cache.
CHUNK = 1 << 15


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, h (a hash of the text), line_no (from 0), line (normalised), id of every line with a word.

    `id` is a 64-bit hash of the line.
    """
    line = F.lower(F.trim(F.col("raw")))
    return (
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            F.xxhash64(docs["text"].cast("string")).alias("h"),
            F.posexplode(F.split(docs["text"].cast("string"), "\n")).alias("line_no", "raw"),
        )
        .select("doc_id", "h", "line_no", line.alias("line"))
        .where(F.col("line").rlike(WORD))
        .select("doc_id", "h", "line_no", "line", F.xxhash64("line").alias("id"))
    )


def shingle_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the shingle that begins at each code point, as far as there is a whole one."""
    x, base = codes.astype(np.uint64), 0x9E3779B97F4A7C15
    for step in (1, 2, 4):
        x = x[:-step] * np.uint64(base) + x[step:]
        base = base * base % 2**64
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def shingle_sets(lines: Sequence[str]) -> Iterator[np.ndarray]:
    """Each line's different shingles as sorted 64-bit hashes; a line shorter than a shingle is one itself."""
    first = 0
    while first < len(lines):
        last, size = first + 1, len(lines[first])
        while last < len(lines) and size + len(lines[last]) <= CHUNK:
            size, last = size + len(lines[last]), last + 1
        codes = np.frombuffer("".join(lines[first:last]).encode("utf-32-le"), np.uint32)
        hashes = shingle_hashes(codes) if size >= SHINGLE else np.empty(0, np.uint64)
        at = 0
        for line in lines[first:last]:
            if len(line) < SHINGLE:
                yield np.array([hash(line) % 2**64], np.uint64)
            else:
                x = np.sort(hashes[at : at + len(line) - SHINGLE + 1])
                new = np.ones(len(x), bool)
                np.not_equal(x[1:], x[:-1], out=new[1:])
                yield x[new]
            at += len(line)
        first = last


def band_keys(codes: np.ndarray, ends: np.ndarray, seed: int = 17) -> np.ndarray:
    """The bucket keys, a row each, of lines of SHINGLE code points or more that follow one another and end there."""
    draw = np.random.default_rng(seed).integers(0, 2**31, (2, BANDS * ROWS), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    starts = np.concatenate([[0], ends[:-1]])
    lanes = np.full((BANDS * ROWS, len(ends)), 2**32 - 1, np.uint32)
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK, side="right")))
        low, high = int(starts[first]), int(ends[last - 1])
        x = shingle_hashes(codes[low:high])
        # Shingles that reach into the next line are left out.
        inner = np.repeat(ends[first:last] - low, ends[first:last] - starts[first:last])[: len(x)]
        x = x[np.arange(len(x)) + SHINGLE <= inner]
        begin = starts[first:last] - low - np.arange(last - first) * (SHINGLE - 1)
        a, b = x.astype(np.uint32), (x >> np.uint64(32)).astype(np.uint32)
        for j in range(BANDS * ROWS):
            lanes[j, first:last] = np.minimum.reduceat(a * draw[0, j] + b * draw[1, j], begin)
        first = last
    keys = np.empty((len(ends), BANDS), np.uint64)
    for k in range(BANDS):
        key = np.full(len(ends), k + 1, np.uint64)
        for lane in lanes[k * ROWS : (k + 1) * ROWS]:
            key = (key ^ lane) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(32)
        keys[:, k] = key
    return keys.view(np.int64)


def signatures(lines: DataFrame) -> DataFrame:
    """id and keys, the bucket keys of its bands, of every distinct line of SHINGLE characters or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, at = np.unique(batch.column(0).to_numpy(), return_index=True)
            ids, text = batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))
            if not len(ids):
                continue
            codes = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le"), np.uint32)
            keys = band_keys(codes, np.cumsum(pc.utf8_length(text).to_numpy().astype(np.int64)))
            listed = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, listed], ["id", "keys"])
        give_back()

    long = lines.select("id", "line").where(F.char_length("line") >= SHINGLE)
    # Equal lines have equal keys.
    return long.mapInArrow(run, "id long, keys array<long>").groupBy("id").agg(F.first("keys").alias("keys"))


def bands(signed: DataFrame) -> DataFrame:
    """id and key: the bucket keys of every signature."""
    return signed.select("id", F.explode("keys").alias("key"))


def grams(line: str, n: int = SHINGLE) -> Column:
    """The distinct shingles of a line, as 64-bit hashes; one code point is four bytes of `UTF-32`."""

    def of(code: Column) -> Column:
        starts = F.sequence(F.lit(0), (F.length(code) / 4).cast("int") - n)
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.substring(code, 4 * i + 1, F.lit(4 * n)))))

    # As the element of an array the code is computed once; inside the lambda it would be for every shingle.
    return F.get(F.transform(F.array(F.encode(line, "UTF-32")), of), F.lit(0))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose lines' shingle sets have at least the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.column(1).to_numpy()
            new = np.append(True, b[1:] != b[:-1])[: len(b)]  # sorted by the join, or nearly
            others = shingle_sets(batch.column(3).filter(pa.array(new)).to_pylist())
            kept = []
            for k, left in enumerate(shingle_sets(batch.column(2).to_pylist())):
                if new[k]:
                    right = next(others)
                both = np.sort(np.concatenate([left, right]))
                common = np.count_nonzero(both[1:] == both[:-1])
                if common >= similarity * (len(both) - common):
                    kept.append(k)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(kept, pa.int64())) for c in batch.columns[:2]], ["a", "b"])
        give_back()

    both = (
        pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("left")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("line").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    return both.mapInArrow(run, "a long, b long")


def bucket_members(signed: DataFrame) -> DataFrame:
    """key, id and n, the lines of the bucket, of all buckets with two lines or more."""
    shared = staged(bands(signed).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    likely = marked_by(bands(signed), "key", shared.select("key")).where("marked").select("id", "key")
    return likely.join(shared, "key").select("key", "id", "n")


def links(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a and b, ids of distinct lines that are near duplicates, enough of them to connect every component."""
    lines = lines_of(docs)
    members = staged(bucket_members(staged(signatures(lines))))
    # The line that others were made from shares more and larger buckets with them than they do among themselves.
    degrees = members.groupBy("id").agg(F.sum("n").alias("degree"))
    central = Window.partitionBy("key").orderBy(F.desc("degree"), "id")
    leaders = (
        members.join(degrees, "id")
        .withColumn("place", F.row_number().over(central))
        .where(F.col("place") <= LEADERS)
        .select("key", F.col("id").alias("leader"))
    )
    met = members.join(leaders, "key").where("id <> leader")
    pairs = staged(met.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct())
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    likely = marked_by(lines.select("id", "line"), "id", needed).where("marked").select("id", "line")
    texts = staged(likely.dropDuplicates(["id"]).join(needed, "id", "left_semi"))
    groups = staged(components(staged(verified(pairs, texts, similarity))))
    rest = staged(unmet(members, groups, texts, similarity).join(pairs, ["a", "b"], "left_anti"))
    stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
    return stars.unionAll(verified(rest, texts, similarity))


def sketches(texts: DataFrame) -> DataFrame:
    """id, size (number of shingles) and words: bit k is the parity of the shingles whose hash falls on it."""
    rows = texts.select("id", grams("line").alias("x")).select("id", F.explode("x").alias("x"))
    bit = F.expr("shiftleft(1L, CAST(x & 63 AS INT))")
    word = F.expr(f"pmod(shiftright(x, 6), {WORDS})")
    parts = [F.coalesce(F.expr("bit_xor(bit) FILTER (WHERE word = %d)" % k), F.lit(0).cast("long")).alias(f"w{k}") for k in range(WORDS)]
    return (
        rows.select("id", bit.alias("bit"), word.alias("word")).groupBy("id").agg(F.count(F.lit(1)).alias("size"), *parts)
    )


def unmet(members: DataFrame, groups: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of a bucket that no link joins yet, without those that cannot have the similarity.

    Sketches differ in no more bits than the sets in shingles, so nothing that verification would accept is left
    out. A bucket is cut into blocks and a key is a pair of blocks, so no task gets a whole large bucket.
    """
    placed = members.where(F.col("n") > LEADERS + 1).join(groups.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("key", "id", "n", F.coalesce("component", "id").alias("g"))
    split = placed.groupBy("key").agg(F.min("g").alias("least"), F.max("g").alias("most")).where("least <> most")
    placed = staged(placed.join(split.select("key"), "key", "left_semi"))
    sketched = staged(sketches(texts.join(placed.select("id").distinct(), "id", "left_semi")))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = placed.join(sketched, "id").withColumn("own", F.pmod(F.hash("id"), blocks)).withColumn("last", blocks - 1)
    kept = ["key", "id", "g", "size", *[f"w{k}" for k in range(WORDS)]]
    low = rows.select(*kept, F.col("own").alias("i"), F.explode(F.sequence("own", "last")).alias("j")).alias("x")
    high = rows.select(*kept, F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j")).alias("y")
    differing = sum((F.bit_count(F.col(f"x.w{k}").bitwiseXOR(F.col(f"y.w{k}"))) for k in range(WORDS)), F.lit(0))
    possible = differing <= (1 - similarity) / (1 + similarity) * (F.col("x.size") + F.col("y.size")) + 1e-6
    once = (F.col("x.i") < F.col("x.j")) | (F.col("x.id") < F.col("y.id"))
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("key", "i", "j")]
    found = low.join(high, [*same, F.col("x.g") != F.col("y.g"), once, possible])
    return found.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, h and line_no of every line that is not the first of its component, by doc_id and line_no."""
    groups = components(links(docs, similarity))
    lines = lines_of(docs).select("doc_id", "h", "line_no", "id", F.xxhash64("line", F.lit(1)).alias("id2"))
    placed = staged(
        lines.join(groups.withColumnRenamed("node", "id"), "id", "left").select(
            "doc_id",
            "h",
            "line_no",
            F.coalesce("component", "id").alias("g"),
            F.when(F.col("component").isNull(), F.col("id2")).otherwise(F.lit(0)).alias("g2"),
        )
    )
    place = F.struct("doc_id", "line_no", "h")
    firsts = staged(
        placed.groupBy("g", "g2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    )
    return (
        placed.join(firsts.select("g", "g2", "first"), ["g", "g2"])
        .where(~place.eqNullSafe(F.col("first")))
        .select("doc_id", "h", "line_no")
    )


def dedup_lines(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, text without repeated lines, n_lines, n_removed, and `carried`, a struct of the columns to carry.

    Lines without a word stay, and those shorter than a shingle have no duplicates but their copies. Of near-equal lines
    the one with the smallest doc_id and place stays; a null doc_id comes first. Rows equal in id and text count as one document: both keep the same lines. A null
    text stays null, with no lines; a text whose lines all went is empty.
    """
    gone = staged(
        removed_lines(docs, similarity).groupBy("doc_id", "h").agg(F.collect_set("line_no").alias("gone"))
    )
    rows = attached(keyed(docs, carry), gone).withColumn("lines", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    rebuilt = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return rows.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(rebuilt).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        "carried",
    )
