"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints are bit strings, so a set of them is a trie. Two of its nodes are visited together, from the
root down; the bits in which their paths differ add up, and a pair of nodes is dropped as soon as they exceed
the budget. Equal fingerprints are one leaf. The upper levels of the trie are walked by the key alone: a
fingerprint goes to every cell (a pair of prefixes within the budget) that its own prefix is part of. A task then walks
the lower levels of its cells over sorted arrays, where a node is a range, and returns a spanning forest of
the links that it finds, which has fewer edges than it has fingerprints, however many pairs there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from straitflow.llm.shared import attached, components, give_back, keyed, marked_by, staged

BITS = 64
#: Fixed value: A-Z to a-z, and the white space that ends a word.
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)} | {c: " " for c in "\t\n\x0b\x0c\r"})

#: Hashes that are turned to bits at a time.
CHUNK = 8192


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles: a bit is set if over half of the shingles' hashes have it."""
    words = [w for w in (text or "").translate(LOWER).split(" ") if w]
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        hashes = np.array([digest(" ".join(words), seed)], np.uint64)
    else:
        joined = " ".join(words).encode()
        ends, at = [], -1
        for w in words:
            at += 1 + (len(w) if w.isascii() else len(w.encode()))
            ends.append(at)
        starts = [0, *(e + 1 for e in ends[: 1 - width or None])]
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :], strict=False)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), CHUNK):
        rows = hashes[k : k + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, h (a hash of the text) and fp, the fingerprint as a signed long; a null text has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), width, seed) for x in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["doc_id", "h", "fp"]
            )

    return keyed(docs).select("doc_id", "h", "text").mapInArrow(run, "doc_id long, h long, fp long")


def links(distinct: DataFrame, budget: int = 2, leaf_rows: int = 4096) -> DataFrame:
    """a and b: edges whose components are those of all fingerprints in `fp` at most `budget` bits apart."""
    rows = distinct.count()
    depth = max(0, min(14, math.ceil(math.log2(max(1, rows) / leaf_rows))))
    flips = [sum(1 << i for i in bits) for n in range(min(budget, depth) + 1) for bits in combinations(range(depth), n)]
    prefix = F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("long")
    sent = distinct.select(prefix.alias("own"), "fp").select(
        "own", F.explode(F.array(*[F.lit(x).cast("long") for x in flips])).alias("flip"), "fp"
    )
    other = F.col("own").bitwiseXOR(F.col("flip"))
    cells = sent.select(
        F.least("own", other).alias("low"), F.greatest("own", other).alias("high"), (F.col("own") > other).alias("right"), "fp"
    )

    def walk(group: pa.Table) -> pa.Table:
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        fps = group.column("fp").to_numpy().view(np.uint64)
        if low == high:
            a = b = np.sort(fps)
        else:
            right = group.column("right").to_numpy(zero_copy_only=False)
            a, b = np.sort(fps[~right]), np.sort(fps[right])
        u, v = forest(a, b, depth, (low ^ high).bit_count(), budget)
        give_back()
        return pa.table({"a": u.view(np.int64), "b": v.view(np.int64)})

    return cells.groupBy("low", "high").applyInArrow(walk, "a long, b long")


def forest(a: np.ndarray, b: np.ndarray, depth: int, differing: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Walks two sorted tries that differ in so many bits above `depth`; a spanning forest of the pairs found."""
    every = a if a is b else np.concatenate([a, b])
    u, v = walked(a, b, (depth, *(np.array([x]) for x in (0, len(a), 0, len(b), differing))), budget)
    return every[u], every[v]


def walked(
    a: np.ndarray, b: np.ndarray, start: tuple[int, *tuple[np.ndarray, ...]], budget: int, others: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places in a (and b behind it) of the edges of a spanning forest of the pairs found below pairs of nodes.

    With `others`, 64 more bits of each leaf of a walk of one trie, only pairs count that `agrees` in these.
    """
    same = a is b
    shift = 0 if same else len(a)
    parent = np.arange(len(a) + (0 if same else len(b)))
    edges: list[tuple[int, int]] = []
    # Pairs of nodes: ranges in a and in b, and bits that differ so far. A stack keeps the frontier bounded.
    stack = [start]
    while stack:
        bit, alo, ahi, blo, bhi, diff = stack.pop()
        keep = (alo < ahi) & (blo < bhi) & (diff <= budget)
        if same:  # each pair of nodes once, and no leaf with itself
            keep &= (alo < blo) | ((alo == blo) & (ahi - alo > 1))
        alo, ahi, blo, bhi, diff = (x[keep] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        if len(alo) > 200_000:
            half = len(alo) // 2
            stack += [(bit, alo[s], ahi[s], blo[s], bhi[s], diff[s]) for s in (slice(half, None), slice(half))]
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if others is not None:
                near &= agrees(others[i], others[j])
            _join(parent, edges, i[near], j[near] + shift)
            alo, ahi, blo, bhi, diff = (x[~single] for x in (alo, ahi, blo, bhi, diff))
        if bit == BITS or not len(alo):
            continue
        amid, bmid = _split(a, alo, ahi, bit), _split(b, blo, bhi, bit)
        cat = np.concatenate
        stack.append(
            (
                bit + 1,
                cat([alo, amid, alo, amid]),
                cat([amid, ahi, amid, ahi]),
                cat([blo, bmid, bmid, blo]),
                cat([bmid, bhi, bhi, bmid]),
                cat([diff, diff, diff + 1, diff + 1]),
            )
        )
    u, v = np.array(edges, np.int64).reshape(-1, 2).T
    return u, v


def _split(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where, in each range of values that agree in the bits above, the ones with this bit set begin."""
    mask = np.uint64(1 << (BITS - 1 - bit))
    ahead = ~(mask - np.uint64(1)) & ~mask
    return np.searchsorted(x, (x[lo] & ahead) | mask).clip(lo, hi)


def _join(parent: np.ndarray, edges: list[tuple[int, int]], left: np.ndarray, right: np.ndarray) -> None:
    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in zip(left.tolist(), right.tolist(), strict=True):
        p, q = root(i), root(j)
        if p != q:
            parent[max(p, q)] = min(p, q)
            edges.append((i, j))


def grouped(docs: DataFrame, width: int = 3, budget: int = 2, seed: int = 42) -> DataFrame:
    """doc_id, h, fp and component_id of every row."""
    marked = staged(fingerprints(docs, width, seed))
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = components(links(distinct.select("fp"), budget))
    # Fingerprints that link with no other are their own component, by the smallest id among their rows.
    owner = staged(distinct.join(joined, distinct["fp"] == joined["node"], "left").select("fp", "least", "component"))
    groups = owner.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("component_id"))
    linked = owner.where("component IS NOT NULL").join(groups, "component").select("fp", "component_id")
    alone = owner.where("component IS NULL").select("fp", F.col("least").alias("component_id"))
    return marked.join(staged(linked.unionAll(alone)), "fp", "left").select("doc_id", "h", "fp", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, budget: int = 2, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable by links of fingerprints.

    Two texts link when their fingerprints differ in at most `budget` bits. Texts without words have fingerprint
    zero and link like any other. Rows stay as they are, repeated ones too; a row with a null doc_id gets the
    component of its fingerprint, null if no row in it has an id.
    """
    out = grouped(docs, width, budget, seed)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 3, budget: int = 2, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text and `carried` of the row with the smallest doc_id of each group of near duplicates.

    Rows equal in id and text are one row. A row with a null doc_id goes if its group has an id.
    """
    return _firsts(docs, staged(grouped(docs, width, budget)), carry)


def _firsts(docs: DataFrame, rows: DataFrame, carry: Sequence[str]) -> DataFrame:
    """doc_id, text and `carried` of the rows that are first of their component, by rows of doc_id, h and component_id."""
    copies = (
        rows.groupBy("doc_id", "h")
        .agg(F.bool_or(~F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("copy"), F.count(F.lit(1)).alias("n"))
        .where("copy OR n > 1")
    )
    out = attached(keyed(docs, carry), staged(copies)).where("copy IS NULL OR NOT copy")
    once = out.where("n > 1").dropDuplicates(["doc_id", "h"])
    return out.where("n IS NULL OR n = 1").unionAll(once).select("doc_id", "text", "carried")


# --- near duplicates by similarity -------------------------------------------

#: Tables of 32-bit fingerprints, and bits that may differ in one. At a similarity of 0.8 a bit differs in 15 % of pairs,
#: so a pair is within two bits in 12 % of the tables, and in one of 20 with 92 %; at 0.85 with 99 %.
TABLES, TABLE_BITS, TABLE_BUDGET = 20, 32, 2
SIMILARITY, SIMILAR_WIDTH = 0.8, 5

#: First bits of the blocks of a fingerprint: two that differ in no more bits than TABLE_BUDGET have one of them in common.
BLOCKS = [-(-TABLE_BITS * k // (TABLE_BUDGET + 1)) for k in range(TABLE_BUDGET + 1)]

#: Bits of 64 of another table's fingerprints in which a pair may differ beside: 10 do at the similarity, 32 of unlike texts.
OTHER_BUDGET = 20

#: A row of a cell of a table: the fingerprint, its text, and 64 bits of other tables.
ROW = np.dtype([("fp", "<u4"), ("h", "<i8"), ("other", "<u8")])

#: Texts whose fingerprints are packed at a time, and of a cell on average.
TAKEN, CELL = 1 << 16, 1 << 15

#: 64-bit words of a text's sketch, and texts of a block of a bucket.
SKETCH_WORDS, BLOCK = 16, 1024

#: Texts that are looked at for common shingles, and how often and how many of these are told apart. Only time depends on them.
SAMPLED, OFTEN, MOST = 20_000, 4, 1 << 16

#: Odd constants from which further hashes of a shingle follow.
_MIX = [int.from_bytes(xxhash.xxh64_digest(b"mix%d" % k), "big") | 1 for k in range(TABLES // 2)]


def _words(text: str | None) -> list[str]:
    return [w for w in (text or "").translate(LOWER).split(" ") if w]


def shingle_set(text: str | None, width: int = SIMILAR_WIDTH) -> set[tuple[str, ...]]:
    """The word shingles of a text; of one with fewer words, all of them; none of one without."""
    words = _words(text)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def shingle_hashes(text: str | None, width: int = SIMILAR_WIDTH) -> np.ndarray:
    """64-bit hashes of the different shingles of a text."""
    words, digest = _words(text), xxhash.xxh64_intdigest
    grams = {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else ()
    return np.array([digest(g, 7) for g in grams], np.uint64)


def wide_fingerprint(text: str | None, width: int = SIMILAR_WIDTH) -> list[int]:
    """SimHashes of 64 bits of the different shingles of a text, under TABLES / 2 hashes."""
    return _wide(shingle_hashes(text, width))


def _wide(base: np.ndarray) -> list[int]:
    if not len(base):
        return [0] * len(_MIX)
    out = []
    for mix in _MIX:
        x = (base ^ np.uint64(mix >> 1)) * np.uint64(mix)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        ones = np.zeros(BITS, np.int64)
        for k in range(0, len(x), CHUNK):
            ones += np.unpackbits(x[k : k + CHUNK].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(ones * 2 > len(x)).tobytes(), "big", signed=True))
    return out


def prefix(base: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles of a text in one order for all texts, so many that two texts of the similarity share one.

    They have at least `similarity` of the shingles of either in common, so no more than the rest can come before the first
    common one. Shingles known as common (sorted, and their counts) come last, by their counts; any order is right.
    """
    known, counts = common
    rank = np.zeros(len(base), np.int64)
    if len(known):
        at = np.searchsorted(known, base).clip(max=len(known) - 1)
        rank = np.where(known[at] == base, counts[at], 0)
    first = len(base) - math.ceil(similarity * len(base) - 1e-6) + 1
    return base[np.lexsort((base, rank))[:first]]


def parity_sketch(base: np.ndarray) -> np.ndarray:
    """Bit k of SKETCH_WORDS words is the parity of the shingles whose hash falls on it."""
    bits = np.bincount((base & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def agrees(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether bits of other tables are as near as those of texts of the similarity; of unlike texts, 0.2 % are."""
    return np.bitwise_count(left ^ right) <= OTHER_BUDGET


def turned(fps: np.ndarray, block: int) -> np.ndarray:
    """Fingerprints of a table, turned so that a block comes first."""
    by = BLOCKS[block]
    return fps << np.uint32(by) | fps >> np.uint32(TABLE_BITS - by) if by else fps


def table_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Table by table, its number and the rows of up to TAKEN texts and a batch, of batches of h and fps."""
    taken: list[tuple[np.ndarray, np.ndarray]] = []

    def rows() -> Iterator[tuple[int, np.ndarray]]:
        h, words = (np.concatenate(x) for x in zip(*taken, strict=True))
        for at in range(TABLES):
            out = np.empty(len(h), ROW)
            out["fp"] = words[:, at // 2] & np.uint64(0xFFFFFFFF) if at % 2 else words[:, at // 2] >> np.uint64(32)
            out["h"], out["other"] = h, words[:, (at // 2 + 1) % words.shape[1]]
            yield at, out

    for batch in batches:
        words = batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        if batch.num_rows:
            taken.append((batch.column(0).to_numpy(), words.reshape(batch.num_rows, -1)))
        if sum(len(h) for h, _ in taken) >= TAKEN:
            yield from rows()
            taken.clear()
    if taken:
        yield from rows()


def leaves(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of different fingerprints, with the smallest text of each, and pairs of it and the others of the fingerprint."""
    rows = rows[np.lexsort((rows["h"], rows["fp"]))]
    first = np.ones(len(rows), bool)
    first[1:] = rows["fp"][1:] != rows["fp"][:-1]
    lead = rows[np.flatnonzero(first)[np.cumsum(first) - 1]]
    near = ~first & agrees(rows["other"], lead["other"])
    return rows[first], lead["h"][near], rows["h"][near]


def near_leaves(rows: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a spanning forest of rows of different fingerprints, within the budget and equal in the block: the trie is
    walked from the nodes that the block leads to."""
    fps = turned(rows["fp"], block).astype(np.uint64) << np.uint64(BITS - TABLE_BITS)
    order = np.argsort(fps)
    fps, rows = fps[order], rows[order]
    width = [*BLOCKS, TABLE_BITS][block + 1] - BLOCKS[block]
    top = fps >> np.uint64(BITS - width)
    low = np.flatnonzero(np.append(True, top[1:] != top[:-1]))
    high = np.append(low[1:], len(fps))
    u, v = walked(fps, fps, (width, low, high, low, high, np.zeros_like(low)), TABLE_BUDGET, rows["other"])
    return rows["h"][u], rows["h"][v]


def similar_pairs(texts: DataFrame, width: int = SIMILAR_WIDTH) -> DataFrame:
    """a and b: candidates among rows of h and fps, different texts. Each table is a trie that is joined with itself.

    Texts of equal fingerprints in a table meet the first of them, and the first ones of fingerprints within the
    budget meet along a spanning forest, so a group of n texts costs a table few pairs a text. A pair that a table
    does not name for this, or as other tables speak against it, has these; only time depends on it.

    Fingerprints within the budget are equal in one of BLOCKS, so each is sent to three cells, however many there are: by
    its table and the first bits of a block. A task sends rows of 20 bytes, packed by cell, once for equal fingerprints.
    """
    texts = texts.select("h", "fps")
    bits = min(b - a for a, b in zip(BLOCKS, [*BLOCKS[1:], TABLE_BITS], strict=True))
    depth = max(0, min(bits, math.ceil(math.log2(max(1, texts.count()) / CELL))))

    def equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in table_rows(batches):
            _, a, b = leaves(rows)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        give_back()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, rows in table_rows(batches):
            kept, out = leaves(rows)[0], []
            for block in range(len(BLOCKS)):
                cell = turned(kept["fp"], block).astype(np.int64) >> (TABLE_BITS - depth)
                order = np.argsort(cell, kind="stable")
                found, starts = np.unique(cell[order], return_index=True)
                parts = np.split(kept[order], starts[1:])
                out += [(at, c, block, x.tobytes()) for c, x in zip(found.tolist(), parts, strict=True)]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["at", "cell", "block", "rows"])
        give_back()

    def walk(group: pa.Table) -> pa.Table:
        edges, blocks = [], group.column("block").to_numpy()
        for block in np.unique(blocks).tolist():
            packed = group.column("rows").take(pa.array(np.flatnonzero(blocks == block))).to_pylist()
            kept, a, b = leaves(np.frombuffer(b"".join(packed), ROW))
            edges += [near_leaves(kept, block), *([] if block else [(a, b)])]  # equal ones meet in all three
        give_back()
        return pa.table({c: np.concatenate(x) for c, x in zip("ab", zip(*edges, strict=True), strict=True)})

    cells = texts.mapInArrow(deal, "at int, cell int, block int, rows binary")
    near = cells.groupBy("at", "cell").applyInArrow(walk, "a long, b long")
    both = texts.mapInArrow(equal, "a long, b long").unionAll(near).where("a <> b")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def common_shingles(rows: DataFrame, width: int = SIMILAR_WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the shingles that many of a bounded sample of texts have; they only set an order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(x.as_py(), width).view(np.int64))], ["x"])

    every = max(1, rows.count() // SAMPLED)
    sample = rows.where(F.pmod("h", F.lit(every)) == 0).select("text").mapInArrow(run, "x long")
    found = sample.groupBy("x").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "x").limit(MOST)
    got = found.collect()
    known = np.array([r.x for r in got], np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], np.array([r.n for r in got], np.int64)[order]


def with_groups(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with an h and `g`, their group: a component of node and component, or h itself for a text without links.

    Only rows that likely have a link are shuffled; the others, most of a corpus, stay where they are.
    """
    likely = marked_by(texts, "h", groups.select(F.col("node").alias("h")))
    linked = likely.where("marked").join(groups.withColumnRenamed("node", "h"), "h", "left")
    linked = linked.select(*texts.columns, F.coalesce("component", "h").alias("g"))
    return linked.unionAll(likely.where("NOT marked").select(*texts.columns, F.col("h").alias("g")))


def missed_pairs(texts: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """a and b: all pairs of texts (h, size, keys, sketch) in different groups that may have the similarity.

    Texts of the similarity share a key of `prefix`, so no pair is left out; those of sizes too far apart, or with sketches that
    differ in more bits than their sets may in shingles, cannot have it, nor those with too few keys in common: what two texts
    share beyond the last key of one of them is among the shingles of that one that are no keys. Long texts, whose sketches
    tell little, share keys by chance, the more pairs of them the more texts there are; but they need many. Only keys that
    two groups have get their members.
    A bucket is cut into blocks and a task gets a pair of blocks, so none gets a whole large bucket.
    """
    spread = with_groups(texts.select("h", "keys"), groups).select("h", "g", F.explode("keys").alias("key"))
    crossing = spread.groupBy("key").agg(F.min("g").alias("least"), F.max("g").alias("most"), F.count(F.lit(1)).alias("n"))
    crossing = staged(crossing.where("least <> most").select("key", "n"))
    members = marked_by(spread, "key", crossing.select("key")).where("marked").select("h", "g", "key").join(crossing, "key")
    sketched = texts.select("h", "size", (F.col("size") - F.size("keys")).alias("others"), *[F.col("sketch")[k].alias(f"w{k}") for k in range(SKETCH_WORDS)])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = staged(members).join(sketched, "h").withColumn("own", F.pmod(F.hash("h"), blocks)).withColumn("last", blocks - 1)
    kept = ["key", "h", "g", "size", "others", *[f"w{k}" for k in range(SKETCH_WORDS)]]
    low = rows.select(*kept, F.col("own").alias("i"), F.explode(F.sequence("own", "last")).alias("j")).alias("x")
    high = rows.select(*kept, F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j")).alias("y")
    differing = sum((F.bit_count(F.col(f"x.w{k}").bitwiseXOR(F.col(f"y.w{k}"))) for k in range(SKETCH_WORDS)), F.lit(0))
    sizes = F.col("x.size"), F.col("y.size")
    possible = (differing <= (1 - similarity) / (1 + similarity) * (sizes[0] + sizes[1]) + 1e-6) & (
        F.least(*sizes) >= similarity * F.greatest(*sizes) - 1e-6
    )
    once = (F.col("x.i") < F.col("x.j")) | (F.col("x.h") < F.col("y.h"))
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("key", "i", "j")]
    found = low.join(high, [*same, F.col("x.g") != F.col("y.g"), once, possible])
    shared = F.ceil(similarity / (1 + similarity) * (sizes[0] + sizes[1]) - 1e-6) - F.greatest("x.others", "y.others")
    found = found.select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b"), shared.alias("least"))
    met = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("least").alias("least"))
    return met.where("n >= least").select("a", "b")


def alike(pairs: DataFrame, texts: DataFrame, similarity: float, width: int = SIMILAR_WIDTH) -> DataFrame:
    """The pairs (a, b) of texts (h, text) whose shingle sets have at least the similarity; wordless texts are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = None, set()
        for batch in batches:
            b, kept = batch.column(1).to_pylist(), []
            for k in range(len(b)):
                if b[k] != last:
                    last, right = b[k], shingle_set(batch.column(3)[k].as_py(), width)
                left = shingle_set(batch.column(2)[k].as_py(), width)
                common = len(left & right)
                if common >= similarity * (len(left) + len(right) - common):
                    kept.append(k)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(kept, pa.int64())) for c in batch.columns[:2]], ["a", "b"])
        give_back()

    both = (
        pairs.join(texts.select(F.col("h").alias("a"), F.col("text").alias("left")), "a")
        .join(texts.select(F.col("h").alias("b"), F.col("text").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    return both.mapInArrow(run, "a long, b long")


def grouped_by_similarity(docs: DataFrame, similarity: float = SIMILARITY, width: int = SIMILAR_WIDTH) -> DataFrame:
    """doc_id, h and component_id of every row: texts link whose word shingles have at least the similarity (Jaccard).

    Most links come from `similar_pairs`, the rest of those between two groups from `missed_pairs`, and each pair is compared
    exactly; so groups are those of all pairs, and no unlike texts link by accident. Component ids are smallest
    doc_ids; a component without any has null.
    """
    rows = keyed(docs)
    common = common_shingles(rows, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases = [shingle_hashes(x.as_py(), width) for x in batch.column(1)]
            keys = [prefix(x, common, similarity).view(np.int64) for x in bases]
            columns = [[_wide(x) for x in bases], keys, [parity_sketch(x) for x in bases]]
            lists = [pa.array(c, pa.list_(pa.int64())) for c in columns]
            sizes = pa.array([len(x) for x in bases], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, *lists], ["h", "size", "fps", "keys", "sketch"])
        give_back()

    def likely(pairs: DataFrame) -> DataFrame:
        needed = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
        found = marked_by(rows.select("h", "text"), "h", needed).where("marked").select("h", "text")
        return staged(found.dropDuplicates(["h"]).join(needed, "h", "left_semi"))

    marked = rows.select("h", "text").mapInArrow(run, "h long, size long, fps array<long>, keys array<long>, sketch array<long>")
    firsts = [F.first(c).alias(c) for c in ("size", "fps", "keys", "sketch")]
    texts = staged(marked.groupBy("h").agg(*firsts))
    pairs = staged(similar_pairs(texts, width))
    joined = staged(components(staged(alike(pairs, likely(pairs), similarity, width))))
    rest = staged(missed_pairs(texts, joined, similarity).join(pairs, ["a", "b"], "left_anti"))
    more = staged(alike(rest, likely(rest), similarity, width))
    if not more.isEmpty():
        stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
        joined = components(stars.unionAll(more))
    told = staged(rows.select("doc_id", "h").join(joined.withColumnRenamed("node", "h"), "h", "left"))
    group = F.coalesce("component", "h")
    least = staged(told.groupBy(group.alias("component")).agg(F.min("doc_id").alias("component_id")))
    return told.select("doc_id", "h", group.alias("component")).join(least, "component").select("doc_id", "h", "component_id")


def keep_first_similar(
    docs: DataFrame, similarity: float = SIMILARITY, width: int = SIMILAR_WIDTH, carry: Sequence[str] = ()
) -> DataFrame:
    """As `keep_first`, for groups of texts alike by their word shingles."""
    return _firsts(docs, staged(grouped_by_similarity(docs, similarity, width)), carry)
