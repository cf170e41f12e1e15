"""Benchmark decontamination with suffix arrays of the training texts.

Training texts are read in shards of bounded size; each task sorts the suffixes of its shard, word by word, into
a suffix array. Every suffix of every benchmark item is then searched in the array by bisection: the
interval of training suffixes that begin like it narrows with each further word, until it is empty. So the
longest verbatim match of a test suffix is known with all its places. A window of ten words is hit where
a match has come that far. Shards are independent of each other, and texts are never shuffled.

Items are pieced, spread over blocks of bounded size, and searched block by block, so what a task holds of them
is bounded, however many there are; a document's hits are the union over the blocks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from straitflow.llm.shared import attached, keyed, staged

#: Fixed value: what bytes of a text become. Letters and digits stay, A-Z lower-cased, as do bytes of other
#: characters; everything else ends a word.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

#: Words in a window.
WIDTH = 10

#: Bytes of text in a shard; a longer text is a shard of its own.
SHARD_BYTES = 6 << 20

#: Bytes of items in a block, on average: what is broadcast at a time.
BLOCK_BYTES = 8 << 20

#: Words in a piece of an item; the pieces of a longer one overlap, so that no window is lost.
PIECE_WORDS = 1 << 14

FOUND = "doc_id long, h long, n_words long, ranges array<struct<start: long, stop: long>>, items array<string>"
LONGEST = "item_id string, length long, item_start long, doc_id long, doc_start long"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


# --- suffix arrays ----------------------------------------------------------


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of `ids`, sorted by the `depth` values that begin there.

    The first sort takes as many values as fit into 64 bits; then lengths double, and only suffixes that
    are not told apart yet are sorted again.
    """
    n = len(ids)
    bits = max(1, int(ids.max(initial=0)).bit_length())
    known = max(1, 63 // bits)
    padded = np.concatenate([ids.astype(np.int64), np.zeros(known, np.int64)])
    key = padded[:n].copy()
    for k in range(1, known):
        key = key << bits | padded[k : n + k]
    order = np.argsort(key)
    key = key[order]
    first = np.ones(n, bool)
    first[1:] = key[1:] != key[:-1]
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(first, slots, 0))
    while known < depth:
        alone = first & np.append(first[1:], True)
        slots, within = slots[~alone], order[slots[~alone]]
        if not len(slots):
            break
        key = rank[within] << 32 | rank[np.minimum(within + known, n - 1)]
        again = np.argsort(key)
        key, within = key[again], within[again]
        order[slots] = within
        first = np.ones(len(slots), bool)
        first[1:] = key[1:] != key[:-1]
        rank[within] = np.maximum.accumulate(np.where(first, slots, 0))
        known *= 2
    return order


class Shard:
    """Texts as numbered words one behind another, each closed by a mark of its own, and their suffix array."""

    def __init__(self, texts: Sequence[bytes | None], depth: int):
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        parts, sizes = [], []
        for text in texts:
            words = words_of(text)
            parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            sizes.append(len(words))
        self.number = number
        self.n_words = np.array(sizes, np.int64)
        self.marks = len(texts)
        ends = np.cumsum(self.n_words + 1)
        self.starts = ends - self.n_words - 1
        self.ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for i, (part, at) in enumerate(zip(parts, self.starts.tolist(), strict=True)):
            self.ids[at : at + len(part)] = part + self.marks
            self.ids[at + len(part)] = i
        self.order = suffix_array(self.ids, depth)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(self.ids, minlength=self.marks + len(number)))])

    def numbered(self, words: Sequence[bytes]) -> np.ndarray:
        """The numbers of other words here, -1 for unknown ones."""
        return np.array([self.number[w] + self.marks if w in self.number else -1 for w in words], np.int64)

    def narrowed(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of each interval whose suffixes have this word `depth` words in."""
        if depth == 0:
            return self.below[word], self.below[word + 1]
        return self._bisect(lo, hi, depth, word), self._bisect(lo, hi, depth, word + 1)

    def _bisect(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while True:
            todo = np.flatnonzero(lo < hi)
            if not len(todo):
                return lo
            mid = (lo[todo] + hi[todo]) >> 1
            less = self.ids[self.order[mid] + depth] < word[todo]
            lo[todo] = np.where(less, mid + 1, lo[todo])
            hi[todo] = np.where(less, hi[todo], mid)


@dataclass
class Items:
    """A block of items: their different words, and their texts one behind another as numbers, closed by -1."""

    ids: list[str | None]
    words: list[bytes]
    flat: np.ndarray
    item: np.ndarray
    left: np.ndarray
    at_start: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, rows: Sequence[tuple[str | None, bytes, int]]) -> Items:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        flat, item, left, whole, offset = [], [], [], [], []
        for i, (_, text, start) in enumerate(rows):
            words = text.split()
            flat += [*map(number.__getitem__, words), -1]
            item += [i] * (len(words) + 1)
            left += range(len(words), -1, -1)
            whole += [start == 0] + [False] * len(words)
            offset += range(start, start + len(words) + 1)
        return cls(
            [r[0] for r in rows], list(number), np.array(flat, np.int64), np.array(item, np.int64),
            np.array(left, np.int64), np.array(whole, bool), np.array(offset, np.int64),
        )


def search(shard: Shard, items: Items, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per depth: it, the test suffixes whose first so many words occur, their intervals, and which of them are a window."""
    test = np.append(shard.numbered(items.words), -1)[items.flat]
    live = np.flatnonzero(test >= 0)
    lo = hi = np.zeros(len(live), np.int64)
    depth = 0
    while len(live):
        lo, hi = shard.narrowed(lo, hi, depth, test[live + depth])
        found = lo < hi
        live, lo, hi = live[found], lo[found], hi[found]
        depth += 1
        short = items.at_start[live] & (items.left[live] == depth) if depth < width else depth == width
        yield depth, live, lo, hi, np.broadcast_to(short, live.shape)
        on = test[live + depth] >= 0
        live, lo, hi = live[on], lo[on], hi[on]


# --- what a shard says ------------------------------------------------------


def shard_hits(shard: Shard, items: Items, width: int) -> tuple[dict[int, list[tuple[int, int]]], dict[int, list[str]]]:
    """By text: the stretches of words that windows cover, and the ids of the items that these are from."""
    windows: dict[tuple[int, int, int], set[int]] = {}
    for depth, live, lo, hi, closed in search(shard, items, width):
        for a, b, i in zip(lo[closed].tolist(), hi[closed].tolist(), items.item[live[closed]].tolist(), strict=True):
            windows.setdefault((a, b, depth), set()).add(i)
        if depth >= width:
            break
    if not windows:
        return {}, {}
    n = len(shard.ids)
    edge = np.zeros(n + 1, np.int64)
    texts, of_window = [], []
    for k, (a, b, depth) in enumerate(windows):  # equal windows share an interval
        places = shard.order[a:b]
        edge += np.bincount(places, minlength=n + 1) - np.bincount(places + depth, minlength=n + 1) if b - a > n // 8 else 0
        if b - a <= n // 8:
            np.add.at(edge, places, 1)
            np.subtract.at(edge, places + depth, 1)
        touched = np.unique(np.searchsorted(shard.starts, places, side="right") - 1)
        texts.append(touched)
        of_window.append(np.full(len(touched), k))
    covered = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    step = np.flatnonzero(covered[1:] != covered[:-1])
    ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)
    owner = np.searchsorted(shard.starts, step[::2], side="right") - 1
    for t, a, b in zip(owner.tolist(), step[::2].tolist(), step[1::2].tolist(), strict=True):
        start = int(shard.starts[t])
        ranges[t].append((a - start, b - start))
    pairs = np.stack([np.concatenate(texts), np.concatenate(of_window)])
    pairs = pairs[:, np.lexsort(pairs[::-1])]
    cuts = np.flatnonzero(pairs[0, 1:] != pairs[0, :-1]) + 1
    members = list(windows.values())
    listed: dict[bytes, list[str]] = {}  # many texts hold the same passage
    names: dict[int, list[str]] = {}
    for t, group in zip(pairs[0, np.concatenate([[0], cuts])].tolist(), np.split(pairs[1], cuts), strict=True):
        key = group.tobytes()
        if key not in listed:
            ids = {items.ids[i] for k in group.tolist() for i in members[k]}
            listed[key] = sorted(x for x in ids if x is not None)
        names[t] = listed[key]
    return ranges, names


def shard_longest(shard: Shard, items: Items, width: int) -> dict[int, tuple[int, int, int, int]]:
    """By item: words of its longest verbatim match, where that begins in the item, and in which text and where there."""
    best: dict[int, tuple[int, int, int, int]] = {}
    for depth, live, lo, _, _ in search(shard, items, width):
        item, at = np.unique(items.item[live], return_index=True)
        place = shard.order[lo[at]]
        text = np.searchsorted(shard.starts, place, side="right") - 1
        rows = zip(item.tolist(), items.offset[live[at]].tolist(), text.tolist(), (place - shard.starts[text]).tolist(), strict=True)
        best.update({i: (depth, offset, t, p) for i, offset, t, p in rows})
    return best


def _shards(batches: Iterator[pa.RecordBatch], depth: int, limit: int) -> Iterator[tuple[list, list, Shard]]:
    """doc_ids, hashes and suffix array of shards of about `limit` bytes."""
    ids, hashes, texts, size = [], [], [], 0
    for batch in batches:
        for i, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if texts and size + len(text or b"") > limit:
                yield ids, hashes, Shard(texts, depth)
                ids, hashes, texts, size = [], [], [], 0
            ids.append(i)
            hashes.append(h)
            texts.append(text)
            size += len(text or b"")
    if texts:
        yield ids, hashes, Shard(texts, depth)


# --- Spark ------------------------------------------------------------------


def pieces(items: DataFrame, width: int = WIDTH, words: int = PIECE_WORDS) -> DataFrame:
    """item_id as text, piece (its folded words, joined by spaces) and start, the words of the item ahead of it; no repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = words_of(text)
                for at in range(0, max(1, len(found) - width + 1) if found else 0, words):
                    out.append((i, b" ".join(found[at : at + words + width - 1]), at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else ((), (), ()), (pa.string(), pa.binary(), pa.int64()), strict=True)],
                ["item_id", "piece", "start"],
            )

    rows = items.select(items["item_id"].cast("string").alias("item_id"), items["text"].cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "item_id string, piece binary, start long").distinct()


def _blocks(items: DataFrame, width: int, block_bytes: int) -> tuple[int, list]:
    """Words of the longest piece, and for each block a function that loads it."""
    rows = staged(pieces(items, width))
    size, longest = rows.agg(
        F.coalesce(F.sum(F.length("piece") + 64), F.lit(0)),
        F.coalesce(F.max(F.size(F.split(F.col("piece").cast("string"), " "))), F.lit(1)),
    ).first()
    count = max(1, math.ceil(size / block_bytes))
    cut = F.pmod(F.xxhash64("item_id", "piece", "start"), F.lit(count))

    def load(k: int) -> Items:
        return Items.of([(r[0], bytes(r[1]), r[2]) for r in rows.where(cut == k).collect()])  # bounded by block_bytes

    return longest, [lambda k=k: load(k) for k in range(count)]


def _texts(docs: DataFrame) -> DataFrame:
    return keyed(docs).select("doc_id", "h", F.col("text").cast("binary").alias("text"))


def matches(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, h (hash of the text), n_words, ranges (stretches of hit words) and items (ids, sorted) of every row."""
    spark = docs.sparkSession
    depth, blocks = _blocks(items, width, block_bytes)
    depth = min(depth, width)
    out, more = None, []
    for number, load in enumerate(blocks):
        held = spark.sparkContext.broadcast(load())

        def run(batches: Iterator[pa.RecordBatch], held=held, whole=number == 0) -> Iterator[pa.RecordBatch]:
            block = held.value
            for ids, hashes, shard in _shards(batches, depth, shard_bytes):
                ranges, names = shard_hits(shard, block, width)
                rows = range(len(ids)) if whole else sorted(ranges)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[t] for t in rows], pa.int64()),
                        pa.array([hashes[t] for t in rows], pa.int64()),
                        pa.array(shard.n_words[list(rows)], pa.int64()),
                        pa.array(
                            [[{"start": a, "stop": b} for a, b in ranges.get(t, ())] for t in rows],
                            pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
                        ),
                        pa.array([names.get(t, []) for t in rows], pa.list_(pa.string())),
                    ],
                    ["doc_id", "h", "n_words", "ranges", "items"],
                )

        found = _texts(docs).mapInArrow(run, FOUND)
        if number == 0:
            out = found if len(blocks) == 1 else staged(found)
        else:
            more.append(staged(found.drop("n_words")))
            held.unpersist()
    if not more:
        return out
    rest = more[0]
    for other in more[1:]:
        rest = rest.unionAll(other)
    rest = rest.groupBy("doc_id", "h").agg(
        F.flatten(F.collect_list("ranges")).alias("more_ranges"), F.flatten(F.collect_list("items")).alias("more_items")
    )
    joined = attached(out, staged(rest))
    none = F.array()
    return joined.select(
        "doc_id",
        "h",
        "n_words",
        F.concat("ranges", F.coalesce("more_ranges", none.cast("array<struct<start: bigint, stop: bigint>>"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("more_items", none.cast("array<string>"))))).alias("items"),
    )


def longest_matches(
    docs: DataFrame, items: DataFrame, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """item_id (text), length, item_start, doc_id, doc_start: an item's longest verbatim match, in words, and a place of it.

    Items of which no word occurs are left out. Of an item of more than PIECE_WORDS words, matches are looked for
    piece by piece. Of several longest matches, the one with the smallest doc_id, then place, comes out,
    as far as shards tell them apart: a shard names one of its own.
    """
    spark = docs.sparkSession
    depth, blocks = _blocks(items, WIDTH, block_bytes)
    found = None
    for load in blocks:
        held = spark.sparkContext.broadcast(load())

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = held.value
            for ids, _, shard in _shards(batches, depth, shard_bytes):
                best = shard_longest(shard, block, WIDTH)
                rows = [(block.ids[i], n, offset, ids[t], p) for i, (n, offset, t, p) in best.items()]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["item_id", "length", "item_start", "doc_id", "doc_start"],
                )

        part = staged(_texts(docs).mapInArrow(run, LONGEST))
        held.unpersist()
        found = part if found is None else found.unionAll(part)
    place = F.struct(-F.col("length"), "doc_id", "doc_start", "item_start")
    return found.groupBy("item_id").agg(
        *[F.min_by(c, place).alias(c) for c in ("length", "item_start", "doc_id", "doc_start")]
    )


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH, **sizes: int) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    A document word inside any occurrence of a window of `width` words of an item is hit; an item of fewer words, but
    not none, is one window. Null and wordless texts and items have no words. Rows stay as they are, repeated ones
    and those with a null doc_id too; equal items or windows count for every item_id that has them, and an item with
    a null id hits words but is not listed.
    """
    found = matches(docs, items, width, **sizes)
    start = F.struct(F.lit(0).cast("long").alias("stop"), F.lit(0).cast("long").alias("n"))
    hit = F.aggregate(
        F.array_sort("ranges"),
        start,
        lambda s, x: F.struct(
            F.greatest(s["stop"], x["stop"]).alias("stop"),
            (s["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(s["stop"], x["start"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("ranges") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, carry: Sequence[str] = (), **sizes: int) -> DataFrame:
    """doc_id, text and `carried` of the rows that hold no window of an item."""
    hit = staged(matches(docs, items, width, **sizes).where("size(ranges) > 0").select("doc_id", "h").distinct())
    out = attached(keyed(docs, carry), hit.withColumn("hit", F.lit(True)))
    return out.where("hit IS NULL").select("doc_id", "text", "carried")
