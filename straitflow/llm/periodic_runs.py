"""Periodic runs of words in texts, by internal pattern matching.

A run repeats a stretch of words at least four times over (and is of six words or more). The words of a text are sorted into a suffix array by
doubling, so at every power of two the suffixes that begin with an aligned (dyadic) block are an interval
of it. A run with a period of at most the block's length, and more than half of it, holds such a block, and holds it
again one period before or behind: the occurrences of a block inside one neighbouring window are an arithmetic
progression whose difference is the period. The nearest occurrences on either side are range predecessor and
successor queries on the suffix array, answered by a wavelet tree for all blocks of all lengths at once. Their
distances are the candidate periods, which are then extended to both sides.

Texts are independent of each other. A task joins short ones to batches, since the arrays are handled whole;
words of different texts are different numbers, so nothing crosses from one to the next.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Words of a batch of texts. A longer text is a batch of its own, and takes about 250 bytes a word.
BATCH_WORDS = 1 << 15

#: A run has at least this many words, and this many times its period.
LEAST_WORDS = 6
LEAST_TIMES = 4

#: Start, length and period of a run, in words.
Run = tuple[int, int, int]

RUNS = "doc_id long, start long, length long, period long, phrase string"
DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # of bytes, split() knows ASCII white space only: \x20 and \x09-\x0D


class WaveletTree:
    """Order statistics of any range of a sequence of numbers from 0 to len - 1, a level a bit from the highest down."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, (len(values) - 1).bit_length())
        self.zeros = []
        for shift in range(self.bits - 1, -1, -1):
            one = (values >> shift & 1).astype(bool)
            ahead = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=ahead[1:])
            self.zeros.append(ahead)
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers of each range are smaller than a value."""
        count = np.zeros(len(lo), np.int64)
        for level, ahead in enumerate(self.zeros):
            a, b = ahead[lo], ahead[hi]
            one = (value >> (self.bits - 1 - level) & 1).astype(bool)
            count += np.where(one, b - a, 0)
            lo = np.where(one, ahead[-1] + lo - a, a)
            hi = np.where(one, ahead[-1] + hi - b, b)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number with k smaller ones in each range."""
        value = np.zeros(len(lo), np.int64)
        for ahead in self.zeros:
            a, b = ahead[lo], ahead[hi]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value = value << 1 | one
            lo = np.where(one, ahead[-1] + lo - a, a)
            hi = np.where(one, ahead[-1] + hi - b, b)
        return value


def dyadic_blocks(ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array, and for each power of two the aligned blocks that occur again, with their intervals of it.

    `ids` are at least 1. Blocks come as (length, positions, from, to).
    """
    n = len(ids)
    bits = int(ids.max(initial=1)).bit_length()
    packed = 1
    while packed * 2 * bits <= 63:
        packed *= 2
    padded = np.concatenate([ids, np.zeros(packed, np.int64)])
    key = padded[:n].copy()
    for k in range(1, packed):
        key = key << bits | padded[k : n + k]
    order = np.argsort(key)
    key = key[order]
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    blocks = []

    def level(length: int, first: np.ndarray) -> np.ndarray:
        """Notes the blocks of a length, where `first` tells which slots begin a group; returns who shares one."""
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, len(first)))
        shared = np.repeat(size > 1, size)
        at, lo, count = order[slots], np.repeat(slots[start], size), np.repeat(size, size)
        rank[at] = lo
        aligned = shared & (at % length == 0)
        blocks.append((length, at[aligned], lo[aligned], (lo + count)[aligned]))
        return shared

    length = 1
    while length <= packed:
        head = key >> bits * (packed - length)
        first = np.ones(n, bool)
        first[1:] = head[1:] != head[:-1]
        shared = level(length, first)
        length *= 2
    while shared.any():
        slots = slots[shared]
        within = order[slots]
        ahead = within + length // 2
        key = rank[within] << 32 | np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        again = np.argsort(key)
        key = key[again]
        order[slots] = within[again]
        first = np.ones(len(slots), bool)
        first[1:] = key[1:] != key[:-1]
        shared = level(length, first)
        length *= 2
    return order, blocks


def candidates(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions i and distances p, ordered by p, then i: ids[i:] and ids[i + p:] agree for p words at least."""
    order, blocks = dyadic_blocks(ids)
    length = np.concatenate([np.full(len(b[1]), b[0]) for b in blocks])
    at, lo, hi = (np.concatenate([b[k] for b in blocks]) for k in (1, 2, 3))
    tree = WaveletTree(order)
    place = tree.below(lo, hi, at)
    has_before, has_behind = place > 0, place + 1 < hi - lo
    near = tree.smallest(
        np.concatenate([lo[has_before], lo[has_behind]]),
        np.concatenate([hi[has_before], hi[has_behind]]),
        np.concatenate([place[has_before] - 1, place[has_behind] + 1]),
    )
    begin = np.concatenate([near[: has_before.sum()], at[has_behind]])
    period = np.concatenate([at[has_before] - near[: has_before.sum()], near[has_before.sum() :] - at[has_behind]])
    size = np.concatenate([length[has_before], length[has_behind]])
    # A run goes on for three periods from some begin, and a block is shorter than two: one side must go on.
    wanted = (period <= size) & (2 * period > size)
    begin, period, size = begin[wanted], period[wanted], size[wanted]
    n = len(ids)
    after, before = begin + size, begin - 1
    goes_on = (after + period < n) & (ids[np.minimum(after, n - 1)] == ids[np.minimum(after + period, n - 1)])
    goes_on |= (before >= 0) & (ids[before] == ids[before + period])
    begin, period = begin[goes_on], period[goes_on]
    by = np.lexsort((begin, period))
    return begin[by], period[by]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values two arrays have in common; looks no further than about twice as far."""
    most, done, step = min(len(a), len(b)), 0, 32
    while done < most:
        stop = min(most, done + step)
        differ = a[done:stop] != b[done:stop]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done, step = stop, step * 2
    return most


def find_runs(ids: np.ndarray) -> list[Run]:
    """All runs, by start, then period."""
    out = []
    past, of = 0, 0
    for at, p in zip(*(x.tolist() for x in candidates(ids)), strict=True):
        if p == of and at < past:
            continue  # inside the stretch found last
        stop = at + p + _agree(ids[at:], ids[at + p :])
        start = at - _agree(ids[:at][::-1], ids[: at + p][::-1])
        past, of = stop - p, p
        if stop - start >= max(LEAST_WORDS, LEAST_TIMES * p):
            out.append((start, stop - start, p))
    return sorted(out)


def runs_of(texts: Sequence[Sequence[bytes]]) -> list[list[Run]]:
    """The runs of each of some texts, which are lists of words."""
    parts, starts, at, numbers = [], [], 0, 1
    for words in texts:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)) + numbers)
        numbers += len(number)
        starts.append(at)
        at += len(words)
    out: list[list[Run]] = [[] for _ in texts]
    if at:
        bounds = np.array(starts)
        for start, length, period in find_runs(np.concatenate(parts)):
            t = int(np.searchsorted(bounds, start, side="right")) - 1
            out[t].append((start - starts[t], length, period))
    return out


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that a run repeats: of each run, its first period stays."""
    if not runs:
        return list(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d]


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run of the greatest length by period; of equal ones, the first, then the one of the smaller period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """A text of the contract of the registered query: a tenth of all texts end in a run made of their own words."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


# --- Spark ------------------------------------------------------------------


def _batches(
    rows: Iterator[pa.RecordBatch], words: Callable[[str | None, int | None], list[bytes]]
) -> Iterator[list[tuple[int | None, list[bytes], list[Run]]]]:
    """doc_id, words and runs of all rows, some texts at a time."""
    ids, texts, size = [], [], 0
    for batch in rows:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            found = words(text.as_py(), doc_id.as_py())
            if texts and size + len(found) > BATCH_WORDS:
                yield list(zip(ids, texts, runs_of(texts), strict=True))
                ids, texts, size = [], [], 0
            ids.append(doc_id.as_py())
            texts.append(found)
            size += len(found)
    if texts:
        yield list(zip(ids, texts, runs_of(texts), strict=True))


def _ids_and_texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[f[1]]) for c, f in zip(columns, fields, strict=True)], [f[0] for f in fields]
    )


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, period and phrase (the first period) of every run of every text; words count from 0.

    Null, empty and wordless texts have none. Repeated rows are reported repeatedly, null ids as null.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _batches(rows, lambda text, _: words_of(text)):
            yield _table(
                [
                    (doc_id, *r, b" ".join(words[r[0] : r[0] + r[2]]).decode())
                    for doc_id, words, found in group
                    for r in found
                ],
                RUNS,
            )

    return _ids_and_texts(docs).mapInArrow(run, RUNS)


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id, text and n_dropped of every row: texts with runs lose repetitions, and have their words joined by spaces.

    Texts without a run stay as they are, white space and nulls included.
    """
    schema = "doc_id long, text string, n_dropped long"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batch.column(1).to_pylist()
            groups = _batches(iter([batch]), lambda text, _: words_of(text))
            out = []
            for text, (doc_id, words, found) in zip(texts, (x for g in groups for x in g), strict=True):
                left = collapsed(words, found)
                out.append((doc_id, b" ".join(left).decode() if found else text, len(words) - len(left)))
            yield _table(out, schema)

    return _ids_and_texts(docs).mapInArrow(run, schema)


def report(docs: DataFrame, words: Callable[[str | None, int | None], list[bytes]]) -> DataFrame:
    """doc_id, n_runs, the strongest run and digests of all runs and of the collapsed text, for every row.

    `words` makes words of a text and its doc_id. Without a run, start, length, period and exponent_milli are
    null. Null, empty and wordless texts have no words. Rows stay as they are, repeated ones and null ids too.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _batches(rows, words):
            out = []
            for doc_id, text, found in group:
                best = strongest(found)
                told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
                kept = b" ".join(collapsed(text, found))
                out.append((doc_id, len(found), *told, sha256(listed.encode()).hexdigest(), sha256(kept).hexdigest()))
            yield _table(out, DIGESTS)

    return _ids_and_texts(docs).mapInArrow(run, DIGESTS)


def planted_report(docs: DataFrame) -> DataFrame:
    """`report` of texts with the runs that the registered query's contract plants in them; a null doc_id plants none."""
    return report(docs, lambda text, doc_id: planted(words_of(text), doc_id))
