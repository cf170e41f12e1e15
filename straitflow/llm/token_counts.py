"""Exact token counts of every prefix of a text, by dynamic programming, for byte-level BPE.

Within a piece, the last token of a prefix is the only vocabulary string that ends there and may follow the
last token of the prefix ahead of it, two tokens being compatible when encoding their joined bytes gives the
two again. So one pass over the prefixes gives the count of each, and questions about truncation and budgets
are lookups: nothing is encoded again. Pieces do not interact, so the counts of a text are running sums.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from straitflow.llm.bpe import ByteBpe, CachedEncoder, is_blank, load, read_spec, split_pieces

#: Entries of the tables of compatible tokens that a task keeps.
PAIR_ENTRIES = 1_000_000

#: First bytes of a piece whose state is kept.
SHARED_BYTES = 6

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"


class PrefixCounter(CachedEncoder):
    """Token counts of prefixes. What is kept of a word: the counts of its prefixes, by character; the last is its own."""

    entries = 800_000

    def __init__(self, bpe: ByteBpe):
        super().__init__(bpe, self._piece)
        self.id_of = {s: i for i, s in enumerate(bpe.symbols) if s and i not in bpe.special.values()}
        self.longest = max(map(len, self.id_of))
        #: Whether the second token may follow the first, by first << 20 | second, -1 standing for no first one.
        self.pairs: dict[int, bool] = {}
        #: The state after the first bytes of a piece, for pieces that begin alike.
        self.heads: dict[bytes, tuple[list[int], list[int]]] = {}

    def _may_follow(self, left: int, right: int) -> bool:
        symbols = self.bpe.symbols
        if left < 0:
            ok = self.bpe.encode_piece(symbols[right]) == [right]
        else:
            ok = self.bpe.encode_piece(symbols[left] + symbols[right]) == [left, right]
        if len(self.pairs) >= PAIR_ENTRIES:
            self.pairs.clear()
        self.pairs[left << 20 | right] = ok
        return ok

    def byte_counts(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of one piece, by bytes; the first entry is the empty prefix."""
        if len(piece) <= SHARED_BYTES:
            return self._extend(piece, [-1], [0])[1]
        head = piece[:SHARED_BYTES]
        state = self.heads.get(head)
        if state is None:
            if len(self.heads) >= self.entries // 4:
                self.heads.clear()
            state = self.heads[head] = self._extend(head, [-1], [0])
        return self._extend(piece, state[0][:], state[1][:])[1]

    def _extend(self, piece: bytes, last: list[int], count: list[int]) -> tuple[list[int], list[int]]:
        """Carries the last tokens and the counts of the prefixes known so far on to the end of the piece."""
        longest, token_at, pair = self.longest, self.id_of.get, self.pairs.get
        for end in range(len(last), len(piece) + 1):
            for start in range(end - 1, end - longest - 1 if end > longest else -1, -1):
                token = token_at(piece[start:end])
                if token is None:
                    continue
                ok = pair(last[start] << 20 | token)
                if ok is None:
                    ok = self._may_follow(last[start], token)
                if ok:
                    last.append(token)
                    count.append(count[start] + 1)
                    break
        return last, count

    def _piece(self, piece: str) -> bytes | array:
        coded = piece.encode()
        counts = self.byte_counts(coded)
        if len(coded) == len(piece):
            return packed(counts[1:])
        at, by_char = 0, []
        for c in piece:
            at += len(c.encode())
            by_char.append(counts[at])
        return packed(by_char)

    def _new(self, word: str) -> bytes | array:
        if word[0] == " " and word[1:].isalpha():
            return self._piece(word)
        pieces = split_pieces(word)
        if len(pieces) == 1:
            return self._piece(word)
        total, by_char, blank = 0, [], ""
        for piece in pieces:
            counts = self._kept(piece)
            start = len(by_char)
            by_char.extend([total + x for x in counts])
            if blank and is_blank(piece[0]):  # cut behind this character, it joins the white space ahead of it
                by_char[start] = total - self._exact(blank)[-1] + self._exact(blank + piece[0])[-1]
            if len(piece) == 3 and piece[0] == "'" and piece[1:].isalpha():  # cut short, "'re" is a mark and a letter
                by_char[start + 1] = total + 2
            total += counts[-1]
            blank = piece if is_blank(piece) else ""
        return packed(by_char)

    def count(self, text: str | None) -> int:
        """Tokens of the whole text."""
        return sum([counts[-1] for counts in self._parts(text)])

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Tokens of the first 0, 1, ... characters; one entry more than the text has characters."""
        out, total = [np.zeros(1, np.int64)], 0
        for counts in self._parts(text):
            out.append(total + np.array(list(counts), np.int64))
            total += counts[-1]
        return np.concatenate(out)

    def longest_within(self, text: str | None, budget: int) -> int:
        """Characters of the longest prefix that takes no more tokens than the budget."""
        total = at = best = 0
        for counts in self._parts(text):
            if total + counts[-1] <= budget:
                best = at + len(counts)
            elif total < budget:
                best = max([best, *(at + k for k, x in enumerate(counts, 1) if total + x <= budget)])
            else:
                break
            total += counts[-1]
            at += len(counts)
        return best

    def _parts(self, text: str | None) -> list[bytes | array]:
        if not text:
            return []
        cut = self.bpe.special_split
        parts = cut.split(text) if cut else [text]
        if len(parts) == 1:
            return self.words(text)
        out: list[bytes | array] = []
        for before, special in zip(parts[::2], parts[1::2], strict=False):
            # Ahead of its last character, a special string is ordinary text behind what precedes it.
            total = sum(x[-1] for x in self.words(before))
            partial, n = [], 0
            for counts in self.words(before + special[:-1]):
                partial.extend([n + x for x in counts])
                n += counts[-1]
            out.append(packed([*partial, total + 1]))
        return out + self.words(parts[-1])


def packed(counts: list[int]) -> bytes | array:
    return bytes(counts) if max(counts) < 256 else array("I", counts)


def count_documents(spark: SparkSession, docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """Per document: UTF-8 bytes, tokens, whether they exceed the limit, and the characters that fit into it.

    A null or empty text has none. Rows stay as they are, repeated ones and a null doc_id too.
    """
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(load(spec.value))
        for batch in batches:
            sizes, totals, fits = [], [], []
            for x in batch.column(1):
                text = x.as_py() or ""
                sizes.append(len(text.encode()))
                totals.append(counter.count(text))
                fits.append(len(text) if totals[-1] <= limit else counter.longest_within(text, limit))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([x > limit for x in totals], pa.bool_()),
                    pa.array(fits, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, COUNTS)


def prefix_table(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and prefix_tokens: an array whose entry k is the token count of the first k characters."""
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(load(spec.value))
        for batch in batches:
            rows = pa.array([counter.prefix_counts(x.as_py()) for x in batch.column(1)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), rows], ["doc_id", "prefix_tokens"])

    narrow = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return narrow.mapInArrow(run, "doc_id long, prefix_tokens array<long>")


def truncate_documents(table: DataFrame, docs: DataFrame, budget: int) -> DataFrame:
    """doc_id and text, each text cut to the longest prefix within the budget, from a table of `prefix_table`."""
    from pyspark.sql import functions as F

    cut = table.select(
        "doc_id",
        F.aggregate(
            F.col("prefix_tokens"),
            F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("best")),
            lambda s, x: F.struct(
                (s["at"] + 1).alias("at"), F.when(x <= budget, s["at"]).otherwise(s["best"]).alias("best")
            ),
        )["best"].alias("fit"),
    )
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return texts.join(cut, "doc_id").select("doc_id", F.expr("substring(text, 1, CAST(fit AS INT))").alias("text"))
