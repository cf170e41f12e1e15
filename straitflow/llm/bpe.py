"""Byte-level BPE: encoding by a priority queue over a linked symbol list, decoding by concatenation.

The vocabulary file (JSON of the public tokenizers format) is read on the driver through its path, which is
a parameter, and sent to the tasks as a broadcast; a vocabulary is a fixed size, whatever the corpus.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

#: Fixed value: how byte-level vocabularies split text ahead of the merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The longest word that a task keeps in its tables.
CACHE_CHARS = 48

ENCODED = "doc_id long, n_tokens long, ids binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in table)
    return table | {b: chr(256 + k) for k, b in enumerate(hidden)}


class ByteBpe:
    """A vocabulary with its merges."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        byte_of = {c: b for b, c in byte_alphabet().items()}
        vocab: dict[str, int] = model["model"]["vocab"]
        self.special: dict[str, int] = {x["content"]: x["id"] for x in model.get("added_tokens", [])}
        self.symbols = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            if token not in self.special:
                self.symbols[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.symbols[i] = token.encode()
        self.byte_id = [0] * 256
        for b, c in byte_alphabet().items():
            self.byte_id[b] = vocab[c]
        #: (left << 20 | right) -> rank, and the symbol that each rank makes
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[left] << 20 | vocab[right], rank)
            self.made.append(vocab[left + right])
        special = sorted(self.special, key=len, reverse=True)
        self.special_split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece. The queue holds rank << 32 | position; an entry whose symbols have changed is stale."""
        byte_id = self.byte_id
        ids = [byte_id[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        rank = self.rank.get
        queue = []
        for i in range(n - 1):
            r = rank(ids[i] << 20 | ids[i + 1])
            if r is not None:
                queue.append(r << 32 | i)
        if not queue:
            return ids
        heapq.heapify(queue)
        before, after, push, pop = list(range(-1, n - 1)), list(range(1, n + 1)), heapq.heappush, heapq.heappop
        while queue:
            entry = pop(queue)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n or rank(ids[i] << 20 | ids[j]) != entry >> 32:
                continue
            merged = ids[i] = self.made[entry >> 32]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(merged << 20 | ids[k])
                if r is not None:
                    push(queue, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = rank(ids[h] << 20 | merged)
                if r is not None:
                    push(queue, r << 32 | h)
        return [x for x in ids if x >= 0]

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary strings of the ids, one after another; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.symbols.__getitem__, ids.tolist())).decode("utf-8", "replace")


class CachedEncoder:
    """Whole texts to bytes, piece by piece: by default the ids as little-endian unsigned 32-bit integers.

    A text is cut ahead of every white space that follows something else. No piece of SPLIT crosses such a
    place, so words can be looked up in tables, which are emptied when full.
    """

    #: Entries that a table may have.
    entries = 1_000_000

    def __init__(self, bpe: ByteBpe, piece_bytes: Callable[[str], bytes] | None = None):
        self.bpe = bpe
        self.piece_bytes = piece_bytes or self.ids_of
        #: By word without the space ahead of it, and by the very string.
        self.spaced: dict[str, bytes] = {}
        self.exact: dict[str, bytes] = {}

    def ids_of(self, piece: str) -> bytes:
        return array("I", self.bpe.encode_piece(piece.encode())).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.bpe.special_split:
            return b"".join(self.words(text))
        parts = self.bpe.special_split.split(text)
        if len(parts) == 1:
            return b"".join(self.words(text))
        return b"".join(
            self.bpe.special[x].to_bytes(4, "little") if k % 2 else b"".join(self.words(x))
            for k, x in enumerate(parts)
        )

    def words(self, text: str) -> list[bytes]:
        """What each word of the text comes to; the text holds no special token."""
        if not text:
            return []
        if not evenly_spaced(text):
            return [self._exact(x) for x in before_space(text)]
        out: list[bytes] = []
        spaced = self.spaced
        for line in text.split("\n"):
            first, *words = line.split(" ")
            out.append(self._exact("\n" + first if out else first))
            try:
                out += [spaced[w] for w in words]
            except KeyError:
                out += [spaced.get(w) or self._spaced(w) for w in words]
        return out

    def _spaced(self, word: str) -> bytes:
        found = self._new(" " + word)
        if len(word) <= CACHE_CHARS:
            if len(self.spaced) >= self.entries:
                self.spaced.clear()
            self.spaced[word] = found
        return found

    def _exact(self, word: str) -> bytes:
        found = self.exact.get(word)
        if found is None:
            found = self._new(word)
            if len(word) <= CACHE_CHARS:
                if len(self.exact) >= self.entries // 4:
                    self.exact.clear()
                self.exact[word] = found
        return found

    def _new(self, word: str) -> bytes:
        if word[0] == " " and word[1:].isalpha():
            return self.piece_bytes(word)
        pieces = split_pieces(word)
        if len(pieces) == 1:
            return self.piece_bytes(word)
        return b"".join(map(self._kept, pieces))

    def _kept(self, piece: str) -> bytes:
        if piece[0] == " " and len(piece) > 1:
            return self.spaced.get(piece[1:]) or self._spaced(piece[1:])
        return self._exact(piece)


split_pieces = regex.compile(SPLIT).findall
before_space = regex.compile(r"\s*\S+|\s+").findall
is_blank = regex.compile(r"\s+").fullmatch


_other_space = re.compile(r"[^\S \n]").search


def evenly_spaced(text: str) -> bool:
    """Whether all white space is single spaces and line feeds between other characters."""
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
        return False
    return not (text[0].isspace() or text[-1].isspace() or _other_space(text))


_loaded: dict[int, tuple[str, ByteBpe]] = {}


def load(spec: str) -> ByteBpe:
    """One vocabulary object per Python worker."""
    key = hash(spec)
    if key not in _loaded or _loaded[key][0] != spec:
        _loaded.clear()
        _loaded[key] = (spec, ByteBpe(spec))
    return _loaded[key][1]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the ids of every whole text, as little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Rows stay as they are, repeated ones too; a null doc_id stays null.
    """
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CachedEncoder(load(spec.value))
        for batch in batches:
            ids = [encoder.encode(x.as_py()) for x in batch.column(1)]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"]
            )

    return _narrow(docs).mapInArrow(run, ENCODED)


def decode_documents(spark: SparkSession, encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and text of what `encode_documents` returned. Null ids give an empty text."""
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(spec.value)
        for batch in batches:
            texts = [bpe.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(encoded["doc_id"].cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encoding and decoding of every text in one pass: counts and digests of the ids and of the decoded text."""
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(spec.value)
        encoder = CachedEncoder(bpe)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for x in batch.column(1):
                ids = encoder.encode(x.as_py())
                counts.append(len(ids) // 4)
                coded.append(sha256(ids).hexdigest())
                decoded.append(sha256(bpe.decode(np.frombuffer(ids, "<u4")).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _narrow(docs).mapInArrow(run, DIGESTS)


def _narrow(docs: DataFrame) -> DataFrame:
    """Only what the operator reads, so that other columns, whatever their names, stay out."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
