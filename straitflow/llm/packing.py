"""Packing by concatenation and cutting: every text's tokens and an end mark, one text after another, cut into
fixed windows.

Two passes over partitions: the first encodes, and notes where each text starts within its partition and how
many tokens the partition holds; running sums over the partitions' totals give global offsets; the second
cuts at multiples of the window, writing a record for each piece that lies between two boundaries.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from straitflow.llm.bpe import SPLIT, ByteBpe, CachedEncoder, load, read_spec
from straitflow.llm.shared import staged

PLACED = "part int, doc_id long, doc_tokens long, start_in_part long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


class RankedEncoder(CachedEncoder):
    """Words that are not in the table yet go to a compiled BPE, which needs ids in the order of the merges."""

    entries = 700_000

    def __init__(self, bpe: ByteBpe):
        super().__init__(bpe)
        self.compiled = None
        if bpe.made == sorted(bpe.made):
            ranks = {s: i for i, s in enumerate(bpe.symbols) if s and i not in bpe.special.values()}
            self.compiled = tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _new(self, word: str) -> bytes:
        if self.compiled is None:
            return super()._new(word)
        return array("I", self.compiled.encode_ordinary(word)).tobytes()


def pack_documents(
    spark: SparkSession, docs: DataFrame, vocabulary: str, window: int = 2048, end_id: int = 1, with_ids: bool = True
) -> DataFrame:
    """One row per piece of a document: where it starts there, its length and crc, its sequence and its place in it.

    Each document's ids are followed by `end_id`, so a null or empty text is one token. Texts are taken in the
    order of the input's partitions; sequences are full but for the last. Repeated rows are packed repeatedly;
    a null doc_id stays null. `ids` holds the piece as little-endian unsigned 32-bit integers.
    """
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))
    # Ids that fit in 16 bits are kept so between the passes.
    kind = "H" if max(len(load(spec.value).symbols), end_id + 1) <= 1 << 16 else "I"
    end = array("I", [end_id]).tobytes()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = RankedEncoder(load(spec.value)), TaskContext.get().partitionId(), 0
        for batch in batches:
            starts, counts, coded = [], [], []
            for x in batch.column(1):
                ids = encoder.encode(x.as_py()) + end
                starts.append(at)
                counts.append(len(ids) // 4)
                at += counts[-1]
                coded.append(ids if kind == "I" else array("H", array("I", ids)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(coded), pa.int32()),
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(coded, pa.binary()),
                ],
                ["part", "doc_id", "doc_tokens", "start_in_part", "ids"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in names}
            for doc_id, tokens, at, coded in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = coded if kind == "I" else array("I", array("H", coded)).tobytes()
                start = 0
                while start < tokens:
                    sequence, offset = divmod(at + start, window)
                    length = min(window - offset, tokens - start)
                    piece = ids[4 * start : 4 * (start + length)]
                    for name, value in zip(
                        names, (doc_id, start, length, zlib.crc32(piece), tokens, sequence, offset, piece), strict=False
                    ):
                        rows[name].append(value)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in rows.items()], names
            )

    schema = PIECES if with_ids else PIECES.removesuffix(", ids binary")
    names = [x.split()[0] for x in schema.split(", ")]
    texts = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    placed = staged(texts.mapInArrow(place, PLACED))
    totals = placed.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    # One row per partition of the input, not per document.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    return (
        placed.join(F.broadcast(offsets), "part")
        .select("doc_id", "doc_tokens", (F.col("base") + F.col("start_in_part")).alias("at"), "ids")
        .mapInArrow(cut, schema)
    )
