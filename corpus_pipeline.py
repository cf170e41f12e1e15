"""From raw documents to packed token sequences: five stages, each one operator of straitflow.llm.

Every stage but the last returns the columns of `documents`. Its result is written as Parquet and read again as
the input of the next, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from straitflow.llm import line_minhash, packing, quality_ftrl, secrets, simhash_trie
from straitflow.llm.registry import VOCABULARY
from straitflow.llm.shared import ship, small_batches
from straitflow.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CARRIED = COLUMNS[2:]

#: The classifier is trained, so SQL has no counterpart; tests compare the stages with brute force.
ORACLE_SQL = None


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of `documents`, from doc_id, text and the carried ones; n_chars follows the text."""
    return rows.select(
        "doc_id",
        "text",
        "carried.lang",
        "carried.source",
        F.coalesce(F.char_length("text").cast("long"), "carried.n_chars").alias("n_chars"),
    )


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that the quality classifier, trained on the labelled ones here, rejects."""
    ship(spark)
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    weights = quality_ftrl.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_ftrl.keep_good(spark, docs, weights, threshold=0.7)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of every group of near-equal lines; documents of which nothing is left go."""
    ship(spark)
    small_batches(spark)
    found = line_minhash.dedup_lines(docs, carry=CARRIED)
    return _documents(found.where("n_removed = 0 OR text <> ''"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of texts alike by five-word shingles (0.8 or more)."""
    ship(spark)
    small_batches(spark)
    return _documents(simhash_trie.keep_first_similar(docs, carry=CARRIED))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    return _documents(secrets.redact_documents(docs, carry=CARRIED))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences of 2048 tokens."""
    ship(spark)
    small_batches(spark)
    return packing.pack_documents(spark, docs, VOCABULARY, with_ids=False)


STAGES = [
    ("quality classifier", classify),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("secret scans", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
