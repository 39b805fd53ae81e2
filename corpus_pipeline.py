"""A corpus pipeline: toxic documents go, then repeated lines, near duplicates and repeated passages; the rest is packed.

Each stage takes (spark, docs, sf_dir), docs with the columns of `documents`, and returns the documents that it keeps, as it changes
them, with the same columns; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import common, line_dedup, minmax_dedup, packing, substring_dedup, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No SQL: the first stage is learnt, and the last one's ids come from a tokenizer. tests/llm compares with brute force.
ORACLE_SQL = None


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars counted anew."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5 stay."""
    return toxicity.toxicity(docs, common.table(spark, sf_dir, "labels")).where("predicted = 0").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents go everywhere."""
    return _documents(line_dedup.drop_frequent_lines(docs, min_docs=10, min_chars=1))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.8 (shingles of five words) connect, the one of smallest id stays."""
    kept = minmax_dedup.near_dedup(docs, percent=80, k=5).where("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a window of 20 words that also starts earlier go; documents without such words stay as they are."""
    found = substring_dedup.remove_repeats(docs, length=20)
    return _documents(found.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, 1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again, and deleted when the next one is written.

    The result is a table in the shared folder; common.release deletes it.
    """
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with common.scope():
            made = common.staged(stage(spark, docs, sf_dir), f"stage-{name}", outside=True)
        common.release(docs)
        docs = made
    return docs
