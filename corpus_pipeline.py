"""Corpus pipeline: toxicity, line dedup, near-dedup, decontamination and packing, each stage on all that
the stage before it kept.

In every stage a null text counts as empty, rows without an id and rows that share one are rows of their own,
told apart by their text, other columns are handed on as they are, and an empty table stays empty. A text
that is empty scores as one without a toxic word; of all empty ones the first stays as a near copy.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import decontaminate, lines, packing, simhash, toxicity
from logloom.llm.common import Cut, table, text_hash

#: The tokenizer's file; it must be at this place on every executor.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7 under a lexicon learned from the labelled ones that are not held out."""
    labels = table(spark, sf_dir, "labels").where((F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & F.col("toxic").isNotNull())
    lexicon = toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")), threshold=0.7)
    return toxicity.keep_clean(docs, lexicon, threshold=0.7)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one; n_chars follows the text."""
    rows = lines.dedup(docs, edits=2, least_chars=1)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share five-word shingles at a similarity of 0.8, the one with the smallest
    id; rows without an id come last, and rows that share an id are told apart by their text."""
    return simhash.first_of_each(docs, words=5, similarity=0.8).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text holds no benchmark item, whatever their ids."""
    texts = docs.select(text_hash(F.col("text")).alias("doc_id"), "text")
    held = decontaminate.contaminated(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_held")).distinct()
    return docs.join(held, text_hash(docs.text) == held._held, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, TOKENIZER, length=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Stages use learned scores and hashes that SQL does not have; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir; each stage's rows are written and read again."""
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        made = Cut(stage(spark, docs, sf_dir))
        if last is not None:
            last.drop()
        docs, last = made.df, made
    return docs
