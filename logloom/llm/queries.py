"""The registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, decontaminate, embeddings, html, language, licenses, lines, packing, phrases, pii, simhash, suffix_tree, toxicity
from .common import table


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(F.coalesce(remainder != 2, F.lit(True))).select("text", "lang"))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs, edits=2, least_chars=1).select("doc_id", "n_lines", "n_removed", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"), "text")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), length=2048)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.find(docs, pii.fit(docs)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where("toxic is not null").select("doc_id", F.col("toxic").alias("label"))
    lexicon = toxicity.fit(docs, labels.where(remainder != 1), threshold=0.7)
    return toxicity.score(docs, lexicon, threshold=0.7).select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 7
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tree = suffix_tree.fit(docs.where(F.coalesce(remainder != 2, F.lit(True))))
    found = suffix_tree.score(docs, tree)
    tree.drop()
    return found.withColumn("held_out", F.coalesce(remainder == 2, F.lit(False)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_line_dedup": op1_line_dedup, "op2_embedding_near_dedup": op2_embedding_near_dedup, "op3_licenses": op3_licenses, "op4_packing": op4_packing, "op5_language": op5_language, "op6_simhash": op6_simhash, "op7_pii": op7_pii, "op8_toxicity": op8_toxicity, "op9_decontaminate": op9_decontaminate, "op10_html": op10_html, "op11_phrases": op11_phrases, "op12_filter_audit": op12_filter_audit, "op13_lm_score": op13_lm_score}


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_near_dedup": embeddings.sql(cosine=0.98), "op3_licenses": licenses.sql(), "op11_phrases": phrases.sql(), "op12_filter_audit": audit.sql()}
