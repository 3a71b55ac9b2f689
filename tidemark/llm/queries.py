"""Registered queries of the document operators: thin callers that derive the digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, compression, decontaminate, exact_dedup, html_text, langid, licenses, merkle, neardup, packing, secret_scan, substring_dedup, toxicity)
from tidemark.llm.common import fold, table

TOKENIZER = "word_bpe_49k.json"
#: Tokenizers A and B of the alignment.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def held_out(id_col: str) -> Column:
    return F.coalesce(fold(F.col(id_col)) == 1, F.lit(False)).alias("held_out")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return told.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.trigram_model(docs)
    told = toxicity.score(docs, model, toxicity.fit(docs, labels, model))
    return told.select(F.col("id").alias("doc_id"), held_out("id"), "score",
                       (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = secret_scan.find_secrets(docs, secret_scan.fit(*secret_scan.samples(docs)))
    return told.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex",
                       F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"), secret_scan.as_text(F.col("spans")).alias("spans"))


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    return told.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op6_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = licenses.scan(table(spark, sf_dir, "documents"))
    return told.withColumnRenamed("id", "doc_id")


def op7_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op8_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = langid.profiles(docs.where(langid.training_rows(docs)))
    told = langid.identify(docs, learned)
    return told.select("doc_id", held_out("doc_id"), "lang_pred", "score")


def op9_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = substring_dedup.find_repeats(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return told.select(F.col("id").alias("doc_id"), "n_words", "n_spans", "repeated_words", "copied_words", spans.alias("spans"), "repeated")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)
    return told.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op11_pair_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, paths = table(spark, sf_dir, "documents"), [tokenizer_path(name) for name in ALIGNED]
    return alignment.align(docs, alignment.count_pairs(docs, *paths), *paths).withColumnRenamed("id", "doc_id")


def op12_merkle_octopus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.proofs(docs, changed=merkle.tampered(docs)).withColumnRenamed("id", "doc_id")


def op13_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = compression.score(docs, compression.fit(docs, table(spark, sf_dir, "labels")))
    away = F.coalesce(compression.fold(F.col("id")) == 2, F.lit(False)).alias("held_out")
    return told.select(F.col("id").alias("doc_id"), away, "score", (F.col("score") >= compression.THRESHOLD).cast("int").alias("predicted"))


QUERIES = {
    "op1_pattern_packing": op1_pattern_packing,
    "op2_decontamination": op2_decontamination,
    "op3_channel_toxicity": op3_channel_toxicity,
    "op4_markov_secrets": op4_markov_secrets,
    "op5_chosen_path": op5_chosen_path,
    "op6_diagonal_voting": op6_diagonal_voting,
    "op7_layout_text": op7_layout_text,
    "op8_language_profiles": op8_language_profiles,
    "op9_gear_chunks": op9_gear_chunks,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_pair_alignment": op11_pair_alignment,
    "op12_merkle_octopus": op12_merkle_octopus,
    "op13_compression_quality": op13_compression_quality,
}

SQL = {
    "op10_exact_dedup": r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
g AS (SELECT n, count(*) AS group_size, first(doc_id ORDER BY chars DESC, doc_id) AS keep_id FROM t GROUP BY n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM t JOIN g USING (n)""",
    "op12_merkle_octopus": merkle.oracle_sql(),
}
