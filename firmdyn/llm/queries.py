"""The registered query of every operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmdyn.llm import oracle
from firmdyn.llm.bloom_dedup import bloom_exact_dedup
from firmdyn.llm.chat_snapshots import format_chats
from firmdyn.llm.chunked_bpe import decode_documents, encode_documents
from firmdyn.llm.common import fold, table
from firmdyn.llm.coordinate_minhash import near_duplicates
from firmdyn.llm.cotraining import quality_scores
from firmdyn.llm.exact_whitening import whiten_embeddings
from firmdyn.llm.fim_arrow import fill_in_middle, restored_text
from firmdyn.llm.license_classifier import scan_licenses
from firmdyn.llm.ngram_lm import score_documents
from firmdyn.llm.pfair_mix import pfair_mix
from firmdyn.llm.piece_langid import identify_languages
from firmdyn.llm.rule_cascade import rule_cascade
from firmdyn.llm.suffix_dedup import remove_repeats


def op1_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "quality_score", (F.col("quality_score") >= 0.5).alias("kept"))


def op4_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rule_cascade(table(spark, sf_dir, "documents"), always=base).select(
        "doc_id", *base, failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))


def op5_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_exact_dedup(table(spark, sf_dir, "documents"))


def op6_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix(table(spark, sf_dir, "documents"))


def op7_piece_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    return identify_languages(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op9_coordinate_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85, matches=40)


def op10_license_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_fim_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored_text(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


def op12_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.col("deviation").try_cast("long"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_chunked_bpe,
        op2_ngram_lm,
        op3_cotraining,
        op4_rule_cascade,
        op5_bloom_exact_dedup,
        op6_pfair_mix,
        op7_piece_langid,
        op8_chat_snapshots,
        op9_coordinate_minhash,
        op10_license_classifier,
        op11_fim_arrow,
        op12_exact_whitening,
        op13_suffix_dedup,
    )
}
ORACLE_SQL: dict[str, str] = oracle.SQL
