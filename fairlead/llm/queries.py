"""One query per operator, each over its whole table, returning the digests of its contract."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm import (
    alignment,
    byterepeats,
    chat,
    decontaminate,
    language,
    lines,
    mixture,
    neardup,
    quality,
    recompress,
    tokens,
    trie,
    weighted,
)
from fairlead.llm.common import ship, table


Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_files(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_drop_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = recompress.drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = mixture.mix_rates(table(spark, sf_dir, "documents"))
    return rates.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4)
    return groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op8_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = byterepeats.drop_byte_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted.compare_with_edits(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align_tokenizers(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_drop_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _shipped(f)
    for f in (
        op1_token_files,
        op2_decontaminate,
        op3_drop_repeats,
        op4_quality,
        op5_mix_sources,
        op6_language,
        op7_near_duplicates,
        op8_format_chats,
        op9_suffix_repeats,
        op10_weighted_fingerprints,
        op11_conversation_trie,
        op12_align_tokenizers,
        op13_drop_lines,
    )
}
