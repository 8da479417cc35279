"""Registered queries of the operators in this folder, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanseason.llm import (
    cover_tree,
    decontaminate,
    exact_dedup,
    language_id,
    licences,
    mixing,
    near_dedup,
    phrases,
    pieces,
    pii,
    ranked_search,
    repeats,
    toxicity,
)
from loanseason.llm.common import fold_of, table, word_count


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"), keep="largest")
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    held_out = F.coalesce(fold_of(F.col("doc_id"), 4) == 2, F.lit(False))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = repeats.repeated_passages(docs).select(
        "k1", "k2", "n_removed", F.sha2("kept_text", 256).alias("part_sha256")
    )
    whole = repeats.keyed(docs.select("doc_id", "text")).select(
        "doc_id",
        "k1",
        "k2",
        word_count(F.col("text")).alias("n_words"),
        F.sha2(repeats.joined_words(F.col("text")), 256).alias("whole_sha256"),
    )
    return whole.join(kept, repeats.KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("part_sha256", "whole_sha256").alias("kept_sha256"),
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(
        table(spark, sf_dir, "documents"), settings=near_dedup.NearSettings(words=2, percent=80)
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files below source and language. One that states a licence anywhere states it for its directory."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), "doc_id").alias("path"),
    )
    return licences.scan(docs, declares=F.lit(True)).select(
        "doc_id", "own_license", F.round("own_score", 6).alias("own_score"), "license", "license_path"
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    decoded = pieces.decode(encoded)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold_of(F.col("doc_id"), 5) == 0, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_decontaminate": op13_decontaminate,
}
