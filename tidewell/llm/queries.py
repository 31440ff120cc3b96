"""The registered queries of the text operators, and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.alignment import align_tokenizers
from tidewell.llm.common import table
from tidewell.llm.language_id import identify_languages, learn_profiles
from tidewell.llm.line_dedup import drop_repeated_lines
from tidewell.llm.mixing import mix
from tidewell.llm.pieces import round_trip
from tidewell.llm.quality_classifier import score_documents
from tidewell.llm.quality_rules import judge_documents
from tidewell.llm.repeats import remove_repeats
from tidewell.llm.secrets import listed, scan_secrets
from tidewell.llm.sharding import shard_by_size
from tidewell.llm.simhash import near_duplicates
from tidewell.llm.voronoi import top_k
from tidewell.llm.whitening import whiten


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    base = ("assign", "access", "hex")
    return found.select(
        "row.doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in (*base, "random")],
        F.sha2(listed(*base).cast("binary"), 256).alias("base_sha256"),
        listed(*base, "random").alias("spans"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_documents(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), carry=["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = drop_repeated_lines(docs)
    return kept.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = remove_repeats(docs, window=50, carry=["doc_id"])
    return kept.select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, table(spark, sf_dir, "labels"), carry=["doc_id"])
    return scored.select("row.doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, carry=["doc_id"]).select("row.doc_id", "fingerprint", "component_id")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = top_k(vectors, F.col("id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    coded = round_trip(docs, carry=["doc_id", "text_sha256"])
    decoded = F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    return coded.select("row.*", "ids", F.size("ids").cast("long").alias("n_pieces"), decoded)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    placed = shard_by_size(docs.select("doc_id", "text", crc.alias("text_crc32")), carry=["doc_id", "text_crc32"])
    return placed.select(
        "row.doc_id",
        "size",
        "row.text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold == 2).alias("held_out"))
    profiles = learn_profiles(docs, train=~F.col("held_out"))
    found = identify_languages(docs.select("doc_id", "text", "held_out"), profiles, carry=["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    columns = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    return whiten(vectors, carry=["vec_id"]).select("row.vec_id", *columns)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return align_tokenizers(docs, carry=["doc_id"]).select("row.doc_id", *columns)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_line_dedup": op3_line_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_mixing": op9_mixing,
    "op10_sharding": op10_sharding,
    "op11_language_id": op11_language_id,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_alignment": op13_token_alignment,
}
