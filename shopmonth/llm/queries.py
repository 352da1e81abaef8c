"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workdir import new_folder
from . import (audit, conversations, decontaminate, jaccard, kneser_ney, licenses, passages, pii, piece_bpe, tokenfile,
               urls, vectors, warc)
from .oracles import ORACLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kneser_ney.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(F.col("id").alias("doc_id"), "lang", "perplexity", "threshold", "keep")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), matches_col="matches")
    return found.select("doc_id", F.size("matches").alias("n_licenses"), F.col("matches.license").alias("licenses"), "matches")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = piece_bpe.encode(docs, path, lossless_col="lossless")
    return encoded.select("doc_id", F.size("token_ids").alias("n_tokens"), "token_ids", "lossless")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    manifest = tokenfile.write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.read_index(manifest, folder)


PSEUDONYM_KEY = "registered query"


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    named = pii.pseudonymise(docs, PSEUDONYM_KEY, found_col="found")
    return named.select("doc_id", "text", F.size("found").alias("n_found"), "found")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontaminate.scan_documents(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort("hits.items")
    return scanned.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archives")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.page_captures(warc.assemble(warc.read_heads(manifest, folder)))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.prepared(table(spark, sf_dir, "conversations"))
    judged = conversations.judged(conversations.damaged(rows))
    return judged.select(F.col("conv").alias("conv_id"), *conversations.FIGURES, "audit", "repaired_sha256")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_license_scan": op2_license_scan,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_url_filter": op4_url_filter,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_token_files": op6_token_files,
    "op7_pii": op7_pii,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_substring_dedup": op13_substring_dedup,
}
