"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` is what its predecessor
kept, and returns a DataFrame; ``run`` writes every stage as Parquet in the shared
folder and hands the next one what it reads back. All stages but the last return
the columns of documents.

Defined results: a null or empty text goes in the first stage; rows without id are
judged like others and kept as groups of their own where nothing else names them;
columns named like those that the last stage adds are replaced by it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmonth.llm import decontaminate, jaccard, kneser_ney, pii, piece_bpe
from shopmonth.sources.workdir import new_folder, stage

SHINGLE, SIMILARITY = 5, (4, 5)
PSEUDONYM_KEY = "corpus pipeline"
PIECES = "piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is in the range of trusted text of their language."""
    return kneser_ney.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are linked by a similarity of 0.8 or more of their 5-word shingles."""
    return jaccard.one_of_each(docs, shingle=SHINGLE, similarity=jaccard.Similarity(*SIMILARITY))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are passages of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format; ``n_chars`` follows the text."""
    named = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return named.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else named


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with merge dropout, and whether they decode to the text."""
    path = public_tokenizers.path(PIECES)
    # Columns that the documents bring under the names of the result make way.
    docs = docs.drop("token_ids", "n_tokens", "lossless")
    tokens = piece_bpe.encode(docs, path, DROPOUT, SEED, lossless_col="lossless")
    return tokens.select(*docs.columns, "token_ids", F.size("token_ids").alias("n_tokens"), "lossless")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("PII", private),
    ("SentencePiece encoding and decoding", encoded),
]

ORACLE_SQL = None  # perplexities and pseudonyms cannot be stated in SQL; tests/llm/test_pipeline.py has brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for number, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), str(number), folder)
    return docs
