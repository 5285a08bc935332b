"""A pipeline over ``documents``: language, near duplicates, benchmark leaks, secrets, token ids.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next one's docs.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgrove.llm import bpe, decontaminate, language_id, secrets, simhash
from wordgrove.llm.common import new_path, remove_table, written

#: A document whose most likely language has a lower score has no clear language.
MIN_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: no text, no letter, or no language ahead of the others.

    The label of a kept document becomes the predicted one.
    """
    model = language_id.train(docs)
    known = language_id.predict(docs, model).where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return known.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the one with the smallest id, null ids last.

    Rows are told apart by id and the digest of their text, so ids may be null or
    repeated; of rows equal in both one is left.
    """
    key = F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2(F.col("text").cast("binary"), 256))
    groups = simhash.near_duplicates(docs.select(key.alias("key"), "text"), id_col="key")
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("key")).distinct()
    return docs.withColumn("key", key).join(kept, "key", "left_semi").dropDuplicates(["key"]).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_leaks(docs, benchmark).where("NOT leak").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; all documents stay."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit integers), which decode to it again."""
    encoded = bpe.encode(docs)
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("bpe", encode_texts),
]

#: Trained models, fingerprints and BPE are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order, over the whole of ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = new_path(spark)
        docs = written(stage(spark, docs, sf_dir), path)
        if before:
            remove_table(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
