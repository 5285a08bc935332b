"""Counts that are kept up to date as new files of texts arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_word_counts(spark: SparkSession, path: str, schema: StructType, text_col: str = "text", key: str = "lang") -> DataFrame:
    """A streaming frame of ``lemma``, the key and ``n`` over Parquet files in a folder, for the ``complete`` or ``update`` output mode."""
    found = F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"\p{L}+"), F.lit(0)))
    return spark.readStream.schema(schema).parquet(path).select(F.col(key), found.alias("lemma")).groupBy("lemma", key).agg(F.count(F.lit(1)).alias("n"))
