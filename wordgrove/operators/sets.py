"""Set operations on lists and the hygiene of annotation files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_relations(frames: list[DataFrame], origins: list[str], keys: list[str]) -> DataFrame:
    """The union of lists, once each, with where each row came from."""
    every = reduce(DataFrame.unionByName, [df.select(*keys).withColumn("origin", F.lit(o)) for df, o in zip(frames, origins)])
    return every.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("origin")), "+").alias("origins"))


def subtract(pool: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a pool whose key isn't done."""
    return pool.join(done.select(*keys).distinct(), keys, "left_anti")


def compare_lists(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of two lists, and whether they are ``common``, ``left`` or ``right`` only."""
    left, right = a.select(*keys).distinct().withColumn("_l", F.lit(True)), b.select(*keys).distinct().withColumn("_r", F.lit(True))
    return left.join(right, keys, "full").select(*keys, F.when(F.col("_l") & F.col("_r"), "common").when(F.col("_l"), "left").otherwise("right").alias("side"))


def mark_deleted(original: DataFrame, pruned: DataFrame) -> DataFrame:
    """Lines (``line``, ``value``) of an original, starred where the pruned file lacks them (spaces aside)."""
    bare = lambda c: F.regexp_replace(c, r"\s+", "")
    kept = pruned.select(bare("value").alias("_k")).distinct().withColumn("_kept", F.lit(True))
    return original.withColumn("_k", bare("value")).join(kept, "_k", "left").select("line", F.when(F.col("_kept"), F.col("value")).otherwise(F.concat(F.lit("*"), "value")).alias("value"))


def drop_contradicted(lines: DataFrame) -> DataFrame:
    """Lines (``line``, ``value``) without starred ones that stand unstarred as well (spaces aside)."""
    bare = F.regexp_replace(F.regexp_replace("value", r"^\*", ""), r"\s+", "")
    keyed = lines.withColumn("_k", bare).withColumn("_star", F.startswith("value", F.lit("*")))
    plain = keyed.where("NOT _star").select("_k").distinct().withColumn("_twin", F.lit(True))
    return keyed.join(plain, "_k", "left").where("NOT _star OR _twin IS NULL").select("line", "value")


def overlay(df: DataFrame, fixes: DataFrame, keys: list[str]) -> DataFrame:
    """Labels (keys, ``label``, ``probability``) after corrections (keys, ``mark``, ``label``): ``$`` drops the label, ``+`` overrides it, an unseen ``+`` is added without a probability."""
    fix = fixes.select(*keys, "mark", F.col("label").alias("_new"))
    both = df.join(fix, keys, "full")
    label = F.when(F.col("mark") == "$", None).when(F.col("mark") == "+", F.col("_new")).otherwise(F.col("label"))
    return both.where("label IS NOT NULL OR mark = '+'").select(*keys, label.alias("label"), F.when(F.col("mark").isNull(), F.col("probability")).alias("probability"))


def route(annotations: DataFrame, rules: list[tuple[str, Column]], otherwise: str = "unrouted") -> DataFrame:
    """Annotations with the name of the first rule whose condition holds."""
    out = F.lit(otherwise)
    for name, condition in reversed(rules):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return annotations.withColumn("route", out)


def annotation_issues(df: DataFrame, lexemes: DataFrame, marks: list[str]) -> DataFrame:
    """Problems of annotated pairs (``line``, ``mark``, ``a``, ``b``): illegal marks, unknown and ambiguous words, different first letters."""
    known = lexemes.groupBy("lemma").agg(F.count(F.lit(1)).alias("_n"))
    out = df.where(~F.coalesce("mark", F.lit("")).isin(*marks, "")).select("line", F.lit("illegal mark").alias("issue"), F.col("mark").alias("detail"))
    for side in ("a", "b"):
        held = df.select("line", F.col(side).alias("lemma")).join(known, "lemma", "left")
        out = out.unionByName(held.where("_n IS NULL").select("line", F.lit("unknown word").alias("issue"), F.col("lemma").alias("detail")))
        out = out.unionByName(held.where("_n > 1").select("line", F.lit("ambiguous word").alias("issue"), F.col("lemma").alias("detail")))
    shifted = df.where(F.lower(F.substring("a", 1, 1)) != F.lower(F.substring("b", 1, 1))).select("line", F.lit("different start").alias("issue"), F.concat_ws(">", "a", "b").alias("detail"))
    return out.unionByName(shifted)


def coverage_gaps(predicted: DataFrame, pattern: Column, label: str) -> DataFrame:
    """Rows whose pattern says a label that wasn't predicted, and the reverse."""
    says, has = F.coalesce(pattern, F.lit(False)), F.coalesce(F.col("label") == label, F.lit(False))
    return predicted.where(says != has).withColumn("gap", F.when(says, "missed").otherwise("unexpected"))
