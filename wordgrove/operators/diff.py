"""Comparison of two versions of a network."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.common import checkpointed


def link_versions(old: DataFrame, new: DataFrame, cascade: list[list[str]], seq: str = "node") -> DataFrame:
    """``old_id``, ``new_id`` and ``level``: nodes linked one to one by ever looser keys; unlinked ones have a null on one side and no level.

    Of several nodes with one key the n-th of one side goes with the n-th of the other.
    """
    rest_old, rest_new, links = checkpointed(old), checkpointed(new), None
    for level, keys in enumerate(cascade):
        order = Window.partitionBy(*keys).orderBy(seq)
        side = lambda df, name: df.select(*keys, F.col("node").alias(name), F.row_number().over(order).alias("_k"))  # noqa: E731, B023
        hit = checkpointed(side(rest_old, "old_id").join(side(rest_new, "new_id"), [*keys, "_k"]).select("old_id", "new_id", F.lit(level).alias("level")))
        links = hit if links is None else links.unionByName(hit)
        rest_old = checkpointed(rest_old.join(hit.select(F.col("old_id").alias("node")), "node", "left_anti"))
        rest_new = checkpointed(rest_new.join(hit.select(F.col("new_id").alias("node")), "node", "left_anti"))
    none = F.lit(None)
    gone = rest_old.select(F.col("node").alias("old_id"), none.cast(dict(new.dtypes)["node"]).alias("new_id"), none.cast("int").alias("level"))
    added = rest_new.select(none.cast(dict(old.dtypes)["node"]).alias("old_id"), F.col("node").alias("new_id"), none.cast("int").alias("level"))
    return links.unionByName(gone).unionByName(added)


def diff_edges(old: DataFrame, new: DataFrame, links: DataFrame) -> DataFrame:
    """For linked nodes whether their edge is ``same``, ``reconnected``, ``connected``, ``disconnected`` or absent (``none``)."""
    pairs = links.where("old_id IS NOT NULL AND new_id IS NOT NULL").select("old_id", "new_id")
    translated = pairs.select(F.col("old_id").alias("old_parent"), F.col("new_id").alias("expected"))
    joined = pairs.join(old.select(F.col("node").alias("old_id"), F.col("parent").alias("old_parent")), "old_id").join(new.select(F.col("node").alias("new_id"), F.col("parent").alias("new_parent")), "new_id").join(translated, "old_parent", "left")
    change = (
        F.when(F.col("old_parent").isNull() & F.col("new_parent").isNull(), "none")
        .when(F.col("old_parent").isNull(), "connected")
        .when(F.col("new_parent").isNull(), "disconnected")
        .when(F.col("expected").eqNullSafe(F.col("new_parent")), "same")
        .otherwise("reconnected")
    )
    return joined.select("old_id", "new_id", change.alias("change"))


def missing_in(network: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """Network rows whose key a word list lacks."""
    return network.join(words.select(*keys).distinct(), keys, "left_anti")
