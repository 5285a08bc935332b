"""Checks of files, forests and features; each gives issues (what, where)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.operators.forest import has_ancestor, running_sum


def check_file(lines: DataFrame, known_types: tuple[str, ...] = ("Derivation", "Compounding", "Conversion", "Variant", "Univerbisation")) -> DataFrame:
    """Problems (``line_no``, ``problem``) of a network file's lines (``line_no``, ``value``) that need more than one line to see.

    Blocks are stretches between blank lines; the number of a block is a running
    count of blank lines, taken in a range-partitioned sort.
    """
    blocks = running_sum(lines.select("line_no", "value", F.when(F.col("value") == "", 1).otherwise(0).cast("long").alias("_blank")), ["line_no"], "_blank", "block")
    rows = blocks.where("value <> '' AND NOT startswith(value, '#')").withColumn("f", F.split("value", "\t", 10)).where(F.size("f") == 10)
    rows = rows.select("line_no", "block", F.col("f")[0].alias("id"), F.col("f")[6].alias("parent"), F.col("f")[7].alias("rel"))
    rows = rows.withColumn("tree", F.split_part("id", F.lit("."), F.lit(1)))
    out = rows.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("line_no"))).where("k > 1").select("line_no", F.lit("duplicate id").alias("problem"))
    trees = rows.groupBy("tree").agg(F.countDistinct("block").alias("n"), F.max("line_no").alias("line_no")).where("n > 1").select("line_no", F.lit("tree in several blocks").alias("problem"))
    mixed = rows.groupBy("block").agg(F.countDistinct("tree").alias("n"), F.max("line_no").alias("line_no")).where("n > 1").select("line_no", F.lit("several trees in a block").alias("problem"))
    up = rows.select(F.col("id").alias("parent"), F.col("line_no").alias("p_line"), F.col("tree").alias("p_tree"))
    hung = rows.where("parent <> ''").join(up, "parent", "left")
    problem = F.when(F.col("p_line").isNull(), "unknown parent").when(F.col("p_tree") != F.col("tree"), "parent in another tree").when(F.col("p_line") >= F.col("line_no"), "parent not before")
    parents = hung.withColumn("problem", problem).where("problem IS NOT NULL").select("line_no", "problem")
    kind = F.regexp_extract("rel", r"(?:^|&)Type=([^&]*)", 1)
    types = hung.withColumn("problem", F.when(kind == "", "missing type").when(~kind.isin(*known_types), "unknown type")).where("problem IS NOT NULL").select("line_no", "problem")
    return out.unionByName(trees).unionByName(mixed).unionByName(parents).unionByName(types)


def check_rules(rows: DataFrame, node: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """``node`` and ``rule`` for every rule (name, condition of a breach) that a row breaks."""
    broken = F.filter(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]), lambda x: x.isNotNull())
    return rows.select(node, F.explode(broken).alias("rule"))


def count_inversions(nodes: DataFrame, offsets: list[float], ratios: list[float]) -> DataFrame:
    """Children more frequent than their parents: count above ratio times (offset + parent's count), for each pair of a grid, with the quotient."""
    up = nodes.select(F.col("node").alias("parent"), F.col("n").alias("parent_n"))
    grid = F.explode(F.array(*[F.struct(F.lit(float(o)).alias("offset"), F.lit(float(r)).alias("ratio")) for o in offsets for r in ratios]))
    both = nodes.join(up, "parent").select("node", "parent", "n", "parent_n", grid.alias("g")).select("node", "parent", "n", "parent_n", "g.offset", "g.ratio")
    score = F.col("n").cast("double") / (F.col("offset") + F.col("parent_n"))
    return both.withColumn("score", score).where("score > ratio").select("node", "parent", "offset", "ratio", "score")


def check_enumerated(nodes: DataFrame, relations: DataFrame, pattern: str, listed: DataFrame, excluded: DataFrame) -> DataFrame:
    """Words that fit a pattern but descend from none of the listed words (``node``) and aren't excluded."""
    fitting = nodes.where(F.col("lemma").rlike(pattern)).join(excluded.select("node"), "node", "left_anti").join(listed.select("node"), "node", "left_anti")
    good = has_ancestor(relations, fitting.select("node"), listed)
    return fitting.join(good, "node", "left_anti").select("node", "lemma")


def check_root_counts(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges over which the number of root morphs (``node``, ``root_morphs``) changes though the child is no compound."""
    own = nodes.select("node", "parent", "is_compound").join(roots, "node")
    up = roots.select(F.col("node").alias("parent"), F.col("root_morphs").alias("parent_roots"))
    joined = own.join(up, "parent")
    return joined.where("NOT is_compound AND root_morphs <> parent_roots OR is_compound AND root_morphs <= parent_roots").select("node", "parent", "root_morphs", "parent_roots")


def roundtrip_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two frames has, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.select(*a.columns).exceptAll(a).withColumn("side", F.lit("second")))
