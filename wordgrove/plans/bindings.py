"""Views of the given tables as word tables, forests and chains.

W: words of ``documents`` by language with their counts.  F: a forest over
``part``.  F2: another version of it.  C: conversations as chains.  Each has its
SQL as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgrove.common import checkpointed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lemma`` and ``pos`` of every word of every document."""
    found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    return table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("pos"), found.alias("lemma"))


TOKENS_SQL = r"""t AS (SELECT doc_id, lang AS pos, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS lemma FROM documents)"""


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W: ``lemma``, ``pos`` and ``n``."""
    return tokens(spark, sf_dir).groupBy("lemma", "pos").agg(F.count(F.lit(1)).alias("n"))


def kept_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W, computed once and kept, for queries that use it several times."""
    return checkpointed(words(spark, sf_dir))


W_SQL = TOKENS_SQL + ", w AS MATERIALIZED (SELECT lemma, pos, count(*) AS n FROM t GROUP BY lemma, pos)"


def forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F: ``node``, ``parent``, ``lemma``, ``pos`` and ``n`` over parts."""
    key = F.col("p_partkey")
    parent = F.when(key % 37 != 0, F.floor(key / 4).cast("long"))
    return table(spark, sf_dir, "part").select(key.alias("node"), parent.alias("parent"), F.col("p_name").alias("lemma"), F.col("p_type").alias("pos"), F.col("p_size").alias("n"))


F_SQL = "f AS (SELECT p_partkey AS node, CASE WHEN p_partkey % 37 <> 0 THEN p_partkey // 4 END AS parent, p_name AS lemma, p_type AS pos, p_size AS n FROM part)"


def forest2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the parts of the lower nine tenths of keys, hung by thirds, some types recoded."""
    parts = table(spark, sf_dir, "part")
    cut = parts.agg(F.max("p_partkey").alias("top"))
    key = F.col("p_partkey")
    kept = parts.join(F.broadcast(cut), key * 10 < F.col("top") * 9)
    pos = F.when(F.col("p_size") % 7 == 0, F.lit("RECODED")).otherwise(F.col("p_type"))
    return kept.select(key.alias("node"), F.when(key % 37 != 0, F.floor(key / 3).cast("long")).alias("parent"), F.col("p_name").alias("lemma"), pos.alias("pos"), F.col("p_size").alias("n"))


F2_SQL = """f2 AS (SELECT p_partkey AS node, CASE WHEN p_partkey % 37 <> 0 THEN p_partkey // 3 END AS parent, p_name AS lemma,
  CASE WHEN p_size % 7 = 0 THEN 'RECODED' ELSE p_type END AS pos, p_size AS n FROM part WHERE p_partkey * 10 < (SELECT max(p_partkey) FROM part) * 9)"""

CLOSURE_SQL = """c(node, ancestor, dist) AS (SELECT node, node, 0::BIGINT FROM f UNION ALL SELECT c.node, f.parent, c.dist + 1 FROM c JOIN f ON c.ancestor = f.node WHERE f.parent IS NOT NULL)"""
ROOT_SQL = "r AS (SELECT node, max_by(ancestor, dist) AS root, max(dist) + 1 AS depth FROM c GROUP BY node)"
#: F with all ancestors (c) and each node's root and depth (r).
FOREST_SQL = f"WITH RECURSIVE {F_SQL}, {CLOSURE_SQL}, {ROOT_SQL}"


def chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C: conversations, each turn hung on the one before; ``node`` and ``parent`` are ``conversation:turn``."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role").dropDuplicates(["conv_id", "turn"])
    name = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    before = turns.select(F.col("conv_id").alias("c"), (F.col("turn") + 1).alias("t"), F.lit(True).alias("there"))
    linked = turns.join(before, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    return linked.select("conv_id", "turn", "role", name(F.col("turn")).alias("node"), F.when(F.col("there"), name(F.col("turn") - 1)).alias("parent"))


C_SQL = """turns AS (SELECT conv_id, turn, min(role) AS role FROM conversations GROUP BY conv_id, turn),
ch AS (SELECT a.conv_id, a.turn, a.role, a.conv_id || ':' || a.turn AS node, CASE WHEN b.turn IS NOT NULL THEN a.conv_id || ':' || (a.turn - 1) END AS parent
  FROM turns a LEFT JOIN turns b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1)"""

#: Signatures of F's trees by the first letter of the part of speech: the longest path has fewer than 16 nodes, as keys are divided by four.
SIGNATURES_SQL = f"WITH {F_SQL}, g0 AS (SELECT node, parent, left(pos, 1) AS sig FROM f)" + "".join(
    f", g{k} AS (SELECT f.node, f.parent, left(f.pos, 1) || coalesce('->(' || k.inner_sigs || ')', '') AS sig FROM f LEFT JOIN (SELECT parent, string_agg(sig, ',' ORDER BY sig) AS inner_sigs FROM g{k - 1} WHERE parent IS NOT NULL GROUP BY parent) k ON k.parent = f.node)"
    for k in range(1, 16)
)
