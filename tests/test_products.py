"""Pairs of rows of a key against plain versions, with blocks and batches so small that all ways are gone."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wordgrove.operators import lookup as op
from wordgrove.operators import resolve as rs


@pytest.fixture
def small_blocks(monkeypatch):
    products = pytest.importorskip("wordgrove.operators.products")
    for name, value in {"LEFT_ROWS": 64, "RIGHT_ROWS": 32, "RUN_ROWS": 7, "BATCH_PAIRS": 100}.items():
        monkeypatch.setattr(products, name, value)
    return products


def file_bytes(df, folder):
    df.write.parquet(str(folder))
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_products_are_whole(spark, small_blocks):
    # a key of many rows, keys of few, keys of one side, nulls and repeated rows
    left = [(["a", "b", "c", "d", None][0 if i < 200 else i % 5], i % 190 if i % 11 else None, f"x{i % 3}") for i in range(260)]
    right = [(["a", "b", "c", "e", None][0 if i < 150 else i % 5], i if i % 13 else None, [i, None]) for i in range(190)]
    a, b = spark.createDataFrame(left, "k string, l long, t string"), spark.createDataFrame(right, "k string, r long, v array<int>")
    plain = [(x, y) for x in left for y in right if x[0] == y[0] and x[0] is not None]
    shown = lambda rows: Counter(tuple(map(str, r)) for r in rows)
    assert shown(small_blocks.products(a, b, ["k"], keep=["k"]).collect()) == shown((*x, *y[1:]) for x, y in plain)
    assert shown(small_blocks.products(a, b, ["k"], unless=("l", "r")).collect()) == shown((*x[1:], y[2]) for x, y in plain if x[1] is None or x[1] != y[1])
    assert small_blocks.products(a, b.where("k = 'e'"), ["k"]).collect() == []


def test_references_of_a_crowded_key_are_dealt_out(spark, small_blocks):
    refs = spark.range(600).select(F.col("id").alias("ref_id"), (F.col("id") % 1).cast("string").alias("lemma"))
    lexemes = spark.range(100).select(F.col("id").alias("node"), (F.col("id") % 1).cast("string").alias("lemma"))
    rows = rs.resolve(refs, lexemes, ["lemma"], "all")[0].withColumn("part", F.spark_partition_id()).collect()
    assert sorted((r.ref_id, r.node) for r in rows) == [(a, b) for a in range(600) for b in range(100)]
    assert len({r.part for r in rows}) > 1


def test_files_of_all_homonyms_stay_small(spark, tmp_path):
    # nodes of a key in runs that repeat, and not more references in a file than a dictionary holds
    refs = spark.range(20000).select(F.col("id").alias("ref_id"), (F.col("id") % 20).cast("string").alias("lemma"))
    lexemes = spark.range(20000).select((F.xxhash64("id") % 1_000_000_007).alias("node"), (F.col("id") % 20).cast("string").alias("lemma"))
    assert file_bytes(rs.resolve(refs, lexemes, ["lemma"], "all")[0], tmp_path / "all") < 0.16 * 20000 * 1000


def test_files_of_external_parents_stay_small(spark, tmp_path):
    nodes = spark.range(8000).select(F.col("id").alias("node"), (F.col("id") % 2).cast("string").alias("lemma"))
    edges = nodes.select("node", F.when(F.col("node") % 4 > 1, F.col("node") - 2).alias("parent"))
    placed = edges.select("node", F.coalesce("parent", "node").alias("root"))
    pairs = spark.createDataFrame([("0", "1"), ("1", "1")], "child string, parent string")
    found = rs.external_parents(edges, nodes, pairs, placed)
    assert file_bytes(found, tmp_path / "found") < 0.16 * 4000 * 4000
    # tops of the second lemma leave out themselves and what hangs below
    assert spark.read.parquet(str(tmp_path / "found")).count() == 4000 * 4000 - 2 * 2000


def test_external_parents_in_small_blocks(spark, small_blocks):
    nodes = spark.range(400).select(F.col("id").alias("node"), (F.col("id") % 2).cast("string").alias("lemma"))
    edges = nodes.select("node", F.when(F.col("node") % 4 > 1, F.col("node") - 2).alias("parent"))
    # a node below two roots is given to both, one without a place to none
    placed = edges.select("node", F.coalesce("parent", "node").alias("root")).where("node <> 9").unionByName(spark.createDataFrame([(3, 5), (9, None)], "node long, root long"))
    pairs = spark.createDataFrame([("0", "1"), ("1", "1")], "child string, parent string")
    found = sorted(tuple(r) for r in rs.external_parents(edges, nodes, pairs, placed).collect())
    roots = {n: {n - n % 4 + n % 2} for n in range(400) if n != 9} | {3: {1, 5}}
    assert found == [(t, p) for t in range(400) if t % 4 < 2 for p in range(1, 400, 2) if p in roots and roots[p] != {t}]


def test_fuzzy_lookups_are_dealt_out(spark, small_blocks):
    # one lemma; keys that find their type, keys that don't, keys without one; lexemes without one
    keys = [(i, "x", ["a", "zz", None][i % 3]) for i in range(300)]
    nodes = [(i, "x", ["a", "b", None, "c", "b"][i % 5]) for i in range(100)]
    shown = lambda rows: Counter(tuple(map(str, r)) for r in rows)
    for some in (nodes, [n for n in nodes if n[2]]):
        lexemes = spark.createDataFrame(some, "node long, lemma string, tech string")
        found = op.lookup(lexemes, spark.createDataFrame(keys, "key_id long, lemma string, tech string"), ["lemma", "tech"], fuzzy="tech", columns=["tech", "node"])
        rows = found.withColumn("part", F.spark_partition_id()).collect()
        met = [(k, n) for k in keys for n in some if k[2] is None or n[2] is None or k[2] == n[2] or not any(m[2] in (None, k[2]) for m in some)]
        assert shown(r[:3] for r in rows) == shown((k[0], n[2], n[0]) for k, n in met)
        assert len({r.part for r in rows}) > 1
    alone = op.lookup(spark.createDataFrame(nodes[:5], "node long, lemma string, tech string").select("lemma", "tech"), spark.createDataFrame(keys[:1], "key_id long, lemma string, tech string"), ["lemma", "tech"], fuzzy="tech")
    assert shown(alone.collect()) == shown([(0, "x", "a"), (0, "x", None)])
