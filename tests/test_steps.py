"""Steps that queries share: what is told once, what isn't sent through the driver."""

import random
import re

from pyspark.sql import functions as F

from wordgrove.common import written
from wordgrove.functions import text as fn
from wordgrove.operators import edits, forest
from wordgrove.operators.forest import path_fold
from wordgrove.plans.stats_queries import suffix_candidates
from wordgrove.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def common(a, b):
    """By the usual table."""
    row = [0] * (len(b) + 1)
    for x in a:
        above, row = row, [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x is not None and x == y else max(above[j + 1], row[j]))
    return row[-1]


def test_longest_common_subsequence(spark):
    draw = random.Random(5)
    some = lambda: [draw.choice(["a", "b", "c", "", None]) for _ in range(draw.randint(0, 80))]
    pairs = [(some(), some()) for _ in range(40)] + [([], []), (None, ["a"]), (["a"], None)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>")
    found = {r.i: r.n for r in rows.select("i", fn.lcs_length(F.col("a"), F.col("b")).alias("n")).collect()}
    assert found == {i: None if a is None or b is None else common(a, b) for i, (a, b) in enumerate(pairs)}


def test_longest_common_subsequence_of_long_texts(spark):
    """The work for a pair of texts grows with their lengths at most, so that a pair of 20,000 words each is nothing special."""
    rows = spark.sql("SELECT transform(sequence(1, 20000), x -> concat('w', x)) AS a, transform(sequence(1, 20000), x -> concat('w', x * 2)) AS b")
    assert rows.select(fn.lcs_length(F.col("a"), F.col("b")).alias("n")).first().n == 10_000


def test_words_are_told_once_for_candidates(spark):
    assert "Generate" not in plan(suffix_candidates(spark, "/root/testdata/sf0.001"))


def test_states_are_not_broadcast(spark):
    """Ids are small in files, however many they are; joins of states don't go by the size of these."""
    state = written(spark.range(1000).withColumnRenamed("id", "node"))
    assert "Broadcast" not in plan(state.join(state.withColumnRenamed("node", "up"), F.col("node") == F.col("up") + 1))
    edges = spark.range(1, 1000).selectExpr("id AS node", "nullif(id div 2, 0) AS parent")
    folded = path_fold(edges, edges.selectExpr("node", "1L AS n"), {"n": lambda upper, lower: upper + lower})
    assert "Broadcast" not in plan(edges.join(folded, "node"))


def broadcasts(df):
    """Joins of the plan that broadcast a side, but for those on a row of each partition or split."""
    return [x for x in plan(df).splitlines() if "BroadcastHashJoin" in x and not re.search(r"\[(_part|file#\d+, _block)#", x) or "BroadcastNestedLoopJoin" in x]


def watched(monkeypatch):
    """What is broadcast for the states that are kept from here on."""
    found = []
    for module in (edits, files, forest):
        for name in ("checkpointed", "written"):
            if hasattr(module, name):
                kept = getattr(module, name)
                monkeypatch.setattr(module, name, lambda df, kept=kept: (found.extend(broadcasts(df)), kept(df))[1])
    return found


def test_pairs_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Pairs (S4) whose names rise and fall along edges, some closing cycles: neither words nor states go through the driver."""
    found = watched(monkeypatch)
    rows = [(i // 4, i) for i in range(1, 120)] + [(i, i // 4) for i in range(4, 120, 11)] + [(200, 201), (201, 202), (202, 200)]
    (tmp_path / "pairs.tsv").write_text("".join(f"w{a}\tw{b}\tN:N\tx\n" for a, b in rows))
    bundle = files.read_pairs_unimorph(spark, str(tmp_path), on_err="continue")
    assert bundle.relations.where("ord = 0").count() == 119 + 2
    assert sorted(r.line_no for r in bundle.errors.collect()) == [*range(120, 120 + len(range(4, 120, 11))), len(rows)]
    for frame in (bundle.lexemes, bundle.relations, bundle.errors):
        found += broadcasts(frame)
    assert not found


def test_variants_are_not_broadcast(spark, monkeypatch):
    """Sets and places of variants (E16, E17) are merged."""
    found = watched(monkeypatch)
    edges = spark.range(1, 200).selectExpr("id AS node", "nullif(id div 4, 0) AS parent")
    sets = edges.where("parent IS NOT NULL AND node % 3 = 0").selectExpr("parent AS set_id", "node", "node AS seq")
    made = edits.merge_labelled_variants(edges, sets)
    members = {}
    for node in range(4, 200):
        if node % 3 == 0:
            members.setdefault(node // 4, []).append(node)
    rep = {node: m[0] for m in members.values() for node in m[1:]}
    assert {(r.node, r.parent, r.label) for r in made.collect()} == {(n, rep.get(n, rep.get(n // 4, n // 4 or None)), "Variant" if n in rep else None) for n in range(1, 200)}
    merged = edits.merge_variants(edges, sets)
    assert merged.count() == 199
    found += broadcasts(made) + broadcasts(merged)
    assert not found
