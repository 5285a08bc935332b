"""Operators on tables of many homonyms, whose work or files must not grow with the square of them."""

import time
from collections import Counter

from pyspark.sql import functions as F

from wordgrove.operators import edits, forest
from wordgrove.operators import lookup as op
from wordgrove.operators import resolve as rs


def test_references_of_a_key_lie_together(spark):
    refs = spark.range(400).select(F.col("id").alias("ref_id"), (F.col("id") % 10).cast("string").alias("lemma")).repartition(4)
    lexemes = spark.range(90).select(F.col("id").alias("node"), F.col("id").alias("seq"), (F.col("id") % 9).cast("string").alias("lemma"))
    hit, missing = rs.resolve(refs, lexemes, ["lemma"], "all")
    rows = hit.withColumn("part", F.spark_partition_id()).collect()
    assert {(r.ref_id, r.node) for r in rows} == {(a, b) for a in range(400) for b in range(90) if a % 10 == b % 9}
    assert len(rows) == 360 * 10
    # one key, one part: in files, its nodes are the same run again and again
    assert len({(r.ref_id % 10, r.part) for r in rows}) == 9
    assert sorted(r.ref_id for r in missing.collect()) == list(range(9, 400, 10))


def test_many_layers_keep_plans_small(spark):
    # while fronts were checkpoints of one another, what was known of their columns doubled with every layer
    f = spark.range(2000).select(F.col("id").alias("node"), F.when(F.col("id") % 37 != 0, F.floor(F.col("id") / 2).cast("long")).alias("parent"))
    second = f.where("node > 0").select(F.floor(F.col("node") / 3).cast("long").alias("source"), F.col("node").alias("target"))
    relations = f.where("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("node").alias("target")).unionByName(second)
    start = time.time()
    found = {r.node for r in forest.has_ancestor(relations, f.select("node"), f.where("node = 1").select("node")).collect()}
    assert time.time() - start < 60
    expected = {1}
    for n in range(2, 2000):
        if n // 3 in expected or (n % 37 and n // 2 in expected):
            expected.add(n)
    assert found == expected - {1}


def largest_count(df, metric="numOutputRows"):
    """The most rows that an operator of the executed plan gave out, or another of its figures."""
    df.write.format("noop").mode("overwrite").save()
    rows, plans = [], [df._jdf.queryExecution().executedPlan()]
    df.collect()
    while plans:
        plan = plans.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
            continue
        if hasattr(plan, "plan") and plan.getClass().getSimpleName().endswith("QueryStageExec"):
            plans.append(plan.plan())
        found = plan.metrics().get(metric)
        rows += [found.get().value()] if found.isDefined() else []
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return max(rows, default=0)


def homonyms(spark, n, words=4):
    return spark.range(n).select(
        F.col("id").alias("node"), (n - F.col("id")).alias("seq"), (F.col("id") % words).cast("string").alias("lemma"), (F.col("id") % 5).cast("string").alias("pos"), F.concat(F.lit("l"), (F.col("id") % 20).cast("string")).alias("lemid")
    )


def test_preferred_node_is_found_by_lemma(spark):
    lexemes = homonyms(spark, 400)
    refs = spark.range(500).select(F.col("id").alias("ref_id"), (F.col("id") % 5).cast("string").alias("lemma"))
    preferred = spark.createDataFrame([("0", "l8"), ("1", "l2")], "lemma string, lemid string")
    found = rs.resolve_preferring(refs, lexemes, preferred, "3")
    rows = [(i, 400 - i, str(i % 4), str(i % 5), f"l{i % 20}") for i in range(400)]
    wanted = {"0": "l8", "1": "l2"}
    best = {w: min((lemid != wanted.get(w), pos != "3", seq, node) for node, seq, lemma, pos, lemid in rows if lemma == w)[3] for w in "0123"}
    assert {r.ref_id: r.node for r in found.collect()} == {i: best[str(i % 5)] for i in range(500) if i % 5 < 4}
    assert largest_count(found) <= 500


def test_best_pair_is_found_by_lemmas(spark):
    lexemes = homonyms(spark, 240).withColumn("homonym", F.when(F.col("node") % 7 != 0, F.col("node") % 3)).withColumn("parent", F.when(F.col("node") % 11 != 0, F.floor(F.col("node") / 6).cast("long")))
    pairs = spark.range(60).select(F.col("id").alias("pair_id"), (F.col("id") % 5).cast("string").alias("source"), F.floor(F.col("id") / 15).cast("string").alias("target"))
    edges = lexemes.where("node < 12").select("node", "parent")
    rows = [r.asDict() for r in lexemes.collect()]
    linked = {(r.node, r.parent) for r in edges.collect()}

    def key(s, t):
        equal = s["homonym"] is not None and s["homonym"] == t["homonym"]
        rank = 0 if (t["node"], s["node"]) in linked else 1 if equal else 2 if t["parent"] is None else 3
        return rank, s["seq"], t["seq"], s["node"], t["node"]

    found = rs.best_pair(pairs, lexemes, edges)
    best = {(a, b): min(key(s, t) for s in rows for t in rows if s["lemma"] == a and t["lemma"] == b) for a in "0123" for b in "0123"}
    expected = {(p, k[3], k[4], k[0]) for p in range(60) if p % 5 < 4 for k in [best[str(p % 5), str(p // 15)]]}
    assert {tuple(r) for r in found.select("pair_id", "source_node", "target_node", "rank").collect()} == expected
    assert largest_count(found) <= 300


def test_external_parents_are_told_once(spark):
    nodes = homonyms(spark, 120).select("node", "lemma")
    # a node of two lemmas, and one that stands twice
    nodes = nodes.unionByName(spark.createDataFrame([(7, "0"), (8, "0")], "node long, lemma string"))
    edges = spark.range(120).select(F.col("id").alias("node"), F.when(F.col("id") % 5 != 0, F.col("id") - F.col("id") % 5).alias("parent"))
    pairs = spark.createDataFrame([("0", "3"), ("0", "0"), ("1", "0"), ("0", "0")], "child string, parent string")
    placed = spark.range(120).select(F.col("id").alias("node"), (F.col("id") - F.col("id") % 5).alias("root"))
    found = rs.external_parents(edges, nodes, pairs, placed)
    rows = [tuple(r) for r in found.collect()]
    lemmas = {n: {str(n % 4)} | ({"0"} if n == 7 else set()) for n in range(120)}
    met = {("0", "3"), ("0", "0"), ("1", "0")}
    expected = {(t, p) for t in range(0, 120, 5) for p in range(120) if p - p % 5 != t and any((a, b) in met for a in lemmas[t] for b in lemmas[p])}
    assert set(rows) == expected and len(rows) == len(expected)
    # what comes out isn't shuffled again
    assert largest_count(found, "shuffleRecordsWritten") < len(rows)


def test_unique_references_meet_no_homonyms(spark):
    lexemes = homonyms(spark, 400).unionByName(homonyms(spark, 1).withColumn("lemma", F.lit("one")))
    refs = spark.range(300).select(F.col("id").alias("ref_id"), F.when(F.col("id") == 3, "one").otherwise((F.col("id") % 5).cast("string")).alias("lemma"))
    hit, rest = rs.resolve(refs, lexemes, ["lemma"], "unique_only")
    assert [tuple(r) for r in hit.collect()] == [(3, 0)]
    assert {tuple(r) for r in rest.collect()} == {(i, "missing" if i % 5 == 4 else "ambiguous") for i in range(300) if i != 3}
    assert largest_count(rest) <= 401
    first = rs.resolve(refs, lexemes, ["lemma"])[0]
    assert {tuple(r) for r in first.collect()} == {(i, 0 if i == 3 else 396 + i % 5) for i in range(300) if i % 5 < 4}


def test_lookup_meets_only_what_fits(spark):
    lexemes = homonyms(spark, 200).select("node", "lemma", "pos", F.when(F.col("node") % 9 != 0, (F.col("node") % 7).cast("string")).alias("tech"))
    made = [(i, str(i % 5), str(i % 5) if i % 3 else None, [str(i % 8), "none", None][i % 7 % 3]) for i in range(40)]
    keys = spark.createDataFrame([*made, (0, "1", "1", "none"), (None, "2", "2", "none")], "key_id long, lemma string, pos string, tech string")
    rows, asked = [tuple(r) for r in lexemes.collect()], [tuple(r) for r in keys.collect()]
    met = [(k, r) for k in asked for r in rows if k[1] == r[1] and (k[2] is None or k[2] == r[2])]
    exact = op.lookup(lexemes, keys, ["lemma", "pos"])
    assert Counter(tuple(r) for r in exact.collect()) == Counter((k[0], *r) for k, r in met)
    hit = lambda k, r: k[3] is None or r[3] is None or k[3] == r[3]
    some = {k[0] for k, r in met if hit(k, r)}
    fuzzy = op.lookup(lexemes, keys, ["lemma", "pos", "tech"], fuzzy="tech")
    assert Counter(tuple(r) for r in fuzzy.collect()) == Counter((k[0], *r) for k, r in met if hit(k, r) or k[0] not in some)
    # what comes out isn't shuffled
    many = spark.range(100).select(F.col("id").alias("key_id"), (F.col("id") % 4).cast("string").alias("lemma"), F.lit("none").alias("tech"))
    wide = op.lookup(lexemes.where("tech IS NOT NULL"), many, ["lemma", "tech"], fuzzy="tech")
    assert wide.count() > 2000
    assert largest_count(wide, "shuffleRecordsWritten") <= 400
    # nothing is met that doesn't fit
    both = many.select("key_id", "lemma", F.lit("1").alias("pos"))
    assert largest_count(op.lookup(lexemes, both, ["lemma", "pos"])) <= 1000


def test_pairs_of_a_cluster_come_out_once(spark):
    rows = [(n % 2, n, ["xab", "yb", "zcd", "d"][n % 4], "N") for n in range(80)]
    members = spark.createDataFrame(rows, "cluster long, node long, lemma string, pos string")
    rules = [("N", "b", "N", "d", False), ("N", "ab", "N", "cd", False), ("N", "b", "N", "b", True), ("N", "ab", "N", "b", False)]
    patterns = spark.createDataFrame(rules, "source_pos string, source_suffix string, target_pos string, target_suffix string, drop boolean")
    found = edits.restructure_clusters(members, patterns)
    out = [tuple(r) for r in found.select("cluster", "node", "parent", "drop").collect()]
    expected = {(c, b, a, r[4]) for c, a, x, _ in rows for d, b, y, _ in rows for r in rules if c == d and a != b and x.endswith(r[1]) and y.endswith(r[3])}
    assert set(out) == expected and len(out) == len(expected)
    assert largest_count(found, "shuffleRecordsWritten") < len(out) / 2
