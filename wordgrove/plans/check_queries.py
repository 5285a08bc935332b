"""Registered queries for validation, comparison, scores, labels and morphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordgrove.operators import diff as df_
from wordgrove.operators import ml
from wordgrove.operators import morphs as mo
from wordgrove.operators import score as sc
from wordgrove.operators import validate as va
from wordgrove.plans.bindings import F2_SQL, F_SQL, FOREST_SQL, W_SQL, forest, forest2, table, words
from wordgrove.plans.registry import query


@query("v02_check_file", f"WITH {F_SQL}, x AS (SELECT node, n, node % 10 AS k, node // 10 AS t FROM f) SELECT node * 2 AS line_no, CASE WHEN (t + 1) * 10 IN (SELECT node FROM f) THEN 'parent in another tree' ELSE 'unknown parent' END AS problem FROM x WHERE k > 0 AND n % 5 = 0 "
       "UNION ALL SELECT node * 2, CASE n % 7 WHEN 0 THEN 'missing type' ELSE 'unknown type' END FROM x WHERE k > 0 AND n % 7 < 2 UNION ALL SELECT node * 2, 'duplicate id' FROM x WHERE k = 4 AND n % 3 = 0")
def v02(spark, sf_dir):
    node, tree, k, n = F.col("node"), F.floor(F.col("node") / 10), F.col("node") % 10, F.col("n")
    named = lambda t, i: F.concat_ws(".", t.cast("string"), i.cast("string"))
    own = named(tree, F.when((k == 4) & (n % 3 == 0), k - 1).otherwise(k))
    parent = F.when(k == 0, "").when(n % 5 == 0, named(tree + 1, F.lit(0))).otherwise(named(tree, F.lit(0)))
    kind = F.when((k == 0) | (n % 7 == 0), "").when(n % 7 == 1, "Type=Odd").otherwise("Type=Derivation")
    value = F.concat_ws("\t", own, "lemma", "lemma", "pos", F.lit(""), F.lit(""), parent, kind, F.lit(""), F.lit("{}"))
    f = forest(spark, sf_dir)
    blanks = f.where("node % 10 = 0").select((node * 2 - 1).alias("line_no"), F.lit("").alias("value"))
    return va.check_file(f.select((node * 2).alias("line_no"), value.alias("value")).unionByName(blanks))


@query("v03_check_rules", f"WITH {F_SQL} SELECT node, unnest(list_filter([CASE WHEN parent IS NULL AND n > 40 THEN 'root too big' END, CASE WHEN pos = 'SMALL' AND n > 20 THEN 'small but large' END, CASE WHEN starts_with(lemma, 'red') AND n % 2 = 0 THEN 'even red' END], lambda x: x IS NOT NULL)) AS rule FROM f")
def v03(spark, sf_dir):
    rules = [("root too big", F.col("parent").isNull() & (F.col("n") > 40)), ("small but large", (F.col("pos") == "SMALL") & (F.col("n") > 20)), ("even red", F.startswith("lemma", F.lit("red")) & (F.col("n") % 2 == 0))]
    return va.check_rules(forest(spark, sf_dir), "node", rules)


@query("v04_count_inversions", f"WITH {F_SQL}, g AS (SELECT o::DOUBLE AS \"offset\", r::DOUBLE AS ratio FROM (VALUES (0), (5)) a(o), (VALUES (1), (2)) b(r)) SELECT f.node, f.parent, g.\"offset\", g.ratio, f.n::DOUBLE / (g.\"offset\" + p.n) AS score FROM f JOIN f p ON p.node = f.parent, g WHERE f.n::DOUBLE / (g.\"offset\" + p.n) > g.ratio")
def v04(spark, sf_dir):
    return va.count_inversions(forest(spark, sf_dir), [0, 5], [1, 2])


@query("v05_check_enumerated", f"WITH RECURSIVE {F_SQL}, c(node, top) AS (SELECT node, parent FROM f WHERE parent IS NOT NULL UNION SELECT c.node, f.parent FROM c JOIN f ON f.node = c.top WHERE f.parent IS NOT NULL) SELECT f.node, f.lemma FROM f WHERE ends_with(f.lemma, 'ring') AND f.n % 10 <> 0 AND f.n % 7 <> 1 AND f.node NOT IN (SELECT c.node FROM c JOIN f l ON l.node = c.top WHERE l.n % 7 = 1)")
def v05(spark, sf_dir):
    f = forest(spark, sf_dir)
    relations = f.where("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("node").alias("target"))
    return va.check_enumerated(f, relations, "ring$", f.where("n % 7 = 1"), f.where("n % 10 = 0"))


@query("v06_check_root_counts", f"WITH {F_SQL}, k AS (SELECT node, parent, n % 4 = 0 AS c, 1 + n % 2 AS m FROM f) SELECT k.node, k.parent, k.m AS root_morphs, p.m AS parent_roots FROM k JOIN k p ON p.node = k.parent WHERE (NOT k.c AND k.m <> p.m) OR (k.c AND k.m <= p.m)")
def v06(spark, sf_dir):
    f = forest(spark, sf_dir)
    return va.check_root_counts(f.withColumn("is_compound", F.col("n") % 4 == 0), f.select("node", (F.col("n") % 2 + 1).alias("root_morphs")))


@query("v07_roundtrip_diff", f"WITH {F_SQL}, {F2_SQL} SELECT *, 'first' AS side FROM (SELECT node, parent FROM f EXCEPT ALL SELECT node, parent FROM f2) UNION ALL SELECT *, 'second' FROM (SELECT node, parent FROM f2 EXCEPT ALL SELECT node, parent FROM f)")
def v07(spark, sf_dir):
    return va.roundtrip_diff(forest(spark, sf_dir).select("node", "parent"), forest2(spark, sf_dir).select("node", "parent"))


LINK_SQL = f"""WITH {F_SQL}, {F2_SQL}, a0 AS (SELECT node, lemma, pos, n, row_number() OVER (PARTITION BY lemma, pos, n ORDER BY node) AS k FROM f), b0 AS (SELECT node, lemma, pos, n, row_number() OVER (PARTITION BY lemma, pos, n ORDER BY node) AS k FROM f2),
l0 AS (SELECT a0.node AS old_id, b0.node AS new_id, 0 AS level FROM a0 JOIN b0 USING (lemma, pos, n, k)),
a1 AS (SELECT node, lemma, n, row_number() OVER (PARTITION BY lemma, n ORDER BY node) AS k FROM f WHERE node NOT IN (SELECT old_id FROM l0)), b1 AS (SELECT node, lemma, n, row_number() OVER (PARTITION BY lemma, n ORDER BY node) AS k FROM f2 WHERE node NOT IN (SELECT new_id FROM l0)),
l1 AS (SELECT a1.node AS old_id, b1.node AS new_id, 1 AS level FROM a1 JOIN b1 USING (lemma, n, k)), l AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1)"""


def versions(spark, sf_dir):
    return df_.link_versions(forest(spark, sf_dir), forest2(spark, sf_dir), [["lemma", "pos", "n"], ["lemma", "n"]])


@query("d01_link_versions", LINK_SQL + " SELECT old_id, new_id, level FROM l UNION ALL SELECT node, NULL, NULL FROM f WHERE node NOT IN (SELECT old_id FROM l) UNION ALL SELECT NULL, node, NULL FROM f2 WHERE node NOT IN (SELECT new_id FROM l)")
def d01(spark, sf_dir):
    return versions(spark, sf_dir)


@query("d02_diff_edges", LINK_SQL + " SELECT l.old_id, l.new_id, CASE WHEN f.parent IS NULL AND f2.parent IS NULL THEN 'none' WHEN f.parent IS NULL THEN 'connected' WHEN f2.parent IS NULL THEN 'disconnected' WHEN p.new_id = f2.parent THEN 'same' ELSE 'reconnected' END AS change FROM l JOIN f ON f.node = l.old_id JOIN f2 ON f2.node = l.new_id LEFT JOIN l p ON p.old_id = f.parent")
def d02(spark, sf_dir):
    return df_.diff_edges(forest(spark, sf_dir), forest2(spark, sf_dir), versions(spark, sf_dir))


@query("d03_missing_in", f"WITH {F_SQL}, {F2_SQL} SELECT node, lemma FROM f WHERE NOT EXISTS (SELECT 1 FROM f2 WHERE f2.lemma = f.lemma AND f2.n = f.n)")
def d03(spark, sf_dir):
    return df_.missing_in(forest(spark, sf_dir).select("node", "lemma", "n"), forest2(spark, sf_dir), ["lemma", "n"]).select("node", "lemma")


#: Gold decisions: the other version's parents, some of them replaced by marks, alternatives and compounds; x has names without spaces, as those join the words of a compound.
GOLD_SQL = f"""{FOREST_SQL}, {F2_SQL}, x AS (SELECT node, parent, n, pos, replace(lemma, ' ', '_') || '/' || node AS lemma FROM f), rel AS (SELECT a.node, CASE WHEN a.n % 4 = 0 THEN 'C:' || p.lemma || ' ' || q.lemma ELSE 'D:' || p.lemma END AS key FROM x a JOIN x p ON p.node = a.parent JOIN x q ON q.node = a.node // 9),
y AS (SELECT a.node, a.n, replace(a.lemma, ' ', '_') || '/' || a.node AS lemma, replace(b.lemma, ' ', '_') || '/' || b.node AS up, replace(q.lemma, ' ', '_') || '/' || q.node AS other FROM f2 a LEFT JOIN f2 b ON b.node = a.parent JOIN f2 q ON q.node = a.node // 9),
gold AS (SELECT CASE WHEN n % 11 = 0 THEN 'gone/' || node ELSE lemma END AS lemma, CASE WHEN n % 13 = 0 THEN '?' WHEN n % 11 = 0 AND n % 2 = 0 OR n = 1 THEN '!' WHEN up IS NULL OR n % 7 = 0 THEN '-' WHEN n % 3 = 0 THEN up || ', ' || split_part(lemma, '/', 1) || '/' || (node // 4) WHEN n % 4 = 0 THEN up || ' ' || other || ', -' ELSE up END AS decision FROM y),
g AS (SELECT g.lemma, g.decision, x.node, list_transform(string_split(g.decision, ', '), lambda k: CASE WHEN k = '-' THEN k WHEN contains(k, ' ') THEN 'C:' || k ELSE 'D:' || k END) AS keys FROM gold g LEFT JOIN x ON x.lemma = g.lemma WHERE g.decision <> '?'),
j AS (SELECT g.*, rel.key FROM g LEFT JOIN rel ON rel.node = g.node WHERE g.node IS NOT NULL AND g.decision <> '!'), wd AS (SELECT node, unnest(string_split(substr(k, 3), ' ')) AS lemma FROM (SELECT node, unnest(keys) AS k FROM j) WHERE k <> '-'),
met AS (SELECT DISTINCT wd.node FROM wd JOIN x ON x.lemma = wd.lemma JOIN r a ON a.node = wd.node JOIN r b ON b.node = x.node WHERE a.root = b.root),
ij AS (SELECT lemma, decision, CASE WHEN key IS NULL THEN CASE WHEN list_contains(keys, '-') THEN 'tn' ELSE 'fn' END WHEN list_contains(keys, key) THEN 'tp' ELSE 'fp' END AS outcome, node, key FROM j),
det AS (SELECT 'lexeme' AS scope, lemma, decision, CASE WHEN node IS NULL THEN CASE WHEN decision = '!' THEN 'tn' ELSE 'fn' END WHEN decision = '!' THEN 'fp' ELSE 'tp' END AS outcome FROM g
  UNION ALL SELECT 'gold', lemma, decision, 'fn' FROM g WHERE node IS NULL AND decision NOT IN ('!', '-') UNION ALL SELECT s, lemma, decision, outcome FROM ij, (VALUES ('internal'), ('gold')) v(s)
  UNION ALL SELECT 'cluster', lemma, decision, CASE WHEN keys = ['-'] THEN CASE WHEN key IS NULL THEN 'tn' ELSE 'fp' END WHEN met.node IS NOT NULL THEN 'tp' WHEN key IS NULL THEN 'fn' ELSE 'fp' END FROM j LEFT JOIN met ON met.node = j.node)"""


def judged(spark, sf_dir):
    """The details of the forest, some of its relations being compounds, against decisions taken from its other version."""
    named = lambda c, k: F.concat(F.replace(c, F.lit(" "), F.lit("_")), F.lit("/"), F.col(k).cast("string"))
    ninth = F.floor(F.col("node") / 9).cast("long")
    f, f2, n = forest(spark, sf_dir), forest2(spark, sf_dir), F.col("n")
    nodes = f.select("node", "pos", named("lemma", "node").alias("lemma"))
    compound = n % 4 == 0
    relations = f.where("parent IS NOT NULL").select(
        F.col("node").alias("target"), F.lit(0).alias("ord"), F.when(compound, "Compounding").otherwise("Derivation").alias("type"), F.col("parent").alias("main"), F.when(compound, F.array(F.col("parent"), ninth)).otherwise(F.array("parent")).alias("sources")
    )
    names = f2.select("node", named("lemma", "node").alias("name"))
    up = names.select(F.col("node").alias("parent"), F.col("name").alias("up"))
    second = names.select(F.col("node").alias("ninth"), F.col("name").alias("other"))
    y = f2.join(up, "parent", "left").withColumn("ninth", ninth).join(second, "ninth").select("node", "n", named("lemma", "node").alias("lemma"), "up", "other")
    either = F.concat("up", F.lit(", "), F.split_part("lemma", F.lit("/"), F.lit(1)), F.lit("/"), F.floor(F.col("node") / 4).cast("string"))
    decision = F.when(n % 13 == 0, "?").when((n % 11 == 0) & (n % 2 == 0) | (n == 1), "!").when(F.col("up").isNull() | (n % 7 == 0), "-").when(n % 3 == 0, either).when(compound, F.concat("up", F.lit(" "), "other", F.lit(", -"))).otherwise(F.col("up"))
    lemma = F.when(n % 11 == 0, F.concat(F.lit("gone/"), F.col("node").cast("string"))).otherwise(F.col("lemma"))
    return sc.score_details(nodes, relations, y.select(lemma.alias("lemma"), decision.alias("decision")))


@query("g01_score_details", GOLD_SQL + " SELECT scope, lemma, decision, outcome FROM det")
def g01_details(spark, sf_dir):
    return judged(spark, sf_dir).select("scope", "lemma", "decision", "outcome")


METRICS_SQL = ", s AS (SELECT scope, count(*) FILTER (WHERE outcome = 'tp')::DOUBLE AS tp, count(*) FILTER (WHERE outcome = 'fp')::DOUBLE AS fp, count(*) FILTER (WHERE outcome = 'tn')::DOUBLE AS tn, count(*) FILTER (WHERE outcome = 'fn')::DOUBLE AS fn FROM det GROUP BY scope)"


@query(
    "g01_score",
    GOLD_SQL + METRICS_SQL + " SELECT scope, 'precision' AS metric, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS value FROM s UNION ALL SELECT scope, 'recall', CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1 END FROM s "
    "UNION ALL SELECT scope, 'specificity', CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 1 END FROM s UNION ALL SELECT scope, 'accuracy', (tp + tn) / (tp + fp + tn + fn) FROM s UNION ALL SELECT scope, 'f1', CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END FROM s",
)
def g01(spark, sf_dir):
    return sc.score(judged(spark, sf_dir))


@query("g02_score_by_creator", GOLD_SQL + " SELECT f.pos AS creator, count(*) FILTER (WHERE outcome = 'tp') AS correct, count(*) FILTER (WHERE outcome = 'fp') AS incorrect, (count(*) FILTER (WHERE outcome = 'tp'))::DOUBLE / count(*) AS precision FROM ij JOIN f ON f.node = ij.node WHERE key IS NOT NULL GROUP BY f.pos")
def g02(spark, sf_dir):
    return sc.score_by_creator(judged(spark, sf_dir), forest(spark, sf_dir).select("node", F.col("pos").alias("creator")))


#: Two segmentations of words: cut after 2 and 4 letters, and after 2 and 5.
SEG_SQL = f"WITH {W_SQL}, sg AS (SELECT lemma, min(pos) AS pos, array_to_string(list_filter([left(lemma, 2), substr(lemma, 3, 2), substr(lemma, 5)], lambda x: x <> ''), '-') AS a, array_to_string(list_filter([left(lemma, 2), substr(lemma, 3, 3), substr(lemma, 6)], lambda x: x <> ''), '-') AS b FROM w GROUP BY lemma)"


def segmented(spark, sf_dir):
    cut = lambda *p: F.array_join(F.filter(F.array(*[F.expr(x) for x in p]), lambda x: x != ""), "-")
    one = words(spark, sf_dir).groupBy("lemma").agg(F.min("pos").alias("pos"))
    return one.select("lemma", "pos", cut("substring(lemma, 1, 2)", "substring(lemma, 3, 2)", "substring(lemma, 5)").alias("a"), cut("substring(lemma, 1, 2)", "substring(lemma, 3, 3)", "substring(lemma, 6)").alias("b"))


def sides(spark, sf_dir):
    s = segmented(spark, sf_dir)
    return [s.select(F.col("lemma").alias("word"), "pos", F.col(c).alias("segments")) for c in "ab"]


BITS_SQL = ", bt AS (SELECT lemma, pos, a, b, list_transform(range(1, length(lemma) + 1), lambda i: CASE WHEN i < length(lemma) AND i IN (2, 4) THEN 1 ELSE 0 END) AS x, list_transform(range(1, length(lemma) + 1), lambda i: CASE WHEN i < length(lemma) AND i IN (2, 5) THEN 1 ELSE 0 END) AS y FROM sg)"


@query("g03_seg_score", SEG_SQL + ", d AS (SELECT pos, length(lemma) AS n, (length(lemma) > 2)::INTEGER AS hit, (length(lemma) > 2)::INTEGER + (length(lemma) > 4)::INTEGER AS gold, (length(lemma) > 2)::INTEGER + (length(lemma) > 5)::INTEGER AS guess, "
       "CASE WHEN length(lemma) <= 4 THEN 0 WHEN length(lemma) = 5 THEN 1 ELSE 2 END AS worst, a, b FROM sg), tt AS (SELECT pos, sum(hit)::DOUBLE AS hit, sum(gold)::DOUBLE AS gold, sum(guess)::DOUBLE AS guess FROM d GROUP BY ROLLUP (pos)) SELECT pos, hit / guess AS precision, hit / gold AS recall, 2 * (hit / guess) * (hit / gold) / (hit / guess + hit / gold) AS f1 FROM tt")
def g03(spark, sf_dir):
    a, b = sides(spark, sf_dir)
    # DuckDB counts edit distance in bytes, so the mean distance is left to the tests
    return sc.seg_score(a, b, "pos").drop("mean_distance")


def bits(spark, sf_dir):
    return [s.select("word", mo.to_boundaries(F.col("segments")).alias("bits")) for s in sides(spark, sf_dir)]


@query("g04_agreement", SEG_SQL + BITS_SQL + " SELECT count(*) AS words, avg((x = y)::INTEGER) AS exact, avg((len(list_filter(list_zip(x, y), lambda p: p[1] > p[2])) = 0 OR len(list_filter(list_zip(x, y), lambda p: p[2] > p[1])) = 0)::INTEGER) AS nested FROM bt")
def g04(spark, sf_dir):
    return sc.agreement(*bits(spark, sf_dir))


@query("g05_boundary_score", SEG_SQL + BITS_SQL + ", tt AS (SELECT avg((x = y)::INTEGER) AS word_accuracy, sum(list_sum(list_transform(list_zip(x, y), lambda p: p[1] * p[2])))::DOUBLE AS hit, sum(list_sum(x))::DOUBLE AS gold, sum(list_sum(y))::DOUBLE AS guess FROM bt) SELECT word_accuracy, hit / guess AS precision, hit / gold AS recall, 2 * (hit / guess) * (hit / gold) / (hit / guess + hit / gold) AS f1 FROM tt")
def g05(spark, sf_dir):
    return sc.boundary_score(*bits(spark, sf_dir))


@query("g06_confusion", "SELECT quality AS truth, toxic AS predicted, count(*) AS n FROM labels GROUP BY quality, toxic")
def g06(spark, sf_dir):
    return sc.confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("g06_one_vs_rest", f"WITH {F_SQL}, p AS (SELECT pos AS truth, CASE WHEN n % 4 = 0 THEN 'SMALL' ELSE pos END AS predicted FROM f), l AS (SELECT DISTINCT truth AS label FROM p), e AS (SELECT label, (SELECT count(*) FROM p WHERE truth = label AND predicted = label)::DOUBLE / (SELECT count(*) FROM p WHERE predicted = label) AS precision, (SELECT count(*) FROM p WHERE truth = label AND predicted = label)::DOUBLE / (SELECT count(*) FROM p WHERE truth = label) AS recall FROM l), "
       "x AS (SELECT label, precision, recall, 2 * precision * recall / (precision + recall) AS f1 FROM e) SELECT * FROM x UNION ALL SELECT 'macro', avg(precision), avg(recall), avg(f1) FROM x")
def g06_rest(spark, sf_dir):
    return sc.one_vs_rest(forest(spark, sf_dir).withColumn("predicted", F.when(F.col("n") % 4 == 0, "SMALL").otherwise(F.col("pos"))), "pos", "predicted")


def labelled_pairs(spark, sf_dir):
    f = forest(spark, sf_dir)
    up = f.select(F.col("node").alias("parent"), F.col("lemma").alias("a"), F.col("pos").alias("a_pos"))
    label = F.when(F.endswith("lemma", F.lit("ring")), "ring").when(F.col("pos") == "SMALL", "small")
    return f.join(up, "parent").select("node", "a", "a_pos", F.col("lemma").alias("b"), F.col("pos").alias("b_pos"), label.alias("label"))


PAIR_SQL = f"WITH {F_SQL}, pr AS (SELECT f.node, p.lemma AS a, p.pos AS a_pos, f.lemma AS b, f.pos AS b_pos FROM f JOIN f p ON p.node = f.parent)"


@query("l01_pair_features", PAIR_SQL + " SELECT node, " + ", ".join(f"CASE WHEN length({s}) >= {k} THEN left({s}, {k}) ELSE 'NA' END AS {s}_prefix_{k}, CASE WHEN length({s}) >= {k} THEN right({s}, {k}) ELSE 'NA' END AS {s}_suffix_{k}" for s in "ab" for k in (1, 2)) + ", lower(left(a, 2)) = lower(left(b, 2)) AS same_start, right(a, 1) = right(b, 1) AS same_end FROM pr")
def l01(spark, sf_dir):
    return ml.pair_features(labelled_pairs(spark, sf_dir).drop("label"), 2).drop("a", "b", "a_pos", "b_pos")


@query("l02_baseline_label", PAIR_SQL + " SELECT node, CASE WHEN right(b, 4) = 'ring' THEN 'ring' WHEN a_pos = b_pos THEN 'same' ELSE 'NONE' END AS predicted FROM pr")
def l02(spark, sf_dir):
    return ml.baseline_label(labelled_pairs(spark, sf_dir), [("ring", F.right("b", F.lit(4)) == "ring"), ("same", F.col("a_pos") == F.col("b_pos"))]).select("node", "predicted")


@query("l03_predict_labels")
def l03(spark, sf_dir):
    features = ml.pair_features(labelled_pairs(spark, sf_dir), 3)
    columns = ["b_suffix_3", "b_pos"]
    train, _ = ml.split_rows(features, ["node"])
    model = ml.fit_labeller(ml.drop_rare(train, columns), columns)
    return ml.predict_labels(model, ml.drop_rare(features, columns)).select("node", "label", "predicted", "chance")


@query("l04_apply_thresholds", "SELECT doc_id, CASE WHEN quality = 1 AND c < 0.5 THEN 'NONE' WHEN quality = 0 AND c < 0.25 THEN 'NONE' ELSE quality::VARCHAR END AS predicted FROM (SELECT doc_id, quality, (doc_id % 10)::DOUBLE / 10 AS c FROM labels)")
def l04(spark, sf_dir):
    predicted = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("predicted"), ((F.col("doc_id") % 10).cast("double") / 10).alias("chance"))
    return ml.apply_thresholds(predicted, {"1": 0.5, "0": 0.25}).select("doc_id", "predicted")


def lex_of(spark, sf_dir):
    return segmented(spark, sf_dir).select(F.col("lemma").alias("lex_id"), "lemma")


@query("m01_complete_morphs", SEG_SQL + " SELECT lemma AS lex_id, 0 AS start, 2 AS \"end\", left(lemma, 2) AS morph, 'Root' AS type FROM sg WHERE length(lemma) > 4 UNION ALL SELECT lemma, 2, 4, substr(lemma, 3, 2), 'Implicit' FROM sg WHERE length(lemma) > 4 UNION ALL SELECT lemma, 4, length(lemma)::INTEGER, substr(lemma, 5), 'Unknown' FROM sg WHERE length(lemma) > 4 UNION ALL SELECT lemma, 0, length(lemma)::INTEGER, lemma, 'Implicit' FROM sg WHERE length(lemma) <= 4")
def m01(spark, sf_dir):
    lex = lex_of(spark, sf_dir)
    long = lex.where("length(lemma) > 4")
    head = long.select("lex_id", F.lit(0).alias("start"), F.lit(2).alias("end"), F.substring("lemma", 1, 2).alias("morph"), F.lit("Root").alias("type"))
    tail = long.select("lex_id", F.lit(4).alias("start"), F.length("lemma").alias("end"), F.lit(None).cast("string").alias("morph"), F.lit(None).cast("string").alias("type"))
    return mo.complete_morphs(lex, head.unionByName(tail))[0]


@query("m02_infer_offsets", SEG_SQL + " SELECT lemma, '0-2,2-' || least(4, greatest(length(lemma), 2)) || ',4-' || greatest(length(lemma), 4) AS spans FROM sg")
def m02(spark, sf_dir):
    morph = lambda s, e, m: F.struct(s.cast("int").alias("start"), e.cast("int").alias("end"), m.alias("morph"))
    none = F.lit(None)
    two = F.rpad(F.substring("lemma", 1, 2), 2, "_")
    made = F.array(morph(none, none, two), morph(none, none, F.expr("substring(lemma, 3, 2)")), morph(F.lit(4), none, F.expr("substring(lemma, 5)")))
    spans = F.array_join(F.transform(mo.infer_offsets(made), lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return segmented(spark, sf_dir).select("lemma", spans.alias("spans"))


@query("m03_drop_offsets", SEG_SQL + " SELECT lemma, '-:-,' || CASE WHEN length(lemma) % 2 = 0 THEN '-:-' ELSE '3:5' END AS spans FROM sg")
def m03(spark, sf_dir):
    morph = lambda s, e, m: F.struct(s.cast("int").alias("start"), e.cast("int").alias("end"), F.expr(m).alias("morph"))
    made = F.array(morph(F.lit(0), F.lit(2), "substring(lemma, 1, 2)"), morph(F.length("lemma") % 2 + 2, F.lit(5), "substring(lemma, 3, 3)"))
    bare = lambda m: F.concat(F.coalesce(m["start"].cast("string"), F.lit("-")), F.lit(":"), F.coalesce(m["end"].cast("string"), F.lit("-")))
    return segmented(spark, sf_dir).select("lemma", F.array_join(F.transform(mo.drop_offsets(made), bare), ",").alias("spans"))


BOUNDS_SQL = SEG_SQL + ", b AS (SELECT lemma AS lex_id, length(lemma) > 2 AS inside, length(lemma) % 3 = 0 AS differ FROM sg)"


def bounds(spark, sf_dir):
    lex = lex_of(spark, sf_dir)
    flag = lambda df, place, allowed: df.select("lex_id", F.lit(place).alias("place"), F.lit(allowed).alias("allowed"))
    return mo.merge_boundaries(lex, flag(lex, 2, True).unionByName(flag(lex.where("length(lemma) % 3 = 0"), 2, False)).unionByName(flag(lex, 99, True)))


@query("m04_merge_boundaries", BOUNDS_SQL + " SELECT lex_id, 2 AS place, inside AS allowed FROM b WHERE NOT differ OR NOT inside UNION ALL SELECT lex_id, 99, false FROM b")
def m04(spark, sf_dir):
    return bounds(spark, sf_dir)[0]


@query("m04_conflicts", BOUNDS_SQL + " SELECT lex_id, 2 AS place FROM b WHERE differ AND inside")
def m04_conflicts(spark, sf_dir):
    return bounds(spark, sf_dir)[1]


@query("m05_morphs_from_splits", SEG_SQL + ", e AS (SELECT lemma, unnest(string_split(a, '-')) AS morph, generate_subscripts(string_split(a, '-'), 1) AS i, len(string_split(a, '-')) AS n FROM sg) SELECT lemma, (CASE i WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 4 END) AS start, morph, CASE WHEN n = 1 THEN 'Root' WHEN i = 1 THEN 'Prefix' WHEN i = n THEN 'Suffix' ELSE 'Root' END AS type FROM e")
def m05(spark, sf_dir):
    return mo.morphs_from_splits(segmented(spark, sf_dir).select("lemma", F.replace("a", F.lit("-"), F.lit(" ")).alias("segments"))).select("lemma", "start", "morph", "type")


@query("m06_morphs_from_typed", SEG_SQL + " SELECT lemma || '/' || pos AS lex_id, 0 AS place, left(lemma, 2) AS morph, left(lemma, 2) AS morph_lemma, 'Prefix' AS type FROM sg UNION ALL SELECT lemma || '/' || pos, 1, substr(lemma, 3), lemma, 'Root' FROM sg")
def m06(spark, sf_dir):
    """One line for each word, which goes to its first homonym."""
    w = words(spark, sf_dir)
    lex = w.select(F.concat_ws("/", "lemma", "pos").alias("lex_id"), "lemma", F.col("pos").alias("seq"))
    lines = segmented(spark, sf_dir).select(F.lit(1).alias("line"), "lemma", F.concat(F.substring("lemma", 1, 2), F.lit(":"), F.substring("lemma", 1, 2), F.lit(":P|"), F.expr("substring(lemma, 3)"), F.lit(":"), "lemma", F.lit(":R")).alias("segments"))
    return mo.morphs_from_typed(lex, lines, {"P": "Prefix", "R": "Root"})


@query("m07_morphs_from_labels", SEG_SQL + ", e AS (SELECT lemma, unnest(string_split(a, '-')) AS morph, generate_subscripts(string_split(a, '-'), 1) AS i FROM sg) SELECT lemma, (CASE i WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 4 END) AS start, (CASE i WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 4 END + length(morph))::INTEGER AS \"end\", morph, CASE i WHEN 1 THEN 'P' WHEN 2 THEN 'R' END AS type FROM e")
def m07(spark, sf_dir):
    labelled = segmented(spark, sf_dir).select("lemma", F.translate(F.replace("a", F.lit("-"), F.lit(" ")), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("segments"), F.lit("P R").alias("labels"))
    return mo.morphs_from_labels(labelled).select("lemma", "start", "end", "morph", "type")


@query(
    "m08_project_roots",
    f"WITH RECURSIVE {F_SQL}, o AS (SELECT * FROM f WHERE n % 13 <> 0), al(a) AS (VALUES ('ring'), ('bolt')), hit AS (SELECT o.node, min(al.a) AS a FROM o JOIN al ON contains(o.lemma, al.a) GROUP BY o.node HAVING count(*) = 1), "
    "h AS (SELECT o.node, strpos(o.lemma, hit.a) - 1 AS s, strpos(o.lemma, hit.a) - 1 + length(hit.a) AS e FROM o JOIN hit ON hit.node = o.node), "
    "d(node, lemma, s, e, how) AS (SELECT node, lemma, 0::BIGINT, 3::BIGINT, 'own' FROM o WHERE parent IS NULL UNION ALL SELECT o.node, o.lemma, CASE WHEN starts_with(o.lemma, left(d.lemma, d.e)) THEN d.s ELSE h.s END, CASE WHEN starts_with(o.lemma, left(d.lemma, d.e)) THEN d.e ELSE h.e END, "
    "CASE WHEN starts_with(o.lemma, left(d.lemma, d.e)) THEN 'parent' WHEN h.node IS NOT NULL THEN 'allomorph' END FROM d JOIN o ON o.parent = d.node LEFT JOIN h ON h.node = o.node) SELECT node, s AS start, e AS \"end\", how FROM d WHERE how IS NOT NULL",
)
def m08(spark, sf_dir):
    f = forest(spark, sf_dir)
    seeds = f.where("parent IS NULL").select("node", F.lit(0).alias("start"), F.lit(3).alias("end"))
    found = mo.project_roots(f, seeds, f.where("n % 13 = 0"), spark.createDataFrame([("ring",), ("bolt",)], "allomorph string"))
    return found.select("node", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "how")


@query("m09_induce_roots", f"WITH {W_SQL}, x AS (SELECT DISTINCT lemma FROM w), al(allomorph, penalty) AS (VALUES ('th', 0), ('ther', 1), ('tion', 0), ('lich', 0), ('en', 0)), h AS (SELECT x.lemma AS lex_id, i - 1 AS start, al.allomorph, length(al.allomorph) - al.penalty AS score FROM x JOIN al ON contains(x.lemma, al.allomorph), range(1, 41) r(i) WHERE substr(x.lemma, i, length(al.allomorph)) = al.allomorph AND i <= length(x.lemma)), "
       "tt AS (SELECT * FROM h QUALIFY rank() OVER (PARTITION BY lex_id ORDER BY score DESC) = 1) SELECT lex_id, min(start)::INTEGER AS start, min(allomorph) AS allomorph FROM tt GROUP BY lex_id HAVING count(*) = 1")
def m09(spark, sf_dir):
    allomorphs = spark.createDataFrame([("th", 0), ("ther", 1), ("tion", 0), ("lich", 0), ("en", 0)], "allomorph string, penalty int")
    return mo.induce_roots(lex_of(spark, sf_dir), allomorphs)


@query("m10_morphs_from_parts", SEG_SQL + " SELECT lemma, left(lemma, 2) || '-' || substr(lemma, 3, length(lemma) - 4) || '-' || right(lemma, 2) AS segments FROM sg WHERE length(lemma) > 5 AND NOT contains(lemma, 'zz')")
def m10(spark, sf_dir):
    parts = F.array(F.substring("lemma", 1, 2), F.lit("zz"), F.right("lemma", F.lit(2)))
    return segmented(spark, sf_dir).where("length(lemma) > 5 AND NOT contains(lemma, 'zz')").select("lemma", F.array_join(mo.morphs_from_parts(F.col("lemma"), parts), "-").alias("segments"))


@query("m11_merge_segmentations", SEG_SQL + " SELECT lemma AS word, CASE WHEN length(lemma) % 2 = 0 THEN a ELSE b || 'x' END AS segments, CASE WHEN length(lemma) % 2 = 0 THEN 'one' ELSE 'two' END AS source, length(lemma) % 2 = 0 AS rebuilds FROM sg")
def m11(spark, sf_dir):
    s = segmented(spark, sf_dir)
    one = s.where("length(lemma) % 2 = 0").select(F.col("lemma").alias("word"), F.col("a").alias("segments"), F.lit("one").alias("source"), F.lit(1).alias("priority"))
    two = s.select(F.col("lemma").alias("word"), F.concat("b", F.lit("x")).alias("segments"), F.lit("two").alias("source"), F.lit(2).alias("priority"))
    return mo.merge_segmentations(one.unionByName(two))


@query("m12_neighbour_outliers", SEG_SQL + ", k AS (SELECT lemma AS word, CASE WHEN length(lemma) % 3 = 0 THEN b ELSE a END AS segments, left(lemma, 2) AS g FROM sg), q AS (SELECT *, string_split(segments, '-')[-1] AS m FROM k), z AS (SELECT *, lag(m) OVER (PARTITION BY g ORDER BY word) AS x, lead(m) OVER (PARTITION BY g ORDER BY word) AS y FROM q) SELECT word, segments, x AS expected FROM z WHERE x = y AND m <> x")
def m12(spark, sf_dir):
    mixed = segmented(spark, sf_dir).select(F.col("lemma").alias("word"), F.when(F.length("lemma") % 3 == 0, F.col("b")).otherwise(F.col("a")).alias("segments"))
    return mo.neighbour_outliers(mixed, F.substring("word", 1, 2), end="last")


@query("m13_seg_diff", SEG_SQL + ", q AS (SELECT lemma, a, b, list_max(list_filter(range(0, 60), lambda i: i <= least(length(a), length(b)) AND left(a, i) = left(b, i))) AS k FROM sg WHERE a <> b) SELECT substr(a, k + 1) AS a, substr(b, k + 1) AS b, count(*) AS n, min(lemma) AS example FROM q GROUP BY 1, 2")
def m13(spark, sf_dir):
    return mo.seg_diff(*sides(spark, sf_dir))


@query("m14_boundaries", SEG_SQL + BITS_SQL + " SELECT lemma AS word, array_to_string(x, '') AS bits, a AS segments FROM bt")
def m14(spark, sf_dir):
    a, _ = sides(spark, sf_dir)
    coded = a.select("word", mo.to_boundaries(F.col("segments")).alias("bits"))
    return coded.select("word", "bits", mo.from_boundaries(F.col("word"), F.col("bits")).alias("segments"))


@query("m15_combine_labels", SEG_SQL + " SELECT lemma, CASE WHEN length(lemma) % 2 = 0 AND left(lemma, 2) NOT IN ('th', 'en') THEN 'R' WHEN length(lemma) % 3 = 0 THEN 'I' ELSE 'D' END AS label FROM sg")
def m15(spark, sf_dir):
    a = F.array(F.when(F.length("lemma") % 2 == 0, "R").when(F.length("lemma") % 3 == 0, "I").otherwise("D"))
    b = F.array(F.when((F.length("lemma") % 2 == 0) & ~F.substring("lemma", 1, 2).isin("th", "en"), "R").when(F.length("lemma") % 3 == 0, "I").otherwise("D"))
    return segmented(spark, sf_dir).select("lemma", mo.combine_labels(a, b, F.array(F.substring("lemma", 1, 2)), ["th", "en"])[0].alias("label"))
