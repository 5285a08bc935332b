"""Registered queries for edits, over the forest of parts and its other version."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordgrove.functions.text import suffix_code_parent
from wordgrove.operators import edits as op
from wordgrove.plans.bindings import F2_SQL, F_SQL, FOREST_SQL, W_SQL, forest, forest2
from wordgrove.plans.bindings import kept_words as words
from wordgrove.plans.registry import query


def edges(spark, sf_dir):
    return forest(spark, sf_dir).select("node", "parent")


def edits_of_f2(spark, sf_dir, condition):
    return forest2(spark, sf_dir).where("parent IS NOT NULL").where(condition).select(F.col("node").alias("line"), "parent", "node")


@query("e01_append_relations", f"WITH {F_SQL}, {F2_SQL}, e AS (SELECT parent, node, CASE WHEN n % 2 = 0 THEN 'Derivation' ELSE 'Compounding' END AS type FROM f2 WHERE parent IS NOT NULL) SELECT parent AS source, node AS target, 'Derivation' AS type, 0 AS ord FROM f WHERE parent IS NOT NULL UNION ALL SELECT e.parent, e.node, e.type, CASE WHEN f.parent IS NULL THEN 0 ELSE 1 END FROM e JOIN f ON f.node = e.node WHERE e.parent IS DISTINCT FROM f.parent OR e.type <> 'Derivation'")
def e01(spark, sf_dir):
    relations = forest(spark, sf_dir).where("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("node").alias("target"), F.lit("Derivation").alias("type"), F.lit(0).alias("ord"))
    kind = F.when(F.col("n") % 2 == 0, "Derivation").otherwise("Compounding")
    edits = forest2(spark, sf_dir).where("parent IS NOT NULL").select(F.col("node").alias("line"), F.col("parent").alias("source"), F.col("node").alias("target"), kind.alias("type"))
    return op.append_relations(relations, edits)


@query("e02_check_arity", f"WITH {F_SQL}, {F2_SQL} SELECT f.node AS line, CASE WHEN f.n % 3 = 0 AND f.parent IS NULL THEN 'needs two sources' WHEN f.n % 3 <> 0 AND f.parent IS NOT NULL THEN 'needs one source' ELSE 'target among the sources' END AS problem FROM f WHERE (f.n % 3 = 0 AND f.parent IS NULL) OR (f.n % 3 <> 0 AND f.parent IS NOT NULL) OR (f.n % 3 <> 0 AND f.parent IS NULL)")
def e02(spark, sf_dir):
    f = forest(spark, sf_dir)
    sources = F.when(F.col("parent").isNull(), F.array("node")).otherwise(F.array("parent", "node"))
    second = F.when(F.col("parent").isNull(), F.array("node")).otherwise(F.array("parent", F.floor(F.col("parent") / 2).cast("long")))
    many = F.col("n") % 3 == 0
    return op.check_arity(f.select(F.col("node").alias("line"), F.when(many, "Compounding").otherwise("Derivation").alias("type"), F.when(many, second).otherwise(sources).alias("sources"), F.coalesce("parent", "node").alias("main"), F.col("node").alias("target")))


@query("e03_check_cycles", f"{FOREST_SQL} SELECT DISTINCT d.node AS line, d.node AS parent, d.ancestor AS node FROM c d WHERE d.dist = 2 AND d.node % 3 = 0")
def e03(spark, sf_dir):
    f = edges(spark, sf_dir)
    up = f.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
    backward = f.join(up, "parent").where("grand IS NOT NULL AND node % 3 = 0").select(F.col("node").alias("line"), F.col("node").alias("parent"), F.col("grand").alias("node"))
    forward = f.where("node % 3 = 1 AND node > 10").select(F.col("node").alias("line"), F.floor(F.col("node") / 7).cast("long").alias("parent"), "node")
    return op.check_cycles(f, backward.unionByName(forward))


@query("e04_replace_parent", f"WITH {F_SQL}, {F2_SQL} SELECT f.node, CASE WHEN f2.parent IS NOT NULL AND f2.n % 5 = 0 THEN f2.parent ELSE f.parent END AS parent FROM f LEFT JOIN f2 ON f2.node = f.node")
def e04(spark, sf_dir):
    return op.replace_parent(edges(spark, sf_dir), edits_of_f2(spark, sf_dir, "n % 5 = 0"))


@query("e05_fill_parent", f"WITH {F_SQL} SELECT node, CASE WHEN parent IS NULL AND node > 0 THEN node // 5 ELSE parent END AS parent FROM f")
def e05(spark, sf_dir):
    f = edges(spark, sf_dir)
    return op.fill_parent(f, f.where("node > 0").select(F.col("node").alias("line"), F.floor(F.col("node") / 5).cast("long").alias("parent"), "node"))


TURN_SQL = "tr AS (SELECT min(a.node) AS node, a.parent FROM f a JOIN f b ON b.node = a.parent WHERE b.parent IS NULL GROUP BY a.parent)"


def turned(spark, sf_dir):
    f = edges(spark, sf_dir)
    tops = f.where("parent IS NULL").select(F.col("node").alias("parent"))
    return f.join(tops, "parent").groupBy("parent").agg(F.min("node").alias("node"))


@query("e06_reverse_edges", f"WITH {F_SQL}, {TURN_SQL} SELECT f.node, CASE WHEN a.node IS NOT NULL THEN NULL WHEN b.parent IS NOT NULL THEN b.node ELSE f.parent END AS parent FROM f LEFT JOIN tr a ON a.node = f.node LEFT JOIN tr b ON b.parent = f.node")
def e06(spark, sf_dir):
    return op.reverse_edges(edges(spark, sf_dir), turned(spark, sf_dir))


#: Of trees of three generations the root, its least and greatest child, and of the former's children the least and the greatest.
PATHS_SQL = """pk AS (SELECT q.node AS r, min(x.node) AS x, max(x.node) AS y FROM f q JOIN f x ON x.parent = q.node WHERE q.parent IS NULL GROUP BY q.node),
pt AS (SELECT r, x, y, min(v.node) AS v, max(v.node) AS w FROM pk JOIN f v ON v.parent = pk.x GROUP BY r, x, y)"""


def paths(spark, sf_dir):
    f = edges(spark, sf_dir)
    kids = f.join(f.where("parent IS NULL").select(F.col("node").alias("parent")), "parent").groupBy(F.col("parent").alias("r")).agg(F.min("node").alias("x"), F.max("node").alias("y"))
    return f.withColumnRenamed("parent", "x").join(kids, "x").groupBy("r", "x", "y").agg(F.min("node").alias("v"), F.max("node").alias("w"))


@query(
    "e06_turns_in_order",
    f"WITH {F_SQL}, {PATHS_SQL}, m AS (SELECT x AS node, CASE r // 37 % 3 WHEN 0 THEN v WHEN 1 THEN NULL ELSE CASE WHEN x = y THEN NULL END END AS up FROM pt UNION ALL SELECT r, CASE r // 37 % 3 WHEN 2 THEN y ELSE x END FROM pt "
    "UNION ALL SELECT v, NULL FROM pt WHERE r // 37 % 3 = 0 UNION ALL SELECT y, x FROM pt WHERE r // 37 % 3 = 2 AND y <> x) SELECT f.node, CASE WHEN m.node IS NOT NULL THEN m.up ELSE f.parent END AS parent FROM f LEFT JOIN m ON m.node = f.node",
)
def e06_in_order(spark, sf_dir):
    """Lines that share nodes: two edges of one path, one edge twice, and two children of one node."""
    case, line = F.floor(F.col("r") / 37) % 3, lambda k, parent, node: F.struct((F.col("r") * 10 + k).alias("line"), F.col(parent).alias("parent"), F.col(node).alias("node"))
    both = F.when(case == 0, F.array(line(1, "r", "x"), line(2, "x", "v"))).when(case == 1, F.array(line(1, "r", "x"), line(2, "r", "x"))).otherwise(F.array(line(1, "r", "x"), line(2, "r", "y")))
    return op.reverse_edges(edges(spark, sf_dir), paths(spark, sf_dir).select(F.explode(both).alias("e")).select("e.*"))


@query("e07_force_reconnect", f"WITH {F_SQL}, {TURN_SQL} SELECT f.node, CASE WHEN a.node IS NOT NULL THEN NULL WHEN b.parent IS NOT NULL THEN b.node ELSE f.parent END AS parent FROM f LEFT JOIN tr a ON a.node = f.node LEFT JOIN tr b ON b.parent = f.node")
def e07(spark, sf_dir):
    return op.force_reconnect(edges(spark, sf_dir), turned(spark, sf_dir).select(F.col("node").alias("line"), F.col("node").alias("parent"), F.col("parent").alias("node")))


@query("e08_attach_roots", f"{FOREST_SQL}, e AS (SELECT a.node AS line, a.root, a.node // 6 AS parent FROM r a JOIN r b ON b.node = a.node // 6 WHERE a.node % 7 = 3 AND b.root < a.root), k AS (SELECT root, min_by(parent, line) AS parent FROM e GROUP BY root) SELECT f.node, coalesce(f.parent, k.parent) AS parent FROM f LEFT JOIN k ON k.root = f.node")
def e08(spark, sf_dir):
    from wordgrove.operators.forest import roots_of

    f = edges(spark, sf_dir)
    placed = roots_of(f)
    lower = placed.select(F.col("node").alias("parent"), F.col("root").alias("other"))
    named = placed.where("node % 7 = 3").withColumn("parent", F.floor(F.col("node") / 6).cast("long")).join(lower, "parent").where("other < root")
    return op.attach_roots(f, named.select(F.col("node").alias("line"), "parent", "node"))


@query("e09_insert_intermediate", f"WITH {F_SQL}, t AS (SELECT node, node // 9 AS parent, node // 27 AS grandparent, CASE n % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' ELSE 'RECONNECT' END AS decision FROM f WHERE node % 4 = 1 AND node > 30), "
       "m AS (SELECT f.node, CASE WHEN t.decision = 'RECONNECT' THEN t.parent ELSE f.parent END AS parent FROM f LEFT JOIN t ON t.node = f.node), e AS (SELECT node AS line, parent, node FROM t WHERE decision <> 'RECONNECT' UNION ALL SELECT node, grandparent, parent FROM t WHERE decision <> 'NO'), "
       "k AS (SELECT node, min_by(parent, line) AS parent FROM e GROUP BY node) SELECT m.node, coalesce(m.parent, k.parent) AS parent FROM m LEFT JOIN k ON k.node = m.node")
def e09(spark, sf_dir):
    key = F.col("node")
    decision = F.when(F.col("n") % 3 == 0, "YES").when(F.col("n") % 3 == 1, "NO").otherwise("RECONNECT")
    triples = forest(spark, sf_dir).where("node % 4 = 1 AND node > 30").select(key.alias("line"), F.floor(key / 27).cast("long").alias("grandparent"), F.floor(key / 9).cast("long").alias("parent"), "node", decision.alias("decision"))
    return op.insert_intermediate(edges(spark, sf_dir), triples)


@query("e10_remove_edges", f"WITH {F_SQL}, {F2_SQL} SELECT f.node, CASE WHEN f2.parent = f.parent THEN NULL ELSE f.parent END AS parent FROM f LEFT JOIN f2 ON f2.node = f.node AND f2.parent = f.parent")
def e10(spark, sf_dir):
    return op.remove_edges(edges(spark, sf_dir), edits_of_f2(spark, sf_dir, "true"))[0]


@query("e10_missing_edges", f"WITH {F_SQL}, {F2_SQL} SELECT f2.parent, f2.node FROM f2 LEFT JOIN f ON f2.node = f.node AND f2.parent = f.parent WHERE f.node IS NULL AND f2.parent IS NOT NULL")
def e10_missing(spark, sf_dir):
    return op.remove_edges(edges(spark, sf_dir), edits_of_f2(spark, sf_dir, "true"))[1]


@query("e11_detach", f"WITH {F_SQL} SELECT f.node, CASE WHEN f.n % 4 = 0 OR p.n % 4 = 0 THEN NULL ELSE f.parent END AS parent FROM f LEFT JOIN f p ON p.node = f.parent")
def e11(spark, sf_dir):
    return op.detach(edges(spark, sf_dir), forest(spark, sf_dir).where("n % 4 = 0"))


COMP_SQL = f"WITH {W_SQL}, x AS (SELECT lemma, min(n * 1000 + length(lemma)) AS node FROM w GROUP BY lemma), l AS (SELECT lemma || '/' || pos AS target, left(lemma, 2) AS a, substr(lemma, 3) AS b FROM w)"


def lex_of_words(spark, sf_dir):
    return words(spark, sf_dir).select("lemma", (F.col("n") * 1000 + F.length("lemma")).alias("node")).withColumn("seq", F.col("node"))


@query("e12_add_compounds", COMP_SQL + " SELECT l.target, xa.node AS first, xb.node AS main FROM l JOIN x xa ON xa.lemma = l.a JOIN x xb ON xb.lemma = l.b")
def e12(spark, sf_dir):
    w = words(spark, sf_dir)
    lists = w.select(F.concat_ws("/", "lemma", "pos").alias("ref_id"), F.array(F.substring("lemma", 1, 2), F.expr("substring(lemma, 3)")).alias("lemmas"))
    return op.add_compounds(lex_of_words(spark, sf_dir), lists).select("target", F.col("sources")[0].alias("first"), "main")


@query("e13_type_compounds", f"WITH {F_SQL} SELECT node, CASE n % 4 WHEN 0 THEN 'Unmotivated' WHEN 1 THEN 'Derivation' WHEN 2 THEN 'Compounding' ELSE 'Univerbisation' END AS kind, CASE WHEN n % 4 < 2 THEN 1 ELSE 2 END AS parts FROM f")
def e13(spark, sf_dir):
    one = F.replace("lemma", F.lit(" "), F.lit("_"))
    parents = F.when(F.col("n") % 4 == 0, one).when(F.col("n") % 4 == 1, F.lower("pos")).when(F.col("n") % 4 == 2, F.col("lemma")).otherwise(F.concat(F.lit("!"), "lemma"))
    named = forest(spark, sf_dir).select(F.concat_ws("/", F.col("node").cast("string"), one).alias("k"), one.alias("lemma"), parents.alias("parents"))
    made = op.type_compounds(named.withColumn("lemma", F.col("lemma")).select(F.col("lemma"), "parents", "k").withColumn("parents", F.col("parents")))
    return _keyed(made, named)


def _keyed(made, named):
    # the operator keeps rows in place, so rows are named again by what they were made of
    parts = F.split(F.trim(F.regexp_replace("parents", r"^!", "")), r"\s+")
    back = named.select(F.split_part("k", F.lit("/"), F.lit(1)).cast("long").alias("node"), "lemma", parts.alias("components"), F.startswith("parents", F.lit("!")).alias("bang"))
    kinds = made.select("lemma", "components", "kind", (F.col("kind") == "Univerbisation").alias("bang")).distinct()
    return back.join(kinds, ["lemma", "components", "bang"]).select("node", "kind", F.size("components").alias("parts"))


@query("e14_add_univerbisations", COMP_SQL + ", alt AS (SELECT target, 0 AS alt, a, b FROM l UNION ALL SELECT target, 1, left(split_part(target, '/', 1), 3), substr(split_part(target, '/', 1), 4) FROM l), "
       "g AS (SELECT alt.target, min(alt.alt) AS alt FROM alt JOIN x xa ON xa.lemma = alt.a JOIN x xb ON xb.lemma = alt.b GROUP BY alt.target) SELECT g.target, g.alt, xa.node AS main FROM g JOIN alt ON alt.target = g.target AND alt.alt = g.alt JOIN x xa ON xa.lemma = alt.a JOIN x xb ON xb.lemma = alt.b "
       "WHERE left(alt.b, length(alt.a) + 1) <> left(alt.target, length(alt.a) + 1) OR length(alt.b) <= length(alt.a)")
def e14(spark, sf_dir):
    w = words(spark, sf_dir)
    cut = lambda k, alt: w.select(F.concat_ws("/", "lemma", "pos").alias("target"), "lemma", F.lit(alt).alias("alt"), F.array(F.substring("lemma", 1, k), F.expr(f"substring(lemma, {k + 1})")).alias("lemmas"))
    found = op.add_univerbisations(lex_of_words(spark, sf_dir), cut(2, 0).unionByName(cut(3, 1)))
    return found.where(F.col("main") == F.col("sources")[0]).select("target", "alt", "main")


@query("e15_retype_conversions", f"WITH {F_SQL} SELECT f.node AS target, p.node AS source, CASE WHEN f.lemma = p.lemma THEN 'Conversion' ELSE 'Derivation' END AS type FROM f JOIN f p ON p.node = f.parent")
def e15(spark, sf_dir):
    f = forest(spark, sf_dir)
    relations = f.where("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("node").alias("target"), F.lit("Derivation").alias("type"))
    return op.retype_conversions(relations, f)


@query("e16_merge_variants", f"WITH {F_SQL}, s AS (SELECT parent AS set_id, node, node AS seq FROM f WHERE parent IS NOT NULL AND n % 3 = 0), p AS (SELECT set_id, min(node) AS rep FROM s GROUP BY set_id), v AS (SELECT s.node, p.rep FROM s JOIN p USING (set_id)), "
       "o AS (SELECT v.rep AS node, min_by(coalesce(u.rep, f.parent), v.node) AS up FROM v JOIN f ON f.node = v.node LEFT JOIN v u ON u.node = f.parent WHERE coalesce(u.rep, f.parent) <> v.rep GROUP BY v.rep) "
       "SELECT f.node, CASE WHEN v.rep = f.node THEN o.up WHEN v.rep IS NOT NULL THEN v.rep ELSE coalesce(u.rep, f.parent) END AS parent FROM f LEFT JOIN v ON v.node = f.node LEFT JOIN v u ON u.node = f.parent LEFT JOIN o ON o.node = f.node")
def e16(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.merge_variants(f.select("node", "parent"), f.where("parent IS NOT NULL AND n % 3 = 0").select(F.col("parent").alias("set_id"), "node", F.col("node").alias("seq")))


@query(
    "e16_variants_of_their_ancestors",
    f"WITH {F_SQL}, {PATHS_SQL}, p AS (SELECT *, r // 37 % 4 AS k FROM pt), m AS (SELECT v AS node, r AS up FROM p WHERE k IN (0, 3) UNION ALL SELECT w, r FROM p WHERE k = 3 AND w <> v UNION ALL SELECT r, v FROM p WHERE k = 1 UNION ALL SELECT v, NULL FROM p WHERE k = 1 "
    "UNION ALL SELECT v, r FROM p WHERE k = 2 UNION ALL SELECT x, v FROM p WHERE k = 2), o AS (SELECT v AS node, r AS owner FROM p WHERE k IN (0, 3) UNION ALL SELECT w, r FROM p WHERE k = 3 AND w <> v UNION ALL SELECT r, v FROM p WHERE k = 1 UNION ALL SELECT x, v FROM p WHERE k = 2) "
    "SELECT f.node, CASE WHEN m.node IS NOT NULL THEN m.up ELSE coalesce(o.owner, f.parent) END AS parent FROM f LEFT JOIN m ON m.node = f.node LEFT JOIN o ON o.node = f.parent",
)
def e16_ancestors(spark, sf_dir):
    """A representative above its variant, one below, one right below, and a variant that represents another set."""
    case, part = F.floor(F.col("r") / 37) % 4, lambda k, seq, node: F.struct((F.col("r") * 10 + k).alias("set_id"), F.lit(seq).alias("seq"), F.col(node).alias("node"))
    listed = (
        F.when(case == 0, F.array(part(0, 0, "r"), part(0, 1, "v")))
        .when(case == 1, F.array(part(0, 0, "v"), part(0, 1, "r")))
        .when(case == 2, F.array(part(0, 0, "v"), part(0, 1, "x")))
        .otherwise(F.array(part(0, 0, "r"), part(0, 1, "v"), part(1, 0, "v"), part(1, 1, "w")))
    )
    return op.merge_variants(edges(spark, sf_dir), paths(spark, sf_dir).select(F.explode(listed).alias("s")).select("s.*"))


@query("e17_labelled_variants", f"WITH {F_SQL}, s AS (SELECT parent AS set_id, node, node AS seq FROM f WHERE parent IS NOT NULL AND n % 3 = 0), p AS (SELECT set_id, min(node) AS rep FROM s GROUP BY set_id), v AS (SELECT s.node, p.rep FROM s JOIN p USING (set_id) WHERE s.node <> p.rep) "
       "SELECT f.node, coalesce(v.rep, u.rep, f.parent) AS parent, CASE WHEN v.rep IS NOT NULL THEN 'Variant' END AS label FROM f LEFT JOIN v ON v.node = f.node LEFT JOIN v u ON u.node = f.parent")
def e17(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.merge_labelled_variants(f.select("node", "parent"), f.where("parent IS NOT NULL AND n % 3 = 0").select(F.col("parent").alias("set_id"), "node", F.col("node").alias("seq")))


@query("e19_parents_from_suffix_codes", f"WITH {F_SQL}, x AS (SELECT node, parent, lower(pos) || substr('abc', (node % 3)::INTEGER + 1, 1) AS lemma, n % 3 AS num FROM f WHERE node < 37 OR parent IS NULL), "
       "c AS (SELECT a.node, b.node AS up, row_number() OVER (PARTITION BY a.node ORDER BY a.num <> b.num, b.node) AS k FROM x a JOIN x b ON b.lemma = left(a.lemma, length(a.lemma) - 1) || 'b' AND b.node < 37 WHERE a.parent IS NULL AND a.lemma NOT LIKE '%b' AND a.node > 37) "
       "SELECT f.node, coalesce(f.parent, c.up) AS parent FROM f LEFT JOIN c ON c.node = f.node AND c.k = 1")
def e19(spark, sf_dir):
    f = forest(spark, sf_dir)
    lemma = F.concat(F.lower("pos"), F.substring(F.lit("abc"), (F.col("node") % 3).cast("int") + 1, F.lit(1)))
    # roots take their parents from the first tree, so that no two trees hang on each other
    code = F.when(F.col("parent").isNull() & (F.col("node") > 37), "_^(*3b)").otherwise("")
    x = f.where("node < 37 OR parent IS NULL").withColumn("lemma", lemma).withColumn("lemma", F.when((F.col("node") >= 37) & F.endswith("lemma", F.lit("b")), F.concat("lemma", F.lit("!"))).otherwise(F.col("lemma")))
    lexemes = x.select("node", F.col("node").alias("seq"), "lemma", F.concat("lemma", F.lit("-"), (F.col("n") % 3).cast("string"), code).alias("techlemma"))
    return op.parents_from_suffix_codes(lexemes, f.select("node", "parent"))


@query("e18_parents_from_codes", f"WITH {F_SQL}, x AS (SELECT node, parent, lemma || '/' || substr('abcdefghijklmnop', (node % 16)::INTEGER + 1, 1) AS lemma FROM f), k AS (SELECT lemma, min(node) AS node FROM x GROUP BY lemma), c AS (SELECT x.node, k.node AS up FROM x JOIN k ON k.lemma = left(x.lemma, length(x.lemma) - 1) || 'b' WHERE x.parent IS NULL AND k.node < x.node) SELECT x.node, coalesce(x.parent, c.up) AS parent FROM x LEFT JOIN c ON c.node = x.node")
def e18(spark, sf_dir):
    x = forest(spark, sf_dir).withColumn("lemma", F.concat_ws("/", "lemma", F.substring(F.lit("abcdefghijklmnop"), (F.col("node") % 16).cast("int") + 1, F.lit(1)))).withColumn("seq", F.col("node"))
    first = x.groupBy("lemma").agg(F.min("node").alias("first"))
    named = suffix_code_parent(F.col("lemma"), F.lit("(*1b)"))
    # only codes that name an earlier part, as later ones would hang trees on each other
    known = x.join(first.withColumnRenamed("lemma", "named"), named == F.col("named"), "left")
    return op.parents_from_codes(known, x.select("node", "parent"), F.when(F.col("first") < F.col("node"), F.col("named")))


@query("e20_add_phantoms", f"WITH {F_SQL}, x AS (SELECT node, parent, lemma || '/' || n AS lemma FROM f), o AS (SELECT lemma, min(node) AS node FROM x GROUP BY lemma HAVING count(*) = 1) SELECT a.node, b.node AS parent, true AS fictitious FROM x c JOIN x p ON p.node = c.parent JOIN o a ON a.lemma = c.lemma JOIN o b ON b.lemma = p.lemma")
def e20(spark, sf_dir):
    x = forest(spark, sf_dir).select("node", "parent", F.concat_ws("/", "lemma", F.col("n").cast("string")).alias("lemma"))
    up = x.select(F.col("node").alias("parent"), F.col("lemma").alias("p"))
    return op.add_phantoms(x, x.join(up, "parent").select(F.col("lemma").alias("child"), F.col("p").alias("parent")))


@query("e21_edges_from_solutions", f"WITH {F_SQL} SELECT node, parent FROM f WHERE parent IS NOT NULL AND n % 2 = 0")
def e21(spark, sf_dir):
    f = forest(spark, sf_dir)
    word = lambda c: F.concat(F.lit("w"), F.col(c).cast("string"))
    lines = f.where("parent IS NOT NULL").select(F.concat(F.when(F.col("n") % 2 == 0, "SOLUTION: ").otherwise("NOTE: "), word("parent"), F.lit(" > "), word("node")).alias("value"))
    return op.edges_from_solutions(f.select("node", word("node").alias("lemma")), lines)


@query("e22_restructure_clusters", f"{FOREST_SQL} SELECT a.root AS cluster, b.node, a.node AS parent FROM r a JOIN f fa ON fa.node = a.node JOIN r b ON b.root = a.root JOIN f fb ON fb.node = b.node WHERE fa.pos = 'SMALL' AND ends_with(fa.lemma, 'ring') AND fb.pos = 'PROMO' AND ends_with(fb.lemma, 'bolt') AND a.node <> b.node AND fa.n < 5")
def e22(spark, sf_dir):
    from wordgrove.operators.forest import roots_of

    f = forest(spark, sf_dir)
    members = roots_of(f.select("node", "parent")).join(f.where("NOT (pos = 'SMALL' AND n >= 5)"), "node").select(F.col("root").alias("cluster"), "node", "lemma", "pos")
    patterns = spark.createDataFrame([("SMALL", "ring", "PROMO", "bolt", False)], "source_pos string, source_suffix string, target_pos string, target_suffix string, drop boolean")
    return op.restructure_clusters(members, patterns).select("cluster", "node", "parent")


@query("e23_reconnect_by_rules", f"WITH {F_SQL} SELECT a.node, min(b.node) AS parent FROM f a JOIN f b ON b.parent = a.parent AND b.lemma = left(a.lemma, length(a.lemma) - 4) || 'bolt' WHERE ends_with(a.lemma, 'ring') AND a.node <> b.node GROUP BY a.node")
def e23(spark, sf_dir):
    return op.reconnect_by_rules(forest(spark, sf_dir), spark.createDataFrame([("ring", "bolt")], "suffix string, sibling_suffix string"))


@query("e24_apply_confirmed", f"WITH {F_SQL}, {F2_SQL} SELECT f.parent AS source, f.node AS target, f.pos AS rule FROM f WHERE f.parent IS NOT NULL AND f.pos IN ('SMALL', 'PROMO') AND NOT EXISTS (SELECT 1 FROM f2 WHERE f2.node = f.node AND f2.parent = f.parent)")
def e24(spark, sf_dir):
    instances = forest(spark, sf_dir).where("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("node").alias("target"), F.col("pos").alias("rule"))
    rejected = forest2(spark, sf_dir).select(F.col("parent").alias("source"), F.col("node").alias("target"))
    return op.apply_confirmed(instances, spark.createDataFrame([("SMALL",), ("PROMO",)], "rule string"), rejected)


@query("e25_edges_from_brackets", f"WITH {F_SQL} SELECT node AS line, 0 AS place, 'w' || node AS lemma, NULL AS parent_lemma FROM f UNION ALL SELECT node, 1, 'a' || n, 'w' || node FROM f UNION ALL SELECT node, 2, 'b', 'a' || n FROM f UNION ALL SELECT node, 3, 'c', 'w' || node FROM f")
def e25(spark, sf_dir):
    value = F.concat(F.lit("w"), F.col("node").cast("string"), F.lit(" ( a"), F.col("n").cast("string"), F.lit(" ( b ) c )"))
    return op.edges_from_brackets(forest(spark, sf_dir).select(F.col("node").alias("line"), value.alias("value")))


#: Trees whose second word is unknown for a third of the lines and whose fourth always is; its child must not hang on a neighbour.
BRIDGED_SQL = f"WITH {F_SQL} SELECT node AS line, 0 AS place, 'w' || node AS lemma, NULL AS parent_lemma FROM f UNION ALL SELECT node, 1, 'a' || n, 'w' || node FROM f WHERE n % 3 <> 0 UNION ALL SELECT node, 2, 'b' || n, CASE WHEN n % 3 <> 0 THEN 'a' || n {{bridge}} END FROM f UNION ALL SELECT node, 4, 'd', {{far}} FROM f"


def with_unknown(spark, sf_dir, bridge):
    f = forest(spark, sf_dir)
    n = F.col("n").cast("string")
    value = F.concat(F.lit("w"), F.col("node").cast("string"), F.lit(" ( a"), n, F.lit(" ( b"), n, F.lit(" ) c ( d ) )"))
    named = lambda letter, column, where: f.where(where).select(F.concat(F.lit(letter), F.col(column).cast("string")).alias("lemma"))
    known = named("w", "node", "true").unionByName(named("a", "n", "n % 3 <> 0")).unionByName(named("b", "n", "true")).unionByName(f.select(F.lit("d").alias("lemma")))
    return op.edges_from_brackets(f.select(F.col("node").alias("line"), value.alias("value")), known, bridge)


@query("e25_bridged", BRIDGED_SQL.format(bridge="ELSE 'w' || node", far="'w' || node"))
def e25_bridged(spark, sf_dir):
    return with_unknown(spark, sf_dir, True)


@query("e25_cut", BRIDGED_SQL.format(bridge="", far="NULL"))
def e25_cut(spark, sf_dir):
    return with_unknown(spark, sf_dir, False)


@query("e26_single_parent", f"WITH {F_SQL}, {F2_SQL} SELECT f.parent AS source, f.node AS target, CASE WHEN f2.parent IS NOT NULL AND f2.parent <> f.parent THEN f2.parent::VARCHAR ELSE '' END AS omitted FROM f LEFT JOIN f2 ON f2.node = f.node WHERE f.parent IS NOT NULL")
def e26(spark, sf_dir):
    relations = forest(spark, sf_dir).where("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("node").alias("target"), F.lit("D").alias("type"), F.lit(0).alias("ord"))
    more = op.append_relations(relations, edits_of_f2(spark, sf_dir, "true").select("line", F.col("parent").alias("source"), F.col("node").alias("target"), F.lit("D").alias("type")))
    return op.single_parent(more).select("source", "target", "omitted")


@query("e27_label_edges", f"WITH {F_SQL}, e AS (SELECT f.node, f.parent, p.lemma AS pl, f.lemma AS cl, row_number() OVER (PARTITION BY p.lemma, f.lemma ORDER BY f.node) AS k FROM f JOIN f p ON p.node = f.parent), l AS (SELECT pl, cl, n::VARCHAR AS label, row_number() OVER (PARTITION BY pl, cl ORDER BY line) AS k FROM (SELECT f.node * 2 AS line, p.lemma AS pl, f.lemma AS cl, f.n FROM f JOIN f p ON p.node = f.parent WHERE f.n % 3 = 0)) SELECT e.node, e.parent, l.label FROM e JOIN l USING (pl, cl, k)")
def e27(spark, sf_dir):
    f = forest(spark, sf_dir)
    up = f.select(F.col("node").alias("parent"), F.col("lemma").alias("p"))
    labels = f.where("n % 3 = 0").join(up, "parent").select((F.col("node") * 2).alias("line"), F.col("p").alias("parent"), F.col("lemma").alias("child"), F.col("n").cast("string").alias("label"))
    return op.label_edges(f, labels)


@query("e28_add_nodes", f"WITH {W_SQL} SELECT lemma, 'xx' AS pos FROM w UNION SELECT upper(pos), pos FROM w")
def e28(spark, sf_dir):
    w = words(spark, sf_dir)
    return op.add_nodes(w, w.select("lemma", F.lit("xx").alias("pos")).unionByName(w.select(F.upper("pos").alias("lemma"), "pos")).unionByName(w.select("lemma", "pos")))


@query("e29_delete_nodes", f"WITH {F_SQL} SELECT f.node, CASE WHEN p.n = 5 THEN NULL ELSE f.parent END AS parent FROM f LEFT JOIN f p ON p.node = f.parent WHERE f.n <> 5")
def e29(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.delete_nodes(f.select("node", "parent"), f.where("n = 5"))[0]


@query("e29_refused", f"WITH {F_SQL} SELECT node FROM f WHERE n = 5 AND (parent IS NOT NULL OR node IN (SELECT parent FROM f WHERE parent IS NOT NULL))")
def e29_refused(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.delete_nodes(f.select("node", "parent"), f.where("n = 5"), cascade=False)[1]


@query("e30_delete_subtrees", f"{FOREST_SQL} SELECT node, lemma FROM f WHERE node NOT IN (SELECT c.node FROM c JOIN f a ON a.node = c.ancestor WHERE a.n = 17)")
def e30(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.delete_subtrees(f, f.where("n = 17")).select("node", "lemma")


@query("e31_prune_unattested", f"{FOREST_SQL} SELECT DISTINCT a.node, a.parent FROM c JOIN f ON f.node = c.node JOIN f a ON a.node = c.ancestor WHERE f.n > 25")
def e31(spark, sf_dir):
    f = forest(spark, sf_dir).withColumn("n", F.when(F.col("n") > 25, F.col("n")).otherwise(0))
    return op.prune_unattested(f).select("node", "parent")


