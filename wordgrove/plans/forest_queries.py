"""Registered queries on forests."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordgrove.operators import forest as op
from wordgrove.plans.bindings import C_SQL, F_SQL, FOREST_SQL, SIGNATURES_SQL, chains, forest
from wordgrove.plans.registry import query


def edges(spark, sf_dir):
    return forest(spark, sf_dir).select("node", "parent")


@query("t01_roots_of", f"{FOREST_SQL} SELECT node, root FROM r")
def t01(spark, sf_dir):
    return op.roots_of(edges(spark, sf_dir))


@query("t02_depths", f"{FOREST_SQL} SELECT node, root, depth FROM r")
def t02(spark, sf_dir):
    return op.depths(edges(spark, sf_dir))


@query("t02_chain_depths", f"WITH {C_SQL} SELECT node, turn - min(turn) OVER (PARTITION BY conv_id, grp) + 1 AS depth FROM (SELECT *, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS grp FROM ch)")
def t02_chains(spark, sf_dir):
    return op.depths(chains(spark, sf_dir)).select("node", "depth")


@query("t03_closure", f"{FOREST_SQL} SELECT node, ancestor, dist FROM c")
def t03(spark, sf_dir):
    return op.closure(edges(spark, sf_dir))


@query("t03_descendants", f"{FOREST_SQL} SELECT c.ancestor, c.node, c.dist FROM c JOIN f s ON s.node = c.ancestor WHERE s.n = 1")
def t03_down(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.descendants(f.select("node", "parent"), f.where("n = 1"))


@query("t04_heights", f"{FOREST_SQL} SELECT ancestor AS node, max(dist) + 1 AS height FROM c GROUP BY ancestor")
def t04(spark, sf_dir):
    return op.heights(edges(spark, sf_dir))


@query(
    "t05_subtree_agg",
    f"{FOREST_SQL} SELECT c.ancestor AS node, count(*) AS size, sum(f.n)::BIGINT AS total, max(f.n) AS largest, count(*) FILTER (WHERE f.n > 25) AS big FROM c JOIN f ON f.node = c.node GROUP BY c.ancestor",
)
def t05(spark, sf_dir):
    f = forest(spark, sf_dir)
    values = f.select("node", F.lit(1).cast("long").alias("size"), F.col("n").cast("long").alias("total"), F.col("n").alias("largest"), (F.col("n") > 25).cast("long").alias("big"))
    return op.subtree_agg(f.select("node", "parent"), values, sums=("size", "total", "big"), maxima=("largest",))


@query(
    "t06_has_ancestor",
    f"WITH RECURSIVE {F_SQL}, rel AS (SELECT parent AS source, node AS target FROM f WHERE parent IS NOT NULL UNION SELECT node // 5, node FROM f WHERE node > 0), "
    "up(node, top) AS (SELECT target, source FROM rel UNION SELECT up.node, rel.source FROM up JOIN rel ON up.top = rel.target) "
    "SELECT DISTINCT up.node FROM up JOIN f w ON w.node = up.top WHERE w.pos LIKE 'SM%' OR w.n = 7",
)
def t06(spark, sf_dir):
    f = forest(spark, sf_dir)
    second = f.where("node > 0").select(F.floor(F.col("node") / 5).cast("long").alias("source"), F.col("node").alias("target"))
    relations = f.where("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("node").alias("target")).unionByName(second)
    return op.has_ancestor(relations, f.select("node"), f.where("pos LIKE 'SM%' OR n = 7").select("node"))


@query(
    "t07_parents_report",
    f"{FOREST_SQL}, hit AS (SELECT DISTINCT lemma, node FROM f), p AS (SELECT h.lemma, string_agg(DISTINCT q.pos, ',' ORDER BY q.pos) AS parents FROM hit h JOIN f ON f.node = h.node JOIN f q ON q.node = f.parent GROUP BY h.lemma), "
    "t AS (SELECT h.lemma, string_agg(DISTINCT q.pos, ',' ORDER BY q.pos) AS roots FROM hit h JOIN r ON r.node = h.node JOIN f q ON q.node = r.root GROUP BY h.lemma) "
    "SELECT t.lemma, coalesce(p.parents, 'ROOT') AS parents, t.roots FROM t LEFT JOIN p ON p.lemma = t.lemma",
)
def t07(spark, sf_dir):
    f = forest(spark, sf_dir)
    relations = f.where("parent IS NOT NULL").select(F.col("parent").alias("source"), F.col("node").alias("target"), F.lit(0).alias("ord"))
    return op.parents_report(f, relations, f.select("lemma"), "pos")


@query(
    "t08_dfs_ids",
    f"WITH RECURSIVE {F_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY lemma, node) AS k FROM f), "
    "d(node, tree, path) AS (SELECT node, k - 1, [0::BIGINT] FROM s WHERE parent IS NULL UNION ALL SELECT s.node, d.tree, list_append(d.path, s.k) FROM d JOIN s ON s.parent = d.node) "
    "SELECT node, tree, row_number() OVER (PARTITION BY tree ORDER BY path) - 1 AS pos FROM d",
)
def t08(spark, sf_dir):
    return op.dfs_ids(forest(spark, sf_dir), ["lemma"]).select("node", "tree", "pos")


@query(
    "t09_render_trees",
    f"WITH RECURSIVE {F_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY lemma, node) AS k, count(*) OVER (PARTITION BY parent) AS m FROM f), "
    "d(node, tree, path, stem, text) AS (SELECT node, k - 1, [0::BIGINT], '', lemma FROM s WHERE parent IS NULL UNION ALL "
    "SELECT s.node, d.tree, list_append(d.path, s.k), d.stem || CASE WHEN s.k = s.m THEN '  ' ELSE '│ ' END, d.stem || CASE WHEN s.k = s.m THEN '└─' ELSE '├─' END || s.lemma FROM d JOIN s ON s.parent = d.node) "
    "SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY path) - 1 AS line_no, text FROM d",
)
def t09(spark, sf_dir):
    return op.render_trees(forest(spark, sf_dir), "lemma", ["lemma"])


@query("t11_signatures", SIGNATURES_SQL + " SELECT node AS root, sig FROM g15 WHERE parent IS NULL")
def t11(spark, sf_dir):
    return op.signatures(forest(spark, sf_dir).withColumn("class", F.substring("pos", 1, 1)), "class")


@query(
    "t12_propagate",
    f"{FOREST_SQL}, best AS (SELECT r.root, min_by(f.lemma, (r.depth, f.lemma)) AS value FROM r JOIN f ON f.node = r.node WHERE f.n % 5 = 0 GROUP BY r.root), "
    "blocked AS (SELECT c.node FROM c JOIN f ON f.node = c.ancestor WHERE f.parent IS NOT NULL AND f.n % 11 = 0) "
    "SELECT r.node, best.value FROM r JOIN best ON best.root = r.root WHERE r.node NOT IN (SELECT node FROM blocked)",
)
def t12(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.propagate(f.select("node", "parent"), f.where("n % 5 = 0").select("node", F.col("lemma").alias("value")), f.select("node", (F.col("n") % 11 != 0).alias("open")))


@query(
    "t13_lift_marks",
    f"{FOREST_SQL}, m AS (SELECT node FROM f WHERE n % 6 = 0), b AS (SELECT DISTINCT c.node FROM c JOIN m ON m.node = c.ancestor WHERE c.dist > 0), "
    "st AS (SELECT f.node, p.node AS held FROM f LEFT JOIN f p ON p.node = f.parent WHERE f.parent IS NULL OR contains(split_part(f.lemma, ' ', 1), split_part(p.lemma, ' ', 1))), "
    "z AS (SELECT c.node, min_by(st.node, c.dist) AS stop FROM c JOIN st ON st.node = c.ancestor GROUP BY c.node) "
    "SELECT m.node, CASE WHEN b.node IS NULL THEN z.stop END AS moved_to, b.node IS NOT NULL AS dropped, CASE WHEN b.node IS NULL THEN st.held END AS held_by FROM m JOIN z ON z.node = m.node JOIN st ON st.node = z.stop LEFT JOIN b ON b.node = m.node",
)
def t13(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.lift_marks(f.select("node", "parent", F.split_part("lemma", F.lit(" "), F.lit(1)).alias("word")), f.where("n % 6 = 0").select("node"), "word")


@query("t14_largest_trees", f"{FOREST_SQL} SELECT root, count(*) AS size FROM r GROUP BY root ORDER BY size DESC, root LIMIT 20")
def t14(spark, sf_dir):
    return op.largest_trees(edges(spark, sf_dir), 20)


@query("t15_families_of", f"{FOREST_SQL} SELECT root, node FROM r WHERE root IN (SELECT r.root FROM r JOIN f ON f.node = r.node WHERE f.pos LIKE 'PROMO%' AND f.n = 3)")
def t15(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.families_of(f.select("node", "parent"), f.where("pos LIKE 'PROMO%' AND n = 3"))


@query(
    "t16_families_with",
    f"{FOREST_SQL}, x AS (SELECT DISTINCT c.node FROM c JOIN f ON f.node = c.ancestor WHERE f.n % 10 = 0), l AS (SELECT r.root, f.node, (f.n = 13 AND x.node IS NULL) AS label FROM f JOIN r ON r.node = f.node LEFT JOIN x ON x.node = f.node) "
    "SELECT root, node, label FROM l WHERE root IN (SELECT root FROM l WHERE label)",
)
def t16(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.families_with(f.select("node", "parent"), f.select("node", (F.col("n") == 13).alias("label")), f.where("n % 10 = 0").select("node"))


@query(
    "t17_root_conflicts",
    f"{FOREST_SQL}, a AS (SELECT node, list_distinct([n % 3, n % 5]) AS v FROM f) SELECT a.node, r.root FROM a JOIN r ON r.node = a.node JOIN a b ON b.node = r.root "
    "WHERE a.node <> r.root AND NOT list_has_all(b.v, a.v) AND NOT list_has_all(a.v, b.v)",
)
def t17(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.root_conflicts(f.select("node", "parent"), f.select("node", F.array_distinct(F.array(F.col("n") % 3, F.col("n") % 5)).alias("values")))


@query("p03_roots", f"WITH {F_SQL} SELECT node, lemma FROM f WHERE parent IS NULL")
def p03_roots(spark, sf_dir):
    return op.roots(forest(spark, sf_dir)).select("node", "lemma")


@query("p03_leaves", f"WITH {F_SQL} SELECT node, lemma FROM f WHERE node NOT IN (SELECT parent FROM f WHERE parent IS NOT NULL)")
def p03_leaves(spark, sf_dir):
    return op.leaves(forest(spark, sf_dir)).select("node", "lemma")


@query("p03_singletons", f"WITH {F_SQL} SELECT node, lemma FROM f WHERE parent IS NULL AND node NOT IN (SELECT parent FROM f WHERE parent IS NOT NULL)")
def p03_singletons(spark, sf_dir):
    return op.singletons(forest(spark, sf_dir)).select("node", "lemma")


@query("v01_cycles", f"WITH RECURSIVE {F_SQL}, g AS (SELECT node, CASE WHEN node IN (100, 101, 102) THEN CASE node WHEN 100 THEN 101 WHEN 101 THEN 102 ELSE 100 END WHEN n = 50 THEN node ELSE parent END AS parent FROM f), "
       "up(node, top, hops) AS (SELECT node, parent, 1 FROM g WHERE parent IS NOT NULL UNION ALL SELECT up.node, g.parent, hops + 1 FROM up JOIN g ON g.node = up.top WHERE g.parent IS NOT NULL AND hops < 40 AND up.top <> up.node) "
       "SELECT DISTINCT node FROM up WHERE node = top")
def v01(spark, sf_dir):
    f = forest(spark, sf_dir)
    ring = F.when(F.col("node") == 100, 101).when(F.col("node") == 101, 102).when(F.col("node") == 102, 100)
    return op.find_cycles(f.select("node", F.coalesce(ring.cast("long"), F.when(F.col("n") == 50, F.col("node")), F.col("parent")).alias("parent")))
