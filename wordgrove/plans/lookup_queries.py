"""Registered queries for lookups, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordgrove.operators import lookup as op
from wordgrove.operators import resolve as rs
from wordgrove.operators.forest import roots_of
from wordgrove.plans.bindings import F2_SQL, F_SQL, FOREST_SQL, W_SQL, forest, forest2, table, words
from wordgrove.plans.registry import query

#: Lexemes are parts: several parts share a name, so names have homonyms.
LEX_SQL = "lex AS (SELECT p_partkey AS node, p_partkey AS seq, p_name AS lemma, p_brand AS pos, p_name || '#' || p_brand AS lemid, p_type AS tech FROM part)"


def lexemes(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("node"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("lemma"), F.col("p_brand").alias("pos"), F.concat("p_name", F.lit("#"), "p_brand").alias("lemid"), F.col("p_type").alias("tech"))


#: References are those of lines to parts, by name and brand, many of them wrong.
REFS_SQL = "refs AS (SELECT ref_id, p_name AS lemma, CASE WHEN l_linenumber % 3 = 0 THEN 'Brand#99' ELSE p_brand END AS pos, p_type AS tech FROM (SELECT l_orderkey * 10 + l_linenumber AS ref_id, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey, l_linenumber) JOIN part ON p_partkey = l_partkey)"


def refs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p_partkey"))
    lines = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ref_id"), "l_linenumber", "p_partkey")
    wrong = F.when(F.col("l_linenumber") % 3 == 0, "Brand#99").otherwise(F.col("p_brand"))
    return lines.join(table(spark, sf_dir, "part"), "p_partkey").select("ref_id", F.col("p_name").alias("lemma"), wrong.alias("pos"), F.col("p_type").alias("tech"))


@query("p01_lookup", f"WITH {LEX_SQL}, k AS (SELECT s_suppkey AS key_id, p_name AS lemma, p_brand AS pos FROM supplier JOIN part ON p_partkey = s_suppkey) SELECT k.key_id, lex.node, lex.seq, lex.lemma, lex.pos, lex.lemid, lex.tech FROM k JOIN lex ON lex.lemma = k.lemma AND lex.pos = k.pos")
def p01(spark, sf_dir):
    keys = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "part"), F.col("s_suppkey") == F.col("p_partkey")).select(F.col("s_suppkey").alias("key_id"), F.col("p_name").alias("lemma"), F.col("p_brand").alias("pos"))
    return op.lookup(lexemes(spark, sf_dir), keys, ["lemma", "pos"])


@query("p01_lookup_fuzzy", f"WITH {LEX_SQL}, k AS (SELECT s_suppkey AS key_id, p_name AS lemma, CASE WHEN s_suppkey % 2 = 0 THEN p_type ELSE 'no such type' END AS tech FROM supplier JOIN part ON p_partkey = s_suppkey), "
       "m AS (SELECT k.key_id, lex.node, lex.lemma, lex.tech = k.tech AS hit, max(lex.tech = k.tech) OVER (PARTITION BY k.key_id) AS has_hit FROM k JOIN lex ON lex.lemma = k.lemma) SELECT key_id, node, lemma FROM m WHERE hit OR NOT has_hit")
def p01_fuzzy(spark, sf_dir):
    tech = F.when(F.col("s_suppkey") % 2 == 0, F.col("p_type")).otherwise("no such type")
    keys = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "part"), F.col("s_suppkey") == F.col("p_partkey")).select(F.col("s_suppkey").alias("key_id"), F.col("p_name").alias("lemma"), tech.alias("tech"))
    return op.lookup(lexemes(spark, sf_dir), keys, ["lemma", "tech"], fuzzy="tech", columns=["node", "lemma"])


@query("p02_lookup_spec", f"WITH {LEX_SQL}, s AS (SELECT DISTINCT p_name || CASE WHEN p_size % 2 = 0 THEN '_' || p_brand ELSE '' END AS spec FROM part WHERE p_size < 10) SELECT s.spec, lex.node FROM s JOIN lex ON lex.lemma = split_part(s.spec, '_', 1) AND (NOT contains(s.spec, '_') OR lex.pos = split_part(s.spec, '_', 2))")
def p02(spark, sf_dir):
    spec = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("_"), "p_brand")).otherwise(""))
    specs = table(spark, sf_dir, "part").where("p_size < 10").select(spec.alias("spec")).distinct()
    return op.lookup_spec(lexemes(spark, sf_dir), specs, ["lemma", "pos"]).select("spec", "node")


@query("p04_drop_paths", "SELECT event_id, '{\"user\":' || user_id || ',\"inner\":{\"type\":\"' || event_type || '\"}}' AS props FROM events")
def p04(spark, sf_dir):
    nested = F.struct(F.col("user_id").alias("user"), F.struct(F.col("value").alias("value"), F.col("event_type").alias("type")).alias("inner"))
    made = table(spark, sf_dir, "events").select("event_id", nested.alias("props"))
    return op.drop_paths(made, "props", ["inner.value", "absent"]).select("event_id", F.to_json("props").alias("props"))


@query("p05_recode", f"WITH {F_SQL} SELECT node, CASE split_part(pos, ' ', 1) WHEN 'STANDARD' THEN 'S' WHEN 'PROMO' THEN 'P' ELSE split_part(pos, ' ', 1) END AS pos FROM f")
def p05(spark, sf_dir):
    first = forest(spark, sf_dir).select("node", F.split_part("pos", F.lit(" "), F.lit(1)).alias("pos"))
    return op.recode(first, "pos", {"STANDARD": "S", "PROMO": "P"}, unknown="keep")


@query("p06_drop_feat", "SELECT p_partkey AS lex_id, 'Brand=' || p_brand AS feats FROM part")
def p06(spark, sf_dir):
    made = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("lex_id"), F.create_map(F.lit("Brand"), "p_brand", F.lit("Type"), "p_type").alias("feats"))
    return op.drop_feat(made, "Type").select("lex_id", F.array_join(F.transform(F.array_sort(F.map_entries("feats")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&").alias("feats"))


@query("p07_add_feat", "SELECT p_partkey AS lex_id, CASE WHEN p_size % 3 = 0 THEN 'Size=' || p_size WHEN p_size % 3 = 1 THEN 'Brand=' || p_brand || '&Size=' || p_size ELSE 'Brand=' || p_brand END AS feats, p_size % 3 = 2 AS conflict FROM part")
def p07(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("lex_id"), "p_brand", "p_size")
    lex = p.select("lex_id", F.create_map(F.lit("Brand"), "p_brand").alias("feats"))
    size = p.where("p_size % 3 <> 2").select("lex_id", F.lit("Size").alias("name"), F.col("p_size").cast("string").alias("value"))
    gone = p.where("p_size % 3 = 0").select("lex_id", F.lit("Brand").alias("name"), F.lit(None).cast("string").alias("value"))
    other = p.where("p_size % 3 = 2").select("lex_id", F.lit("Brand").alias("name"), F.lit("another").alias("value"))
    out, conflicts = op.add_feat(lex, size.unionByName(gone).unionByName(other))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("feats")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")
    return out.join(conflicts.select("lex_id", F.lit(True).alias("c")), "lex_id", "left").select("lex_id", shown.alias("feats"), F.coalesce("c", F.lit(False)).alias("conflict"))


@query("p08_fill_lemid", f"WITH {W_SQL} SELECT lemma, pos, CASE WHEN n % 2 = 0 THEN 'own' || n ELSE lemma || '#' || pos || '??????????????' END AS lemid FROM w")
def p08(spark, sf_dir):
    w = words(spark, sf_dir)
    own = F.when(F.col("n") % 2 == 0, F.concat(F.lit("own"), F.col("n").cast("string"))).when(F.col("n") % 3 == 0, F.concat("lemma", F.lit("#"), "pos"))
    return op.fill_lemid(w.select("lemma", "pos", own.alias("lemid")))


@query("p09_mark_roots", f"WITH {F_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY node) AS k FROM f) SELECT lemma, node FROM k WHERE k = 1 AND parent IS NULL")
def p09(spark, sf_dir):
    f = forest(spark, sf_dir).withColumn("seq", F.col("node"))
    return op.mark_roots(f, f.select("lemma"))


@query("p10_mark_preferring_roots", f"WITH {F_SQL} SELECT lemma, node FROM f QUALIFY row_number() OVER (PARTITION BY lemma ORDER BY parent IS NOT NULL, node) = 1")
def p10(spark, sf_dir):
    f = forest(spark, sf_dir).withColumn("seq", F.col("node"))
    return op.mark_preferring_roots(f, f.select("lemma"))


@query("p11_set_label", f"WITH {W_SQL}, m AS (SELECT c_custkey AS line, lower(split_part(c_mktsegment, ' ', 1)) AS pos, (c_nationkey % 2 = 0) <> (c_acctbal < 0) AS label FROM customer), l AS (SELECT CASE pos WHEN 'building' THEN 'en' WHEN 'machinery' THEN 'de' WHEN 'automobile' THEN 'fr' ELSE 'none' END AS pos, max_by(label, line) AS label FROM m GROUP BY 1) SELECT w.lemma, w.pos, l.label FROM w LEFT JOIN l ON l.pos = w.pos")
def p11(spark, sf_dir):
    segment = F.lower(F.split_part("c_mktsegment", F.lit(" "), F.lit(1)))
    pos = F.when(segment == "building", "en").when(segment == "machinery", "de").when(segment == "automobile", "fr").otherwise("none")
    marks = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("line"), pos.alias("pos"), (F.col("c_nationkey") % 2 == 0).alias("label"), (F.col("c_acctbal") < 0).alias("flip"))
    return op.set_label(words(spark, sf_dir).select("lemma", "pos"), marks, ["pos"])


@query("p12_clear_label_below", f"{FOREST_SQL}, b AS (SELECT DISTINCT c.node FROM c JOIN f ON f.node = c.ancestor WHERE f.n = 9) SELECT f.node, CASE WHEN b.node IS NULL THEN f.pos END AS label FROM f LEFT JOIN b ON b.node = f.node")
def p12(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.clear_label_below(f.select("node", F.col("pos").alias("label")), f.select("node", "parent"), f.where("n = 9"))


@query("p13_chains3", f"WITH {F_SQL} SELECT a.node AS child, b.node AS parent, g.node AS grandparent FROM f a JOIN f b ON a.parent = b.node JOIN f g ON b.parent = g.node WHERE a.pos = g.pos AND a.pos <> b.pos AND NOT ends_with(b.lemma, a.lemma)")
def p13(spark, sf_dir):
    predicate = (F.col("c_pos") == F.col("g_pos")) & (F.col("c_pos") != F.col("p_pos")) & ~F.endswith("p_lemma", "c_lemma")
    return op.chains3(forest(spark, sf_dir), predicate).select(F.col("c_node").alias("child"), F.col("p_node").alias("parent"), F.col("g_node").alias("grandparent"))


@query("p14_edge_scan", f"WITH {F_SQL} SELECT a.node, b.node AS parent FROM f a JOIN f b ON a.parent = b.node WHERE regexp_matches(a.pos, 'ECON|PROMO|STAND|SMALL') AND regexp_matches(b.pos, 'ECON|PROMO|STAND|SMALL') AND a.n % 5 IS NOT DISTINCT FROM b.n % 5")
def p14(spark, sf_dir):
    metal = lambda c: F.col(c).rlike("ECON|PROMO|STAND|SMALL")
    return op.edge_scan(forest(spark, sf_dir), metal("c_pos") & metal("p_pos") & (F.col("c_n") % 5).eqNullSafe(F.col("p_n") % 5)).select(F.col("c_node").alias("node"), F.col("p_node").alias("parent"))


@query("p15_edges_by_feat", f"WITH {F_SQL} SELECT p.node, p.lemma, string_agg(f.lemma, ',' ORDER BY f.lemma) AS targets FROM f JOIN f p ON p.node = f.parent WHERE f.n % 4 = 1 GROUP BY p.node, p.lemma")
def p15(spark, sf_dir):
    f = forest(spark, sf_dir)
    feats = F.create_map(F.lit("Label"), F.when(F.col("n") % 4 == 1, "Female").otherwise("Other"))
    relations = f.where("parent IS NOT NULL").select(F.col("parent").alias("main_source"), F.col("node").alias("target"), feats.alias("feats"))
    return op.edges_by_feat(relations, f, "Label", "Female")


@query("p16_children_of_class", f"WITH {F_SQL} SELECT a.node, a.lemma, b.lemma AS parent_lemma FROM f a JOIN f b ON a.parent = b.node WHERE b.pos = 'SMALL'")
def p16(spark, sf_dir):
    return op.children_of_class(forest(spark, sf_dir), "SMALL")


@query("p17_clean_wordlist", f"WITH {W_SQL} SELECT lemma, pos, n FROM w WHERE length(lemma) >= 3 AND n >= 2 AND regexp_matches(lemma, '[aeiouyáéíóúýäöüèêàâôîûëïœæ]')")
def p17(spark, sf_dir):
    return op.clean_wordlist(words(spark, sf_dir))


PAIRS_SQL = f"WITH {F_SQL}, pr AS (SELECT b.lemma AS a, b.pos AS a_pos, a.lemma AS b, a.pos AS b_pos FROM f a JOIN f b ON a.parent = b.node)"


def edge_pairs(spark, sf_dir):
    return op.edge_scan(forest(spark, sf_dir), F.lit(True)).select(F.col("p_lemma").alias("a"), F.col("p_pos").alias("a_pos"), F.col("c_lemma").alias("b"), F.col("c_pos").alias("b_pos"))


@query("p18_plausible_pairs", f"{PAIRS_SQL} SELECT * FROM pr WHERE (a_pos = b_pos OR (a_pos LIKE '%' AND a_pos = 'SMALL' AND b_pos = 'PROMO')) AND lower(left(a, 2)) = lower(left(b, 2))")
def p18(spark, sf_dir):
    return op.plausible_pairs(edge_pairs(spark, sf_dir), pos_pairs=(("SMALL", "PROMO"),))


@query("p18_plausible_pairs_loose", f"{PAIRS_SQL} SELECT * FROM pr WHERE lower(left(a, 1)) = lower(left(b, 1))")
def p18_loose(spark, sf_dir):
    return op.plausible_pairs(edge_pairs(spark, sf_dir), strict=False)


@query("j01_resolve_first", f"WITH {LEX_SQL}, {REFS_SQL} SELECT refs.ref_id, min(lex.node) AS node FROM refs JOIN lex ON lex.lemma = refs.lemma AND lex.pos = refs.pos GROUP BY refs.ref_id")
def j01(spark, sf_dir):
    return rs.resolve(refs(spark, sf_dir), lexemes(spark, sf_dir), ["lemma", "pos"])[0]


@query("j01_resolve_all", f"WITH {LEX_SQL}, {REFS_SQL} SELECT refs.ref_id, lex.node FROM refs JOIN lex ON lex.lemma = refs.lemma AND lex.pos = refs.pos")
def j01_all(spark, sf_dir):
    return rs.resolve(refs(spark, sf_dir), lexemes(spark, sf_dir), ["lemma", "pos"], "all")[0]


@query("j01_resolve_unique", f"WITH {LEX_SQL}, {REFS_SQL}, k AS (SELECT lemma, pos, count(*) AS n FROM lex GROUP BY lemma, pos) SELECT refs.ref_id, CASE WHEN k.n IS NULL THEN 'missing' ELSE 'ambiguous' END AS reason FROM refs LEFT JOIN k ON k.lemma = refs.lemma AND k.pos = refs.pos WHERE k.n IS NULL OR k.n > 1")
def j01_unique(spark, sf_dir):
    return rs.resolve(refs(spark, sf_dir), lexemes(spark, sf_dir), ["lemma", "pos"], "unique_only")[1]


@query("j02_resolve_cascade", f"WITH {LEX_SQL}, {REFS_SQL}, a AS (SELECT refs.ref_id, min(lex.node) AS node FROM refs JOIN lex ON lex.lemma = refs.lemma AND lex.pos = refs.pos GROUP BY 1), b AS (SELECT refs.ref_id, min(lex.node) AS node FROM refs JOIN lex ON lex.lemma = refs.lemma AND lex.tech = refs.tech GROUP BY 1), "
       "d AS (SELECT refs.ref_id, min(lex.node) AS node FROM refs JOIN lex ON lex.lemma = refs.lemma GROUP BY 1) SELECT d.ref_id, coalesce(a.node, b.node, d.node) AS node, CASE WHEN a.node IS NOT NULL THEN 0 WHEN b.node IS NOT NULL THEN 1 ELSE 2 END AS level FROM d LEFT JOIN a ON a.ref_id = d.ref_id LEFT JOIN b ON b.ref_id = d.ref_id")
def j02(spark, sf_dir):
    return rs.resolve_cascade(refs(spark, sf_dir), lexemes(spark, sf_dir), [[("lemma", "lemma"), ("pos", "pos")], [("lemma", "lemma"), ("tech", "tech")], [("lemma", "lemma")]])


@query("j03_best_pair", f"WITH {F_SQL}, x AS (SELECT *, n % 4 AS h FROM f), pr AS (SELECT node AS pair_id, 0 FROM f), q AS (SELECT a.node AS pair_id, b.lemma AS source, a.lemma AS target FROM f a JOIN f b ON b.node = a.node // 7 WHERE a.node <> b.node), "
       "m AS (SELECT q.pair_id, s.node AS source_node, t.node AS target_node, CASE WHEN t.parent = s.node THEN 0 WHEN s.h = t.h THEN 1 WHEN t.parent IS NULL THEN 2 ELSE 3 END AS rank FROM q JOIN x s ON s.lemma = q.source JOIN x t ON t.lemma = q.target) "
       "SELECT pair_id, source_node, target_node, rank FROM m QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY rank, source_node, target_node) = 1")
def j03(spark, sf_dir):
    f = forest(spark, sf_dir)
    b = f.select(F.col("node").alias("m"), F.col("lemma").alias("source"))
    pairs = f.join(b, (F.floor(F.col("node") / 7) == F.col("m")) & (F.col("node") != F.col("m"))).select(F.col("node").alias("pair_id"), "source", F.col("lemma").alias("target"))
    return rs.best_pair(pairs, f.withColumn("seq", F.col("node")).withColumn("homonym", F.col("n") % 4), f.select("node", "parent"))


@query("j04_resolve_preferring", f"WITH {LEX_SQL}, {REFS_SQL}, pf AS (SELECT lemma, max(lemid) AS lemid FROM lex GROUP BY lemma HAVING count(*) % 2 = 0), k AS (SELECT refs.ref_id, lex.node, row_number() OVER (PARTITION BY refs.ref_id ORDER BY NOT coalesce(lex.lemid = pf.lemid, false), lex.pos <> 'Brand#11', lex.seq) AS k FROM refs LEFT JOIN pf ON pf.lemma = refs.lemma JOIN lex ON lex.lemma = refs.lemma) SELECT ref_id, node FROM k WHERE k = 1")
def j04(spark, sf_dir):
    lex = lexemes(spark, sf_dir)
    preferred = lex.groupBy("lemma").agg(F.max("lemid").alias("lemid"), F.count(F.lit(1)).alias("n")).where("n % 2 = 0").select("lemma", "lemid")
    return rs.resolve_preferring(refs(spark, sf_dir).select("ref_id", "lemma"), lex, preferred, "Brand#11")


PARTS_SQL = f"WITH {W_SQL}, x AS (SELECT lemma, min(n * 1000 + length(lemma)) AS node FROM w GROUP BY lemma), refs AS (SELECT lemma || '/' || pos AS ref_id, [left(lemma, 2), substr(lemma, 3), 'en'] AS lemmas FROM w)"


def part_refs(spark, sf_dir):
    w = words(spark, sf_dir)
    lex = w.select("lemma", (F.col("n") * 1000 + F.length("lemma")).alias("node")).withColumn("seq", F.col("node"))
    return w.select(F.concat_ws("/", "lemma", "pos").alias("ref_id"), F.array(F.substring("lemma", 1, 2), F.expr("substring(lemma, 3)"), F.lit("en")).alias("lemmas")), lex


@query("j05_resolve_parts", PARTS_SQL + ", e AS (SELECT ref_id, unnest(lemmas) AS lemma, generate_subscripts(lemmas, 1) AS i FROM refs), m AS (SELECT ref_id, string_agg(node::VARCHAR, ',' ORDER BY i) AS nodes, count(*) AS k FROM e JOIN x USING (lemma) GROUP BY ref_id) SELECT ref_id, nodes FROM m WHERE k = 3")
def j05(spark, sf_dir):
    parts, lex = part_refs(spark, sf_dir)
    return rs.resolve_all(parts, lex).select("ref_id", F.array_join(F.transform("nodes", lambda n: n.cast("string")), ",").alias("nodes"))


@query("j06_resolve_some_parts", PARTS_SQL + ", e AS (SELECT ref_id, unnest(lemmas) AS lemma, generate_subscripts(lemmas, 1) AS i FROM refs), m AS (SELECT ref_id, string_agg(node::VARCHAR, ',' ORDER BY i) AS nodes, count(*) AS k FROM e JOIN x USING (lemma) GROUP BY ref_id) SELECT ref_id, nodes FROM m WHERE k >= 2")
def j06(spark, sf_dir):
    parts, lex = part_refs(spark, sf_dir)
    return rs.resolve_all(parts, lex, at_least=2).select("ref_id", F.array_join(F.transform("nodes", lambda n: n.cast("string")), ",").alias("nodes"))


@query("j07_copy_feature", f"WITH {F_SQL}, {F2_SQL}, s AS (SELECT node, lemma || '#' || node AS lemid, lemma, pos, CASE WHEN n % 3 <> 0 THEN n END AS aspect FROM f2), a AS (SELECT lemid, min_by(aspect, node) AS v FROM s WHERE aspect IS NOT NULL GROUP BY lemid), b AS (SELECT lemma, pos, min_by(aspect, node) AS v FROM s WHERE aspect IS NOT NULL GROUP BY lemma, pos) "
       "SELECT f.node, coalesce(a.v, b.v) AS aspect FROM f LEFT JOIN a ON a.lemid = f.lemma || '#' || f.node LEFT JOIN b ON b.lemma = f.lemma AND b.pos = f.pos")
def j07(spark, sf_dir):
    named = lambda df: df.withColumn("lemid", F.concat("lemma", F.lit("#"), F.col("node").cast("string"))).withColumn("seq", F.col("node"))
    src = named(forest2(spark, sf_dir)).withColumn("aspect", F.when(F.col("n") % 3 != 0, F.col("n")))
    return rs.copy_feature(named(forest(spark, sf_dir)), src, "aspect").select("node", "aspect")


@query("j08_membership", f"WITH {W_SQL}, l AS (SELECT lemma, max(n > 1) AS known FROM w GROUP BY lemma) SELECT w.lemma, w.pos, coalesce(l.known, false) AS known, true AS single FROM w JOIN l USING (lemma)")
def j08(spark, sf_dir):
    w = words(spark, sf_dir)
    return rs.membership(w.select("lemma", "pos"), w.where("n > 1"), ["lemma"])


@query("j09_mark_listed", f"WITH {W_SQL} SELECT lemma, pos, lemma IN (SELECT lemma FROM w WHERE pos = 'fr') AS listed FROM w")
def j09(spark, sf_dir):
    w = words(spark, sf_dir)
    return rs.mark_listed(w.select("lemma", "pos"), w.where("pos = 'fr'"), ["lemma"])


@query("j10_overlap_pairs", "WITH s AS (SELECT DISTINCT l_orderkey AS set_id, l_partkey AS element FROM lineitem) SELECT a.set_id AS a, b.set_id AS b, count(*) AS shared FROM s a JOIN s b ON a.element = b.element AND a.set_id < b.set_id WHERE a.set_id % 4 <> b.set_id % 4 GROUP BY 1, 2")
def j10(spark, sf_dir):
    sets = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("set_id"), F.col("l_partkey").alias("element"), (F.col("l_orderkey") % 4).alias("batch"))
    return rs.overlap_pairs(sets, across="batch")


@query("j11_external_parents", f"{FOREST_SQL}, pr AS (SELECT DISTINCT a.lemma AS child, b.lemma AS parent FROM f a JOIN f b ON b.node = a.node // 9 + 1) SELECT DISTINCT t.node, p.node AS parent_node FROM pr JOIN f t ON t.lemma = pr.child AND t.parent IS NULL JOIN f p ON p.lemma = pr.parent JOIN r ON r.node = p.node WHERE r.root <> t.node")
def j11(spark, sf_dir):
    f = forest(spark, sf_dir)
    b = f.select(F.col("node").alias("m"), F.col("lemma").alias("parent"))
    pairs = f.select("node", F.col("lemma").alias("child")).join(b, F.floor(F.col("node") / 9) + 1 == F.col("m")).select("child", "parent").distinct()
    return rs.external_parents(f.select("node", "parent"), f.select("node", "lemma"), pairs, roots_of(f.select("node", "parent")))


@query("j12_confirm", f"WITH {F_SQL}, {F2_SQL} SELECT f2.parent, f2.node, CASE WHEN f.node IS NOT NULL THEN '%' ELSE '' END AS mark FROM f2 LEFT JOIN f ON f.node = f2.node AND f.parent = f2.parent WHERE f2.parent IS NOT NULL")
def j12(spark, sf_dir):
    return rs.confirm(forest2(spark, sf_dir).where("parent IS NOT NULL").select("parent", "node"), forest(spark, sf_dir))


@query("j13_classify_pairs", f"WITH {F_SQL}, x AS (SELECT node, parent, lemma || '/' || (node % 40) AS lemma FROM f), q AS (SELECT a.node AS pair_id, b.lemma AS parent, CASE WHEN a.node % 50 = 0 THEN 'nothing' ELSE a.lemma END AS child FROM x a JOIN x b ON b.node = a.node // 4), "
       "j AS (SELECT q.pair_id, q.parent, c.node, p.lemma AS pl FROM q LEFT JOIN x c ON c.lemma = q.child LEFT JOIN x p ON p.node = c.parent) "
       "SELECT pair_id, CASE WHEN count(node) = 0 THEN 'unknown' WHEN coalesce(max(pl = parent), false) THEN 'same' WHEN count(pl) > 0 THEN 'other' WHEN count(node) = 1 THEN 'unique' ELSE 'ambiguous' END AS kind FROM j GROUP BY pair_id")
def j13(spark, sf_dir):
    x = forest(spark, sf_dir).select("node", "parent", F.concat_ws("/", "lemma", (F.col("node") % 40).cast("string")).alias("lemma"))
    b = x.select(F.col("node").alias("m"), F.col("lemma").alias("up"))
    pairs = x.select("node", "lemma").join(b, F.floor(F.col("node") / 4) == F.col("m")).select(F.col("node").alias("pair_id"), F.col("up").alias("parent"), F.when(F.col("node") % 50 == 0, "nothing").otherwise(F.col("lemma")).alias("child"))
    return rs.classify_pairs(pairs, x)
