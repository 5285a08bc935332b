"""Registered queries for candidates and for set operations, over the words of ``documents``, parts and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordgrove.operators import candidates as op
from wordgrove.operators import sets as so
from wordgrove.plans.bindings import F2_SQL, F_SQL, FOREST_SQL, W_SQL, forest, forest2, table
from wordgrove.plans.bindings import kept_words as words
from wordgrove.plans.registry import query

#: Rules that suit the invented words: (rule, from_suffix, from_pos, to_suffix, to_pos).
RULES = [("r1", "", "en", "en", "en"), ("r2", "", "en", "th", "en"), ("r3", "", "en", "er", "en"), ("r4", "an", "en", "at", "en"), ("r5", "", "de", "ung", "de"), ("r6", "o", "es", "a", "es")]
RULES_SQL = "rules(rule, from_suffix, from_pos, to_suffix, to_pos) AS (VALUES " + ", ".join(str(r) for r in RULES) + ")"
LINKED_SQL = "linked AS (SELECT DISTINCT lemma FROM w WHERE n % 3 = 0)"
#: Cut first and joined on the made word afterwards: DuckDB would else meet all pairs of words.
APPLY_SQL = "cut AS MATERIALIZED (SELECT t.lemma AS target, r.rule, r.from_pos, left(t.lemma, length(t.lemma) - length(r.to_suffix)) AS stem, r.from_suffix, length(r.to_suffix) AS size FROM w t JOIN rules r ON t.pos = r.to_pos AND right(t.lemma, length(r.to_suffix)) = r.to_suffix AND length(t.lemma) > length(r.to_suffix)), made AS MATERIALIZED (SELECT *, stem || from_suffix AS source FROM cut), ap AS (SELECT m.source, m.target, m.rule, m.size FROM made m JOIN w s ON s.pos = m.from_pos AND s.lemma = m.source WHERE s.lemma <> m.target)"


def rules(spark):
    return spark.createDataFrame(RULES, "rule string, from_suffix string, from_pos string, to_suffix string, to_pos string")


@query("c01_mine_suffix_rules", f"WITH {W_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY left(lemma, 2) ORDER BY lemma, pos) AS k FROM w WHERE length(lemma) >= 2), p AS (SELECT a.lemma, a.pos, b.lemma AS other, b.pos AS other_pos FROM o a JOIN o b ON left(a.lemma, 2) = left(b.lemma, 2) AND b.k BETWEEN a.k - 6 AND a.k - 1), "
       "q AS (SELECT *, list_max(list_filter(range(0, 40), lambda i: i <= least(length(lemma), length(other)) AND left(lemma, i) = left(other, i))) AS k FROM p) SELECT other_pos AS from_pos, substr(other, k + 1) AS from_suffix, pos AS to_pos, substr(lemma, k + 1) AS to_suffix, count(*) AS n FROM q GROUP BY 1, 2, 3, 4")
def c01(spark, sf_dir):
    return op.mine_suffix_rules(words(spark, sf_dir))


@query("c02_apply_suffix_rules", f"WITH {W_SQL}, {RULES_SQL}, {APPLY_SQL}, mc AS MATERIALIZED (SELECT target, rule, from_pos, left(stem, length(stem) - 2) || 'th' || from_suffix AS source FROM cut WHERE ends_with(stem, 'ed')), "
       "ch AS (SELECT m.source, m.target, m.rule FROM mc m JOIN w s ON s.pos = m.from_pos AND s.lemma = m.source WHERE m.source <> m.target) SELECT source, target, rule, false AS changed FROM ap UNION ALL SELECT source, target, rule, true FROM ch")
def c02(spark, sf_dir):
    return op.apply_suffix_rules(words(spark, sf_dir), rules(spark), [("ed", "th")])


@query("c02_rule_flags", f"WITH {W_SQL}, {RULES_SQL}, {APPLY_SQL}, e AS (SELECT left(lemma, length(lemma) - 2) AS source, lemma AS target FROM w WHERE n % 2 = 0 AND length(lemma) > 2 GROUP BY lemma) SELECT ap.source, ap.target, ap.rule, false AS changed, false AS capitalised, e.target IS NOT NULL AS linked FROM ap LEFT JOIN e ON e.source = ap.source AND e.target = ap.target")
def c02_flags(spark, sf_dir):
    w = words(spark, sf_dir)
    linked = w.where("n % 2 = 0 AND length(lemma) > 2").select(F.expr("substring(lemma, 1, length(lemma) - 2)").alias("source"), F.col("lemma").alias("target"))
    return op.apply_suffix_rules(w, rules(spark), edges=linked, capitalised=True)


@query("c03_open_stem_candidates", f"WITH {W_SQL}, x AS (SELECT DISTINCT lemma FROM w), s(suffix) AS (VALUES (''), ('en'), ('th')), k AS MATERIALIZED (SELECT x.lemma AS target, left(x.lemma, length(x.lemma) - cut) || suffix AS source, (-2 * cut - length(suffix))::INTEGER AS score FROM x, range(0, 5) r(cut), s WHERE length(x.lemma) - cut >= 3), m AS (SELECT k.target, k.source, k.score FROM k JOIN x ON x.lemma = k.source WHERE k.source <> k.target) "
       "SELECT source, target, score FROM m QUALIFY row_number() OVER (PARTITION BY target ORDER BY score DESC, source) = 1")
def c03(spark, sf_dir):
    return op.open_stem_candidates(words(spark, sf_dir).select("lemma").distinct(), spark.createDataFrame([("",), ("en",), ("th",)], "suffix string"))


@query("c04_unexploited", f"WITH {W_SQL}, {RULES_SQL}, {APPLY_SQL}, {LINKED_SQL} SELECT source, target, rule FROM ap WHERE target NOT IN (SELECT lemma FROM linked) QUALIFY row_number() OVER (PARTITION BY target ORDER BY size DESC, rule, source) = 1")
def c04(spark, sf_dir):
    w = words(spark, sf_dir)
    return op.unexploited(w, w.where("n % 3 = 0"), rules(spark))


@query("c05_rule_cascade", f"WITH {W_SQL}, r(rank, rule, from_suffix, to_suffix) AS (VALUES (1, 'a', '', 'en'), (2, 'b', 'an', 'en'), (3, 'c', '', 'er')), p AS (SELECT DISTINCT t.lemma AS target, rank, rule, left(t.lemma, length(t.lemma) - length(to_suffix)) || from_suffix AS source FROM w t JOIN r ON ends_with(t.lemma, to_suffix) AND length(t.lemma) > length(to_suffix)), "
       "f AS (SELECT p.target, p.rank, p.rule, p.source FROM p JOIN w ON w.lemma = p.source GROUP BY ALL HAVING count(*) = 1), b AS (SELECT target, arg_min(rule, rank) AS rule, arg_min(source, rank) AS source FROM f GROUP BY target) SELECT d.target, coalesce(b.rule, 'UNRESOLVED') AS rule, b.source FROM (SELECT DISTINCT target FROM p) d LEFT JOIN b ON b.target = d.target")
def c05(spark, sf_dir):
    ranked = spark.createDataFrame([(1, "a", "", "en"), (2, "b", "an", "en"), (3, "c", "", "er")], "rank int, rule string, from_suffix string, to_suffix string")
    return op.rule_cascade(words(spark, sf_dir), ranked)


@query("c06_pattern_search", f"WITH {W_SQL}, e AS (SELECT lemma, CASE WHEN n % 2 = 0 THEN left(lemma, length(lemma) - 2) ELSE 'elsewhere' END AS parent_lemma FROM w WHERE n % 4 < 2 AND length(lemma) > 2), tg AS (SELECT DISTINCT lemma AS target, left(lemma, length(lemma) - 2) AS source FROM w WHERE ends_with(lemma, 'er')), k AS (SELECT lemma, count(*) AS n FROM w GROUP BY lemma) "
       "SELECT t.target, t.source, CASE WHEN EXISTS (SELECT 1 FROM e WHERE e.lemma = t.target AND e.parent_lemma = t.source) THEN 'A' WHEN EXISTS (SELECT 1 FROM e WHERE e.lemma = t.target) THEN 'B' WHEN k.n = 1 THEN 'C' WHEN k.n > 1 THEN 'D' ELSE 'E' END AS code FROM tg t LEFT JOIN k ON k.lemma = t.source")
def c06(spark, sf_dir):
    w = words(spark, sf_dir)
    up = F.when(F.col("n") % 2 == 0, F.expr("substring(lemma, 1, length(lemma) - 2)")).otherwise("elsewhere")
    return op.pattern_search(w, w.where("n % 4 < 2 AND length(lemma) > 2").select("lemma", up.alias("parent_lemma")), "", "er")


@query("c07_rules_with_exceptions", f"WITH {W_SQL}, x AS (SELECT DISTINCT lemma FROM w), ex AS (SELECT lemma AS target, CASE WHEN length(lemma) % 2 = 0 THEN 'the' END AS source FROM x WHERE length(lemma) % 3 = 0), c AS (SELECT lemma AS target, left(lemma, length(lemma) - 2) AS by_rule FROM x WHERE ends_with(lemma, 'th') AND length(lemma) > 2), "
       "j AS (SELECT c.target, CASE WHEN ex.target IS NOT NULL THEN ex.source ELSE c.by_rule END AS source, ex.target IS NOT NULL AS is_ex FROM c LEFT JOIN ex ON ex.target = c.target) SELECT j.target, 'th' AS rule, j.source, CASE WHEN is_ex AND source IS NULL THEN 3 WHEN x.lemma IS NULL THEN 2 WHEN is_ex THEN 1 ELSE 0 END AS situation FROM j LEFT JOIN x ON x.lemma = j.source")
def c07(spark, sf_dir):
    w = words(spark, sf_dir)
    exceptions = w.select("lemma").distinct().where("length(lemma) % 3 = 0").select(F.col("lemma").alias("target"), F.when(F.length("lemma") % 2 == 0, "the").alias("source"))
    return op.rules_with_exceptions(w, spark.createDataFrame([("th", "", "th")], "rule string, from_suffix string, to_suffix string"), exceptions)


@query("c08_ending_alternatives", f"WITH {W_SQL}, x AS (SELECT DISTINCT lemma FROM w), o(rank, e) AS (VALUES (0, 'er'), (1, 'en'), (2, '')), m AS (SELECT a.lemma AS target, b.lemma AS source, o.rank FROM x a, o JOIN x b ON b.lemma = left(a.lemma, length(a.lemma) - 2) || o.e WHERE ends_with(a.lemma, 'ed')) SELECT target, arg_min(source, rank) AS source, min(rank) AS rank FROM m GROUP BY target")
def c08(spark, sf_dir):
    return op.ending_alternatives(words(spark, sf_dir), "ed", ["er", "en", ""])


@query("c09_strip_prefixes", f"WITH {W_SQL}, p(prefix) AS (VALUES ('be'), ('ver'), ('en'), ('re'), ('in')), cut AS MATERIALIZED (SELECT t.lemma AS target, t.pos, p.prefix, substr(t.lemma, length(p.prefix) + 1) AS source FROM w t JOIN p ON starts_with(t.lemma, p.prefix) AND length(t.lemma) >= length(p.prefix) + 2) "
       "SELECT cut.source, cut.target, cut.pos, cut.prefix FROM cut JOIN w s ON s.pos = cut.pos AND s.lemma = cut.source QUALIFY row_number() OVER (PARTITION BY cut.target, cut.pos ORDER BY length(cut.prefix) DESC) = 1")
def c09(spark, sf_dir):
    return op.strip_prefixes(words(spark, sf_dir), ["be", "ver", "en", "re", "in"])


@query("c10_phantom_children", f"WITH {W_SQL}, {LINKED_SQL}, x AS (SELECT DISTINCT lemma FROM w), ph AS (SELECT DISTINCT reverse(lemma) AS phantom FROM x WHERE length(lemma) BETWEEN 3 AND 5 AND reverse(lemma) NOT IN (SELECT lemma FROM x)) SELECT x.lemma, ph.phantom FROM x, range(3, 6) r(k) JOIN ph ON ph.phantom = right(x.lemma, k) WHERE length(x.lemma) > k AND x.lemma NOT IN (SELECT lemma FROM linked)")
def c10(spark, sf_dir):
    w = words(spark, sf_dir)
    return op.phantom_children(w, w.where("n % 3 = 0"), w.where("length(lemma) BETWEEN 3 AND 5").select(F.reverse("lemma").alias("lemma")))


@query("c11_split_compounds", f"WITH {W_SQL}, x AS (SELECT DISTINCT lemma FROM w), p AS (SELECT lemma AS target, pos, split_part(lemma, 'o', 1) AS a, split_part(lemma, 'o', 2) AS head FROM w WHERE regexp_full_match(lemma, '[^o]{{2,}}o[^o]{{2,}}')), e(e) AS (VALUES (''), ('e'), ('en')), m AS (SELECT DISTINCT p.target, p.pos, x.lemma AS modifier, p.head FROM p JOIN w h ON h.lemma = p.head AND h.pos = p.pos, e JOIN x ON x.lemma = p.a || e.e) SELECT target, pos, min(modifier) AS modifier, min(head) AS head FROM m GROUP BY target, pos HAVING count(*) = 1")
def c11(spark, sf_dir):
    return op.split_compounds(words(spark, sf_dir), "o", 2, ["", "e", "en"])


@query("c12_conversion_pairs", f"WITH {W_SQL} SELECT a.lemma, a.n AS n_a, b.n AS n_b FROM w a JOIN w b ON a.lemma = b.lemma WHERE a.pos = 'en' AND b.pos = 'de' AND NOT regexp_matches(a.lemma, '^\\p{{Lu}}')")
def c12(spark, sf_dir):
    return op.conversion_pairs(words(spark, sf_dir), "en", "de")


@query("c13_sibling_patterns", f"WITH {F_SQL} SELECT a.parent, a.node AS first, b.node AS second FROM f a JOIN f b ON a.parent = b.parent WHERE ends_with(a.lemma, 'ring') AND ends_with(b.lemma, 'bolt')")
def c13(spark, sf_dir):
    return op.sibling_patterns(forest(spark, sf_dir), "ring", "bolt")


#: Words leave the pool ending by ending, from six letters down to three.
SUFFIX_SQL = f"WITH {W_SQL}, left6 AS (SELECT DISTINCT lemma FROM w)" + "".join(
    f", hit{k} AS (SELECT right(lemma, {k}) AS suffix, lemma FROM left{k} WHERE length(lemma) >= {k} QUALIFY count(*) OVER (PARTITION BY right(lemma, {k})) >= 2), left{k - 1} AS (SELECT lemma FROM left{k} WHERE lemma NOT IN (SELECT lemma FROM hit{k}))" for k in range(6, 2, -1)
)


@query("c14_group_by_suffix", SUFFIX_SQL + " UNION ALL ".join(f" SELECT suffix, lemma FROM hit{k}" for k in range(6, 2, -1)))
def c14(spark, sf_dir):
    return op.group_by_suffix(words(spark, sf_dir), max_len=6, min_len=3)


PAIR_SQL = f"{{with}}, pr AS (SELECT b.lemma AS source, a.lemma AS target FROM w a JOIN w b ON a.pos = b.pos AND length(a.lemma) > 4 AND b.lemma = left(a.lemma, length(a.lemma) - 2) || 'th' AND a.lemma <> b.lemma)".replace("{with}", f"WITH {W_SQL}")


def word_pairs(spark, sf_dir):
    w = words(spark, sf_dir)
    made = w.where("length(lemma) > 4").select(F.col("lemma").alias("target"), "pos", F.expr("concat(substring(lemma, 1, length(lemma) - 2), 'th')").alias("source"))
    return made.join(w.select(F.col("lemma").alias("source"), "pos"), ["source", "pos"]).where("source <> target").select("source", "target")


@query("c15_group_by_rule_shape", PAIR_SQL + ", q AS (SELECT *, list_max(list_filter(range(0, 40), lambda i: i <= least(length(source), length(target)) AND left(source, i) = left(target, i))) AS k FROM pr), s AS (SELECT source, target, substr(source, k + 1) || '>' || substr(target, k + 1) AS shape FROM q) SELECT source, target, shape, count(*) OVER (PARTITION BY shape) AS n FROM s")
def c15(spark, sf_dir):
    return op.group_by_rule_shape(word_pairs(spark, sf_dir))


@query("c16_orient_by_length", f"WITH {F_SQL} SELECT CASE WHEN length(p.lemma) > length(f.lemma) THEN f.lemma ELSE p.lemma END AS source, CASE WHEN length(p.lemma) > length(f.lemma) THEN p.lemma ELSE f.lemma END AS target, length(p.lemma) > length(f.lemma) AS turned FROM f JOIN f p ON p.node = f.parent")
def c16(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.orient_by_length(f.join(f.select(F.col("node").alias("parent"), F.col("lemma").alias("source")), "parent").select("source", F.col("lemma").alias("target")))


@query("c17_missing_from_tree", f"{FOREST_SQL} SELECT f.node // 6 AS head, f.node AS member, CASE WHEN r.root = f.node THEN 'direct' ELSE 'via' END AS proposal, r.root AS top FROM f JOIN r ON r.node = f.node JOIN r h ON h.node = f.node // 6 WHERE h.root <> r.root")
def c17(spark, sf_dir):
    from wordgrove.operators.forest import roots_of

    f = forest(spark, sf_dir)
    return op.missing_from_tree(f, roots_of(f.select("node", "parent")), f.select(F.floor(F.col("node") / 6).cast("long").alias("head"), F.col("node").alias("member")))


@query("c18_normalise_entries", "WITH e AS (SELECT p_partkey AS entry_id, CASE p_size % 3 WHEN 0 THEN left(p_name, 2) || '(xy)' || substr(p_name, 3) WHEN 1 THEN p_name || '/' || lower(p_type) || '1' ELSE p_name END AS entry, p_size, p_name, p_type FROM part), "
       "f AS (SELECT entry_id, unnest(CASE p_size % 3 WHEN 0 THEN [p_name, left(p_name, 2) || 'xy' || substr(p_name, 3)] WHEN 1 THEN [p_name, lower(p_type) || '1'] ELSE [p_name] END) AS form FROM e) SELECT DISTINCT entry_id, regexp_replace(split_part(trim(form), ' ', 1), '[^\\p{L}]', '', 'g') AS word FROM f WHERE regexp_replace(split_part(trim(form), ' ', 1), '[^\\p{L}]', '', 'g') <> ''")
def c18(spark, sf_dir):
    k = F.col("p_size") % 3
    entry = F.when(k == 0, F.concat(F.substring("p_name", 1, 2), F.lit("(xy)"), F.expr("substring(p_name, 3)"))).when(k == 1, F.concat("p_name", F.lit("/"), F.lower("p_type"), F.lit("1"))).otherwise(F.col("p_name"))
    return op.normalise_entries(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entry_id"), entry.alias("entry")))


@query("c19_pairs_from_markup", """WITH p AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html FROM pages), m AS (SELECT page_id, title, 'link' AS kind, unnest(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 2)) AS item FROM p UNION ALL SELECT page_id, title, 'heading', unnest(regexp_extract_all(html, '<h[1-6]>([^<]*)</h[1-6]>', 1)) FROM p) SELECT DISTINCT page_id, title, kind, item FROM m WHERE item <> '' AND NOT regexp_matches(item, '[\\s-]')""")
def c19(spark, sf_dir):
    patterns = spark.createDataFrame([("link", '<a href="/([^"]*)">([^<]*)</a>', 2), ("heading", "<h[1-6]>([^<]*)</h[1-6]>", 1)], "kind string, pattern string, group_no int")
    return op.pairs_from_markup(table(spark, sf_dir, "pages"), patterns, F.regexp_extract("html", "<title>([^<]*)</title>", 1))


@query("c20_plausible_by_bigrams", PAIR_SQL + ", b AS (SELECT source AS a, target AS b, translate(lower(source), 'aeiouyáéíóúýäöüèêàâôîûëïœæ', '') AS x, translate(lower(target), 'aeiouyáéíóúýäöüèêàâôîûëïœæ', '') AS y FROM pr) SELECT a, b FROM b WHERE length(x) >= 2 AND length(y) >= 2 AND list_has_any(list_transform(range(1, length(x)), lambda i: substr(x, i, 2)), list_transform(range(1, length(y)), lambda i: substr(y, i, 2)))")
def c20(spark, sf_dir):
    return op.plausible_by_bigrams(word_pairs(spark, sf_dir).select(F.col("source").alias("a"), F.col("target").alias("b")))


@query("c21_triage_candidates", PAIR_SQL + " SELECT target, CASE WHEN ends_with(target, 'ed') THEN 'ed' WHEN ends_with(target, 'en') THEN 'en' ELSE 'other' END AS ending, CASE WHEN count(*) = 1 THEN 'one' ELSE 'several' END AS kind, arg_min(source, (length(source), source)) AS first, left(target, 1) = left(arg_min(source, (length(source), source)), 1) AS alike FROM pr GROUP BY target")
def c21(spark, sf_dir):
    return op.triage_candidates(word_pairs(spark, sf_dir).withColumn("rank", F.length("source")), ["ed", "en"])


@query("c22_group_permutations", f"WITH {F_SQL} SELECT DISTINCT a.parent AS group_id, a.lemma AS a, b.lemma AS b FROM f a JOIN f b ON a.parent = b.parent WHERE a.lemma <> b.lemma AND left(a.lemma, 1) = left(b.lemma, 1)")
def c22(spark, sf_dir):
    return op.group_permutations(forest(spark, sf_dir).where("parent IS NOT NULL").select(F.col("parent").alias("group_id"), F.col("lemma").alias("word")))


E2_SQL = f"WITH {F_SQL}, {F2_SQL}, e1 AS (SELECT parent, node FROM f WHERE parent IS NOT NULL), e2 AS (SELECT parent, node FROM f2 WHERE parent IS NOT NULL)"


def both_edges(spark, sf_dir):
    return [g(spark, sf_dir).where("parent IS NOT NULL").select("parent", "node") for g in (forest, forest2)]


@query("o01_merge_relations", E2_SQL + ", u AS (SELECT *, 'f1' AS o FROM e1 UNION ALL SELECT *, 'f2' FROM e2) SELECT parent, node, string_agg(DISTINCT o, '+' ORDER BY o) AS origins FROM u GROUP BY parent, node")
def o01(spark, sf_dir):
    return so.merge_relations(both_edges(spark, sf_dir), ["f1", "f2"], ["parent", "node"])


@query("o02_subtract", E2_SQL + " SELECT parent, node FROM e1 EXCEPT SELECT parent, node FROM e2")
def o02(spark, sf_dir):
    a, b = both_edges(spark, sf_dir)
    return so.subtract(a, b, ["parent", "node"])


@query("o03_compare_lists", f"WITH {W_SQL}, a AS (SELECT lemma FROM w WHERE pos = 'en'), b AS (SELECT lemma FROM w WHERE pos = 'fr') SELECT coalesce(a.lemma, b.lemma) AS lemma, CASE WHEN a.lemma IS NOT NULL AND b.lemma IS NOT NULL THEN 'common' WHEN a.lemma IS NOT NULL THEN 'left' ELSE 'right' END AS side FROM a FULL JOIN b ON a.lemma = b.lemma")
def o03(spark, sf_dir):
    w = words(spark, sf_dir)
    return so.compare_lists(w.where("pos = 'en'"), w.where("pos = 'fr'"), ["lemma"])


@query("o04_mark_deleted", f"WITH {F_SQL}, k AS (SELECT DISTINCT replace(lemma || n, ' ', '') AS k FROM f WHERE n % 3 = 0) SELECT node AS line, CASE WHEN replace(lemma || ' ' || n, ' ', '') IN (SELECT k FROM k) THEN lemma || ' ' || n ELSE '*' || lemma || ' ' || n END AS value FROM f")
def o04(spark, sf_dir):
    f = forest(spark, sf_dir)
    line = lambda sep: F.concat("lemma", F.lit(sep), F.col("n").cast("string"))
    return so.mark_deleted(f.select(F.col("node").alias("line"), line(" ").alias("value")), f.where("n % 3 = 0").select(line("  ").alias("value")))


@query("o04_drop_contradicted", f"WITH {F_SQL}, l AS (SELECT node AS line, CASE WHEN n % 2 = 0 THEN '*' ELSE '' END || lemma || (n % 4 // 2) AS value FROM f) SELECT line, value FROM l WHERE NOT starts_with(value, '*') OR substr(value, 2) NOT IN (SELECT value FROM l)")
def o04_drop(spark, sf_dir):
    value = F.concat(F.when(F.col("n") % 2 == 0, "*").otherwise(""), "lemma", F.floor(F.col("n") % 4 / 2).cast("string"))
    return so.drop_contradicted(forest(spark, sf_dir).select(F.col("node").alias("line"), value.alias("value")))


@query("o05_overlay", f"WITH {F_SQL}, {F2_SQL}, l AS (SELECT node, pos AS label, n::DOUBLE AS probability FROM f WHERE node % 3 <> 0), x AS (SELECT node, CASE WHEN n % 2 = 0 THEN '$' ELSE '+' END AS mark, pos AS new FROM f2 WHERE node % 2 = 0) SELECT coalesce(l.node, x.node) AS node, CASE WHEN mark = '$' THEN NULL WHEN mark = '+' THEN new ELSE label END AS label, CASE WHEN mark IS NULL THEN probability END AS probability FROM l FULL JOIN x ON l.node = x.node WHERE label IS NOT NULL OR mark = '+'")
def o05(spark, sf_dir):
    labels = forest(spark, sf_dir).where("node % 3 <> 0").select("node", F.col("pos").alias("label"), F.col("n").cast("double").alias("probability"))
    fixes = forest2(spark, sf_dir).where("node % 2 = 0").select("node", F.when(F.col("n") % 2 == 0, "$").otherwise("+").alias("mark"), F.col("pos").alias("label"))
    return so.overlay(labels, fixes, ["node"])


@query("o06_route", f"WITH {F_SQL} SELECT node, CASE WHEN parent IS NULL THEN 'unmotivated' WHEN contains(lemma, 'ring') THEN 'variants' WHEN n % 7 = 0 THEN 'delete' WHEN n > 30 THEN 'compounds' ELSE 'derivations' END AS route FROM f")
def o06(spark, sf_dir):
    ladder = [("unmotivated", F.col("parent").isNull()), ("variants", F.contains("lemma", F.lit("ring"))), ("delete", F.col("n") % 7 == 0), ("compounds", F.col("n") > 30)]
    return so.route(forest(spark, sf_dir), ladder, "derivations").select("node", "route")


@query("o07_annotation_issues", f"WITH {F_SQL}, x AS (SELECT node, lemma || '/' || (n % 9) AS lemma FROM f), a AS (SELECT f.node AS line, CASE f.n % 5 WHEN 0 THEN '?!' WHEN 1 THEN '*' ELSE '' END AS mark, p.lemma || '/' || (p.n % 9) AS a, f.lemma || '/' || (f.n % 10) AS b FROM f JOIN f p ON p.node = f.parent), k AS (SELECT lemma, count(*) AS n FROM x GROUP BY lemma), "
       "s AS (SELECT line, a AS lemma FROM a UNION ALL SELECT line, b FROM a) SELECT line, 'illegal mark' AS issue, mark AS detail FROM a WHERE mark = '?!' UNION ALL SELECT s.line, CASE WHEN k.n IS NULL THEN 'unknown word' ELSE 'ambiguous word' END, s.lemma FROM s LEFT JOIN k ON k.lemma = s.lemma WHERE k.n IS NULL OR k.n > 1 UNION ALL SELECT line, 'different start', a || '>' || b FROM a WHERE lower(left(a, 1)) <> lower(left(b, 1))")
def o07(spark, sf_dir):
    f = forest(spark, sf_dir)
    named = lambda k: F.concat_ws("/", "lemma", (F.col("n") % k).cast("string"))
    up = f.select(F.col("node").alias("parent"), named(9).alias("a"))
    mark = F.when(F.col("n") % 5 == 0, "?!").when(F.col("n") % 5 == 1, "*").otherwise("")
    return so.annotation_issues(f.join(up, "parent").select(F.col("node").alias("line"), mark.alias("mark"), "a", named(10).alias("b")), f.select(named(9).alias("lemma")), ["*", "%"])


@query("o08_coverage_gaps", f"WITH {F_SQL} SELECT node, CASE WHEN ends_with(lemma, 'ring') THEN 'missed' ELSE 'unexpected' END AS gap FROM f WHERE ends_with(lemma, 'ring') <> (pos = 'SMALL')")
def o08(spark, sf_dir):
    predicted = forest(spark, sf_dir).withColumn("label", F.col("pos"))
    return so.coverage_gaps(predicted, F.endswith("lemma", F.lit("ring")), "SMALL").select("node", "gap")
