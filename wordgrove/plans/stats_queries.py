"""Registered queries for counts, statistics and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordgrove.common import checkpointed
from wordgrove.operators import stats as op
from wordgrove.operators.forest import subtree_agg
from wordgrove.plans.bindings import FOREST_SQL, F_SQL, SIGNATURES_SQL, TOKENS_SQL, W_SQL, forest, table, tokens, words
from wordgrove.plans.registry import query


@query("a01_count_values", f"WITH {TOKENS_SQL} SELECT lemma, pos, count(*) AS n FROM t GROUP BY lemma, pos")
def a01(spark, sf_dir):
    return op.count_values(tokens(spark, sf_dir), ["lemma", "pos"])


@query(
    "a02_tag_masks",
    f"WITH {W_SQL}, g AS (SELECT pos, CASE WHEN n % 5 <> 4 THEN substr(lemma, 1, 2) END AS stem, rpad(substr(lemma, 1, 6), 6, '-') AS tag, n FROM w), "
    "p AS (SELECT pos, stem, i, CASE WHEN min(substr(tag, i, 1)) = max(substr(tag, i, 1)) THEN min(substr(tag, i, 1)) ELSE '?' END AS letter FROM g, range(1, 7) r(i) GROUP BY pos, stem, i), "
    "m AS (SELECT pos, stem, string_agg(letter, '' ORDER BY i) AS mask FROM p GROUP BY pos, stem), s AS (SELECT pos, stem, sum(n)::BIGINT AS n FROM g GROUP BY pos, stem) "
    "SELECT m.pos, m.stem, m.mask, s.n FROM m JOIN s ON m.pos = s.pos AND m.stem IS NOT DISTINCT FROM s.stem",
)
def a02(spark, sf_dir):
    forms = words(spark, sf_dir).select("pos", F.when(F.col("n") % 5 != 4, F.substring("lemma", 1, 2)).alias("stem"), F.rpad(F.substring("lemma", 1, 6), 6, "-").alias("tag"), "n")
    return op.tag_masks(forms, ["pos", "stem"])


@query("a03_import_counts", f"WITH {W_SQL}, {F_SQL}, k AS (SELECT node, lower(split_part(lemma, ' ', 1)) AS lemma FROM f), c AS (SELECT substr(lemma, 1, 3) AS lemma, sum(n)::BIGINT AS count FROM w GROUP BY 1) "
       "SELECT k.node, substr(k.lemma, 1, 3) AS lemma, coalesce(c.count, 0) AS count FROM k LEFT JOIN c ON substr(k.lemma, 1, 3) = c.lemma")
def a03(spark, sf_dir):
    lexemes = forest(spark, sf_dir).select("node", F.substring(F.lower(F.split_part("lemma", F.lit(" "), F.lit(1))), 1, 3).alias("lemma"))
    return op.import_counts(lexemes, words(spark, sf_dir).select(F.substring("lemma", 1, 3).alias("lemma"), "n"), ["lemma"])


@query(
    "a04_import_counts_sublemmas",
    f"WITH {W_SQL}, x AS (SELECT lemma, pos FROM w WHERE n >= 3), c AS (SELECT substr(lemma, 1, greatest(length(lemma) - 2, 1)) AS lemma, lemma AS sublemma, pos, n FROM w), "
    "k AS (SELECT CASE WHEN x.lemma IS NOT NULL THEN c.sublemma ELSE c.lemma END AS lemma, c.pos, c.n FROM c LEFT JOIN x ON x.lemma = c.sublemma AND x.pos = c.pos), "
    "s AS (SELECT lemma, pos, sum(n)::BIGINT AS count FROM k GROUP BY lemma, pos) SELECT x.lemma, x.pos, coalesce(s.count, 0) AS count FROM x LEFT JOIN s ON s.lemma = x.lemma AND s.pos = x.pos",
)
def a04(spark, sf_dir):
    w = words(spark, sf_dir)
    counts = w.select(F.substring("lemma", F.lit(1), F.greatest(F.length("lemma") - 2, F.lit(1))).alias("lemma"), F.col("lemma").alias("sublemma"), "pos", "n")
    return op.import_counts_sublemmas(w.where("n >= 3").select("lemma", "pos"), counts)


@query("a05_relative_freq", f"WITH {W_SQL} SELECT lemma, pos, n, n::DOUBLE / (SELECT sum(n) FROM w)::DOUBLE AS rf FROM w")
def a05(spark, sf_dir):
    return op.relative_freq(words(spark, sf_dir))


@query("a06_sparsity", f"WITH {W_SQL}, s AS (SELECT lemma, pos, n - 1 AS n, (n - 1)::DOUBLE / 1e6 AS rf FROM w) SELECT lemma, pos, n, rf, CASE WHEN rf > 0 THEN -log10(rf) ELSE -log10(1.0::DOUBLE / 1e6) END AS sparsity FROM s")
def a06(spark, sf_dir):
    rare = op.relative_freq(words(spark, sf_dir).withColumn("n", F.col("n") - 1), total=1e6)
    return op.sparsity(rare, total=F.lit(1e6))


@query("a07_tie_percentile", f"WITH {W_SQL}, v AS (SELECT lemma, pos, CASE WHEN n % 6 <> 5 THEN n - 1 END AS n FROM w), k AS (SELECT n, 100.0::DOUBLE * (rank() OVER (ORDER BY n) - 1) / count(*) OVER () AS p FROM v WHERE n IS NOT NULL), d AS (SELECT n, min(p) AS p FROM k GROUP BY n) SELECT v.lemma, v.pos, v.n, CASE WHEN v.n = 0 THEN 0 ELSE d.p END AS percentile FROM v LEFT JOIN d ON d.n = v.n")
def a07(spark, sf_dir):
    return op.tie_percentile(words(spark, sf_dir).withColumn("n", F.when(F.col("n") % 6 != 5, F.col("n") - 1)), "n")


@query(
    "a08_network_stats",
    f"WITH {F_SQL}, e AS (SELECT parent, pos AS child_pos FROM f WHERE parent IS NOT NULL), d AS (SELECT f.node, count(e.parent) AS deg FROM f LEFT JOIN e ON e.parent = f.node GROUP BY f.node) "
    "SELECT 'pos' AS metric, pos AS key, count(*) AS value FROM f GROUP BY pos UNION ALL "
    "SELECT 'pos_edges', p.pos || '->' || e.child_pos, count(*) FROM e JOIN f p ON p.node = e.parent GROUP BY 2 UNION ALL "
    "SELECT 'out_degree', deg::VARCHAR, count(*) FROM d GROUP BY deg UNION ALL "
    "SELECT 'total', 'lexemes', count(*) FROM f UNION ALL SELECT 'total', 'lemmas', count(DISTINCT lemma) FROM f UNION ALL SELECT 'total', 'edges', count(parent) FROM f UNION ALL "
    "SELECT 'total', 'capitalised', count(*) FROM f WHERE regexp_matches(lemma, '^\\p{Lu}') UNION ALL SELECT 'total', 'capitalised_roots', count(*) FROM f WHERE regexp_matches(lemma, '^\\p{Lu}') AND parent IS NULL",
)
def a08(spark, sf_dir):
    return op.network_stats(forest(spark, sf_dir))


@query(
    "a08_creators_and_singletons",
    f"WITH {F_SQL}, c AS (SELECT node, parent, CASE WHEN node % 3 = 0 THEN upper(lemma) ELSE lemma END AS lemma, CASE n % 4 WHEN 0 THEN NULL WHEN 1 THEN 'list' ELSE 'rules' END AS creator FROM f) "
    "SELECT 'creator' AS metric, CASE WHEN parent IS NULL THEN 'no parent' ELSE coalesce(creator, 'unknown') END AS key, count(*) AS value FROM c GROUP BY 2 UNION ALL "
    "SELECT 'total', 'capitalised_singletons', count(*) FROM c WHERE parent IS NULL AND regexp_matches(lemma, '^\\p{Lu}') AND node NOT IN (SELECT parent FROM c WHERE parent IS NOT NULL)",
)
def a08_creators(spark, sf_dir):
    f = forest(spark, sf_dir).withColumn("lemma", F.when(F.col("node") % 3 == 0, F.upper("lemma")).otherwise(F.col("lemma")))
    creator = F.when(F.col("n") % 4 == 1, "list").when(F.col("n") % 4 > 1, "rules")
    return op.network_stats(f.withColumn("creator", creator), "creator").where("metric = 'creator' OR key = 'capitalised_singletons'")


@query(
    "a09_cluster_stats",
    f"{FOREST_SQL}, t AS (SELECT root, count(*) AS size, max(depth) AS depth, sum(depth)::BIGINT AS depths FROM r GROUP BY root) "
    "SELECT size, count(*) AS trees, max(depth) AS max_depth, sum(depths)::DOUBLE / sum(size)::DOUBLE AS mean_depth FROM t GROUP BY size",
)
def a09(spark, sf_dir):
    return op.cluster_stats(forest(spark, sf_dir).select("node", "parent"))


@query("a09_signature_counts", SIGNATURES_SQL + " SELECT sig, count(*) AS trees, array_to_string(list_sort(list(node))[1:21], ',') AS examples FROM g15 WHERE parent IS NULL GROUP BY sig")
def a09_signatures(spark, sf_dir):
    return op.signature_counts(forest(spark, sf_dir).withColumn("class", F.substring("pos", 1, 1)), "class")


@query(
    "a10_node_report",
    f"{FOREST_SQL}, g AS (SELECT node, parent, CASE WHEN n % 4 = 0 THEN 0 ELSE n END AS n FROM f), k AS (SELECT parent AS node, count(*) FILTER (WHERE n > 0) AS a, count(*) FILTER (WHERE n = 0) AS u FROM g WHERE parent IS NOT NULL GROUP BY parent), "
    "s AS (SELECT c.ancestor AS node, count(*) AS size, count(*) FILTER (WHERE g.n > 0) AS attested, max(c.dist) AS height FROM c JOIN g ON g.node = c.node GROUP BY c.ancestor) "
    "SELECT g.node, g.n, coalesce(k.a, 0) AS attested_children, coalesce(k.u, 0) AS unattested_children, s.size, s.attested, r.depth, s.height FROM g LEFT JOIN k ON k.node = g.node JOIN s ON s.node = g.node JOIN r ON r.node = g.node",
)
def a10(spark, sf_dir):
    nodes = forest(spark, sf_dir).withColumn("n", F.when(F.col("n") % 4 == 0, 0).otherwise(F.col("n")))
    counted = nodes.select("node", F.lit(1).cast("long").alias("size"), (F.col("n") > 0).cast("long").alias("attested"))
    subtree = subtree_agg(nodes.select("node", "parent"), counted, sums=("size", "attested"))
    return op.node_report(nodes, subtree)


@query("a11_homonyms", f"WITH {W_SQL} SELECT lemma, count(*) AS variants, string_agg(pos, ',' ORDER BY pos) AS values FROM w GROUP BY lemma HAVING count(*) > 1")
def a11(spark, sf_dir):
    return op.homonyms(words(spark, sf_dir), ["lemma"], "pos")


@query(
    "a11_odd_homonym_numbers",
    f"WITH {W_SQL}, k AS (SELECT left(lemma, 4) AS lemma, pos, CASE WHEN n % 3 = 0 THEN 0 ELSE length(lemma) END AS number FROM w) "
    "SELECT lemma, pos, count(*) AS lexemes, count(*) FILTER (WHERE number = 0) AS unnumbered FROM k GROUP BY lemma, pos HAVING count(*) > 1 AND min(number) = 0",
)
def a11_odd(spark, sf_dir):
    number = F.when(F.col("n") % 3 == 0, "").otherwise(F.concat(F.lit("-"), F.length("lemma").cast("string")))
    return op.odd_homonym_numbers(words(spark, sf_dir).select("pos", F.concat(F.substring("lemma", 1, 4), number, F.lit("_:T"), F.lit("_comment-7")).alias("techlemma")))


@query("a12_roots_by_freq", f"WITH {F_SQL} SELECT node, lemma, n FROM f WHERE parent IS NULL AND NOT regexp_matches(lemma, '^\\p{{Lu}}') AND n % 2 = 1")
def a12(spark, sf_dir):
    f = forest(spark, sf_dir)
    return op.roots_by_freq(f, f.where("n % 2 = 0"))


@query("a13_best_variant", f"WITH {W_SQL}, s AS (SELECT pos, substr(lemma, 1, 3) AS stem, lemma, ln(n) + CASE WHEN length(lemma) > 6 THEN 0.5 ELSE 0 END::DOUBLE AS score FROM w) "
       "SELECT pos, stem, lemma, score FROM s QUALIFY row_number() OVER (PARTITION BY pos, stem ORDER BY score DESC, lemma) = 1")
def a13(spark, sf_dir):
    w = words(spark, sf_dir).withColumn("stem", F.substring("lemma", 1, 3))
    return op.best_variant(w, ["pos", "stem"], "lemma", F.log("n") + F.when(F.length("lemma") > 6, 0.5).otherwise(0.0))


@query("a14_multi_label", f"WITH {W_SQL}, p AS (SELECT DISTINCT substr(lemma, 1, 2) AS a, substr(lemma, greatest(length(lemma) - 1, 1)) AS b, pos AS label FROM w) SELECT a, b, count(*) AS variants, string_agg(label, ',' ORDER BY label) AS values FROM p GROUP BY a, b HAVING count(*) > 1")
def a14(spark, sf_dir):
    w = words(spark, sf_dir)
    return op.multi_label(w.select(F.substring("lemma", 1, 2).alias("a"), F.substring("lemma", F.greatest(F.length("lemma") - 1, F.lit(1)), F.lit(2)).alias("b"), F.col("pos").alias("label")), ["a", "b"], "label")


CANDS_SQL = f"WITH {W_SQL}, x AS (SELECT DISTINCT lemma FROM w), r(suffix) AS (VALUES ('en'), ('er'), ('th'), ('an')), cand AS (SELECT b.lemma AS source, a.lemma AS target, r.suffix AS rule FROM x a JOIN r ON ends_with(a.lemma, r.suffix) JOIN x b ON b.lemma = left(a.lemma, length(a.lemma) - length(r.suffix)))"


def suffix_candidates(spark, sf_dir):
    # told once, as every suffix and every use of the candidates asks for them again
    lemmas = checkpointed(words(spark, sf_dir).select("lemma").distinct())
    made = None
    for suffix in ("en", "er", "th", "an"):
        cut = lemmas.where(F.endswith("lemma", F.lit(suffix))).select(F.expr(f"substring(lemma, 1, length(lemma) - {len(suffix)})").alias("source"), F.col("lemma").alias("target"), F.lit(suffix).alias("rule"))
        made = cut if made is None else made.unionByName(cut)
    return made.join(lemmas.withColumnRenamed("lemma", "source"), "source", "left_semi")


@query("a15_split_by_source_count", f"{CANDS_SQL} SELECT target, count(DISTINCT source) AS sources, string_agg(DISTINCT rule, '+' ORDER BY rule) AS rules, CASE WHEN count(DISTINCT source) = 1 THEN 'mono' ELSE 'multi' END AS kind FROM cand GROUP BY target")
def a15(spark, sf_dir):
    return op.split_by_source_count(suffix_candidates(spark, sf_dir))


@query("a15_rule_combinations", f"{CANDS_SQL}, k AS (SELECT target, string_agg(DISTINCT rule, '+' ORDER BY rule) AS rules FROM cand GROUP BY target) SELECT rules, count(*) AS targets FROM k GROUP BY rules")
def a15_rules(spark, sf_dir):
    return op.rule_combinations(suffix_candidates(spark, sf_dir))


@query("a15_groups_with_change", f"{CANDS_SQL} SELECT source, target, rule FROM cand WHERE source IN (SELECT source FROM cand WHERE rule = 'th' AND length(target) > 4)")
def a15_change(spark, sf_dir):
    return op.groups_with(suffix_candidates(spark, sf_dir), ["source"], (F.col("rule") == "th") & (F.length("target") > 4))


@query("a16_sample_uniform")
def a16(spark, sf_dir):
    return op.sample_uniform(words(spark, sf_dir), 500, ["lemma", "pos"], seed=7)


@query("a17_sample_weighted")
def a17(spark, sf_dir):
    return op.sample_weighted(words(spark, sf_dir), 500, ["lemma", "pos"], F.col("n") + 0.5, seed=7)


@query("a18_sample_negatives")
def a18(spark, sf_dir):
    cands = suffix_candidates(spark, sf_dir)
    return op.sample_negatives(cands.select("source", "target"), cands.where("rule <> 'an'").select("source", "target", F.col("rule").alias("label")), ["source", "target"])


@query("a19_retrograde", f"WITH {TOKENS_SQL} SELECT DISTINCT lower(lemma) AS lemma, reverse(lower(lemma)) AS reversed FROM t")
def a19(spark, sf_dir):
    return op.retrograde(tokens(spark, sf_dir), "lemma")


@query(
    "a20_first_sentences",
    r"WITH s AS (SELECT turn AS sent, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM conversations) SELECT word, min(sent) AS sent FROM s WHERE sent < 3 AND word NOT IN (SELECT word FROM s WHERE sent >= 5) GROUP BY word",
)
def a20(spark, sf_dir):
    found = table(spark, sf_dir, "conversations").select(F.col("turn").alias("sent"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return op.first_sentences(found, 3, found.where("sent >= 5").select("word").distinct())


#: Tokens of conversations; the first three letters stand for the lemma, in capitals in every other turn.
SPOKEN_SQL = r"""k AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS form FROM conversations), sp AS (SELECT DISTINCT conv_id, turn, form, CASE WHEN turn % 2 = 0 THEN upper(left(form, 3)) ELSE left(form, 3) END AS lemma FROM k),
ls AS (SELECT DISTINCT upper(left(form, 3)) AS lemma FROM k WHERE length(form) > 8)"""


def spoken(spark, sf_dir):
    found = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("form"))
    stem = F.substring("form", 1, 3)
    tokens = found.withColumn("lemma", F.when(F.col("turn") % 2 == 0, F.upper(stem)).otherwise(stem)).distinct()
    return tokens, found.where(F.length("form") > 8).select(F.upper(stem).alias("lemma"))


@query("a20_listed_examples", f"WITH {SPOKEN_SQL} SELECT conv_id, turn, form, lemma FROM sp WHERE upper(lemma) IN (SELECT lemma FROM ls) QUALIFY row_number() OVER (PARTITION BY lower(lemma) ORDER BY conv_id, turn, form) = 1")
def a20_examples(spark, sf_dir):
    tokens, listed = spoken(spark, sf_dir)
    return op.listed_examples(tokens, listed, ["conv_id", "turn", "form"])


@query("a20_unlisted_tokens", f"WITH {SPOKEN_SQL} SELECT conv_id, turn, form, lemma FROM sp WHERE lemma NOT IN (SELECT lemma FROM ls)")
def a20_unlisted(spark, sf_dir):
    return op.unlisted_tokens(*spoken(spark, sf_dir))
