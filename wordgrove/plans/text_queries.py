"""Registered queries for scalar functions, over the words of ``documents`` and other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordgrove.functions import text as fn
from wordgrove.plans.bindings import F_SQL, W_SQL, forest, table, words
from wordgrove.plans.registry import query


@query("x01_parse_v1_id", "SELECT o_orderkey, CASE WHEN regexp_matches(s, '^\\d+$') THEN try_cast(s AS BIGINT) END AS id FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE '' END || o_orderkey AS s FROM orders)")
def x01(spark, sf_dir):
    text = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "-").otherwise(""), F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.parse_v1_id(text).alias("id"))


@query("x02_parse_v2_id", "SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(s, '^(0|[1-9]\\d*)\\.(0|[1-9]\\d*)$') THEN split_part(s, '.', 1)::BIGINT END AS tree, CASE WHEN regexp_matches(s, '^(0|[1-9]\\d*)\\.(0|[1-9]\\d*)$') THEN split_part(s, '.', 2)::BIGINT END AS lex "
       "FROM (SELECT l_orderkey, l_linenumber, l_orderkey || '.' || CASE WHEN l_linenumber % 2 = 0 THEN '0' ELSE '' END || l_linenumber AS s FROM lineitem)")
def x02(spark, sf_dir):
    text = F.concat(F.col("l_orderkey").cast("string"), F.lit("."), F.when(F.col("l_linenumber") % 2 == 0, "0").otherwise(""), F.col("l_linenumber").cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", fn.parse_v2_id(text).alias("id")).select("l_orderkey", "l_linenumber", "id.tree", "id.lex")


@query("x03_kw_round_trip", "SELECT p_partkey, 'Brand=' || p_brand || '&Size=' || p_size || '&Type=' || p_type || '|Name=' || p_name AS kw, 2 AS groups, p_brand AS brand FROM part")
def x03(spark, sf_dir):
    raw = F.concat(F.lit("Type="), "p_type", F.lit("&Size="), F.col("p_size").cast("string"), F.lit("&Brand="), "p_brand", F.lit("|Name="), "p_name")
    parsed = table(spark, sf_dir, "part").select("p_partkey", fn.kw_parse(raw).alias("maps"))
    return parsed.select("p_partkey", fn.kw_format(F.col("maps")).alias("kw"), F.size("maps").alias("groups"), F.element_at("maps", 1)["Brand"].alias("brand"))


@query("x04_techlemma", f"WITH {W_SQL}, k AS (SELECT lemma, pos, lemma || '-' || (n % 4) || CASE WHEN n % 2 = 0 THEN '_^(note)' ELSE '`x' END AS tech FROM w) SELECT tech, pos, lemma, lemma || '-' || regexp_extract(tech, '-(\\d+)[_`]', 1) AS short, regexp_extract(tech, '-(\\d+)[_`]', 1)::INTEGER AS number FROM k")
def x04(spark, sf_dir):
    tech = F.concat("lemma", F.lit("-"), (F.col("n") % 4).cast("string"), F.when(F.col("n") % 2 == 0, "_^(note)").otherwise("`x"))
    return words(spark, sf_dir).select(tech.alias("tech"), "pos").select("tech", "pos", fn.techlemma_to_lemma(F.col("tech")).alias("lemma"), fn.short_with_number(F.col("tech")).alias("short"), fn.homonym_number(F.col("tech")).alias("number"))


@query("x05_suffix_code", f"WITH {W_SQL}, k AS (SELECT lemma, pos, n % 9 AS cut FROM w) SELECT lemma, pos, CASE WHEN length(lemma) >= cut THEN left(lemma, length(lemma) - cut) || 'ost' END AS parent FROM k")
def x05(spark, sf_dir):
    code = F.concat(F.lit("_^(*"), (F.col("n") % 9).cast("string"), F.lit("ost)"))
    return words(spark, sf_dir).select("lemma", "pos", fn.suffix_code_parent(F.col("lemma"), code).alias("parent"))


@query("x06_range_overlaps", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < q AND l_linenumber + 1 < 8 THEN l_linenumber < 8 AND l_linenumber + 1 < q END AS overlaps FROM (SELECT l_orderkey, l_linenumber, (l_quantity / 5)::INTEGER AS q FROM lineitem)")
def x06(spark, sf_dir):
    q = F.round(F.col("l_quantity") / 5).cast("int")
    a = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", fn.range_overlaps(a, q, a + 1, F.lit(8)).alias("overlaps"))


@query("x07_common_prefix", f"WITH {W_SQL}, k AS (SELECT lemma, pos, substr(lemma, 1, (length(lemma) + 1) // 2) || 'qx' AS other FROM w) SELECT lemma, pos, (SELECT max(i) FROM range(0, 40) r(i) WHERE i <= least(length(lemma), length(other)) AND left(lemma, i) = left(other, i))::INTEGER AS shared FROM k")
def x07(spark, sf_dir):
    other = F.concat(F.substring("lemma", F.lit(1), F.floor((F.length("lemma") + 1) / 2).cast("int")), F.lit("qx"))
    return words(spark, sf_dir).select("lemma", "pos", fn.common_prefix_length(F.col("lemma"), other).alias("shared"))


@query("x08_tag_features", f"WITH {F_SQL} SELECT node, CASE substr(pos, 1, 1) WHEN 'S' THEN 'Standard' WHEN 'P' THEN 'Promo' END AS class, CASE substr(pos, 2, 1) WHEN 'T' THEN 'T' WHEN 'R' THEN 'R' END AS second, CASE WHEN contains(pos, 'LARGE') THEN 'Br' WHEN contains(pos, 'SMALL') THEN 'Sn' END AS metal FROM f")
def x08(spark, sf_dir):
    features = fn.tag_features(F.col("pos"), {1: ("class", {"S": "Standard", "P": "Promo"}), 2: ("second", {"T": "T", "R": "R"})})
    marks = fn.mark_features(F.col("pos"), {"LARGE": ("metal", "Br"), "SMALL": ("metal", "Sn")})
    return forest(spark, sf_dir).select("node", features.alias("f"), marks.alias("m")).select("node", F.col("f")["class"].alias("class"), F.col("f")["second"].alias("second"), F.col("m")["metal"].alias("metal"))


@query("x09_merge_tags", f"WITH {W_SQL}, k AS (SELECT lemma, pos, rpad(lemma, 8, '-')[1:8] AS a, rpad(reverse(lemma), 8, '-')[1:8] AS b FROM w) SELECT lemma, pos, (SELECT string_agg(CASE WHEN substr(a, i, 1) = substr(b, i, 1) THEN substr(a, i, 1) ELSE '?' END, '' ORDER BY i) FROM range(1, 9) r(i)) AS mask FROM k")
def x09(spark, sf_dir):
    return words(spark, sf_dir).select("lemma", "pos", fn.merge_tags(F.array(F.rpad("lemma", 8, "-"), F.rpad(F.reverse("lemma"), 8, "-"))).alias("mask"))


@query("x10_relation_text", f"WITH {F_SQL} SELECT f.node, 'Compounding:(' || p.lemma || '+*' || p.pos || ')->' || f.lemma AS text FROM f JOIN f p ON p.node = f.parent")
def x10(spark, sf_dir):
    f = forest(spark, sf_dir)
    p = f.select(F.col("node").alias("parent"), F.col("lemma").alias("a"), F.col("pos").alias("b"))
    return f.join(p, "parent").select("node", fn.relation_text(F.lit("Compounding"), F.array("a", "b"), F.col("b"), F.col("lemma")).alias("text"))


@query("x11_case", "SELECT p_partkey, regexp_matches(p_type, '^\\p{Lu}') AS capital, p_name = lower(p_name) AND regexp_matches(p_name, '\\p{L}') AS low, upper(left(p_name, 1)) || substr(p_name, 2) AS title FROM part")
def x11(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", fn.is_capitalised(F.col("p_type")).alias("capital"), fn.is_lower(F.col("p_name")).alias("low"), fn.title_case(F.col("p_name")).alias("title"))


@query("x12_affix_ngrams", f"WITH {W_SQL} SELECT lemma, pos, " + ", ".join(f"CASE WHEN length(lemma) >= {k} THEN left(lemma, {k}) ELSE 'NA' END AS prefix_{k}, CASE WHEN length(lemma) >= {k} THEN right(lemma, {k}) ELSE 'NA' END AS suffix_{k}" for k in range(1, 7)) + " FROM w")
def x12(spark, sf_dir):
    return words(spark, sf_dir).select("lemma", "pos", *[c.alias(name) for name, c in fn.affix_ngrams(F.col("lemma")).items()])


@query("x13_json_get", "SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k, coalesce(json_extract_string(props, '$.absent'), 'none') AS absent FROM events")
def x13(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fn.json_get(F.col("props"), "$.k", "none").alias("k"), fn.json_get(F.col("props"), "$.absent", "none").alias("absent"))


@query("x14_edit_distance", "SELECT p_partkey, levenshtein(p_name, p_type)::INTEGER AS distance FROM part")
def x14(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", fn.edit_distance(F.col("p_name"), F.col("p_type")).alias("distance"))


@query(
    "x15_lcs_length",
    "WITH RECURSIVE t AS (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations), pr AS (SELECT a.conv_id, a.turn, a.w, b.w AS v FROM t a JOIN t b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1), "
    "d(conv_id, turn, w, v, i, acc) AS (SELECT conv_id, turn, w, v, 0, list_transform(range(0, len(v) + 1), lambda j: 0) FROM pr UNION ALL "
    "SELECT conv_id, turn, w, v, i + 1, list_prepend(0, list_transform(range(1, len(v) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(acc[k + 1], CASE WHEN v[k] = w[i + 1] THEN acc[k] + 1 ELSE 0 END))))) FROM d WHERE i < len(w)) "
    "SELECT conv_id, turn, acc[len(acc)]::INTEGER AS common FROM d WHERE i = len(w)",
)
def x15(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", " ").alias("w"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("v"))
    return turns.join(after, ["conv_id", "turn"]).select("conv_id", "turn", fn.lcs_length(F.col("w"), F.col("v")).alias("common"))


#: (id, pattern, part of speech) in order: invented rules that suit the invented words of ``documents``.
WORD_RULES = [("letters", "[qwx]", None), ("double", "(ss|ee|oo)", None), ("vowels", "(au|ou)", "fr"), ("ending", "(tion|ing)$", "en"), ("start", "^un", "de")]


@query("x16_first_rule", f"WITH {W_SQL} SELECT lemma, pos, CASE WHEN regexp_matches(lemma, '[qwx]') THEN 'letters' WHEN regexp_matches(lemma, '(ss|ee|oo)') THEN 'double' WHEN regexp_matches(lemma, '(au|ou)') AND pos = 'fr' THEN 'vowels' WHEN regexp_matches(lemma, '(tion|ing)$') AND pos = 'en' THEN 'ending' WHEN regexp_matches(lemma, '^un') AND pos = 'de' THEN 'start' END AS rule FROM w")
def x16(spark, sf_dir):
    return words(spark, sf_dir).select("lemma", "pos", fn.first_rule(F.col("lemma"), F.col("pos"), WORD_RULES).alias("rule"))


@query("x17_paradigm_class", f"WITH {W_SQL}, k AS (SELECT left(lemma, 3) AS stem, max(CASE WHEN length(lemma) = 4 THEN right(lemma, 1) END) AS a, max(CASE WHEN length(lemma) = 5 THEN right(lemma, 2) END) AS b FROM w WHERE length(lemma) IN (4, 5) GROUP BY 1) "
       "SELECT stem, CASE WHEN a IS NULL OR b IS NULL THEN 'partial' WHEN a = left(b, 1) THEN 'long' WHEN a = right(b, 1) THEN 'short' ELSE 'mixed' END AS class FROM k")
def x17(spark, sf_dir):
    from wordgrove.operators.morphs import paradigm_class

    forms = words(spark, sf_dir).where("length(lemma) IN (4, 5)").select(F.substring("lemma", 1, 3).alias("stem"), F.length("lemma").cast("string").alias("tag"), F.expr("substring(lemma, 4)").alias("ending"))
    a, b = F.col("4"), F.col("5")
    ladder = [("partial", a.isNull() | b.isNull()), ("long", a == F.substring(b, 1, 1)), ("short", a == F.right(b, F.lit(1)))]
    return paradigm_class(forms, "stem", "tag", "ending", ["4", "5"], ladder, "mixed")


@query("x18_agreed_class", f"WITH {W_SQL} SELECT lemma, min(pos) AS class FROM w GROUP BY lemma HAVING count(DISTINCT pos) = 1")
def x18(spark, sf_dir):
    from wordgrove.operators.morphs import agreed_value

    return agreed_value(words(spark, sf_dir), ["lemma"], "pos", "class")


@query("x19_transliterate", f"WITH {W_SQL}, k AS (SELECT lemma, pos, replace(replace(lemma, 'th', 'þ'), 'ou', 'u') AS a, replace(lemma, 'ou', 'ů') AS b FROM w) SELECT lemma, pos, unnest(list_distinct([a, b])) AS form FROM k")
def x19(spark, sf_dir):
    return words(spark, sf_dir).select("lemma", "pos", F.explode(fn.both_forms(F.col("lemma"), [("th", "þ"), ("ou", "u")], [("ou", "ů")])).alias("form"))


@query("x20_marked_root", f"WITH {W_SQL} SELECT lemma, pos, CASE WHEN length(lemma) >= 4 AND regexp_matches(substr(lemma, 4, 1), '[aeiou]') THEN left(lemma, 4) END AS root FROM w")
def x20(spark, sf_dir):
    marked = F.concat(F.lit("["), F.substring("lemma", 1, 4), F.lit("]"), F.expr("substring(lemma, 5)"))
    root = F.when(F.length("lemma") >= 4, fn.marked_root(marked, "aeiou"))
    return words(spark, sf_dir).select("lemma", "pos", root.alias("root"))
