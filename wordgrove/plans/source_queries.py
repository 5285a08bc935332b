"""Registered queries for readers and writers: the parts are written in a form to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordgrove.common import scratch_path
from wordgrove.plans.bindings import F_SQL, forest
from wordgrove.plans.registry import query
from wordgrove.sources import files as fl


def written(lines, *order) -> str:
    """Lines (``value``) as text files that follow each other in an order."""
    path = scratch_path(lines.sparkSession)
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.text(path)
    return path


def v1_bundle(spark, sf_dir):
    f = forest(spark, sf_dir)
    lexemes = f.select(F.col("node").alias("lex_id"), F.col("node").alias("seq"), "lemma", F.concat("lemma", F.lit("-1")).alias("techlemma"), F.substring("pos", 1, 1).alias("pos"), (F.col("n") % 5 == 0).alias("is_compound"), (F.col("n") % 7 == 0).alias("unmotivated"))
    relations = f.where("parent IS NOT NULL").select(F.lit("Derivation").alias("type"), F.col("parent").alias("main_source"), F.array("parent").alias("sources"), F.col("node").alias("target"), F.lit(0).alias("ord"))
    return fl.Bundle(lexemes, relations, lexemes.limit(0))


V1_SQL = f"WITH {F_SQL}, k AS (SELECT *, row_number() OVER (ORDER BY node) - 1 AS id FROM f)"


@query("s01_forest_v1", V1_SQL + " SELECT id AS lex_id, lemma, lemma || '-1' AS techlemma, left(pos, 1) AS pos, n % 5 = 0 AS is_compound, n % 7 = 0 AS unmotivated FROM k")
def s01(spark, sf_dir):
    bundle, path = v1_bundle(spark, sf_dir), scratch_path(spark)
    fl.write_forest_v1(bundle.lexemes, bundle.relations, path)
    return fl.read_forest_v1(spark, path).lexemes.drop("seq")


@query("s06_forest_v1_relations", V1_SQL + " SELECT k.id AS target, p.id AS main_source, 'Derivation' AS type FROM k JOIN k p ON p.node = k.parent")
def s06(spark, sf_dir):
    bundle, path = v1_bundle(spark, sf_dir), scratch_path(spark)
    fl.write_forest_v1(bundle.lexemes, bundle.relations, path)
    return fl.read_forest_v1(spark, path).relations.select("target", "main_source", "type")


@query("s09_bad_lines", f"WITH {F_SQL} SELECT CASE n % 6 WHEN 0 THEN 'not five fields' WHEN 1 THEN 'bad id' WHEN 2 THEN 'empty lemma' WHEN 3 THEN 'own parent' ELSE 'good' END AS problem, count(*) AS n FROM f GROUP BY 1")
def s09(spark, sf_dir):
    kind, key = F.col("n") % 6, F.col("node").cast("string")
    fields = [F.when(kind == 1, F.concat(F.lit("x"), key)).otherwise(key), F.when(kind == 2, "").otherwise(F.col("lemma")), F.col("lemma"), F.lit("N"), F.when(kind == 3, key).otherwise("")]
    value = F.when(kind == 0, F.concat_ws("\t", *fields[:4])).otherwise(F.concat_ws("\t", *fields))
    bundle = fl.read_forest_v1(spark, written(forest(spark, sf_dir).select("node", value.alias("value")), "node"), on_err="continue")
    return bundle.errors.select("problem").unionByName(bundle.lexemes.select(F.lit("good").alias("problem"))).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def v2_bundle(spark, sf_dir):
    f = forest(spark, sf_dir)
    morph = lambda text, kind: F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.expr(text).alias("morph"), F.lit(kind).alias("type"))
    lexemes = f.select(
        F.col("node").cast("string").alias("lex_id"), F.col("node").alias("seq"), F.concat_ws("#", "lemma", "pos", F.col("node").cast("string")).alias("lemid"), "lemma", "pos", F.create_map(F.lit("Size"), F.col("n").cast("string")).alias("feats"),
        F.array(morph("substring(lemma, 1, 2)", "Root"), morph("substring(lemma, 3)", "Suffix")).alias("morphs"), F.lit("{}").alias("misc"),
    )
    kind = F.when(F.col("n") % 4 == 0, "Compounding").otherwise("Derivation")
    parent, second = F.col("parent").cast("string"), F.floor(F.col("node") / 9).cast("string")
    relations = f.where("parent IS NOT NULL").select(kind.alias("type"), parent.alias("main_source"), F.when(F.col("n") % 4 == 0, F.array(parent, second)).otherwise(F.array(parent)).alias("sources"), F.col("node").cast("string").alias("target"), F.lit(0).alias("ord"), F.create_map().cast("map<string,string>").alias("feats"))
    return lexemes, relations


def v2_round_trip(spark, sf_dir):
    path = scratch_path(spark)
    fl.write_network_v2(*v2_bundle(spark, sf_dir), path)
    return fl.read_network_v2(spark, path)


@query("s02_network_v2", f"WITH {F_SQL} SELECT lemma || '#' || pos || '#' || node AS lemid, lemma, pos, n::VARCHAR AS size, left(lemma, 2) || ':Root|' || substr(lemma, 3) || ':Suffix' AS morphs FROM f")
def s02(spark, sf_dir):
    morphs = F.array_join(F.transform("morphs", lambda m: F.concat(m["morph"], F.lit(":"), m["type"])), "|")
    return v2_round_trip(spark, sf_dir).lexemes.select("lemid", "lemma", "pos", F.col("feats")["Size"].alias("size"), morphs.alias("morphs"))


@query("s07_network_v2_relations", f"WITH {F_SQL} SELECT f.lemma || '#' || f.pos || '#' || f.node AS target, CASE WHEN f.n % 4 = 0 THEN 'Compounding' ELSE 'Derivation' END AS type, f.parent || CASE WHEN f.n % 4 = 0 THEN ',' || (f.node // 9) ELSE '' END AS sources FROM f WHERE f.parent IS NOT NULL")
def s07(spark, sf_dir):
    """Sources are named by the numbers in their lemids, as ids are given anew."""
    bundle = v2_round_trip(spark, sf_dir)
    lemid = bundle.lexemes.select(F.col("lex_id").alias("source"), F.substring_index("lemid", "#", -1).alias("number"))
    each = bundle.relations.select("target", "type", F.posexplode("sources").alias("i", "source")).join(lemid, "source")
    joined = each.groupBy("target", "type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "number"))), lambda x: x["number"]), ",").alias("sources"))
    return joined.join(bundle.lexemes.select(F.col("lex_id").alias("target"), "lemid"), "target").select(F.col("lemid").alias("target"), "type", "sources")


@query("s03_json_morphs", f"WITH {F_SQL} SELECT node || '.0' AS lex_id, left(lemma, 3) || ':Root|' || substr(lemma, 4) || ':Suffix' AS morphs FROM f")
def s03(spark, sf_dir):
    morph = lambda text, keys: F.concat(F.lit(f'{{"{keys[0]}": "'), F.expr(text), F.lit(f'", "{keys[1]}": "'), F.lit(keys[2]), F.lit('"}'))
    # keys in title case and in lower case
    segments = F.concat(F.lit("["), morph("substring(lemma, 1, 3)", ("Morph", "Type", "Root")), F.lit(", "), morph("substring(lemma, 4)", ("morph", "type", "Suffix")), F.lit("]"))
    value = F.concat_ws("\t", F.concat(F.col("node").cast("string"), F.lit(".0")), "lemma", "lemma", "pos", F.lit(""), segments, F.lit(""), F.lit(""), F.lit(""), F.lit("{}"))
    bundle = fl.read_network_v2(spark, written(forest(spark, sf_dir).select("node", value.alias("value")), "node"))
    return bundle.lexemes.select("lex_id", F.array_join(F.transform("morphs", lambda m: F.concat(m["morph"], F.lit(":"), m["type"])), "|").alias("morphs"))


def pairs(spark, sf_dir):
    """Every edge, and after all of them some that turn an edge round."""
    f = forest(spark, sf_dir).where("parent IS NOT NULL")
    word = lambda c: F.concat(F.lit("w"), F.col(c).cast("string"))
    line = lambda df, a, b, kind: df.select(F.lit(kind).alias("kind"), "node", F.concat_ws("\t", word(a), word(b), F.lit("V:N"), F.col("pos")).alias("value"))
    lines = line(f, "parent", "node", 0).withColumn("value", F.replace("value", F.lit("V:N"), F.lit("N:N"))).unionByName(line(f.where("n % 11 = 0"), "node", "parent", 1).withColumn("value", F.replace("value", F.lit("V:N"), F.lit("N:N"))))
    return fl.read_pairs_unimorph(spark, written(lines, "kind", "node"), on_err="continue")


@query("s04_pairs", f"WITH {F_SQL} SELECT 'w' || parent || '#N' AS main_source, 'w' || node || '#N' AS target, 0 AS ord, pos AS affix FROM f WHERE parent IS NOT NULL")
def s04(spark, sf_dir):
    return pairs(spark, sf_dir).relations.select("main_source", "target", "ord", "affix")


@query("s04_cycles", f"WITH {F_SQL} SELECT 'closes a cycle' AS problem, count(*) AS n FROM f WHERE parent IS NOT NULL AND n % 11 = 0 HAVING count(*) > 0")
def s04_cycles(spark, sf_dir):
    return pairs(spark, sf_dir).errors.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query("s05_annotations", f"WITH {F_SQL} SELECT CASE n % 4 WHEN 1 THEN '%' WHEN 2 THEN '*%' ELSE '' END AS mark, 'w' || node AS a, lemma AS b FROM f WHERE n % 3 <> 0")
def s05(spark, sf_dir):
    n = F.col("n")
    mark = F.when(n % 4 == 1, "%").when(n % 4 == 2, "*%").otherwise("")
    line = F.concat(mark, F.lit("w"), F.col("node").cast("string"), F.lit("\t"), "lemma")
    value = F.when(n % 6 == 0, "# note").when(n % 3 == 0, "  ").otherwise(line)
    return fl.read_annotations(spark, written(forest(spark, sf_dir).select("node", value.alias("value")), "node"), ["a", "b"], marks="*%").drop("line_no")


@query("s08_snapshot", f"WITH {F_SQL} SELECT f.node AS lex_id, f.lemma, f.parent AS main_source FROM f")
def s08(spark, sf_dir):
    path = scratch_path(spark)
    fl.write_snapshot(v1_bundle(spark, sf_dir), path)
    lexemes, relations = fl.read_snapshot(spark, path)
    return lexemes.join(relations.select(F.col("target").alias("lex_id"), "main_source"), "lex_id", "left").select("lex_id", "lemma", "main_source")


@query("s10_candidate_blocks", f"WITH {F_SQL}, g AS (SELECT count(DISTINCT parent) AS k FROM f WHERE parent IS NOT NULL) SELECT parent || '>' || node AS value, 1::BIGINT AS n FROM f WHERE parent IS NOT NULL UNION ALL SELECT '', k FROM g WHERE k > 0")
def s10(spark, sf_dir):
    """Lines of the written blocks, and how many blank ones end a block."""
    path = scratch_path(spark)
    f = forest(spark, sf_dir).where("parent IS NOT NULL")
    fl.write_candidate_blocks(f, "parent", F.concat_ws(">", F.col("parent").cast("string"), F.col("node").cast("string")), path)
    return spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("s11_records", f"WITH {F_SQL} SELECT 'w' || node AS word, lemma || '|' || pos AS forms, n::VARCHAR AS size FROM f")
def s11(spark, sf_dir):
    value = F.concat(F.lit("word: w"), F.col("node").cast("string"), F.lit("\nforms: "), "lemma", F.lit(", "), "pos", F.lit("\nsize: "), F.col("n").cast("string"))
    found = fl.read_records(spark, written(forest(spark, sf_dir).select("node", value.alias("value")), "node"), list_fields=("forms",))
    return found.select("word", F.array_join("forms", "|").alias("forms"), F.col("fields")["size"].alias("size"))


@query("s12_segmentation_table", f"WITH {F_SQL} SELECT lemma || node AS word, left(lemma, 2) || '-' || substr(lemma, 3) || '-' || node AS segments FROM f WHERE n % 5 <> 0")
def s12(spark, sf_dir):
    key = F.col("node").cast("string")
    last = F.when(F.col("n") % 5 == 0, "wrong").otherwise(key)
    value = F.concat_ws("\t", F.concat("lemma", key), F.substring("lemma", 1, 2), F.expr("substring(lemma, 3)"), F.lit(""), last)
    return fl.read_segmentation_table(spark, written(forest(spark, sf_dir).select("node", value.alias("value")), "node"), 0, [1, 2, 3, 4]).drop("line_no")


@query("v02_last_newlines", f"WITH {F_SQL} SELECT n AS part, count(*) AS line_no, 'missing trailing newline' AS problem FROM f WHERE n % 2 = 0 GROUP BY n")
def v02_newlines(spark, sf_dir):
    """Files of whole lines, and files whose last line ends in a space."""
    path = scratch_path(spark)
    texts = forest(spark, sf_dir).groupBy(F.col("n").cast("long").alias("part")).agg(F.concat_ws("\n", F.collect_list("lemma")).alias("value"))
    for rest, end in ((1, "\n"), (0, " ")):
        texts.where(F.col("part") % 2 == rest).repartition("part").write.option("lineSep", end).partitionBy("part").mode("append").text(path)
    found = fl.missing_last_newlines(spark, path)
    return found.select(F.regexp_extract("file", r"part=(\d+)/", 1).cast("long").alias("part"), "line_no", "problem")
