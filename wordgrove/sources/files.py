"""Readers and writers of network files and annotation files.

Readers give the good rows and the bad ones with what is wrong (``errors``);
with ``on_err='raise'`` a bad row is an error.  Lines are numbered within each
file by the order of its splits and of the lines in them.  A folder is read as one
text, its files in order of their names, and networks are written as such folders,
so that no task holds them whole; put together in that order they are the release file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordgrove.common import checkpointed
from wordgrove.functions.text import kw_format, kw_parse, parse_v1_id, parse_v2_id
from wordgrove.operators.edits import check_cycles, fill_parent
from wordgrove.operators.forest import dfs_ids, numbered, running_sum


@dataclass(frozen=True)
class Bundle:
    """A network: lexemes, relations and what was wrong with their source."""

    lexemes: DataFrame
    relations: DataFrame
    errors: DataFrame


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line_no`` (from 1) and ``value`` of text files, in each file's order, and ``place``, the number over all files in order of their names.

    Lines are numbered within the splits that a file is read in, and the splits
    counted, so that a large file is numbered by as many tasks as it has splits.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_in_split"), "value")
    # one row for each split
    sizes = lines.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("file", "_block", *[(F.sum("_n").over(w.orderBy("file", "_block")) - F.col("_n")).alias(c) for w, c in ((Window.partitionBy("file"), "_before"), (Window.partitionBy(), "_before_all"))])
    numbered_lines = lines.withColumn("_k", F.row_number().over(Window.partitionBy("file", "_block").orderBy("_in_split")))
    return numbered_lines.join(before, ["file", "_block"]).select("file", (F.col("_before") + F.col("_k")).cast("long").alias("line_no"), (F.col("_before_all") + F.col("_k")).cast("long").alias("place"), "value")


def missing_last_newlines(spark: SparkSession, path: str) -> DataFrame:
    """Files (``file``, ``line_no``, ``problem``) whose last line doesn't end in a newline.

    Told by their sizes: with one, a file has a byte more for each line than its
    lines have.  Compressed files can't be told so and are left out.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.octet_length("value").alias("bytes"))
    plain = lines.where(~F.col("file").rlike(r"\.(gz|bz2|zst|xz|lz4|snappy|deflate)$"))
    counted = plain.groupBy("file").agg(F.count(F.lit(1)).alias("line_no"), F.sum("bytes").alias("bytes"), F.max("size").alias("size"))
    return counted.where("size = bytes + line_no - 1").select("file", "line_no", F.lit("missing trailing newline").alias("problem"))


def _checked(bundle: Bundle, on_err: str) -> Bundle:
    if on_err not in ("raise", "continue"):
        raise ValueError("on_err is raise or continue")
    if on_err == "raise" and (bad := bundle.errors.orderBy("line_no").take(3)):
        raise ValueError(f"bad lines: {[(r.line_no, r.problem) for r in bad]}")
    return bundle


def read_forest_v1(spark: SparkSession, path: str, on_err: str = "raise") -> Bundle:
    """Five tab-separated columns: id, lemma, techlemma, part of speech with marks C and U, parent id."""
    rows = read_lines(spark, path).withColumn("f", F.split("value", "\t", -1))
    field = lambda i: F.get("f", F.lit(i))
    parsed = rows.select("line_no", "place", F.size("f").alias("n"), parse_v1_id(field(0)).alias("lex_id"), field(1).alias("lemma"), field(2).alias("techlemma"), field(3).alias("p"), field(4).alias("parent_text"), parse_v1_id(field(4)).alias("parent"))
    parsed = parsed.withColumn("k", F.row_number().over(Window.partitionBy("lex_id").orderBy("place")))
    ids = parsed.where("lex_id IS NOT NULL").select(F.col("lex_id").alias("parent")).distinct().withColumn("there", F.lit(True))
    parsed = parsed.join(ids, "parent", "left")
    problem = (
        F.when(F.col("n") != 5, "not five fields")
        .when(F.col("lex_id").isNull(), "bad id")
        .when(F.col("k") > 1, "repeated id")
        .when(F.col("lemma") == "", "empty lemma")
        .when((F.col("parent_text") != "") & F.col("parent").isNull(), "bad parent id")
        .when((F.col("parent_text") != "") & F.col("there").isNull(), "unknown parent")
        .when(F.col("parent") == F.col("lex_id"), "own parent")
    )
    parsed = parsed.withColumn("problem", problem)
    good = parsed.where("problem IS NULL")
    lexemes = good.select(
        "lex_id", F.col("place").alias("seq"), "lemma", F.when(F.col("techlemma") != "", F.col("techlemma")).alias("techlemma"), F.substring("p", 1, 1).alias("pos"),
        F.contains(F.expr("substring(p, 2)"), F.lit("C")).alias("is_compound"), F.contains(F.expr("substring(p, 2)"), F.lit("U")).alias("unmotivated"),
    )
    kept = good.select(F.col("lex_id").alias("parent"))
    relations = good.where("parent IS NOT NULL").join(kept, "parent", "left_semi").select(F.lit("Derivation").alias("type"), F.col("parent").alias("main_source"), F.array("parent").alias("sources"), F.col("lex_id").alias("target"), F.lit(0).alias("ord"))
    return _checked(Bundle(lexemes, relations, parsed.where("problem IS NOT NULL").select("line_no", "problem")), on_err)


def write_forest_v1(lexemes: DataFrame, relations: DataFrame, path: str, on_err: str = "raise") -> None:
    """The reverse, as files in order of ids, these renumbered from 0 by ``seq``; several parents are an error, or only the main one is written."""
    if on_err == "raise" and relations.where("ord > 0 OR size(sources) > 1").take(1):
        raise ValueError("nodes with several parents")
    given = numbered(lexemes, ["seq", "lex_id"], "id").withColumn("id", F.col("id") - 1)
    up = relations.where("ord = 0").select(F.col("target").alias("lex_id"), F.col("main_source").alias("_p"))
    parent = given.select(F.col("lex_id").alias("_p"), F.col("id").alias("parent"))
    rows = given.join(up, "lex_id", "left").join(parent, "_p", "left")
    pos = F.concat("pos", F.when(F.coalesce("is_compound", F.lit(False)), "C").otherwise(""), F.when(F.coalesce("unmotivated", F.lit(False)), "U").otherwise(""))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows.select("id", F.concat_ws("\t", text("id"), text("lemma"), F.coalesce("techlemma", "lemma"), pos, text("parent")).alias("value")).repartitionByRange("id").sortWithinPartitions("id").select("value").write.mode("overwrite").text(path)


_MORPH = "struct<start:int,end:int,morph:string,type:string>"


def _morphs(col: Column) -> Column:
    """Morphs of a segmentation in key-value or JSON form."""
    as_json = F.from_json(col, f"array<{_MORPH}>")
    pick = lambda m: F.struct(m["Start"].try_cast("int").alias("start"), m["End"].try_cast("int").alias("end"), m["Morph"].alias("morph"), m["Type"].alias("type"))
    title = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(col, '"Start"', '"start"'), '"End"', '"end"'), '"Morph"', '"morph"'), '"Type"', '"type"')
    return F.when(F.startswith(col, F.lit("[")), F.coalesce(F.from_json(title, f"array<{_MORPH}>"), as_json)).otherwise(F.transform(kw_parse(F.when(F.startswith(col, F.lit("[")), "").otherwise(col)), pick))


def read_network_v2(spark: SparkSession, path: str, on_err: str = "raise", known_types: tuple[str, ...] = ("Derivation", "Compounding", "Conversion", "Variant", "Univerbisation")) -> Bundle:
    """Ten tab-separated columns, trees in blocks; segmentations in key-value or JSON form.

    Sources may stand further on or in other trees.  With ``on_err='continue'`` a
    relation without a type is a derivation and one of an unknown type is left out.
    """
    lines = read_lines(spark, path).where("value <> '' AND NOT startswith(value, '#')").withColumn("f", F.split("value", "\t", 10))
    field = lambda i: F.get("f", F.lit(i))
    rows = lines.select("line_no", "place", F.size("f").alias("n"), field(0).alias("id"), parse_v2_id(field(0)).alias("pid"), *[field(i).alias(c) for i, c in enumerate(("lemid", "lemma", "pos", "feats", "seg", "parent", "rel", "other", "misc"), 1)])
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("place")))
    kind = F.regexp_extract("rel", r"(?:^|&)Type=([^&]*)", 1)
    ids = rows.where("pid IS NOT NULL").select(F.col("id").alias("parent"), F.col("place").alias("p_line")).groupBy("parent").agg(F.min("p_line").alias("p_line"))
    rows = rows.join(ids, "parent", "left").withColumn("kind", kind)
    problem = (
        F.when(F.col("n") != 10, "not ten fields")
        .when(F.col("pid").isNull(), "bad id")
        .when(F.col("k") > 1, "repeated id")
        .when(F.col("lemma") == "", "empty lemma")
        .when(F.try_parse_json("misc").isNull(), "bad JSON")
        .when(F.contains("feats", F.lit("|")), "several groups of features")
        .when((F.col("parent") != "") & F.col("p_line").isNull(), "unknown parent")
        .when((F.col("parent") != "") & (F.split_part("parent", F.lit("."), F.lit(1)) != F.col("pid.tree").cast("string")), "parent in another tree")
        .when((F.col("parent") != "") & (F.col("p_line") >= F.col("place")), "parent not before")
    )
    if on_err == "raise":
        problem = problem.when((F.col("parent") != "") & (F.col("kind") == ""), "missing type").when((F.col("parent") != "") & ~F.col("kind").isin(*known_types), "unknown type")
    rows = rows.withColumn("problem", problem)
    good = rows.where("problem IS NULL")
    first = lambda c: F.coalesce(F.try_element_at(kw_parse(F.col(c)), F.lit(1)), F.create_map().cast("map<string,string>"))
    lexemes = good.select(
        F.col("id").alias("lex_id"), F.col("place").alias("seq"), F.when(F.col("lemid") == "", F.concat("lemma", F.lit("#"), "pos")).otherwise(F.col("lemid")).alias("lemid"), "lemma", "pos", first("feats").alias("feats"), _morphs(F.col("seg")).alias("morphs"), "misc"
    )
    sources = lambda m, main: F.when(m["Sources"].isNull(), F.array(main)).otherwise(F.split(m["Sources"], ","))
    feats = lambda m: F.map_filter(m, lambda k, v: ~k.isin("Type", "Sources", "MainSource"))
    main = good.where("parent <> ''").withColumn("m", first("rel")).select(F.coalesce(F.col("m")["Type"], F.lit("Derivation")).alias("type"), F.col("parent").alias("main_source"), sources(F.col("m"), F.col("parent")).alias("sources"), F.col("id").alias("target"), F.lit(0).alias("ord"), feats(F.col("m")).alias("feats"))
    more = good.where("other <> ''").select("id", F.posexplode(kw_parse(F.col("other"))).alias("i", "m"))
    more = more.select(F.coalesce(F.col("m")["Type"], F.lit("Derivation")).alias("type"), F.col("m")["MainSource"].alias("main_source"), sources(F.col("m"), F.col("m")["MainSource"]).alias("sources"), F.col("id").alias("target"), (F.col("i") + 1).alias("ord"), feats(F.col("m")).alias("feats"))
    relations = main.unionByName(more).where(F.col("type").isin(*known_types))
    return _checked(Bundle(lexemes, relations, rows.where("problem IS NOT NULL").select("line_no", "problem")), on_err)


def write_network_v2(lexemes: DataFrame, relations: DataFrame, path: str) -> None:
    """The reverse, as files in order: trees in order of their roots' lemmas, nodes depth first, a blank line between trees."""
    main = relations.where("ord = 0")
    edges = lexemes.select(F.col("lex_id").alias("node"), "lemma", "pos", "lemid").join(main.select(F.col("target").alias("node"), F.col("main_source").alias("parent")), "node", "left")
    ids = dfs_ids(edges, ["lemma", "pos", "lemid"]).select("node", "tree", "pos", F.concat_ws(".", F.col("tree").cast("string"), F.col("pos").cast("string")).alias("id"))
    named = ids.select(F.col("node").alias("old"), F.col("id").alias("new"))

    def renamed(rels: DataFrame, with_main: bool) -> DataFrame:
        each = rels.select("target", "ord", "type", "main_source", "feats", F.size("sources").alias("n"), F.posexplode("sources").alias("i", "old")).join(named, "old")
        whole = each.groupBy("target", "ord").agg(F.first("type").alias("type"), F.first("main_source").alias("old"), F.first("feats").alias("feats"), F.first("n").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "new"))), lambda x: x["new"]), ",").alias("sources"))
        whole = whole.join(named, "old")
        extra = F.map_from_entries(F.filter(F.array(F.struct(F.lit("Type").alias("k"), F.col("type").alias("v")), F.struct(F.lit("Sources").alias("k"), F.when(F.col("n") > 1, F.col("sources")).alias("v")), F.struct(F.lit("MainSource").alias("k"), F.col("new").alias("v") if with_main else F.lit(None).cast("string").alias("v"))), lambda e: e["v"].isNotNull()))
        return whole.select("target", "ord", "new", F.map_concat("feats", extra).alias("m"))

    own = renamed(main, False).select(F.col("target").alias("node"), F.col("new").alias("parent_id"), kw_format(F.array("m")).alias("rel"))
    rest = renamed(relations.where("ord > 0"), True).groupBy(F.col("target").alias("node")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.map_entries("m").alias("e")))), lambda x: F.map_from_entries(x["e"])).alias("ms")).select("node", kw_format(F.col("ms")).alias("other"))
    seg = F.transform("morphs", lambda m: F.map_from_entries(F.filter(F.array(F.struct(F.lit("Start").alias("k"), m["start"].cast("string").alias("v")), F.struct(F.lit("End").alias("k"), m["end"].cast("string").alias("v")), F.struct(F.lit("Morph").alias("k"), m["morph"].alias("v")), F.struct(F.lit("Type").alias("k"), m["type"].alias("v"))), lambda e: e["v"].isNotNull())))
    rows = lexemes.select(F.col("lex_id").alias("node"), "lemid", "lemma", F.col("pos").alias("word_class"), "feats", seg.alias("seg"), "misc").join(ids, "node").join(own, "node", "left").join(rest, "node", "left")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat_ws("\t", "id", text("lemid"), "lemma", text("word_class"), kw_format(F.when(F.size("feats") > 0, F.array("feats")).otherwise(F.array().cast("array<map<string,string>>"))), F.coalesce(kw_format(F.col("seg")), F.lit("")), text("parent_id"), text("rel"), text("other"), F.coalesce("misc", F.lit("{}")))
    # a blank line goes before each tree but the first
    value = F.when((F.col("pos") == 0) & (F.col("tree") > 0), F.concat(F.lit("\n"), line)).otherwise(line)
    rows.select("tree", "pos", value.alias("value")).repartitionByRange("tree", "pos").sortWithinPartitions("tree", "pos").select("value").write.mode("overwrite").text(path)


def read_pairs_unimorph(spark: SparkSession, path: str, on_err: str = "raise") -> Bundle:
    """Four columns: parent, child, ``P:C`` parts of speech, affix.  Both ends become lexemes.

    The first pair of a child that closes no cycle is its main relation; others are
    further ones.  A word that derives itself, and a pair that closes a cycle of
    main relations, are errors.
    """
    rows = numbered(read_lines(spark, path).where("value <> ''"), ["file", "line_no"], "line").withColumn("f", F.split("value", "\t", -1))
    field = lambda i: F.get("f", F.lit(i))
    parsed = rows.select("line", "line_no", F.size("f").alias("n"), field(0).alias("parent"), field(1).alias("child"), F.split_part(field(2), F.lit(":"), F.lit(1)).alias("p_pos"), F.split_part(field(2), F.lit(":"), F.lit(2)).alias("c_pos"), field(3).alias("affix"))
    problem = F.when(F.col("n") != 4, "not four fields").when((F.col("parent") == "") | (F.col("child") == ""), "empty word").when(F.col("c_pos") == "", "bad parts of speech").when((F.col("parent") == F.col("child")) & (F.col("p_pos") == F.col("c_pos")), "derives itself")
    parsed = parsed.withColumn("problem", problem)
    good = checkpointed(parsed.where("problem IS NULL").select("line", "line_no", "affix", F.concat_ws("#", "parent", "p_pos").alias("main_source"), F.concat_ws("#", "child", "c_pos").alias("target"), "parent", "p_pos", "child", "c_pos")).hint("merge")
    ends = good.select(F.col("parent").alias("lemma"), F.col("p_pos").alias("pos"), "line").unionByName(good.select(F.col("child").alias("lemma"), F.col("c_pos").alias("pos"), "line"))
    lexemes = ends.groupBy("lemma", "pos").agg(F.min("line").alias("seq")).withColumn("lex_id", F.concat_ws("#", "lemma", "pos"))
    edits = good.select("line", F.col("main_source").alias("parent"), F.col("target").alias("node"))
    forest = checkpointed(fill_parent(lexemes.select(F.col("lex_id").alias("node"), F.lit(None).cast("string").alias("parent")), edits)).hint("merge")
    cyclic = check_cycles(forest, edits).select("line", F.lit(True).alias("cyclic"))
    told = good.join(cyclic, "line", "left").join(forest.select(F.col("node").alias("target"), F.col("parent").alias("_main")), "target")
    order = Window.partitionBy("target").orderBy(F.col("main_source") != F.col("_main"), "line")
    relations = told.where("cyclic IS NULL").select(F.lit("Derivation").alias("type"), "main_source", "target", (F.row_number().over(order) - 1).alias("ord"), "affix")
    errors = parsed.where("problem IS NOT NULL").select("line_no", "problem").unionByName(told.where("cyclic").select("line_no", F.lit("closes a cycle").alias("problem")))
    return _checked(Bundle(lexemes, relations.withColumn("sources", F.array("main_source")), errors), on_err)


def read_annotations(spark: SparkSession, path: str, columns: list[str], sep: str = "\t", comment: str | None = "#", marks: str = "", header: bool = False) -> DataFrame:
    """``line_no``, ``mark`` and the named columns of an annotation file; blank and comment lines are left out.

    ``marks`` are characters that may stand before the first column.
    """
    rows = read_lines(spark, path).where("trim(value) <> ''")
    if comment:
        rows = rows.where(~F.startswith("value", F.lit(comment)))
    if header:
        rows = rows.where("line_no > 1")
    found = F.regexp_extract("value", f"^([{marks}]*)", 1) if marks else F.lit("")
    parts = F.split(F.expr("substring(value, length(mark) + 1)"), sep.replace("|", r"\|"), -1)
    return rows.withColumn("mark", found).withColumn("_f", parts).select("line_no", "mark", *[F.get("_f", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def write_snapshot(bundle: Bundle, path: str) -> None:
    """Lexemes and relations as Parquet."""
    bundle.lexemes.write.mode("overwrite").parquet(f"{path}/lexemes")
    bundle.relations.write.mode("overwrite").parquet(f"{path}/relations")


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/lexemes"), spark.read.parquet(f"{path}/relations")


def write_candidate_blocks(df: DataFrame, group: str, line: Column, path: str, per_file: int = 500) -> None:
    """Rows in blocks by group, blank lines between them, so many groups a file at most."""
    blocks = df.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("value"))
    total = max(1, blocks.count())
    blocks.repartitionByRange(-(-total // per_file), group).sortWithinPartitions(group).select(F.concat("value", F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def read_records(spark: SparkSession, path: str, head: str = "word", list_fields: tuple[str, ...] = ()) -> DataFrame:
    """Records of ``key: value`` lines, each begun by the ``head`` key, as maps; the named fields as comma-separated lists."""
    rows = read_lines(spark, path).where("value RLIKE '^[^:]+:'").select("file", "line_no", F.trim(F.split_part("value", F.lit(":"), F.lit(1))).alias("key"), F.trim(F.regexp_replace("value", r"^[^:]*:", "")).alias("text"))
    heads = running_sum(rows.withColumn("_head", F.when(F.col("key") == head, 1).otherwise(0).cast("long")), ["file", "line_no"], "_head", "_heads")
    # heads of earlier files don't count
    first = heads.groupBy("file").agg(F.min("_heads").alias("_first"))
    made = heads.join(first, "file").withColumn("record", F.col("_heads") + F.col("_head") - F.col("_first")).where("record > 0").groupBy("file", "record").agg(F.map_from_entries(F.collect_list(F.struct("key", "text"))).alias("fields"))
    return made.select("record", F.col("fields")[head].alias(head), *[F.split(F.col("fields")[f], r",\s*").alias(f) for f in list_fields], "fields")


def read_segmentation_table(spark: SparkSession, path: str, word: int, morphs: list[int], sep: str = "\t") -> DataFrame:
    """Words (column ``word``) with morphs spread over columns, joined by hyphens; rows that don't rebuild their word are left out."""
    rows = read_lines(spark, path).withColumn("f", F.split("value", sep, -1))
    parts = F.filter(F.array(*[F.get("f", F.lit(i)) for i in morphs]), lambda m: F.coalesce(m, F.lit("")) != "")
    made = rows.select("line_no", F.get("f", F.lit(word)).alias("word"), parts.alias("parts"))
    return made.where(F.array_join("parts", "") == F.col("word")).select("line_no", "word", F.array_join("parts", "-").alias("segments"))
