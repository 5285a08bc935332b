"""Projections, filters and lookups on nodes."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.operators.forest import below
from wordgrove.operators.products import products


def lookup(lexemes: DataFrame, keys: DataFrame, on: list[str], fuzzy: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Lexemes that match each key (``key_id`` and the columns ``on``), with all columns or those in ``columns``.

    ``fuzzy`` names a column that is only held against the key where some match
    agrees on it; if none does, all matches stay.
    """
    strict = [c for c in on if c != fuzzy]
    wanted = keys.select("key_id", *[F.col(c).alias(f"_{c}") for c in on])
    # keys with the same columns given are joined on all of them at once, so that nothing is met that doesn't fit
    ways = []
    for given in product((True, False), repeat=len(strict) - 1):
        cols = [strict[0], *[c for c, there in zip(strict[1:], given) if there]]
        absent = [F.col(f"_{c}").isNull() for c in strict if c not in cols]
        ways.append((cols, wanted.where(reduce(lambda a, b: a & b, absent)) if absent else wanted))
    met = lambda some, lexemes, cols: some.join(lexemes, [F.col(c) == F.col(f"_{c}") for c in cols])
    out = ["key_id", *(columns or lexemes.columns)]
    if not fuzzy:
        return reduce(DataFrame.unionByName, [met(some, lexemes, cols).select(*out) for cols, some in ways])
    asks, open_ = F.col(f"_{fuzzy}").isNotNull(), lexemes.where(F.col(fuzzy).isNull())
    agreeing = []
    for cols, some in ways:
        agreeing += [
            met(some, lexemes.select(*cols, fuzzy).distinct(), [*cols, fuzzy]).select("key_id"),
            met(some.where(asks), open_.select(*cols).distinct(), cols).select("key_id"),
            met(some.where(~asks), lexemes.select(*cols).distinct(), cols).select("key_id"),
        ]
    agreed = reduce(DataFrame.unionByName, agreeing).distinct().select(F.col("key_id").alias("_key"), F.lit(True).alias("_any"))
    # what is asked of lexemes: any, one that agrees, or one that holds nothing against the key
    kind = lexemes.schema[fuzzy].dataType
    how = lambda k, value=None: F.struct(F.lit(k).alias("kind"), (F.lit(None) if value is None else F.col(value)).cast(kind).alias("value"))
    known = lexemes.withColumn("_how", F.explode(F.array(how("any"), F.when(F.col(fuzzy).isNull(), how("open")).otherwise(how("same", fuzzy)))))
    found = []
    for cols, some in ways:
        told = some.join(agreed, F.col("key_id").eqNullSafe(F.col("_key")), "left")
        asked = told.withColumn("_how", F.explode(F.when(F.col("_any") & asks, F.array(how("same", f"_{fuzzy}"), how("open"))).otherwise(F.array(how("any")))))
        on_all = [*cols, "_how"]
        rest = [c for c in out[1:] if c not in cols]
        found.append(products(asked.select("key_id", *[F.col(f"_{c}").alias(c) for c in cols], "_how"), known.select(*on_all, *(rest or [F.lit(True).alias("_met")])), on_all, keep=[c for c in out[1:] if c in cols]))
    return reduce(DataFrame.unionByName, [df.select(*out) for df in found])


def lookup_spec(lexemes: DataFrame, specs: DataFrame, parts: list[str], sep: str = "_") -> DataFrame:
    """Lexemes that fit a ``spec`` such as ``lemma_pos_gender``: its parts by ``sep`` against ``parts`` in order, absent ones fitting all."""
    split = F.split("spec", sep)
    wanted = specs.select("spec", *[F.get(split, F.lit(i)).alias(f"_{c}") for i, c in enumerate(parts)])
    condition = F.col(parts[0]) == F.col(f"_{parts[0]}")
    for c in parts[1:]:
        condition &= F.col(f"_{c}").isNull() | F.col(c).eqNullSafe(F.col(f"_{c}"))
    return wanted.join(lexemes, condition).select("spec", *lexemes.columns)


def drop_paths(df: DataFrame, col: str, paths: list[str]) -> DataFrame:
    """A struct column without nested fields; a path that isn't there is passed over."""
    return df.withColumn(col, F.col(col).dropFields(*paths))


def recode(df: DataFrame, col: str, mapping: dict[str, str], unknown: str = "error") -> DataFrame:
    """A column by a mapping; a value outside it is an error, or stays (``unknown='keep'``)."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    missing = F.col(col) if unknown == "keep" else F.when(F.col(col).isNotNull(), F.raise_error(F.concat(F.lit("no code for "), F.col(col).cast("string"))))
    return df.withColumn(col, F.coalesce(table[F.col(col)], missing))


def drop_feat(df: DataFrame, name: str, feats: str = "feats") -> DataFrame:
    """All rows without a feature."""
    return df.withColumn(feats, F.map_filter(feats, lambda k, v: k != name))


def add_feat(lexemes: DataFrame, additions: DataFrame, feats: str = "feats") -> tuple[DataFrame, DataFrame]:
    """Features (``lex_id``, ``name``, ``value``) set on lexemes, and additions that contradict what is there.

    The same value again changes nothing; a null value deletes the feature.
    """
    joined = additions.join(lexemes.select("lex_id", feats), "lex_id").withColumn("now", F.col(feats)[F.col("name")])
    conflicts = joined.where("now IS NOT NULL AND value IS NOT NULL AND now <> value").select("lex_id", "name", "now", "value")
    fine = additions.join(conflicts.select("lex_id", "name"), ["lex_id", "name"], "left_anti")
    sets = fine.where("value IS NOT NULL").groupBy("lex_id").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("name", "value")))).alias("_set"))
    gone = fine.where("value IS NULL").groupBy("lex_id").agg(F.collect_set("name").alias("_gone"))
    out = lexemes.join(sets, "lex_id", "left").join(gone, "lex_id", "left")
    kept = F.map_filter(feats, lambda k, v: ~F.array_contains(F.coalesce("_gone", F.array().cast("array<string>")), k) & ~F.coalesce(F.map_contains_key("_set", k), F.lit(False)))
    merged = F.when(F.col("_set").isNull(), kept).otherwise(F.map_concat(kept, F.col("_set")))
    return out.withColumn(feats, merged).drop("_set", "_gone"), conflicts


def fill_lemid(df: DataFrame, mask: str = "?" * 14) -> DataFrame:
    """Default ids (``lemma#pos``) with a mask after them."""
    default = F.concat("lemma", F.lit("#"), "pos")
    return df.withColumn("lemid", F.when(F.coalesce("lemid", default) == default, F.concat(default, F.lit(mask))).otherwise(F.col("lemid")))


def mark_roots(nodes: DataFrame, listed: DataFrame) -> DataFrame:
    """The first node by ``seq`` of each listed ``lemma``, if it is a root: ``lemma``, ``node``."""
    first = Window.partitionBy("lemma").orderBy("seq")
    return nodes.join(listed.select("lemma").distinct(), "lemma", "left_semi").withColumn("k", F.row_number().over(first)).where("k = 1 AND parent IS NULL").select("lemma", "node")


def mark_preferring_roots(nodes: DataFrame, listed: DataFrame) -> DataFrame:
    """For each listed ``lemma`` its first root by ``seq``; its first node if it has no root: ``lemma``, ``node``."""
    order = Window.partitionBy("lemma").orderBy(F.col("parent").isNotNull(), "seq")
    return nodes.join(listed.select("lemma").distinct(), "lemma", "left_semi").withColumn("k", F.row_number().over(order)).where("k = 1").select("lemma", "node")


def set_label(nodes: DataFrame, marks: DataFrame, keys: list[str]) -> DataFrame:
    """Labels from annotated lines (``line``, keys, ``label``, ``flip``): the last line of a key counts, a flip negates it."""
    last = marks.groupBy(*keys).agg(F.max_by(F.col("label") != F.coalesce("flip", F.lit(False)), "line").alias("label"))
    return nodes.join(last, keys, "left")


def clear_label_below(nodes: DataFrame, edges: DataFrame, marked: DataFrame) -> DataFrame:
    """``nodes`` with a null ``label`` wherever one of ``marked`` (``node``) is an ancestor or the node itself."""
    inside = below(edges, marked).withColumn("_below", F.lit(True))
    return nodes.join(inside, "node", "left").withColumn("label", F.when(F.col("_below").isNull(), F.col("label"))).drop("_below")


def chains3(nodes: DataFrame, predicate: Column) -> DataFrame:
    """Child, parent and grandparent (``c_``, ``p_`` and ``g_`` columns of ``nodes``) for which a predicate holds."""
    side = lambda p: nodes.select(*[F.col(c).alias(f"{p}_{c}") for c in nodes.columns])
    return side("c").join(side("p"), F.col("c_parent") == F.col("p_node")).join(side("g"), F.col("p_parent") == F.col("g_node")).where(predicate)


def edge_scan(nodes: DataFrame, predicate: Column) -> DataFrame:
    """Child and parent (``c_`` and ``p_`` columns of ``nodes``) for which a predicate holds."""
    side = lambda p: nodes.select(*[F.col(c).alias(f"{p}_{c}") for c in nodes.columns])
    return side("c").join(side("p"), F.col("c_parent") == F.col("p_node")).where(predicate)


def edges_by_feat(relations: DataFrame, lexemes: DataFrame, name: str, value: str) -> DataFrame:
    """Sources of relations with a feature, and their targets' lemmas in order, comma-joined."""
    label = lexemes.select(F.col("node").alias("target"), F.col("lemma").alias("target_lemma"))
    found = relations.where(F.col("feats")[name] == value).join(label, "target")
    grouped = found.groupBy(F.col("main_source").alias("node")).agg(F.array_join(F.array_sort(F.collect_list("target_lemma")), ",").alias("targets"))
    return grouped.join(lexemes.select("node", "lemma"), "node").select("node", "lemma", "targets")


def children_of_class(nodes: DataFrame, pos: str) -> DataFrame:
    """Children whose parent has a part of speech."""
    return edge_scan(nodes, F.col("p_pos") == pos).select(F.col("c_node").alias("node"), F.col("c_lemma").alias("lemma"), F.col("p_lemma").alias("parent_lemma"))


def clean_wordlist(words: DataFrame, min_length: int = 3, min_count: int = 2) -> DataFrame:
    """Words without digits, punctuation or inner capitals, not short, not rare and not an abbreviation."""
    w = F.col("lemma")
    return words.where(~w.rlike(r"[\p{N}\p{P}]") & ~w.rlike(r"^.+\p{Lu}") & (F.length(w) >= min_length) & (F.col("n") >= min_count) & w.rlike("[aeiouyáéíóúýäöüèêàâôîûëïœæ]"))


def plausible_pairs(pairs: DataFrame, strict: bool = True, pos_pairs: tuple[tuple[str, str], ...] = (("N", "A"),)) -> DataFrame:
    """Pairs (``a``, ``a_pos``, ``b``, ``b_pos``) of the same or a listed part of speech with equal starts of two letters; or of one letter, if not strict."""
    start = lambda c, k: F.lower(F.substring(c, 1, k))
    if not strict:
        return pairs.where(start("a", 1) == start("b", 1))
    pos = reduce(lambda x, y: x | y, [(F.col("a_pos") == a) & (F.col("b_pos") == b) for a, b in pos_pairs], F.col("a_pos") == F.col("b_pos"))
    return pairs.where(pos & (start("a", 2) == start("b", 2)))
