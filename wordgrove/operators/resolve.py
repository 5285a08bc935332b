"""Joins that resolve names to nodes, and other joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgrove.common import checkpointed, written
from wordgrove.operators.products import products

#: Sets of one block of an element that many sets hold.
BLOCK_SETS = 2048
#: Rows, or pairs of sets, of one task when overlaps are counted.
OVERLAP_ROWS = 2_000_000


def resolve(refs: DataFrame, lexemes: DataFrame, on: list[str], policy: str = "first", ref_id: str = "ref_id") -> tuple[DataFrame, DataFrame]:
    """References resolved (``ref_id``, ``node``) and those that aren't (``ref_id``, ``reason``).

    ``first`` takes the first homonym by ``seq``, ``all`` every one, ``unique_only``
    none where there are several, and ``error`` fails on those.
    """
    if policy not in ("first", "all", "unique_only", "error"):
        raise ValueError(f"no policy {policy}")
    if policy == "all":
        refs, known = written(refs.select(ref_id, *on)), lexemes.select(*on, "node").where("node IS NOT NULL")
        missing = refs.join(known.select(*on).distinct(), on, "left_anti").select(ref_id, F.lit("missing").alias("reason"))
        return products(refs, known, on), missing
    # one row for each key, so that no reference meets its homonyms
    first = lexemes.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("seq", "node"))["node"].alias("node"))
    found = refs.join(first, on, "left")
    missing = found.where("node IS NULL").select(ref_id, F.lit("missing").alias("reason"))
    hit = found.where("node IS NOT NULL")
    if policy == "first":
        return hit.select(ref_id, "node"), missing
    ambiguous = hit.where("_n > 1").select(ref_id, F.lit("ambiguous").alias("reason"))
    if policy == "error" and (bad := ambiguous.take(5)):
        raise ValueError(f"ambiguous references: {[r[0] for r in bad]}")
    return hit.where("_n = 1").select(ref_id, "node"), missing.unionByName(ambiguous)


def resolve_cascade(refs: DataFrame, lexemes: DataFrame, levels: list[list[tuple[str, str]]], ref_id: str = "ref_id") -> DataFrame:
    """``ref_id``, ``node`` and ``level``: the first list of (reference column, node column) pairs that matches; its first node by ``seq``."""
    joined = refs
    for level, pairs in enumerate(levels):
        keys = [F.col(c).alias(f"_r{i}") for i, (_, c) in enumerate(pairs)]
        # one row for each key, so a level adds a column to the references and no row
        first = lexemes.groupBy(*keys).agg(F.min_by("node", "seq").alias(f"_node{level}"))
        joined = joined.join(first, [F.col(r) == F.col(f"_r{i}") for i, (r, _) in enumerate(pairs)], "left").drop(*[f"_r{i}" for i in range(len(pairs))])
    hits = F.filter(F.array(*[F.struct(F.lit(i).alias("level"), F.col(f"_node{i}").alias("node")) for i in range(len(levels))]), lambda h: h["node"].isNotNull())
    found = joined.select(ref_id, F.get(hits, F.lit(0)).alias("b")).where("b IS NOT NULL")
    return found.groupBy(ref_id).agg(F.min("b").alias("b")).select(ref_id, "b.node", "b.level")


def best_pair(pairs: DataFrame, lexemes: DataFrame, edges: DataFrame) -> DataFrame:
    """For each pair of lemmas (``pair_id``, ``source``, ``target``) the best nodes.

    Linked already, then equal homonym numbers, then a target without a parent,
    then the first of both.
    """
    # pairs of equal lemmas have the same best, and the first by homonym number stand for all others
    wanted = checkpointed(pairs.select("source", "target").where("source IS NOT NULL AND target IS NOT NULL").distinct())
    side = lambda p, lemma: lexemes.select(F.col("lemma").alias(lemma), F.col("homonym").alias("_h"), F.col("parent").alias("_up"), F.struct("seq", "node").alias(p))
    s, t = side("s", "source"), side("t", "target")
    links = edges.select(F.col("node").alias("_t"), F.col("parent").alias("_s")).distinct()
    linked = links.join(s.withColumn("_s", F.col("s.node")), "_s").drop("_h", "_up").join(t.withColumn("_t", F.col("t.node")), "_t").join(wanted, ["source", "target"], "left_semi")
    numbered = lambda x, p, lemma: x.where("_h IS NOT NULL").groupBy(lemma, "_h").agg(F.min(p).alias(p))
    equal = wanted.join(numbered(s, "s", "source"), "source").join(numbered(t, "t", "target"), ["target", "_h"])
    first = wanted.join(s.groupBy("source").agg(F.min("s").alias("s")), "source")
    tops = first.join(t.where("_up IS NULL").groupBy("target").agg(F.min("t").alias("t")), "target")
    any_of = first.join(t.groupBy("target").agg(F.min("t").alias("t")), "target")
    ranked = [df.select("source", "target", F.struct(F.lit(k).alias("rank"), F.col("s.seq").alias("s_seq"), F.col("t.seq").alias("t_seq"), F.col("s.node").alias("s_node"), F.col("t.node").alias("t_node")).alias("_best")) for k, df in enumerate((linked, equal, tops, any_of))]
    best = reduce(DataFrame.unionByName, ranked).groupBy("source", "target").agg(F.min("_best").alias("_best"))
    found = pairs.join(best, ["source", "target"]).groupBy("pair_id").agg(F.min("_best").alias("_best"))
    return found.select("pair_id", F.col("_best.s_node").alias("source_node"), F.col("_best.t_node").alias("target_node"), "_best.rank")


def resolve_preferring(refs: DataFrame, lexemes: DataFrame, preferred: DataFrame, first_pos: str | None = None) -> DataFrame:
    """``ref_id`` and ``node`` of a ``lemma``: the preferred ``lemid`` of a side table, then a part of speech, then the first by ``seq``."""
    # one row for each lemma, so that no reference meets its homonyms
    wanted = preferred.select("lemma", "lemid", F.lit(True).alias("_wanted")).distinct()
    known = lexemes.select("lemma", "lemid", "pos", "seq", "node").join(wanted, ["lemma", "lemid"], "left")
    place = F.struct(F.col("_wanted").isNull().alias("other"), (F.col("pos") != F.lit(first_pos) if first_pos else F.lit(False)).alias("late"), "seq", "node")
    best = known.groupBy("lemma").agg(F.min(place).alias("_best"))
    return refs.join(best, "lemma").groupBy("ref_id").agg(F.min("_best").alias("_best")).select("ref_id", "_best.node")


def resolve_all(refs: DataFrame, lexemes: DataFrame, at_least: int | None = None) -> DataFrame:
    """References to several lemmas (``ref_id``, ``lemmas``) with the first node of each, in order (``nodes``).

    All must be found, or so many at least.
    """
    first = lexemes.groupBy("lemma").agg(F.min_by("node", "seq").alias("node"))
    each = refs.select("ref_id", F.size("lemmas").alias("wanted"), F.posexplode("lemmas").alias("place", "lemma")).join(first, "lemma")
    grouped = each.groupBy("ref_id", "wanted").agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias("found"))
    enough = F.col("wanted") if at_least is None else F.lit(at_least)
    return grouped.where(F.size("found") >= enough).select("ref_id", F.transform("found", lambda x: x["node"]).alias("nodes"))


def copy_feature(dst: DataFrame, src: DataFrame, feature: str) -> DataFrame:
    """``dst`` with a feature of another version: by ``lemid``, else by lemma and part of speech; the first that isn't null by ``seq``."""
    known = src.where(F.col(feature).isNotNull())
    by_id = known.groupBy("lemid").agg(F.min_by(feature, "seq").alias("_a"))
    by_word = known.groupBy("lemma", "pos").agg(F.min_by(feature, "seq").alias("_b"))
    return dst.drop(feature).join(by_id, "lemid", "left").join(by_word, ["lemma", "pos"], "left").withColumn(feature, F.coalesce("_a", "_b")).drop("_a", "_b")


def membership(words: DataFrame, lexemes: DataFrame, on: list[str]) -> DataFrame:
    """Words with ``known`` (in the network) and ``single`` (one word)."""
    there = lexemes.select(*on).distinct().withColumn("_there", F.lit(True))
    return words.join(there, on, "left").withColumn("known", F.coalesce("_there", F.lit(False))).withColumn("single", ~F.contains(F.col(on[0]), F.lit(" "))).drop("_there")


def mark_listed(table: DataFrame, listed: DataFrame, on: list[str], name: str = "listed") -> DataFrame:
    """A table with a flag on rows whose key is listed."""
    return table.join(listed.select(*on).distinct().withColumn(name, F.lit(True)), on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def overlap_pairs(sets: DataFrame, across: str | None = None) -> DataFrame:
    """Pairs of sets (``set_id``, ``element``) that share an element: ``a``, ``b``, ``shared``; only across batches if a column is named.

    Elements are an inverted index; nothing else is compared.  Those of many sets
    are dealt out in pairs of blocks of ``BLOCK_SETS`` sets, so that an element
    that a third of all sets hold isn't one task.  Pairs outnumber rows and hardly
    repeat, so they are counted where they are brought together, and there are as
    many tasks as pairs call for, told from the sizes of elements beforehand.
    """
    cols = ["set_id", "element", *([across] if across else [])]
    least = sets.sparkSession.sparkContext.defaultParallelism
    tasks = lambda rows: max(rows // OVERLAP_ROWS + 1, least)
    sets = sets.select(*cols).where("set_id IS NOT NULL AND element IS NOT NULL")
    each = written(sets.repartition(tasks(sets.count()), "set_id", "element").distinct())
    sizes = checkpointed(each.groupBy("element").agg(F.count(F.lit(1)).alias("_n")))
    n = tasks(int(sizes.agg(F.sum(F.col("_n").cast("decimal(38,0)") * (F.col("_n") - 1) / 2)).first()[0] or 0))
    # at most one row for each ``BLOCK_SETS`` rows of sets
    crowded = sizes.where(F.col("_n") > BLOCK_SETS).select("element", F.ceil(F.col("_n") / F.lit(float(BLOCK_SETS))).cast("int").alias("_blocks"))
    dealt = each.join(F.broadcast(crowded), "element", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1))).withColumn("_own", F.pmod(F.xxhash64("set_id"), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    extra = [F.col(across)] if across else []
    left = dealt.select(F.col("set_id").alias("a"), "element", F.col("_own").alias("_i"), F.col("_other").alias("_j"), *extra)
    right = dealt.select(F.col("set_id").alias("b"), "element", F.col("_other").alias("_i"), F.col("_own").alias("_j"), *([F.col(across).alias("_batch")] if across else []))
    pairs = left.repartition(n, "element", "_i", "_j").join(right.repartition(n, "element", "_i", "_j").hint("merge"), ["element", "_i", "_j"]).where("a < b")
    if across:
        pairs = pairs.where(F.col(across) != F.col("_batch"))
    return pairs.select("a", "b").repartition(n, "a", "b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


def external_parents(edges: DataFrame, nodes: DataFrame, pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """Candidate parents (``child``, ``parent`` lemmas) for roots, known in the network and not in the root's own tree.

    ``placed`` has ``node`` and ``root``.  Gives ``node`` and ``parent_node``.
    """
    # nodes of the same lemmas make a class; classes are paired first, so that a pair of nodes comes out once and needs no search for copies
    classed = written(nodes.where("lemma IS NOT NULL").groupBy("node").agg(F.array_sort(F.collect_set("lemma")).alias("_class")))
    each = classed.select("_class").distinct().select("_class", F.explode("_class").alias("_lemma"))
    side = lambda name, lemma: each.select(F.col("_class").alias(name), F.col("_lemma").alias(lemma))
    met = pairs.join(side("_of_child", "child"), "child").join(side("_of_parent", "parent"), "parent").select("_of_child", "_of_parent").distinct()
    tops = classed.join(edges.where("parent IS NULL").select("node"), "node", "left_semi").select("node", F.col("_class").alias("_of_child"))
    # what hangs below one root alone isn't given to that root
    ends = placed.groupBy(F.col("node").alias("parent_node")).agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low IS NOT NULL")
    others = classed.select(F.col("node").alias("parent_node"), F.col("_class").alias("_of_parent")).join(ends, "parent_node").select("_of_parent", "parent_node", F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("_own"))
    asked = tops.join(met, "_of_child").select("_of_parent", "node")
    return products(asked, written(others), ["_of_parent"], unless=("node", "_own"))


def confirm(cands: DataFrame, edges: DataFrame) -> DataFrame:
    """Candidates (``parent``, ``node``) marked ``%`` if that edge exists."""
    return cands.join(edges.select("parent", "node", F.lit("%").alias("mark")), ["parent", "node"], "left").withColumn("mark", F.coalesce("mark", F.lit("")))


def classify_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of lemmas (``pair_id``, ``parent``, ``child``) against a network.

    ``same`` and ``other`` parent, ``unique`` or ``ambiguous`` among children
    without one, or ``unknown``.
    """
    up = nodes.select(F.col("node").alias("_p"), F.col("lemma").alias("_p_lemma"))
    child = nodes.select("node", F.col("parent").alias("_p"), F.col("lemma").alias("child")).join(up, "_p", "left")
    seen = nodes.select(F.col("lemma").alias("parent")).distinct().withColumn("_known", F.lit(True))
    joined = pairs.join(child, "child", "left").join(seen, "parent", "left")
    grouped = joined.groupBy("pair_id").agg(
        F.max(F.col("_p_lemma") == F.col("parent")).alias("same"), F.count("_p_lemma").alias("hung"), F.count("node").alias("nodes"), F.max("_known").alias("known")
    )
    kind = (
        F.when((F.col("nodes") == 0) | F.col("known").isNull(), "unknown")
        .when(F.coalesce("same", F.lit(False)), "same")
        .when(F.col("hung") > 0, "other")
        .when(F.col("nodes") == 1, "unique")
        .otherwise("ambiguous")
    )
    return grouped.select("pair_id", kind.alias("kind"))
