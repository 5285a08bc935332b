"""Morph segmentations: arrays of structs (``start``, ``end``, ``morph``, ``type``), boundaries, labels and their comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.functions.text import common_prefix_length
from wordgrove.operators.forest import path_fold


def paradigm_class(forms: DataFrame, key: str, tag: str, form: str, tags: list[str], ladder: list[tuple[str, Column]], otherwise: str) -> DataFrame:
    """``key`` and ``class``: forms pivoted by tag (the last of several in order), then the first condition that holds."""
    wide = forms.groupBy(key).pivot(tag, tags).agg(F.max(form))
    out = F.lit(otherwise)
    for name, condition in reversed(ladder):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return wide.select(key, out.alias("class"))


def agreed_value(df: DataFrame, keys: list[str], col: str, name: str) -> DataFrame:
    """Keys all of whose rows agree on a value."""
    return df.groupBy(*keys).agg(F.min(col).alias(name), F.countDistinct(col).alias("_n")).where("_n = 1").drop("_n")


def complete_morphs(lex: DataFrame, morphs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Checked and completed segmentations, and what is wrong with the others.

    ``lex`` has ``lex_id`` and ``lemma``; ``morphs`` has ``lex_id``, ``start``,
    ``end``, ``morph`` and ``type``.  A morph must lie in the word, start before it
    ends, have the text that stands there and not overlap the one before.  Missing
    types become ``Unknown``; gaps become ``Implicit`` morphs.
    """
    order = Window.partitionBy("lex_id").orderBy("start", "end")
    placed = morphs.join(lex.select("lex_id", "lemma"), "lex_id").withColumn("before", F.coalesce(F.lag("end").over(order), F.lit(0)))
    text = F.substring("lemma", F.col("start") + 1, F.col("end") - F.col("start"))
    problem = (
        F.when((F.col("start") < 0) | (F.col("end") > F.length("lemma")), "out of range")
        .when(F.col("start") >= F.col("end"), "empty")
        .when(F.col("start") < F.col("before"), "overlap")
        .when(F.col("morph").isNotNull() & (F.col("morph") != text), "text differs")
    )
    checked = placed.withColumn("problem", problem)
    issues = checked.where("problem IS NOT NULL").select("lex_id", "start", "end", "problem")
    good = checked.join(issues.select("lex_id").distinct(), "lex_id", "left_anti")
    own = good.select("lex_id", "start", "end", text.alias("morph"), F.coalesce("type", F.lit("Unknown")).alias("type"))
    gaps = good.where(F.col("start") > F.col("before")).select("lex_id", F.col("before").alias("start"), F.col("start").alias("end"), F.substring("lemma", F.col("before") + 1, F.col("start") - F.col("before")).alias("morph"), F.lit("Implicit").alias("type"))
    ends = good.groupBy("lex_id", "lemma").agg(F.max("end").alias("last"))
    bare = lex.select("lex_id", "lemma").join(morphs.select("lex_id").distinct(), "lex_id", "left_anti").withColumn("last", F.lit(0))
    tails = ends.unionByName(bare).where(F.col("last") < F.length("lemma")).select("lex_id", F.col("last").alias("start"), F.length("lemma").alias("end"), F.expr("substring(lemma, last + 1)").alias("morph"), F.lit("Implicit").alias("type"))
    return own.unionByName(gaps).unionByName(tails), issues


def infer_offsets(morphs: Column) -> Column:
    """Starts and ends of an array of morphs (``start``, ``end``, ``morph``) that may lack them, in their order."""

    empty = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,morph:string>>")

    def guarded(acc: Column, m: Column) -> Column:
        last = F.when(F.size(acc) > 0, F.try_element_at(acc, F.lit(-1))["end"]).otherwise(F.lit(0))
        size = F.length(m["morph"])
        start = F.coalesce(m["start"], F.when(m["end"].isNotNull(), m["end"] - size), last)
        return F.concat(acc, F.array(F.struct(start.alias("start"), F.coalesce(m["end"], start + size).alias("end"), m["morph"].alias("morph"))))

    return F.aggregate(morphs, empty, guarded)


def drop_offsets(morphs: Column) -> Column:
    """The same array with null offsets wherever a morph follows the one before it."""
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.try_element_at(morphs, i)["end"])

    def bare(m: Column, i: Column) -> Column:
        follows = m["start"] == before(i)
        return F.struct(F.when(~follows, m["start"]).alias("start"), F.when(~follows, m["end"]).alias("end"), m["morph"].alias("morph"))

    return F.transform(morphs, bare)


def merge_boundaries(lex: DataFrame, flags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Boundary flags (``lex_id``, ``place``, ``allowed``) by place, and places that are both allowed and forbidden.

    Places outside the word are forbidden; places without a flag are unknown and have no row.
    """
    placed = flags.join(lex.select("lex_id", "lemma"), "lex_id").withColumn("inside", (F.col("place") > 0) & (F.col("place") < F.length("lemma")))
    grouped = placed.groupBy("lex_id", "place").agg(F.min("allowed").alias("low"), F.max("allowed").alias("high"), F.first("inside").alias("inside"))
    conflicts = grouped.where("low <> high AND inside").select("lex_id", "place")
    return grouped.where("low = high OR NOT inside").select("lex_id", "place", (F.col("high") & F.col("inside")).alias("allowed")), conflicts


def morphs_from_splits(lines: DataFrame, segments: str = "segments") -> DataFrame:
    """One row a morph of words segmented by spaces: ``start``, ``end``, ``morph`` and a type guessed from its place.

    A single morph is a root; else the first is a prefix, the last a suffix and
    those between are roots.
    """
    parts = F.split(segments, " ")
    rows = lines.select("*", F.size(parts).alias("_n"), F.posexplode(parts).alias("_i", "morph"), parts.alias("_parts"))
    start = F.aggregate(F.slice("_parts", F.lit(1), F.col("_i")), F.lit(0), lambda total, p: total + F.length(p))
    kind = F.when(F.col("_n") == 1, "Root").when(F.col("_i") == 0, "Prefix").when(F.col("_i") == F.col("_n") - 1, "Suffix").otherwise("Root")
    return rows.select(*lines.columns, start.alias("start"), (start + F.length("morph")).alias("end"), "morph", kind.alias("type"))


def morphs_from_typed(lex: DataFrame, lines: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed morphs ``morph:lemma:type|...`` (``line``, ``lemma``, ``segments``): the n-th line of a word goes to its n-th homonym."""
    rank = lambda order: F.row_number().over(Window.partitionBy("lemma").orderBy(order))
    matched = lines.withColumn("k", rank("line")).join(lex.select("lex_id", "lemma", "seq").withColumn("k", rank("seq")), ["lemma", "k"])
    part = F.transform(F.split("segments", r"\|"), lambda s: F.split(s, ":"))
    rows = matched.select("lex_id", "lemma", F.posexplode(part).alias("place", "p"))
    names = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return rows.select("lex_id", "place", F.col("p")[0].alias("morph"), F.col("p")[1].alias("morph_lemma"), names[F.col("p")[2]].alias("type"))


def morphs_from_labels(words: DataFrame, segments: str = "segments", labels: str = "labels") -> DataFrame:
    """One row a morph of words with ``segments`` and ``labels``, both by spaces; fewer labels leave nulls."""
    zipped = F.arrays_zip(F.split(segments, " ").alias("m"), F.split(labels, " ").alias("l"))
    rows = words.select("*", F.posexplode(zipped).alias("_i", "_z"), F.split(segments, " ").alias("_parts")).where("_z.m IS NOT NULL")
    start = F.aggregate(F.slice("_parts", F.lit(1), F.col("_i")), F.lit(0), lambda total, p: total + F.length(p))
    return rows.select(*words.columns, start.alias("start"), (start + F.length("_z.m")).alias("end"), F.lower("_z.m").alias("morph"), F.col("_z.l").alias("type"))


_SPAN = "struct<start:int,end:int,how:string,reach:int>"


def project_roots(nodes: DataFrame, seeds: DataFrame, stops: DataFrame, allomorphs: DataFrame) -> DataFrame:
    """Root spans (``node``, ``start``, ``end``, ``how``) carried down trees of ``node``, ``parent``, ``lemma``.

    A node takes its own annotation (``seeds``); else its parent's prefix and root
    if its word begins with them; else the only ``allomorph`` that its word holds
    once.  Nothing is carried to or below ``stops``.

    What a node makes of its parent's span depends on the end of the span alone: it
    stays if the two words agree so far, else the node's own match takes its place.
    Such functions can be put together, a path's becoming the greatest ends that pass
    each of its bottlenecks and what comes of others, so paths are folded by pointer
    doubling.
    """
    edges = nodes.select("node", "parent")
    words = nodes.select("node", "parent", "lemma")
    hits = _occurrences(words.join(stops.select("node"), "node", "left_anti"), "node", allomorphs.select("allomorph").distinct()).select("node", "lemma", "allomorph").distinct()
    only = hits.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("allomorph").alias("allomorph"), F.first("lemma").alias("lemma")).where("n = 1")
    first = F.instr("lemma", F.col("allomorph")) - 1
    span = lambda start, end, how, reach: F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit(how).alias("how"), reach.cast("int").alias("reach"))
    matched = only.select("node", span(first, first + F.length("allomorph"), "allomorph", first + F.length("allomorph")).alias("match"))
    own = seeds.select("node", "start", "end")
    held = words.join(own, "node", "left").join(matched, "node", "left").join(words.select(F.col("node").alias("parent"), F.col("lemma").alias("_up")), "parent", "left")
    value = F.when(F.col("end").isNotNull(), span(F.col("start"), F.col("end"), "own", F.least("end", F.length("lemma")))).otherwise(F.col("match"))
    passes = F.when(F.col("end").isNull() & F.col("_up").isNotNull(), common_prefix_length(F.col("_up"), F.col("lemma"))).otherwise(-1).cast("int")
    steps = held.select("node", F.struct(F.array(F.struct(passes.alias("limit"), value.alias("value"))).alias("limits"), value.alias("none")).alias("step"))
    shut = edges.select("node").join(stops.select("node", F.lit(True).alias("shut")).distinct(), "node", "left").select("node", F.coalesce("shut", F.lit(False)).alias("shut"))
    folded = path_fold(edges, steps.join(shut, "node"), {"step": _after, "shut": lambda upper, lower: upper | lower})
    return folded.where("NOT shut AND step.none IS NOT NULL").select("node", "step.none.start", "step.none.end", "step.none.how")


def _after(upper: Column, lower: Column) -> Column:
    """What two steps of ``project_roots`` do one after the other.

    A step has ``limits``, falling: a span that ends beyond the first of them gives
    its ``value``, one that passes them all stays; ``none`` is what comes of no span.
    """

    def through(span: Column) -> Column:
        stopped = F.get(F.filter(lower["limits"], lambda x: span["reach"] > x["limit"]), F.lit(0))
        stays = F.struct(span["start"].alias("start"), span["end"].alias("end"), F.lit("parent").alias("how"), span["reach"].alias("reach"))
        return F.when(span.isNull(), lower["none"]).when(stopped.isNull(), stays).otherwise(stopped["value"]).cast(_SPAN)

    narrowest = F.element_at(upper["limits"], -1)["limit"]
    passed = F.transform(upper["limits"], lambda x: F.struct(x["limit"].alias("limit"), through(x["value"]).alias("value")))
    own = F.filter(lower["limits"], lambda x: x["limit"] < narrowest)
    return F.struct(F.concat(passed, own).alias("limits"), through(upper["none"]).alias("none"))


#: Characters of the patterns of one automaton, and automata that are tried before words are cut up instead.
PATTERN_CHARACTERS, MOST_AUTOMATA = 2_000_000, 8


def _occurrences(words: DataFrame, key: str, allomorphs: DataFrame) -> DataFrame:
    """Every place (``start``, ``size``) at which an ``allomorph`` stands in a ``lemma``.

    Patterns of a bounded size make an automaton (Aho and Corasick) that words pass
    through where they lie, so only hits are shuffled; more patterns make some such
    passes.  Where even that many don't hold them, all substrings of the lengths that
    allomorphs have are joined with them.  An empty one stands nowhere.
    """
    patterns = allomorphs.select("allomorph").where("allomorph <> ''").distinct()
    groups = (patterns.agg(F.sum(F.length("allomorph"))).first()[0] or 0) // PATTERN_CHARACTERS + 1
    if groups > MOST_AUTOMATA:
        return _by_substrings(words, key, allomorphs.where("allomorph <> ''"))
    found = None
    for group in range(groups):
        listed = [r.allomorph for r in patterns.where(F.pmod(F.xxhash64("allomorph"), F.lit(groups)) == group).collect()]
        part = words.select(key, "lemma").where("lemma IS NOT NULL").mapInArrow(_passed_through(listed), f"{key} {dict(words.dtypes)[key]}, lemma string, start int, size int, allomorph string")
        found = part if found is None else found.unionByName(part)
    return found.join(allomorphs, "allomorph")


def _passed_through(patterns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for pattern in patterns:
            automaton.add_word(pattern, pattern)
        automaton.make_automaton()
        for batch in batches:
            rows, starts, found = [], [], []
            if patterns:
                for k, lemma in enumerate(batch.column(1).to_pylist()):
                    for end, pattern in automaton.iter(lemma):
                        rows.append(k)
                        starts.append(end + 1 - len(pattern))
                        found.append(pattern)
            taken = batch.take(pa.array(rows, pa.int64()))
            columns = [*taken.columns, pa.array(starts, pa.int32()), pa.array([len(p) for p in found], pa.int32()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "start", "size", "allomorph"])

    return run


def _by_substrings(words: DataFrame, key: str, allomorphs: DataFrame) -> DataFrame:
    spans = words.select(key, "lemma", F.explode(F.sequence(F.lit(1), F.length("lemma"))).alias("start"))
    # the lengths of allomorphs are few, whatever their number
    sizes = F.broadcast(allomorphs.select(F.length("allomorph").alias("size")).distinct())
    spans = spans.join(sizes, F.col("start") + F.col("size") - 1 <= F.length("lemma"))
    return spans.select(key, "lemma", (F.col("start") - 1).alias("start"), "size", F.substring("lemma", F.col("start"), F.col("size")).alias("allomorph")).join(allomorphs, "allomorph")


def induce_roots(lex: DataFrame, allomorphs: DataFrame) -> DataFrame:
    """For each word the longest allomorph that occurs in it, less its penalty, with its first place; ties are left out.

    ``allomorphs`` has ``allomorph`` and ``penalty``.
    """
    hits = _occurrences(lex, "lex_id", allomorphs)
    scored = hits.withColumn("score", F.col("size") - F.col("penalty"))
    best = Window.partitionBy("lex_id").orderBy(F.desc("score"))
    top = scored.withColumn("k", F.rank().over(best)).where("k = 1")
    return top.groupBy("lex_id").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("start"), F.min("allomorph").alias("allomorph")).where("n = 1").select("lex_id", "start", "allomorph")


def morphs_from_parts(word: Column, parts: Column) -> Column:
    """A word cut by a list of parts: those that match from its start, those from its end, one residual between them."""
    steps = F.sequence(F.lit(0), F.size(parts))
    text = lambda a: F.array_join(a, "")
    head = F.array_max(F.filter(steps, lambda k: F.startswith(word, text(F.slice(parts, F.lit(1), k)))))
    tail_of = lambda k: F.slice(parts, F.size(parts) - k + 1, k)
    tail = F.array_max(F.filter(F.sequence(F.lit(0), F.size(parts) - head), lambda k: F.endswith(word, text(tail_of(k))) & (F.length(text(F.slice(parts, F.lit(1), head))) + F.length(text(tail_of(k))) <= F.length(word))))
    begin, end = F.slice(parts, F.lit(1), head), F.slice(parts, F.size(parts) - tail + 1, tail)
    middle = F.substring(word, F.length(text(begin)) + 1, F.length(word) - F.length(text(begin)) - F.length(text(end)))
    return F.filter(F.concat(begin, F.array(middle), end), lambda p: p != "")


def merge_segmentations(sources: DataFrame, sep: str = "-") -> DataFrame:
    """Of several ``sources`` (``word``, ``segments``, ``source``, ``priority``) the first by priority, and whether it rebuilds the word."""
    best = sources.groupBy("word").agg(F.min(F.struct("priority", "source", "segments")).alias("b"))
    return best.select("word", F.col("b.segments").alias("segments"), F.col("b.source").alias("source"), (F.replace("b.segments", F.lit(sep), F.lit("")) == F.col("word")).alias("rebuilds"))


def neighbour_outliers(segs: DataFrame, partition: Column, end: str = "first", sep: str = "-") -> DataFrame:
    """Words whose first (last) morph differs while those of both neighbours in order agree, within partitions of the order."""
    place = 1 if end == "first" else -1
    order = Window.partitionBy("_group").orderBy("word")
    marked = segs.withColumn("_group", partition).withColumn("_m", F.element_at(F.split("segments", sep), place))
    marked = marked.withColumn("_a", F.lag("_m").over(order)).withColumn("_b", F.lead("_m").over(order))
    return marked.where("_a = _b AND _m <> _a").select("word", "segments", F.col("_a").alias("expected"))


def seg_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Patterns of difference of two resources (``word``, ``segments``): the forms without their common start, how often, and the first word."""
    both = a.select("word", F.col("segments").alias("a")).join(b.select("word", F.col("segments").alias("b")), "word").where("a <> b")
    longest = F.least(F.length("a"), F.length("b"))
    shared = F.array_max(F.filter(F.sequence(F.lit(0), longest), lambda k: F.substring("a", F.lit(1), k) == F.substring("b", F.lit(1), k)))
    cut = both.select("word", F.expr("a").alias("a"), F.expr("b").alias("b"), shared.alias("k"))
    rest = cut.select("word", F.expr("substring(a, k + 1)").alias("a"), F.expr("substring(b, k + 1)").alias("b"))
    return rest.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("word").alias("example"))


def to_boundaries(segments: Column, sep: str = "-") -> Column:
    """One bit a letter: 1 where a morph ends, but for the last."""
    parts = F.split(segments, sep)
    bits = F.transform(parts, lambda p: F.concat(F.repeat(F.lit("0"), F.greatest(F.length(p) - 1, F.lit(0))), F.lit("1")))
    joined = F.array_join(bits, "")
    return F.concat(F.substring(joined, F.lit(1), F.length(joined) - 1), F.lit("0"))


def from_boundaries(word: Column, bits: Column, sep: str = "-") -> Column:
    """The reverse: a separator after every letter with a 1."""
    letters = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, i, F.lit(1)), F.when(F.substring(bits, i, F.lit(1)) == "1", sep).otherwise("")))
    return F.array_join(letters, "")


def combine_labels(a: Column, b: Column, morphs: Column, affixes: list[str]) -> Column:
    """One label a morph from two sequences: root if both say so and it is no known affix; inflectional if either does; else derivational."""
    triples = F.arrays_zip(a.alias("a"), b.alias("b"), morphs.alias("m"))
    root = lambda t: (t["a"] == "R") & (t["b"] == "R") & ~t["m"].isin(affixes)
    return F.transform(triples, lambda t: F.when(root(t), "R").when((t["a"] == "I") | (t["b"] == "I"), "I").otherwise("D"))
