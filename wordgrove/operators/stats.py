"""Counts, frequencies, percentiles, samples and other statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.operators.forest import depths, heights, running_sum, signatures


def count_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows by value."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def tag_masks(forms: DataFrame, keys: list[str], tag: str = "tag", count: str = "n") -> DataFrame:
    """For each key one mask of its tags, ``?`` where they differ, and the sum of counts.

    Null keys are keys like others.  A key whose tags are null or empty has an empty mask.
    """
    counted = forms.groupBy(*keys, F.col(tag).alias("_tag")).agg(F.sum(count).alias("_n"))
    longest = counted.agg(F.max(F.length("_tag"))).first()[0] or 0
    # a tag has as many letters as its scheme has places, so the masks are that many columns of one aggregation
    letter = lambda i: F.when(F.length("_tag") >= i, F.substring("_tag", i, 1))
    ends = [f(letter(i)).alias(f"_{name}{i}") for i in range(1, longest + 1) for name, f in (("a", F.min), ("b", F.max))]
    wide = counted.groupBy(*keys).agg(F.sum("_n").alias("n"), *ends)
    places = [F.when(F.col(f"_a{i}") == F.col(f"_b{i}"), F.col(f"_a{i}")).when(F.col(f"_a{i}").isNotNull(), "?").otherwise("") for i in range(1, longest + 1)]
    return wide.select(*keys, F.concat(*places, F.lit("")).alias("mask"), "n")


def import_counts(lexemes: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Every lexeme with the sum of its key's counts; homonyms all get it; 0 where there is none."""
    return lexemes.join(counts.groupBy(*keys).agg(F.sum("n").alias("count")), keys, "left").withColumn("count", F.coalesce("count", F.lit(0)))


def import_counts_sublemmas(lexemes: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts by ``sublemma`` where it is a known lemma of that part of speech, else by ``lemma``."""
    known = lexemes.select(F.col("lemma").alias("sublemma"), "pos").distinct().withColumn("known", F.lit(True))
    keyed = counts.join(known, ["sublemma", "pos"], "left").select(F.when(F.col("known"), F.col("sublemma")).otherwise(F.col("lemma")).alias("lemma"), "pos", "n")
    return import_counts(lexemes, keyed, ["lemma", "pos"])


def relative_freq(df: DataFrame, count: str = "n", total: float | None = None) -> DataFrame:
    """``rf``: the count by the total, that of the table if none is given."""
    if total is not None:
        return df.withColumn("rf", F.col(count).cast("double") / F.lit(float(total)))
    whole = df.agg(F.sum(count).cast("double").alias("_total"))
    return df.join(F.broadcast(whole)).withColumn("rf", F.col(count).cast("double") / F.col("_total")).drop("_total")


def sparsity(df: DataFrame, rf: str = "rf", total: Column | None = None) -> DataFrame:
    """``sparsity``: the negative decimal logarithm of the relative frequency; that of 1 / total where it is 0."""
    rare = F.lit(None).cast("double") if total is None else -F.log10(F.lit(1.0) / total)
    return df.withColumn("sparsity", F.when(F.col(rf) > 0, -F.log10(rf)).otherwise(rare))


def tie_percentile(df: DataFrame, col: str, name: str = "percentile") -> DataFrame:
    """100 times the share of rows with a lower value; 0 where the value is 0, null where it is null.

    Ranks come from the histogram of values, summed up in a range-partitioned sort,
    so no task orders them all.  Rows with a null value count for neither share.
    """
    histogram = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_rows"))
    below = running_sum(histogram, [col], "_rows", "_below")
    total = below.agg(F.sum("_rows").alias("_all"))
    placed = below.join(F.broadcast(total)).select(col, F.when(F.col(col) == 0, 0.0).otherwise(F.lit(100.0) * F.col("_below") / F.col("_all")).alias(name))
    return df.join(placed, col, "left")


def network_stats(nodes: DataFrame, creator: str | None = None) -> DataFrame:
    """Long-format statistics (``metric``, ``key``, ``value``) of nodes with ``node``, ``parent``, ``lemma``, ``pos``.

    ``creator`` names a column for what made the edge to the parent: then there are
    also capitalised singletons, and edges by creator, ``unknown`` where it is null;
    nodes without a parent count under ``no parent``.
    """
    edges = nodes.where("parent IS NOT NULL").select("parent", F.col("pos").alias("child_pos"))
    kids = edges.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    with_degree = nodes.join(kids, "node", "left").select("*", F.coalesce("degree", F.lit(0)).cast("long").alias("out"))
    capital = F.col("lemma").rlike(r"^\p{Lu}")
    long = lambda df, metric: df.select(F.lit(metric).alias("metric"), F.col("key").cast("string").alias("key"), F.col("value").cast("long").alias("value"))
    single = nodes.agg(F.count(F.lit(1)).alias("lexemes"), F.countDistinct("lemma").alias("lemmas"), F.count("parent").alias("edges"), F.count_if(capital).alias("capitalised"), F.count_if(capital & F.col("parent").isNull()).alias("capitalised_roots"))
    totals = single.select(F.explode(F.create_map(*[x for c in single.columns for x in (F.lit(c), F.col(c))])).alias("key", "value"))
    by_pos = nodes.groupBy(F.col("pos").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    pairs = edges.join(nodes.select(F.col("node").alias("parent"), "pos"), "parent").groupBy(F.concat_ws("->", "pos", "child_pos").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    degrees = with_degree.groupBy(F.col("out").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    found = long(totals, "total").unionByName(long(by_pos, "pos")).unionByName(long(pairs, "pos_edges")).unionByName(long(degrees, "out_degree"))
    if creator is None:
        return found
    alone = with_degree.agg(F.lit("capitalised_singletons").alias("key"), F.count_if(capital & F.col("parent").isNull() & (F.col("out") == 0)).alias("value"))
    made_by = F.when(F.col("parent").isNull(), "no parent").otherwise(F.coalesce(creator, F.lit("unknown")))
    return found.unionByName(long(alone, "total")).unionByName(long(nodes.groupBy(made_by.alias("key")).agg(F.count(F.lit(1)).alias("value")), "creator"))


def cluster_stats(edges: DataFrame) -> DataFrame:
    """``size``, how many trees have it, and the mean and greatest depth of their nodes."""
    placed = depths(edges)
    trees = placed.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.max("depth").alias("depth"), F.sum("depth").alias("depths"))
    return trees.groupBy("size").agg(F.count(F.lit(1)).alias("trees"), F.max("depth").alias("max_depth"), (F.sum("depths") / F.sum("size")).alias("mean_depth"))


def signature_counts(edges: DataFrame, label: str, examples: int = 21) -> DataFrame:
    """How many trees have each signature, with the first roots, so many at most, as examples."""
    found = signatures(edges, label)
    # the least roots of a signature are taken in each task before they are brought together
    first = found.withColumn("_k", F.row_number().over(Window.partitionBy("sig").orderBy("root"))).where(F.col("_k") <= examples)
    listed = first.groupBy("sig").agg(F.array_join(F.transform(F.array_sort(F.collect_list("root")), lambda x: x.cast("string")), ",").alias("examples"))
    return found.groupBy("sig").agg(F.count(F.lit(1)).alias("trees")).join(listed, "sig")


def node_report(nodes: DataFrame, subtree: DataFrame) -> DataFrame:
    """``node``, ``n``, attested and unattested children, subtree size and attested part, depth and height.

    ``subtree`` has ``node``, ``size`` and ``attested`` (see ``subtree_agg``).
    """
    edges = nodes.select("node", "parent")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count_if(F.col("n") > 0).alias("attested_children"), F.count_if(F.col("n") == 0).alias("unattested_children"))
    out = nodes.select("node", "n").join(kids, "node", "left").join(subtree, "node").join(depths(edges).select("node", "depth"), "node").join(heights(edges, leaf=0), "node")
    return out.select("node", "n", F.coalesce("attested_children", F.lit(0)).alias("attested_children"), F.coalesce("unattested_children", F.lit(0)).alias("unattested_children"), "size", "attested", "depth", "height")


def homonyms(df: DataFrame, keys: list[str], distinct: str) -> DataFrame:
    """Keys with more than one distinct value, the values joined in order."""
    found = df.groupBy(*keys).agg(F.array_sort(F.collect_set(F.col(distinct).cast("string"))).alias("_values"))
    return found.where(F.size("_values") > 1).select(*keys, F.size("_values").cast("long").alias("variants"), F.array_join("_values", ",").alias("values"))


def odd_homonym_numbers(lexemes: DataFrame) -> DataFrame:
    """Lemmas (``lemma``, ``pos``) of several ``techlemma``, not all of which have a number: ``lexemes`` and ``unnumbered`` are how many.

    A technical lemma is a word, perhaps with a hyphen and a number, perhaps with
    comments from ``_`` or a grave accent on.
    """
    bare = F.regexp_replace("techlemma", r"(?s)[_`].+", "")
    number = F.regexp_extract(bare, r"^.+-(\d+)$", 1)
    named = lexemes.select("pos", F.when(number == "", bare).otherwise(F.regexp_extract(bare, r"^(.+)-\d+$", 1)).alias("lemma"), F.when(number == "", 0).otherwise(F.regexp_replace(number, "^0+(?=.)", "").try_cast("long")).alias("number"))
    counted = named.groupBy("lemma", "pos").agg(F.count(F.lit(1)).alias("lexemes"), F.count_if(F.col("number") == 0).alias("unnumbered"))
    return counted.where("lexemes > 1 AND unnumbered > 0")


def roots_by_freq(nodes: DataFrame, compounds: DataFrame | None = None) -> DataFrame:
    """Roots with their counts, without capitalised ones and without ``compounds`` if given."""
    found = nodes.where("parent IS NULL").where(~F.col("lemma").rlike(r"^\p{Lu}"))
    if compounds is not None:
        found = found.join(compounds.select("node"), "node", "left_anti")
    return found.select("node", "lemma", "n").orderBy(F.desc("n"), "lemma", "node")


def best_variant(df: DataFrame, keys: list[str], variant: str, score: Column) -> DataFrame:
    """For each key the variant with the highest score; ties to the first in order."""
    scored = df.withColumn("_score", score)
    best = Window.partitionBy(*keys).orderBy(F.desc("_score"), variant)
    return scored.withColumn("_k", F.row_number().over(best)).where("_k = 1").select(*keys, variant, F.col("_score").alias("score"))


def multi_label(pairs: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Pairs with more than one label, the labels joined in order."""
    return homonyms(pairs, keys, label)


def split_by_source_count(cands: DataFrame) -> DataFrame:
    """Candidates (``source``, ``target``, ``rule``) by target: how many sources and which rules gave them."""
    return cands.groupBy("target").agg(
        F.countDistinct("source").alias("sources"), F.array_join(F.array_sort(F.collect_set("rule")), "+").alias("rules")
    ).withColumn("kind", F.when(F.col("sources") == 1, "mono").otherwise("multi"))


def groups_with(df: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """The rows of groups in one row of which a condition holds, as of clusters that hold a change."""
    return df.join(df.where(condition).select(*keys).distinct(), keys, "left_semi")


def rule_combinations(cands: DataFrame) -> DataFrame:
    """How many targets each combination of rules gave."""
    return split_by_source_count(cands).groupBy("rules").agg(F.count(F.lit(1)).alias("targets"))


def sample_uniform(df: DataFrame, k: int, key: list[str], seed: int = 0) -> DataFrame:
    """``k`` rows without replacement, by the least hashes of a seed and the key."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(k)


def sample_weighted(df: DataFrame, k: int, key: list[str], weight: Column, seed: int = 0) -> DataFrame:
    """``k`` rows without replacement, each drawn in proportion to its weight; rows of weight 0 never.

    Exponential races: the least -ln(u) / weight win, u a uniform hash of the key.
    """
    u = (F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 52)).cast("double") + 1.0) / float((1 << 52) + 1)
    return df.withColumn("_weight", weight.cast("double")).where("_weight > 0").withColumn("_time", -F.log(u) / F.col("_weight")).orderBy("_time", *key).limit(k).drop("_weight", "_time")


def sample_negatives(pairs: DataFrame, labelled: DataFrame, keys: list[str], label: str = "label", factor: float = 1.5, seed: int = 0) -> DataFrame:
    """Unlabelled pairs, ``factor`` times the mean size of a label's class, by the least hashes."""
    sizes = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.avg("n")).first()[0] or 0
    return sample_uniform(pairs.join(labelled.select(*keys), keys, "left_anti"), int(factor * sizes), keys, seed)


def retrograde(df: DataFrame, col: str) -> DataFrame:
    """Distinct lower-cased words with their reversed form, in the order of the latter."""
    low = df.select(F.lower(col).alias(col)).distinct()
    return low.withColumn("reversed", F.reverse(col)).orderBy("reversed")


def first_sentences(sentences: DataFrame, n: int, known: DataFrame) -> DataFrame:
    """Words (``word``) of sentences (``sent``, ``word``) numbered below ``n`` that aren't known, with the first sentence of each."""
    return sentences.where(F.col("sent") < n).join(known.select("word"), "word", "left_anti").groupBy("word").agg(F.min("sent").alias("sent"))


def listed_examples(tokens: DataFrame, listed: DataFrame, order: list[str]) -> DataFrame:
    """For each listed ``lemma`` the first of the ``tokens`` (``lemma``, any other columns) that has it, in whatever case."""
    wanted = listed.select(F.lower("lemma").alias("_lemma")).distinct()
    found = tokens.withColumn("_lemma", F.lower("lemma")).join(wanted, "_lemma", "left_semi")
    # the first of each task is taken before they are brought together
    first = found.groupBy("_lemma").agg(F.min(F.struct(*order, F.struct(*[c for c in tokens.columns if c not in order]).alias("_rest"))).alias("_first"))
    return first.select(*[F.col(f"_first.{c}") if c in order else F.col(f"_first._rest.{c}") for c in tokens.columns])


def unlisted_tokens(tokens: DataFrame, listed: DataFrame) -> DataFrame:
    """Tokens whose ``lemma``, as it is written, isn't listed."""
    return tokens.join(listed.select("lemma").distinct(), "lemma", "left_anti").select(*tokens.columns)
