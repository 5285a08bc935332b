"""Scores against a gold standard, of relations, segmentations and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordgrove.common import checkpointed
from wordgrove.operators.forest import roots_of


def _ratio(a: Column, b: Column, empty: float) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(empty))


SCOPES = ("lexeme", "internal", "gold", "cluster")
METRICS = ("precision", "recall", "specificity", "accuracy", "f1")


def _asked(nodes: DataFrame, gold: DataFrame, ignore_pos: bool) -> DataFrame:
    """Gold decisions with their alternatives as relation keys, and the node of each lexeme of that name, null where there is none."""
    on = ["lemma"] if ignore_pos or "pos" not in gold.columns else ["lemma", "pos"]
    named = gold.where("decision IS NOT NULL AND decision NOT IN ('', '?')").withColumn("gold_id", F.struct(*[c for c in ("lemma", "pos", "decision") if c in gold.columns])).distinct()
    parts = F.filter(F.transform(F.split("decision", ","), lambda x: F.trim(x)), lambda x: x != "")
    keys = F.transform(parts, lambda x: F.when(x == "-", "-").when(F.contains(x, F.lit(" ")), F.concat(F.lit("C:"), F.regexp_replace(x, r"\s+", " "))).otherwise(F.concat(F.lit("D:"), x)))
    there = nodes.select(*on, "node")
    return named.select("gold_id", *on, "decision", keys.alias("keys")).join(there, on, "left").select("gold_id", "lemma", "decision", "keys", "node")


def _relation_keys(nodes: DataFrame, relations: DataFrame) -> DataFrame:
    """``node``, ``rel_id`` and ``key`` of every relation: whether it is a compound, and the lemmas of its sources."""
    each = relations.select(F.struct("target", "ord").alias("rel_id"), F.col("target").alias("node"), (F.col("type") == "Compounding").alias("c"), F.posexplode("sources").alias("i", "source"))
    named = each.join(nodes.select(F.col("node").alias("source"), F.col("lemma").alias("l")), "source")
    grouped = named.groupBy("rel_id", "node", "c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "l"))), lambda x: x["l"]), " ").alias("lemmas"))
    return grouped.select("node", "rel_id", F.concat(F.when(F.col("c"), "C:").otherwise("D:"), "lemmas").alias("key"))


def score_details(nodes: DataFrame, relations: DataFrame, gold: DataFrame, ignore_pos: bool = False) -> DataFrame:
    """Every judgement (``scope``, ``lemma``, ``decision``, ``node``, ``rel_id``, ``outcome``) on a network held against gold decisions.

    ``nodes`` has ``node``, ``lemma`` and ``pos``; ``relations`` has ``target``,
    ``ord``, ``type`` and ``sources``; ``gold`` has ``lemma``, ``decision`` and, if
    wanted, ``pos``.  A decision is ``-`` (underived), ``?`` (left out), ``!`` (no
    word: it should be absent) or alternatives after commas; an alternative of
    several words is a compound.  Every homonym is judged, and each of its
    relations.  Scopes: ``lexeme`` (is the word there), ``internal`` (relations of
    words that are there), ``gold`` (also those that missing words should have),
    ``cluster`` (is a parent that the gold names in the word's family; once,
    however many are).  Outcomes: tp, fp, tn, fn.
    """
    # both are read several times below
    asked = checkpointed(_asked(nodes, gold, ignore_pos))
    absent, present = asked.where("node IS NULL"), asked.where("node IS NOT NULL")
    no_rel = F.lit(None).cast(f"struct<target:{dict(relations.dtypes)['target']},ord:int>")

    def rows(frame: DataFrame, scopes: list[str], outcome: Column, rel: Column = no_rel) -> DataFrame:
        made = frame.select("lemma", "decision", "node", rel.alias("rel_id"), outcome.alias("outcome"))
        return made.withColumn("scope", F.explode(F.array(*map(F.lit, scopes)))).select("scope", "lemma", "decision", "node", "rel_id", "outcome")

    banned = F.col("decision") == "!"
    out = rows(absent, ["lexeme"], F.when(banned, "tn").otherwise("fn"))
    out = out.unionByName(rows(absent.where("decision NOT IN ('!', '-')"), ["gold"], F.lit("fn")))
    out = out.unionByName(rows(present, ["lexeme"], F.when(banned, "fp").otherwise("tp")))
    judged = present.where("decision <> '!'")
    keyed = checkpointed(_relation_keys(nodes, relations.withColumn("ord", F.col("ord").cast("int"))))
    related = judged.join(keyed, "node", "left")
    correct = F.array_contains("keys", F.col("key"))
    underived = F.when(F.array_contains("keys", F.lit("-")), "tn").otherwise("fn")
    out = out.unionByName(rows(related, ["internal", "gold"], F.when(F.col("key").isNull(), underived).when(correct, "tp").otherwise("fp"), F.col("rel_id")))

    # the family of a word by main relations
    main = relations.where("ord = 0").groupBy(F.col("target").alias("node")).agg(F.first("main").alias("parent"))
    placed = roots_of(nodes.select("node").join(main, "node", "left"))
    derived = keyed.select("node").distinct().withColumn("derived", F.lit(True))
    told = judged.join(derived, "node", "left").withColumn("derived", F.coalesce("derived", F.lit(False)))
    wanted = told.select("gold_id", "node", F.explode(F.filter("keys", lambda k: k != "-")).alias("k")).select("gold_id", "node", F.explode(F.split(F.expr("substring(k, 3)"), " ")).alias("lemma")).distinct()
    homes = nodes.select("lemma", F.col("node").alias("other")).join(placed.select(F.col("node").alias("other"), F.col("root").alias("home")), "other").select("lemma", "home").distinct()
    met = wanted.join(homes, "lemma").join(placed, "node").where("root = home").select("gold_id", "node").distinct().withColumn("met", F.lit(True))
    only_root = F.size(F.filter("keys", lambda k: k != "-")) == 0
    outcome = F.when(only_root, F.when(F.col("derived"), "fp").otherwise("tn")).when(F.col("met"), "tp").when(F.col("derived"), "fp").otherwise("fn")
    return out.unionByName(rows(told.join(met, ["gold_id", "node"], "left"), ["cluster"], outcome))


def _metrics(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Long-format metrics of counts ``tp``, ``fp``, ``tn`` and ``fn``; empty denominators give 0, 1, 1, 0 and 0."""
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    values = {"precision": _ratio(tp, tp + fp, 0.0), "recall": _ratio(tp, tp + fn, 1.0), "specificity": _ratio(tn, tn + fp, 1.0), "accuracy": _ratio(tp + tn, tp + fp + tn + fn, 0.0), "f1": _ratio(2 * tp, 2 * tp + fp + fn, 0.0)}
    return counts.select(*keys, F.explode(F.create_map(*[x for name in METRICS for x in (F.lit(name), values[name])])).alias("metric", "value"))


def score(details: DataFrame) -> DataFrame:
    """``scope``, ``metric`` and ``value`` of details: precision, recall, specificity, accuracy and F1."""
    return _metrics(details.groupBy("scope").agg(*[F.count_if(F.col("outcome") == x).alias(x) for x in ("tp", "fp", "tn", "fn")]), ["scope"])


def score_by_creator(details: DataFrame, history: DataFrame) -> DataFrame:
    """Correct and incorrect relations, compounds among them, and precision by the creator (``node``, ``creator``) of each node's relations."""
    made = details.where("scope = 'internal' AND rel_id IS NOT NULL").join(history.select("node", "creator"), "node")
    grouped = made.groupBy("creator").agg(F.count_if(F.col("outcome") == "tp").alias("correct"), F.count_if(F.col("outcome") == "fp").alias("incorrect"))
    return grouped.withColumn("precision", _ratio(F.col("correct"), F.col("correct") + F.col("incorrect"), 0.0))


def seg_score(gold: DataFrame, guess: DataFrame, by: str, sep: str = "-") -> DataFrame:
    """Mean edit distance and micro precision, recall and F1 of morph boundaries by category and over all (null category)."""
    both = gold.select("word", by, F.col("segments").alias("g")).join(guess.select("word", F.col("segments").alias("s")), "word")
    ends = lambda c: F.slice(F.transform(F.sequence(F.lit(1), F.size(F.split(c, sep))), lambda i: F.aggregate(F.slice(F.split(c, sep), F.lit(1), i), F.lit(0), lambda t, p: t + F.length(p))), F.lit(1), F.size(F.split(c, sep)) - 1)
    marked = both.select(by, F.levenshtein("g", "s").alias("distance"), ends("g").alias("a"), ends("s").alias("b"))
    marked = marked.select(by, "distance", F.size(F.array_intersect("a", "b")).alias("hit"), F.size("a").alias("gold"), F.size("b").alias("guess"))
    grouped = marked.rollup(by).agg(F.avg("distance").alias("mean_distance"), F.sum("hit").alias("hit"), F.sum("gold").alias("gold"), F.sum("guess").alias("guess"))
    precision, recall = _ratio(F.col("hit"), F.col("guess"), 0.0), _ratio(F.col("hit"), F.col("gold"), 1.0)
    return grouped.select(by, "mean_distance", precision.alias("precision"), recall.alias("recall"), F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0).alias("f1"))


def agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shares of words (``word``, ``bits``) on which two annotators agree, and on which one's boundaries all are the other's."""
    both = a.select("word", F.col("bits").alias("a")).join(b.select("word", F.col("bits").alias("b")), "word")
    within = lambda x, y: F.forall(F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: (p != "1") | (q == "1")), lambda ok: ok)
    return both.agg(F.count(F.lit(1)).alias("words"), F.avg((F.col("a") == F.col("b")).cast("int")).alias("exact"), F.avg((within("a", "b") | within("b", "a")).cast("int")).alias("nested"))


def boundary_score(gold: DataFrame, guess: DataFrame) -> DataFrame:
    """Word accuracy and micro precision, recall and F1 of boundary bits (``word``, ``bits``)."""
    both = gold.select("word", F.col("bits").alias("g")).join(guess.select("word", F.col("bits").alias("s")), "word")
    ones = lambda c: F.length(F.replace(c, F.lit("0"), F.lit("")))
    hit = F.aggregate(F.zip_with(F.split("g", ""), F.split("s", ""), lambda p, q: F.when((p == "1") & (q == "1"), 1).otherwise(0)), F.lit(0), lambda t, x: t + x)
    sums = both.agg(F.avg((F.col("g") == F.col("s")).cast("int")).alias("word_accuracy"), F.sum(hit).alias("hit"), F.sum(ones("g")).alias("gold"), F.sum(ones("s")).alias("guess"))
    precision, recall = _ratio(F.col("hit"), F.col("guess"), 0.0), _ratio(F.col("hit"), F.col("gold"), 1.0)
    return sums.select("word_accuracy", precision.alias("precision"), recall.alias("recall"), F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0).alias("f1"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """``truth``, ``predicted`` and how many rows."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def one_vs_rest(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 of each label, and their means as the label ``macro``."""
    cells = confusion(df, truth, predicted)
    right = cells.where("truth = predicted").select(F.col("truth").alias("label"), F.col("n").alias("hit"))
    said, was = cells.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("said")), cells.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("was"))
    each = was.join(said, "label", "full").join(right, "label", "left").na.fill(0, ["hit", "said", "was"])
    precision, recall = _ratio(F.col("hit"), F.col("said"), 0.0), _ratio(F.col("hit"), F.col("was"), 1.0)
    each = each.select("label", precision.alias("precision"), recall.alias("recall")).withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    return each.unionByName(each.agg(F.lit("macro").alias("label"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1")))
