"""Candidate relations between words: mined and applied rules, prefixes, compounds, patterns, pairs from pages.

Rules are matched by keys: a word is exploded into its endings of the lengths
that rules have, and joined on them, so that no word meets every rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.common import checkpointed
from wordgrove.functions.text import common_prefix_length, title_case
from wordgrove.operators.forest import numbered

#: Words of one window when suffix rules are mined.
BLOCK_WORDS = 50_000


def _ending(word: str, size: str) -> Column:
    return F.substring(word, F.length(word) - F.col(size) + 1, F.col(size))


def _without(word: str, size: str) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - F.col(size))


def endings(words: DataFrame, col: str, sizes: DataFrame, least: int = 1) -> DataFrame:
    """Words with ``_ending`` and ``_stem`` for each of some lengths (``_size``) that leaves a stem of ``least`` letters."""
    # the lengths that a rule table has are few, whatever its rows
    cut = words.join(F.broadcast(sizes.select("_size").distinct()), F.length(col) >= F.col("_size") + least)
    return cut.withColumn("_ending", _ending(col, "_size")).withColumn("_stem", _without(col, "_size"))


def mine_suffix_rules(words: DataFrame, window: int = 6, min_prefix: int = 2) -> DataFrame:
    """Pairs of endings (``from_pos``, ``from_suffix``, ``to_pos``, ``to_suffix``) of words (``lemma``, ``pos``) that follow each other closely in order, with counts.

    A pair shares so many first letters at least.  Words are numbered in a
    range-partitioned sort and looked at in blocks, each with the last words of the
    block before it, so that a frequent beginning is spread over many tasks.
    """
    placed = numbered(words.where(F.length("lemma") >= min_prefix).select("lemma", "pos"), ["lemma", "pos"], "_i").withColumn("_block", F.floor((F.col("_i") - 1) / BLOCK_WORDS))
    carried = placed.where((F.col("_i") - 1) % BLOCK_WORDS >= BLOCK_WORDS - window).withColumn("_block", F.col("_block") + 1).withColumn("_own", F.lit(False))
    near = Window.partitionBy("_block").orderBy("_i").rowsBetween(-window, -1)
    before = placed.withColumn("_own", F.lit(True)).unionByName(carried).withColumn("others", F.collect_list(F.struct("lemma", "pos")).over(near))
    pairs = before.where("_own").select("lemma", "pos", F.explode("others").alias("o")).select("lemma", "pos", F.col("o.lemma").alias("other"), F.col("o.pos").alias("other_pos"))
    cut = pairs.where(F.substring("lemma", 1, min_prefix) == F.substring("other", 1, min_prefix)).withColumn("k", common_prefix_length(F.col("lemma"), F.col("other")))
    rest = lambda c: F.substring(c, F.col("k") + 1, F.length(c))
    return cut.groupBy(F.col("other_pos").alias("from_pos"), rest("other").alias("from_suffix"), F.col("pos").alias("to_pos"), rest("lemma").alias("to_suffix")).agg(F.count(F.lit(1)).alias("n"))


def apply_suffix_rules(words: DataFrame, rules: DataFrame, changes: list[tuple[str, str]] | None = None, edges: DataFrame | None = None, capitalised: bool = False) -> DataFrame:
    """``source``, ``target``, ``rule`` and ``changed``: words made of other words by rules
    (``rule``, ``from_suffix``, ``from_pos``, ``to_suffix``, ``to_pos``), with optional sound changes of the stem's end.

    ``edges`` (``source``, ``target``) adds ``linked``: whether the pair is one already.
    ``capitalised`` also tries lower-case stems with a capital and adds a flag of that name.
    """
    sized = rules.withColumn("_size", F.length("to_suffix")).withColumnRenamed("to_suffix", "_ending")
    cut = endings(words.select(F.col("lemma").alias("target"), F.col("pos").alias("to_pos")), "target", sized).join(sized, ["_ending", "to_pos", "_size"])
    made = cut.select("target", "rule", "from_pos", "from_suffix", "_stem", F.lit(False).alias("changed"))
    for old, new in changes or []:
        stem = F.concat(F.substring("_stem", F.lit(1), F.length("_stem") - len(old)), F.lit(new))
        made = made.unionByName(cut.where(F.endswith("_stem", F.lit(old))).select("target", "rule", "from_pos", "from_suffix", stem.alias("_stem"), F.lit(True).alias("changed")))
    made = made.withColumn("capitalised", F.lit(False))
    if capitalised:
        made = made.unionByName(made.where(F.col("_stem") == F.lower("_stem")).withColumn("_stem", title_case(F.col("_stem"))).withColumn("capitalised", F.lit(True)))
    made = made.select("target", "rule", "from_pos", F.concat("_stem", "from_suffix").alias("source"), "changed", "capitalised")
    known = words.select(F.col("lemma").alias("source"), F.col("pos").alias("from_pos")).distinct()
    found = made.join(known, ["source", "from_pos"], "left_semi").where("source <> target")
    flags = ["changed", *(["capitalised"] if capitalised else [])]
    if edges is not None:
        there = edges.select("source", "target", F.lit(True).alias("_there")).distinct()
        found = found.join(there, ["source", "target"], "left").withColumn("linked", F.coalesce("_there", F.lit(False)))
        flags.append("linked")
    return found.select("source", "target", "rule", *flags)


def open_stem_candidates(words: DataFrame, suffixes: DataFrame, min_stem: int = 3, max_cut: int = 4) -> DataFrame:
    """For each word the best source whose stem it shares: score -2 for each letter cut and -1 for each of the suffix (``suffix``)."""
    cuts = words.select(F.col("lemma").alias("target"), F.explode(F.sequence(F.lit(0), F.lit(max_cut))).alias("cut"))
    stems = cuts.select("target", "cut", F.substring("target", F.lit(1), F.length("target") - F.col("cut")).alias("_stem")).where(F.length("_stem") >= min_stem)
    # words are cut by the suffixes too, so that stems meet on equal keys
    sized = suffixes.select(F.col("suffix").alias("_ending"), F.length("suffix").alias("_size")).distinct()
    sources = endings(words.select(F.col("lemma").alias("source")).distinct(), "source", sized, min_stem).join(sized, ["_ending", "_size"])
    found = stems.join(sources, "_stem").where("source <> target").select("target", "source", (-2 * F.col("cut") - F.col("_size")).alias("score"))
    best = Window.partitionBy("target").orderBy(F.desc("score"), "source")
    return found.withColumn("k", F.row_number().over(best)).where("k = 1").select("source", "target", "score")


def unexploited(words: DataFrame, linked: DataFrame, rules: DataFrame) -> DataFrame:
    """Rule candidates for words (``lemma``) that have no parent (not in ``linked``), the longest ending first."""
    found = apply_suffix_rules(words, rules).join(linked.select(F.col("lemma").alias("target")).distinct(), "target", "left_anti")
    found = found.join(rules.select("rule", F.length("to_suffix").alias("_size")).distinct(), "rule")
    best = Window.partitionBy("target").orderBy(F.desc("_size"), "rule", "source")
    return found.withColumn("k", F.row_number().over(best)).where("k = 1").select("source", "target", "rule")


def rule_cascade(words: DataFrame, rules: DataFrame) -> DataFrame:
    """For each word (``lemma``) that some rule fits, the first rule (by ``rank``) with exactly one candidate, also tried with a capital; else UNRESOLVED."""
    sized = rules.withColumn("_size", F.length("to_suffix"))
    sizes = F.broadcast(sized.select("_size").distinct())
    targets = words.select(F.col("lemma").alias("target")).distinct()
    cut = targets.join(sizes, F.length("target") > F.col("_size")).withColumn("to_suffix", _ending("target", "_size")).withColumn("_stem", _without("target", "_size")).join(sized, ["to_suffix", "_size"])
    plain = cut.select("target", "rank", "rule", F.concat("_stem", "from_suffix").alias("source"))
    both = plain.unionByName(plain.withColumn("source", title_case(F.col("source"))).withColumn("rank", F.col("rank") + 1000))
    found = both.join(words.select(F.col("lemma").alias("source"), "pos"), "source").groupBy("target", "rank", "rule").agg(F.count(F.lit(1)).alias("n"), F.min("source").alias("source")).where("n = 1")
    best = found.groupBy("target").agg(F.min(F.struct("rank", "rule", "source")).alias("b"))
    return plain.select("target").distinct().join(best, "target", "left").select("target", F.coalesce("b.rule", F.lit("UNRESOLVED")).alias("rule"), F.col("b.source").alias("source"))


def pattern_search(words: DataFrame, edges: DataFrame, from_suffix: str, to_suffix: str) -> DataFrame:
    """Words with one ending held against those with another: A linked so, B linked elsewhere, C free and there, D there several times, E absent."""
    size = len(to_suffix)
    made = words.where(F.endswith("lemma", F.lit(to_suffix))).select(F.col("lemma").alias("target"), F.expr(f"concat(substring(lemma, 1, length(lemma) - {size}), '{from_suffix}')").alias("source")).distinct()
    known = words.groupBy(F.col("lemma").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    up = edges.groupBy(F.col("lemma").alias("target")).agg(F.collect_set("parent_lemma").alias("parents"))
    joined = made.join(known, "source", "left").join(up, "target", "left")
    code = F.when(F.coalesce(F.array_contains("parents", F.col("source")), F.lit(False)), "A").when(F.size(F.coalesce("parents", F.array().cast("array<string>"))) > 0, "B").when(F.col("n") == 1, "C").when(F.col("n") > 1, "D").otherwise("E")
    return joined.select("target", "source", code.alias("code"))


def rules_with_exceptions(words: DataFrame, rules: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Rule candidates where an exception (``target``, ``source`` or null) replaces or forbids the rule's source.

    ``situation``: 0 the rule's source is there, 1 an exception's is, 2 the source is missing, 3 forbidden.
    """
    sized = rules.withColumn("_size", F.length("to_suffix"))
    sized = sized.withColumnRenamed("to_suffix", "_ending")
    cut = endings(words.select(F.col("lemma").alias("target")).distinct(), "target", sized).join(sized, ["_ending", "_size"])
    ruled = cut.select("target", "rule", F.concat("_stem", "from_suffix").alias("by_rule"))
    with_ex = ruled.join(exceptions.select("target", F.col("source").alias("by_exception"), F.lit(True).alias("_ex")), "target", "left").withColumn("source", F.when(F.col("_ex"), F.col("by_exception")).otherwise(F.col("by_rule")))
    known = words.select(F.col("lemma").alias("source"), F.lit(True).alias("_known")).distinct()
    situation = F.when(F.col("_ex") & F.col("by_exception").isNull(), 3).when(F.col("_known").isNull(), 2).when(F.col("_ex"), 1).otherwise(0)
    return with_ex.join(known, "source", "left").select("target", "rule", "source", situation.alias("situation"))


def ending_alternatives(words: DataFrame, ending: str, options: list[str]) -> DataFrame:
    """For each word with an ending the first of the alternative endings that makes a known word."""
    size = len(ending)
    stem = words.where(F.endswith("lemma", F.lit(ending))).select(F.col("lemma").alias("target"), F.expr(f"substring(lemma, 1, length(lemma) - {size})").alias("stem")).distinct()
    tried = stem.select("target", F.posexplode(F.array(*[F.concat("stem", F.lit(o)) for o in options])).alias("rank", "source"))
    found = tried.join(words.select(F.col("lemma").alias("source")).distinct(), "source", "left_semi")
    return found.groupBy("target").agg(F.min(F.struct("rank", "source")).alias("b")).select(F.col("b.source").alias("source"), "target", "b.rank")


def strip_prefixes(words: DataFrame, prefixes: list[str], exceptions: DataFrame | None = None, min_rest: int = 2) -> DataFrame:
    """Words (``lemma``, ``pos``) with a listed prefix whose rest is a word of the same part of speech; the longest prefix first."""
    sizes = sorted({len(p) for p in prefixes})
    cut = words.select("lemma", "pos", F.explode(F.array(*[F.lit(k) for k in sizes])).alias("k")).where(F.length("lemma") >= F.col("k") + min_rest)
    cut = cut.select(F.col("lemma").alias("target"), "pos", "k", F.substring("lemma", F.lit(1), F.col("k")).alias("prefix"), F.substring("lemma", F.col("k") + 1, F.length("lemma")).alias("source"))
    found = cut.where(F.col("prefix").isin(prefixes)).join(words.select(F.col("lemma").alias("source"), "pos").distinct(), ["source", "pos"], "left_semi")
    if exceptions is not None:
        found = found.join(exceptions.select(F.col("lemma").alias("target")), "target", "left_anti")
    best = Window.partitionBy("target", "pos").orderBy(F.desc("k"))
    return found.withColumn("_r", F.row_number().over(best)).where("_r = 1").select("source", "target", "pos", "prefix")


def phantom_children(words: DataFrame, linked: DataFrame, phantoms: DataFrame) -> DataFrame:
    """Words without a parent that end in a listed word which is itself unknown: ``lemma``, ``phantom``."""
    absent = phantoms.select(F.col("lemma").alias("phantom")).distinct().join(words.select(F.col("lemma").alias("phantom")), "phantom", "left_anti")
    sizes = F.broadcast(absent.select(F.length("phantom").alias("k")).distinct())
    free = words.select("lemma").distinct().join(linked.select("lemma"), "lemma", "left_anti")
    return free.join(sizes, F.length("lemma") > F.col("k")).withColumn("phantom", _ending("lemma", "k")).join(absent, "phantom").select("lemma", "phantom")


def split_compounds(words: DataFrame, link: str, min_len: int, endings: list[str]) -> DataFrame:
    """Words with exactly one linking letter, both parts long enough, the second known with that part of speech and the first with one of the endings; only unique results."""
    parts = words.where(F.col("lemma").rlike(f"^[^{link}]{{{min_len},}}{link}[^{link}]{{{min_len},}}$")).select(F.col("lemma").alias("target"), "pos", F.split("lemma", link).alias("p"))
    second = parts.select("target", "pos", F.col("p")[0].alias("first"), F.col("p")[1].alias("head")).join(words.select(F.col("lemma").alias("head"), "pos"), ["head", "pos"], "left_semi")
    forms = second.select("target", "pos", "head", F.explode(F.array(*[F.concat("first", F.lit(e)) for e in endings])).alias("modifier"))
    forms = forms.unionByName(forms.withColumn("modifier", title_case(F.col("modifier"))))
    found = forms.join(words.select(F.col("lemma").alias("modifier")).distinct(), "modifier", "left_semi").distinct()
    return found.groupBy("target", "pos").agg(F.count(F.lit(1)).alias("n"), F.min("modifier").alias("modifier"), F.min("head").alias("head")).where("n = 1").drop("n")


def conversion_pairs(words: DataFrame, a: str, b: str) -> DataFrame:
    """Lemmas that two parts of speech share, without capitalised ones."""
    left, right = words.where(F.col("pos") == a), words.where(F.col("pos") == b)
    return left.select("lemma", F.col("n").alias("n_a")).join(right.select("lemma", F.col("n").alias("n_b")), "lemma").where(~F.col("lemma").rlike(r"^\p{Lu}"))


def sibling_patterns(nodes: DataFrame, a: str, b: str) -> DataFrame:
    """Children of one parent, one with each of two endings: ``parent``, ``first``, ``second``."""
    left, right = nodes.where(F.endswith("lemma", F.lit(a))).select("parent", F.col("node").alias("first")), nodes.where(F.endswith("lemma", F.lit(b))).select("parent", F.col("node").alias("second"))
    return left.join(right, "parent").where("first <> second")


def group_by_suffix(words: DataFrame, max_len: int = 10, min_len: int = 1) -> DataFrame:
    """Words grouped by ending, the longest first: a word leaves with the first ending that it shares with another left word.

    Words are put in the order of their letters from the last on, dealt by ranges, so
    words of one ending follow one another.  A pass over a range keeps one place for
    each letter of the ending: the first word that waits there for another one.  Only
    the endings that go on in the next range are left open, one word each, and put
    together for all ranges.
    """
    turned = words.select("lemma").distinct().withColumn("key", F.substring(F.reverse("lemma"), 1, max_len))
    dealt = checkpointed(turned.repartitionByRange(F.col("key"), F.col("lemma")).sortWithinPartitions("key", "lemma").withColumn("part", F.spark_partition_id()))
    # one row for each range
    ends = dealt.groupBy("part").agg(F.min("key").alias("least"), F.max("key").alias("most")).orderBy("part").collect()
    around = {row.part: (ends[k - 1].most if k else None, ends[k + 1].least if k + 1 < len(ends) else None) for k, row in enumerate(ends)}

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, near = _Endings(max_len, min_len), (None, None)
        for batch in batches:
            for lemma, key, part in zip(*(c.to_pylist() for c in batch.columns)):
                near = around[part]
                state.add(key, lemma, near)
            yield state.taken()
        state.close(0, near)
        yield state.taken()

    swept = checkpointed(dealt.mapInArrow(sweep, "suffix string, lemma string, open boolean"))
    # at most two rows for each letter and range
    left = _joined_endings([(r.suffix, r.lemma) for r in swept.where("open").collect()], min_len)
    rest = words.sparkSession.createDataFrame(left, "suffix string, lemma string")
    return swept.where("NOT open").select("suffix", "lemma").unionByName(rest)


class _Endings:
    """Words that come in order of their turned endings, and those that wait at each letter of the present one."""

    def __init__(self, max_len: int, min_len: int) -> None:
        self.min_len, self.key = min_len, ""
        self.waiting: list[str | None] = [None] * (max_len + 1)
        self.shared = [False] * (max_len + 1)
        self.rows: list[tuple[str, str | None, bool]] = []

    def _put(self, depth: int, lemma: str) -> None:
        if depth < self.min_len:
            return
        if self.shared[depth]:
            self.rows.append((self.key[:depth][::-1], lemma, False))
        elif self.waiting[depth] is None:
            self.waiting[depth] = lemma
        else:
            self.shared[depth] = True
            self.rows += [(self.key[:depth][::-1], w, False) for w in (self.waiting[depth], lemma)]
            self.waiting[depth] = None

    def close(self, depth: int, near: tuple[str | None, str | None]) -> None:
        """Ends all endings longer than ``depth``: a word that has waited in vain goes on to the next shorter one."""
        for d in range(len(self.key), depth, -1):
            waits, shared = self.waiting[d], self.shared[d]
            self.waiting[d], self.shared[d] = None, False
            if any(other is not None and other.startswith(self.key[:d]) for other in near):
                # the ending goes on in another range: who waits here, or that it is shared
                if d >= self.min_len and (waits is not None or shared):
                    self.rows.append((self.key[:d][::-1], waits, True))
            elif waits is not None:
                self._put(d - 1, waits)

    def add(self, key: str, lemma: str, near: tuple[str | None, str | None]) -> None:
        same = next((i for i, (a, b) in enumerate(zip(self.key, key)) if a != b), min(len(self.key), len(key)))
        self.close(same, near)
        self.key = key
        self._put(len(key), lemma)

    def taken(self) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in self.rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.bool_()))]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, names=["suffix", "lemma", "open"])


def _joined_endings(left: list[tuple[str, str | None]], min_len: int) -> list[tuple[str, str]]:
    """Groups among words that wait at endings of several ranges; no word says that its range has some already."""
    at: dict[str, list[str | None]] = {}
    for suffix, lemma in left:
        at.setdefault(suffix, []).append(lemma)
    found = []
    for size in range(max(map(len, at), default=0), min_len - 1, -1):
        for suffix in [s for s in at if len(s) == size]:
            words = [w for w in at[suffix] if w is not None]
            if len(words) < len(at[suffix]) or len(words) > 1:
                found += [(suffix, w) for w in words]
            elif words and size > min_len:
                at.setdefault(suffix[1:], []).append(words[0])
    return found


def group_by_rule_shape(pairs: DataFrame) -> DataFrame:
    """Pairs (``source``, ``target``) with their rule shape (the endings after what they share) and how many have it."""
    k = common_prefix_length(F.col("source"), F.col("target"))
    rest = lambda c: F.substring(c, F.col("_k") + 1, F.length(c))
    shaped = pairs.withColumn("_k", k).withColumn("shape", F.concat(rest("source"), F.lit(">"), rest("target"))).drop("_k")
    return shaped.join(shaped.groupBy("shape").agg(F.count(F.lit(1)).alias("n")), "shape")


def orient_by_length(pairs: DataFrame) -> DataFrame:
    """Pairs with the longer word as the target, flagged where they were turned."""
    turn = F.length("source") > F.length("target")
    return pairs.select(F.when(turn, F.col("target")).otherwise(F.col("source")).alias("source"), F.when(turn, F.col("source")).otherwise(F.col("target")).alias("target"), turn.alias("turned"))


def missing_from_tree(nodes: DataFrame, placed: DataFrame, listed: DataFrame) -> DataFrame:
    """Listed derivations (``head``, ``member`` nodes) whose ends are in different trees: ``direct`` if the member is a root, else ``via`` its root."""
    side = lambda c: placed.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    both = listed.join(side("head"), "head").join(side("member"), "member").where("head_root <> member_root")
    return both.select("head", "member", F.when(F.col("member") == F.col("member_root"), "direct").otherwise("via").alias("proposal"), F.col("member_root").alias("top"))


def normalise_entries(entries: DataFrame) -> DataFrame:
    """Dictionary entries (``entry_id``, ``entry``) as words: ``x(y)z`` gives both forms, ``a/b`` both words, other signs go, of several words the first stays."""
    pattern = r"^([^()]*)\(([^()]*)\)([^()]*)$"
    optional = F.col("entry").rlike(pattern)
    group = lambda i: F.regexp_extract("entry", pattern, i)
    forms = F.when(optional, F.array(F.concat(group(1), group(3)), F.concat(group(1), group(2), group(3)))).otherwise(F.split("entry", "/"))
    cleaned = F.regexp_replace(F.split_part(F.trim(F.col("form")), F.lit(" "), F.lit(1)), r"[^\p{L}]", "")
    return entries.select("entry_id", F.explode(forms).alias("form")).select("entry_id", cleaned.alias("word")).where("word <> ''").distinct()


def pairs_from_markup(pages: DataFrame, patterns: DataFrame, title: Column) -> DataFrame:
    """Pairs (``title``, ``item``, ``kind``) of pages (``page_id``, ``html``) by a table of patterns (``kind``, ``pattern``, ``group_no``); items with spaces or hyphens are left out."""
    found = pages.select("page_id", "html", title.alias("title")).join(F.broadcast(patterns)).select("page_id", "title", "kind", F.explode(F.regexp_extract_all("html", F.col("pattern"), F.col("group_no"))).alias("item"))
    return found.where(~F.col("item").rlike(r"[\s-]") & (F.col("item") != "")).distinct()


def plausible_by_bigrams(pairs: DataFrame, vowels: str = "aeiouyáéíóúýäöüèêàâôîûëïœæ") -> DataFrame:
    """Pairs (``a``, ``b``) that share a pair of neighbouring consonants once vowels are left out."""
    bare = lambda c: F.translate(F.lower(c), vowels, "")
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 1, F.lit(1))), lambda i: F.substring(w, i, F.lit(2)))
    both = pairs.withColumn("_a", bare("a")).withColumn("_b", bare("b"))
    return both.where((F.length("_a") >= 2) & (F.length("_b") >= 2)).where(F.arrays_overlap(grams(F.col("_a")), grams(F.col("_b")))).drop("_a", "_b")


def triage_candidates(cands: DataFrame, endings: list[str]) -> DataFrame:
    """Ranked candidates (``target``, ``source``, ``rank``) by target: its ending, how many there are, the first, and whether that starts alike."""
    ending = F.lit("other")
    for e in reversed(endings):
        ending = F.when(F.endswith("target", F.lit(e)), e).otherwise(ending)
    grouped = cands.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rank", "source")).alias("b"))
    return grouped.select("target", ending.alias("ending"), F.when(F.col("n") == 1, "one").otherwise("several").alias("kind"), F.col("b.source").alias("first"), (F.substring("target", 1, 1) == F.substring("b.source", 1, 1)).alias("alike"))


def group_permutations(groups: DataFrame) -> DataFrame:
    """Ordered pairs of members (``group_id``, ``word``) of one group with the same first letter."""
    left, right = groups.select("group_id", F.col("word").alias("a")), groups.select("group_id", F.col("word").alias("b"))
    return left.join(right, "group_id").where((F.col("a") != F.col("b")) & (F.substring("a", 1, 1) == F.substring("b", 1, 1))).select("group_id", "a", "b").distinct()
