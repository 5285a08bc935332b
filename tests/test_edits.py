"""Edits that close cycles, against lines applied one by one; and small cases of other operators."""

import random

import pytest
from pyspark.sql import functions as F

from wordgrove.operators import edits as ed
from wordgrove.operators import forest as fo
from wordgrove.operators import morphs as mo
from wordgrove.operators import candidates as ca
from wordgrove.operators import resolve as rs
from wordgrove.operators import stats as st
from wordgrove.plans.pipeline import Network, log_changes, on_edges, run


def one_by_one(parent, edits, policy):
    parent = dict(parent)
    for _, up, node in edits:
        if policy == "fill" and parent[node] is not None:
            continue
        at, seen = up, set()
        while at is not None and at != node and at not in seen:
            seen.add(at)
            at = parent[at]
        if at == node:
            if policy == "fill" or up == node:
                continue
            parent[up] = None
        parent[node] = up
    return parent


@pytest.mark.parametrize("seed", range(3))
def test_replace_parent_with_cycles(spark, seed):
    draw = random.Random(seed)
    parent = {n: None if n % 5 == 0 else draw.randrange(n) for n in range(25)}
    edits = [(i, draw.randrange(25), n) for i, n in enumerate(draw.sample(range(25), 8))]
    edges = spark.createDataFrame(list(parent.items()), "node long, parent long")
    found = ed.replace_parent(edges, spark.createDataFrame(edits, "line long, parent long, node long"))
    assert {r.node: r.parent for r in found.collect()} == one_by_one(parent, edits, "replace")
    assert fo.find_cycles(found).count() == 0


def test_fill_parent_with_cycles(spark):
    draw = random.Random(5)
    parent = {n: None if n % 3 == 0 else draw.randrange(n) for n in range(25)}
    edits = [(i, draw.randrange(25), draw.randrange(25)) for i in range(25)]
    edges = spark.createDataFrame(list(parent.items()), "node long, parent long")
    found = ed.fill_parent(edges, spark.createDataFrame(edits, "line long, parent long, node long"))
    assert {r.node: r.parent for r in found.collect()} == one_by_one(parent, edits, "fill")


def test_fill_parent_leaves_cycles_out(spark):
    edges = spark.createDataFrame([(1, None), (2, 1), (3, None), (4, 3)], "node long, parent long")
    edits = [(1, 2, 1), (2, 4, 1), (3, 2, 3)]
    found = ed.fill_parent(edges, spark.createDataFrame(edits, "line long, parent long, node long"))
    assert fo.find_cycles(found).count() == 0
    assert {r.node: r.parent for r in found.collect()}[2] == 1


def test_roots_with_cycles_and_dangling_parents(spark):
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 4), (4, 3), (5, 4), (6, 99)], "node long, parent long")
    assert {(r.node, r.root) for r in fo.roots_of(edges).collect()} == {(1, 1), (2, 1)}
    assert {r.node for r in fo.find_cycles(edges).collect()} == {3, 4}


def test_render_and_signature(spark):
    edges = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 1, "c"), (4, 2, "d")], "node long, parent long, lemma string")
    lines = [r.text for r in fo.render_trees(edges, "lemma", ["lemma"]).orderBy("line_no").collect()]
    assert lines == ["a", "├─b", "│ └─d", "└─c"]
    assert fo.signatures(edges, "lemma").first().sig == "a->(b->(d),c)"


def test_connected(spark):
    pairs = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1), (8, 7)], "a long, b long")
    assert {(r.node, r.component) for r in fo.connected(pairs).collect()} == {(1, 1), (3, 1), (4, 1), (5, 1), (7, 7), (8, 7), (9, 7)}


def test_complete_morphs_issues(spark):
    lex = spark.createDataFrame([(1, "dogs"), (2, "cats"), (3, "owl")], "lex_id long, lemma string")
    morphs = spark.createDataFrame([(1, 0, 3, "dog", "Root"), (2, 0, 3, "cat", None), (2, 2, 4, "ts", None), (3, 1, 9, None, None)], "lex_id long, start int, end int, morph string, type string")
    good, issues = mo.complete_morphs(lex, morphs)
    assert sorted((r.lex_id, r.start, r.end, r.morph, r.type) for r in good.collect()) == [(1, 0, 3, "dog", "Root"), (1, 3, 4, "s", "Implicit")]
    assert {(r.lex_id, r.problem) for r in issues.collect()} == {(2, "overlap"), (3, "out of range")}


def test_merge_boundaries(spark):
    lex = spark.createDataFrame([(1, "dogs")], "lex_id long, lemma string")
    flags = spark.createDataFrame([(1, 3, True), (1, 3, True), (1, 2, True), (1, 2, False), (1, 9, True)], "lex_id long, place int, allowed boolean")
    kept, conflicts = mo.merge_boundaries(lex, flags)
    assert {(r.place, r.allowed) for r in kept.collect()} == {(3, True), (9, False)} and [r.place for r in conflicts.collect()] == [2]


def test_typed_and_labelled_morphs(spark):
    lex = spark.createDataFrame([(7, "undone", 1), (8, "undone", 2)], "lex_id long, lemma string, seq long")
    lines = spark.createDataFrame([(1, "undone", "un:un:P|done:do:R")], "line long, lemma string, segments string")
    assert [(r.lex_id, r.morph, r.type) for r in mo.morphs_from_typed(lex, lines, {"P": "Prefix", "R": "Root"}).orderBy("place").collect()] == [(7, "un", "Prefix"), (7, "done", "Root")]
    words = spark.createDataFrame([("Undone", "Un done", "P")], "word string, segments string, labels string")
    assert [(r.start, r.end, r.morph, r.type) for r in mo.morphs_from_labels(words).orderBy("start").collect()] == [(0, 2, "un", "P"), (2, 6, "done", None)]


def test_project_roots(spark):
    nodes = spark.createDataFrame([(1, None, "work"), (2, 1, "worker"), (3, 2, "coworker"), (4, 1, "wrought")], "node long, parent long, lemma string")
    seeds = spark.createDataFrame([(1, 0, 4)], "node long, start int, end int")
    stops, allomorphs = spark.createDataFrame([(4,)], "node long"), spark.createDataFrame([("work",)], "allomorph string")
    found = {r.node: (r.start, r.end, r.how) for r in mo.project_roots(nodes, seeds, stops, allomorphs).collect()}
    assert found == {1: (0, 4, "own"), 2: (0, 4, "parent"), 3: (2, 6, "allomorph")}


def test_parts_and_offsets(spark):
    row = spark.range(1).select(mo.morphs_from_parts(F.lit("undoings"), F.array(F.lit("un"), F.lit("do"), F.lit("s"))).alias("p")).first()
    assert row.p == ["un", "do", "ing", "s"]
    morph = lambda s, e, m: F.struct(F.lit(s).alias("start"), F.lit(e).alias("end"), F.lit(m).alias("morph"))
    bare = spark.range(1).select(mo.drop_offsets(F.array(morph(0, 2, "un"), morph(3, 5, "do"))).alias("m")).first().m
    assert [(m.start, m.end) for m in bare] == [(None, None), (3, 5)]


def small_network(spark):
    nodes = spark.createDataFrame([(1, "a"), (2, "b")], "node long, lemma string")
    relations = spark.createDataFrame([(2, 0, "Derivation", 1, [1])], "target long, ord int, type string, main long, sources array<long>")
    return Network(nodes, relations)


def test_run_keeps_going(spark):
    def fails(_):
        raise ValueError("no")

    def breaks(network):
        """Fails only when its job runs."""
        return Network(network.nodes.withColumn("x", F.raise_error(F.lit("late"))), network.relations)

    steps = [("fails", fails), ("breaks", breaks), ("detach", on_edges(lambda e: ed.detach(e, e.where("node = 2"), "parents")))]
    done = run(small_network(spark), steps, keep_going=True)
    assert done.failed == ("fails", "breaks") and {r.node: r.parent for r in done.network.edges.collect()} == {1: None, 2: None}
    with pytest.raises(ValueError, match="no"):
        run(small_network(spark), [("fails", fails)])


def test_deletions_and_additions_are_logged(spark):
    before = spark.createDataFrame([(1, None), (2, 1), (3, None), (4, 1)], "node long, parent long")
    after = spark.createDataFrame([(1, None), (4, None), (5, None), (6, 1)], "node long, parent long")
    log = {(r.node, r.change, r.old_parent, r.new_parent) for r in log_changes(before, after, "c", "1").collect()}
    assert log == {(2, "deleted", 1, None), (3, "deleted", None, None), (4, "detached", 1, None), (5, "added", None, None), (6, "added", None, 1)}


def test_brackets_with_unknown_words(spark):
    lines = spark.createDataFrame([(1, "a ( b ( x ) c ( d ) )"), (2, "u ( v w ( z ) ) q")], "line long, value string")
    known = spark.createDataFrame([(x,) for x in "abdxvzq"], "lemma string")
    show = lambda df: {(r.line, r.lemma): r.parent_lemma for r in df.collect()}
    assert show(ed.edges_from_brackets(lines)) == {(1, "a"): None, (1, "b"): "a", (1, "x"): "b", (1, "c"): "a", (1, "d"): "c", (2, "u"): None, (2, "v"): "u", (2, "w"): "u", (2, "z"): "w", (2, "q"): None}
    assert show(ed.edges_from_brackets(lines, known)) == {(1, "a"): None, (1, "b"): "a", (1, "x"): "b", (1, "d"): "a", (2, "v"): None, (2, "z"): None, (2, "q"): None}
    assert show(ed.edges_from_brackets(lines, known, bridge=False)) == {(1, "a"): None, (1, "b"): "a", (1, "x"): "b", (1, "d"): None, (2, "v"): None, (2, "z"): None, (2, "q"): None}


def test_append_relations_only_skips_the_main_one(spark):
    relations = spark.createDataFrame([(1, 9, "D", 0), (2, 9, "D", 1)], "source long, target long, type string, ord int")
    edits = spark.createDataFrame([(1, 1, 9, "D"), (2, 2, 9, "D"), (3, 1, 9, "C"), (4, 5, 8, "D"), (5, 5, 8, "D"), (6, 6, 8, "D")], "line long, source long, target long, type string")
    found = sorted((r.target, r.ord, r.source, r.type) for r in ed.append_relations(relations, edits).collect())
    assert found == [(8, 0, 5, "D"), (8, 1, 6, "D"), (9, 0, 1, "D"), (9, 1, 2, "D"), (9, 2, 2, "D"), (9, 3, 1, "C")]


def test_labelled_variants(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, None), (4, 3), (5, None), (6, 5), (7, 6)], "node long, parent long")
    sets = spark.createDataFrame([(1, 1, 0), (1, 3, 1), (2, 6, 0), (2, 7, 1)], "set_id long, node long, seq long")
    found = {r.node: (r.parent, r.label) for r in ed.merge_labelled_variants(edges, sets).collect()}
    assert found == {1: (None, None), 2: (1, None), 3: (1, "Variant"), 4: (1, None), 5: (None, None), 6: (5, None), 7: (6, "Variant")}


def test_lift_marks_stops_at_held_words(spark):
    rows = [(1, None, "work"), (2, 1, "homework"), (3, 2, "homeworker"), (4, None, "x"), (5, 4, "abc"), (6, 5, "zz")]
    edges = spark.createDataFrame(rows, "node long, parent long, lemma string")
    marks = spark.createDataFrame([(3,), (6,), (5,)], "node long")
    found = {r.node: (r.moved_to, r.dropped, r.held_by) for r in fo.lift_marks(edges, marks, "lemma").collect()}
    assert found == {3: (3, False, 2), 6: (None, True, None), 5: (4, False, None)}
    assert {r.node: r.moved_to for r in fo.lift_marks(edges, marks).collect()} == {3: 1, 6: None, 5: 4}


def test_masks_and_percentiles_of_null(spark):
    forms = spark.createDataFrame([(None, "ab", 1), (None, "ac", 2), ("k", "abc", 4), ("k", None, 1), ("m", None, 3)], "key string, tag string, n long")
    assert {(r.key, r.mask, r.n) for r in st.tag_masks(forms, ["key"]).collect()} == {(None, "a?", 3), ("k", "abc", 5), ("m", "", 3)}
    values = spark.createDataFrame([(0,), (2,), (2,), (5,), (None,)], "v long")
    assert sorted((str(r.v), r.percentile) for r in st.tie_percentile(values, "v").collect()) == sorted([("0", 0.0), ("2", 25.0), ("2", 25.0), ("5", 75.0), ("None", None)], key=lambda x: x[0])


def test_overlaps_of_a_hot_element(spark, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_SETS", 4)
    rows = [(i, "hot") for i in range(30)] + [(i, f"e{i // 2}") for i in range(30)]
    found = {(r.a, r.b): r.shared for r in rs.overlap_pairs(spark.createDataFrame(rows, "set_id long, element string")).collect()}
    assert found == {(a, b): 1 + (a // 2 == b // 2) for a in range(30) for b in range(a + 1, 30)}


def test_overlaps_are_counted_by_as_many_tasks_as_pairs_call_for(spark, monkeypatch):
    monkeypatch.setattr(rs, "OVERLAP_ROWS", 100)
    rows = [(i, "hot") for i in range(60)] + [(7, "hot"), (7, None), (8, None)]
    pairs = rs.overlap_pairs(spark.createDataFrame(rows, "set_id long, element string"))
    assert pairs.count() == 60 * 59 // 2 and pairs.where("shared = 1").count() == 60 * 59 // 2
    # the number of shuffle partitions, 4 here, doesn't bound it
    assert pairs.rdd.getNumPartitions() >= 60 * 59 // 2 // 100


def test_mined_rules_over_block_ends(spark, monkeypatch):
    monkeypatch.setattr(ca, "BLOCK_WORDS", 7)
    draw = random.Random(3)
    words = sorted({"ab" + "".join(draw.choice("xyz") for _ in range(draw.randint(0, 4))) for _ in range(60)})
    wanted = {}
    for i, w in enumerate(words):
        for v in words[max(0, i - 6) : i]:
            k = max(j for j in range(min(len(v), len(w)) + 1) if v[:j] == w[:j])
            wanted[v[k:], w[k:]] = wanted.get((v[k:], w[k:]), 0) + 1
    found = ca.mine_suffix_rules(spark.createDataFrame([(w, "p") for w in words], "lemma string, pos string")).collect()
    assert {(r.from_suffix, r.to_suffix): r.n for r in found} == wanted


def test_rule_flags(spark):
    words = spark.createDataFrame([("read", "V"), ("reader", "N"), ("Prague", "N"), ("praguer", "N")], "lemma string, pos string")
    rules = spark.createDataFrame([("r1", "", "V", "er", "N"), ("r2", "e", "N", "er", "N")], "rule string, from_suffix string, from_pos string, to_suffix string, to_pos string")
    edges = spark.createDataFrame([("read", "reader")], "source string, target string")
    found = {(r.source, r.target, r.capitalised, r.linked) for r in ca.apply_suffix_rules(words, rules, edges=edges, capitalised=True).collect()}
    assert found == {("read", "reader", False, True), ("Prague", "praguer", True, False)}


def test_suffix_code_parents(spark):
    rows = [(1, 1, "work", "work-1"), (2, 2, "work", "work-2"), (3, 3, "worker", "worker-2_^(*4)"), (4, 4, "walker", "walker_^(*2)"), (5, 5, "walk", "walk"), (6, 6, "xii", "xii_^(^GC**dozen)"), (7, 7, "dozen", "dozen"), (8, 8, "self", "self-1_^(*2)")]
    lexemes = spark.createDataFrame(rows, "node long, seq long, lemma string, techlemma string")
    found = {r.node: r.parent for r in ed.parents_from_suffix_codes(lexemes, lexemes.select("node", F.lit(None).cast("long").alias("parent"))).collect()}
    assert {k: v for k, v in found.items() if v} == {3: 2, 4: 5, 6: 7}


def test_stream_word_counts(spark, tmp_path):
    from wordgrove.streaming.counts import stream_word_counts

    df = spark.createDataFrame([("en", "a b a"), ("de", "b")], "lang string, text string")
    df.write.parquet(str(tmp_path / "in"))
    query = stream_word_counts(spark, str(tmp_path / "in"), df.schema).writeStream.outputMode("complete").format("memory").queryName("wordgrove_counts").start()
    query.processAllAvailable()
    query.stop()
    assert {(r.lemma, r.lang, r.n) for r in spark.table("wordgrove_counts").collect()} == {("a", "en", 2), ("b", "en", 1), ("b", "de", 1)}
