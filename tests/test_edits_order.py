"""Edits that depend on the order of lines, against plain versions that take one line after another."""

import random
import time

import pytest

from wordgrove.operators import edits as ed
from wordgrove.operators import forest as fo
from wordgrove.operators.linkcut import LinkCut

EDGES = "node long, parent long"


def forest(draw, n, roots=3):
    return {i: None if i < roots else draw.randrange(max(0, i - 6), i) for i in range(n)}


def above(parent, upper, lower):
    while lower is not None and lower != upper:
        lower = parent.get(lower)
    return lower == upper


def as_dict(df):
    return {r.node: r.parent for r in df.collect()}


def test_link_cut_trees():
    draw, n = random.Random(2), 60
    trees, parent = LinkCut(n), dict.fromkeys(range(n))
    for _ in range(4000):
        a, b = draw.randrange(n), draw.randrange(n)
        assert trees.is_above(a, b) == above(parent, a, b)
        if parent[a] is None and not above(parent, a, b):
            trees.link(a, b)
            parent[a] = b
        elif draw.random() < 0.5:
            trees.cut(a)
            parent[a] = None
    added = trees.add()
    trees.link(added, 0)
    assert trees.is_above(0, added) and not trees.is_above(added, 0)


def turned(parent, lines):
    parent = dict(parent)
    for _, up, node in sorted(lines):
        if node != up and parent.get(node) == up:
            parent[node], parent[up] = parent[up], node
    return parent


@pytest.mark.parametrize("seed", range(2))
def test_turns(spark, seed):
    draw = random.Random(seed)
    parent = forest(draw, 60)
    pairs = [(parent[n], n) for n in parent if parent[n] is not None]
    lines = [(k, *draw.choice(pairs)) for k in range(40)] + [(k + 40, b, a) for k, (a, b) in enumerate(draw.sample(pairs, 15))]
    found = as_dict(ed.reverse_edges(spark.createDataFrame(list(parent.items()), EDGES), spark.createDataFrame(lines, "line long, parent long, node long")))
    assert found == turned(parent, lines)


def test_turns_of_a_path_and_of_one_edge_twice(spark):
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, None), (5, 4)], EDGES)
    pairs = [(1, 1, 2), (2, 2, 3), (3, 4, 5), (4, 4, 5), (5, 9, 9), (6, 4, 3)]
    found = ed.reverse_edges(edges, spark.createDataFrame(pairs, "line long, parent long, node long"))
    assert as_dict(found) == {1: 2, 2: 3, 3: None, 4: 5, 5: None}
    assert found.count() == 5 and fo.find_cycles(found).count() == 0


def merged(parent, sets):
    """The steps of the description, on a whole forest; in the end children of variants are lifted."""
    parent, variant_of = dict(parent), {}
    for _, members in sorted(sets.items()):
        first, others = members[0], members[1:]
        for node in others:
            if node == first:
                continue
            if above(parent, node, first):
                parent[first] = None
                variant_of.pop(first, None)
            if above(parent, first, node):
                parent[node] = None
                variant_of.pop(node, None)
            if parent[node] is not None and parent[first] is None:
                parent[first] = parent[node]
            home = first
            while home in variant_of:
                home = variant_of[home]
            parent[node], variant_of[node] = home, first
            for child in [c for c, p in parent.items() if p == node]:
                parent[child] = home
    return parent


@pytest.mark.parametrize("seed", range(4))
def test_variants_in_order(spark, seed):
    draw = random.Random(seed)
    parent = forest(draw, 50, roots=4)
    sets = {k: draw.sample(range(50), draw.choice([2, 3, 4])) for k in range(5)}
    rows = [(k, n, i) for k, members in sets.items() for i, n in enumerate(members)]
    found = ed.merge_variants(spark.createDataFrame(list(parent.items()), EDGES), spark.createDataFrame(rows, "set_id long, node long, seq long"))
    assert as_dict(found) == merged(parent, sets)
    assert fo.find_cycles(found).count() == 0


def test_variant_below_its_representative(spark):
    names = {"R": 1, "X": 2, "V": 3, "K": 4}
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3)], EDGES)
    found = ed.merge_variants(edges, spark.createDataFrame([(1, names["R"], 0), (1, names["V"], 1)], "set_id long, node long, seq long"))
    assert as_dict(found) == {1: None, 2: 1, 3: 1, 4: 1}


def test_one_edit_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = [0]

    def counted(keep):
        def run(df):
            rounds[0] += 1
            return keep(df)

        return run

    for name in ("checkpointed", "written"):
        monkeypatch.setattr(fo, name, counted(getattr(fo, name)))
    edges = spark.createDataFrame([(n, n - 1 if n else None) for n in range(5000)] + [(9000, None)], EDGES)
    found = ed.replace_parent(edges, spark.createDataFrame([(1, 9000, 4000)], "line long, parent long, node long"))
    assert as_dict(found)[4000] == 9000 and rounds[0] < 20


def test_long_chain_of_edits_that_closes_a_ring(spark):
    n = 2000
    edges = spark.createDataFrame([(i, None) for i in range(n)], EDGES)
    lines = [(i, i - 1, i) for i in range(1, n)] + [(n, n - 1, 0)]
    found = as_dict(ed.fill_parent(edges, spark.createDataFrame(lines, "line long, parent long, node long")))
    assert found == {i: i - 1 if i else None for i in range(n)}


def test_replay_of_a_large_component():
    draw, n = random.Random(0), 100_000
    trees = LinkCut(n)
    began = time.perf_counter()
    for i in range(1, n):
        trees.link(i, i - 1)
    for _ in range(10_000):
        a, b = draw.randrange(n), draw.randrange(n)
        if trees.is_above(a, b):
            trees.cut(b)
        trees.cut(a)
        if a != b:
            trees.link(a, b)
    assert time.perf_counter() - began < 60


def test_signatures_and_cycles_of_long_chains(spark):
    n = 600
    edges = spark.createDataFrame([(i, i - 1 if i else None, "ab"[i % 2]) for i in range(n)], "node long, parent long, label string")
    want = "b"
    for i in range(n - 2, -1, -1):
        want = f"{'ab'[i % 2]}->({want})"
    assert [tuple(r) for r in fo.signatures(edges, "label").collect()] == [(0, want)]
    ring = [(i, (i + 1) % 50) for i in range(50)] + [(100, 3), (3, 101), (101, 102), (102, 7), (7, 500), (500, 501), (200, 201), (201, 202), (202, 202)]
    assert {r.node for r in fo.on_cycles(spark.createDataFrame(ring, EDGES)).collect()} == {*range(50), 101, 102, 202}


def test_reachability_over_many_ways(spark):
    layers = 30
    pairs = [((k, a), (k + 1, b)) for k in range(layers) for a in (0, 1) for b in (0, 1)]
    name = lambda x: 2 * x[0] + x[1]
    relations = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], "source long, target long")
    nodes = spark.range(2 * layers + 2).withColumnRenamed("id", "node")
    found = fo.has_ancestor(relations, nodes, nodes.where("node = 4"))
    assert {r.node for r in found.collect()} == set(range(6, 2 * layers + 2))
