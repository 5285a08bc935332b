"""Trees that are deep or wide, against plain walks; nothing is cut or left out."""

import random

import pytest

from wordgrove.operators import forest as fo
from wordgrove.sources import files as fl


@pytest.fixture(scope="module")
def trees():
    draw = random.Random(1)
    parent = {i: None if i % 40 == 0 else draw.randrange(max(0, i - 6), i) for i in range(160)}
    parent |= {1000 + i: 1000 + i - 1 if i else None for i in range(400)}
    return parent | {2000 + i: 2000 if i else None for i in range(60)}


@pytest.fixture(scope="module")
def edges(spark, trees):
    return spark.createDataFrame([(n, p, n % 7) for n, p in trees.items()], "node long, parent long, n long")


def plain(trees):
    kids = {n: sorted((c for c, p in trees.items() if p == n), key=lambda c: (c % 7, c)) for n in trees}
    order, sizes, tops = {}, {}, {}

    def walk(top):
        stack, out = [top], []
        while stack:
            n = stack.pop()
            out.append(n)
            stack.extend(reversed(kids[n]))
        return out

    for t, top in enumerate(sorted((n for n, p in trees.items() if p is None), key=lambda n: (n % 7, n))):
        for i, n in enumerate(walk(top)):
            order[n] = (t, i)
    for n in trees:
        below = walk(n)
        sizes[n], tops[n] = len(below), (sum(x % 7 for x in below), max(x % 7 for x in below))
    return order, sizes, tops


def test_numbers_and_sums(spark, trees, edges):
    order, sizes, tops = plain(trees)
    assert {r.node: (r.tree, r.pos) for r in fo.dfs_ids(edges, ["n"]).collect()} == order
    values = edges.selectExpr("node", "1L AS size", "n AS total", "n AS top")
    found = fo.subtree_agg(edges, values, sums=("size", "total"), maxima=("top",), height="height").collect()
    assert {r.node: (r.size, (r.total, r.top)) for r in found} == {n: (sizes[n], tops[n]) for n in trees}
    assert {r.node: r.height for r in found}[1000] == 399 and {r.node: r.height for r in fo.heights(edges).collect()}[2000] == 2
    lines = [r.text for r in fo.render_trees(edges, "node", ["n"]).where("tree = 0").orderBy("line_no").collect()]
    assert len(lines) == sizes[next(n for n, x in order.items() if x == (0, 0))]


def test_below_and_propagate(spark, trees, edges):
    seeds = {5, 1100, 2003}
    under = {n for n in trees if any(a in seeds for a in path(trees, n))}
    assert {r.node for r in fo.below(edges, spark.createDataFrame([(s,) for s in seeds], "node long")).collect()} == under
    notes = spark.createDataFrame([(1000, "x"), (2000, "y"), (2005, "a")], "node long, value string")
    gate = edges.selectExpr("node", "node <> 1200 AS open")
    found = {r.node: r.value for r in fo.propagate(edges, notes, gate).collect()}
    assert found == {**{1000 + i: "x" for i in range(200)}, **{2000 + i: "y" for i in range(60)}}


def path(trees, n):
    while n is not None:
        yield n
        n = trees[n]


def test_nodes_on_cycles_are_left_out(spark):
    rows = spark.createDataFrame([(1, None), (2, 1), (3, 4), (4, 3), (5, 4), (6, 99)], "node long, parent long")
    assert {(r.node, r.size) for r in fo.subtree_agg(rows, rows.selectExpr("node", "1L AS size"), sums=("size",)).collect()} == {(1, 2), (2, 1), (6, 1)}
    assert {r.node for r in fo.below(rows, rows.where("node IN (1, 4)")).collect()} == {1, 2}


def test_deep_chain_is_written_and_read_back_whole(spark, tmp_path):
    lexemes = spark.range(1000).selectExpr("cast(id AS string) AS lex_id", "id AS seq", "concat('w', id, '#N') AS lemid", "concat('w', id) AS lemma", "'N' AS pos", "map() :: map<string,string> AS feats", "cast(array() AS array<struct<start:int,end:int,morph:string,type:string>>) AS morphs", "'{}' AS misc")
    relations = spark.range(1, 1000).selectExpr("'Derivation' AS type", "cast(id - 1 AS string) AS main_source", "array(cast(id - 1 AS string)) AS sources", "cast(id AS string) AS target", "0 AS ord", "map() :: map<string,string> AS feats")
    fl.write_network_v2(lexemes, relations, str(tmp_path / "deep"))
    again = fl.read_network_v2(spark, str(tmp_path / "deep"))
    assert {r.lex_id: r.lemma for r in again.lexemes.collect()} == {f"0.{i}": f"w{i}" for i in range(1000)}
    assert {(r.main_source, r.target) for r in again.relations.collect()} == {(f"0.{i - 1}", f"0.{i}") for i in range(1, 1000)}
