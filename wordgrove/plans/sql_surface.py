"""Operators in SQL: table functions, views of a network, and pipeline steps written in SQL.

``register_functions(spark)`` gives a session two table functions.  Each takes a
table dealt by a key, works through a partition's Arrow batches as they come, and
gives Arrow tables of bounded size:

``subtree(TABLE(e) PARTITION BY root ORDER BY depth)``
    ``e`` has ``node``, ``parent`` and, to deal and order by, ``root`` and
    ``depth`` (the view ``places`` has them).  Gives ``ancestor``, ``node`` and
    ``dist`` of all pairs of a tree, each node with itself included.
``suffix_candidates(TABLE(k) PARTITION BY ending, pos ORDER BY rule NULLS LAST)``
    ``k`` has rows of rules (``rule``, ``from_suffix``, ``from_pos``) and rows of
    words cut by endings (``lemma``, ``stem``), both with ``ending`` and ``pos``
    (the view ``rule_keys`` has them).  Gives ``target``, ``source``, ``from_pos``
    and ``rule``; whether the source is a word is for a join to tell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgrove.operators.candidates import endings
from wordgrove.operators.forest import depths
from wordgrove.plans.pipeline import Network

#: Rows of one Arrow table that a function gives.
ROWS_AT_A_TIME = 1 << 16


def _tables(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.Table]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_AT_A_TIME:
            yield _table(held, names, kinds)
            held.clear()
    if held:
        yield _table(held, names, kinds)


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)


class Subtree:
    """Pairs of ancestors and nodes of one tree, whose parents come before their children."""

    def __init__(self) -> None:
        self.parent: dict[int, int | None] = {}

    def _pairs(self, nodes: list, parents: list) -> Iterator[tuple[int, int, int]]:
        for node, parent in zip(nodes, parents):
            self.parent[node] = parent
            at, dist = node, 0
            while at is not None:
                yield at, node, dist
                at, dist = self.parent.get(at), dist + 1

    def eval(self, table: pa.RecordBatch) -> Iterator[pa.Table]:
        pairs = self._pairs(table.column("node").to_pylist(), table.column("parent").to_pylist())
        yield from _tables(pairs, ["ancestor", "node", "dist"], [pa.int64()] * 3)


class SuffixCandidates:
    """What the rules of one ending make of the words that have it; rules come before words."""

    def __init__(self) -> None:
        self.rules: list[tuple[str, str, str]] = []

    def _made(self, table: pa.RecordBatch) -> Iterator[tuple[str, str, str, str]]:
        columns = [table.column(c).to_pylist() for c in ("rule", "from_suffix", "from_pos", "lemma", "stem")]
        for rule, suffix, pos, lemma, stem in zip(*columns):
            if rule is not None:
                self.rules.append((rule, suffix, pos))
                continue
            for name, from_suffix, from_pos in self.rules:
                if stem + from_suffix != lemma:
                    yield lemma, stem + from_suffix, from_pos, name

    def eval(self, table: pa.RecordBatch) -> Iterator[pa.Table]:
        yield from _tables(self._made(table), ["target", "source", "from_pos", "rule"], [pa.string()] * 4)


def register_functions(spark: SparkSession) -> None:
    """Makes the table functions known to a session's SQL."""
    spark.udtf.register("subtree", F.arrow_udtf(Subtree, returnType="ancestor long, node long, dist long"))
    spark.udtf.register("suffix_candidates", F.arrow_udtf(SuffixCandidates, returnType="target string, source string, from_pos string, rule string"))


def rule_keys(words: DataFrame, rules: DataFrame) -> DataFrame:
    """Words (``lemma``, ``pos``) cut by the endings that rules have, and the rules themselves, under ``ending`` and ``pos``."""
    sized = rules.select(F.col("to_suffix").alias("_ending"), F.col("to_pos").alias("pos"), F.length("to_suffix").alias("_size")).distinct()
    none = F.lit(None).cast("string")
    cut = endings(words.select("lemma", "pos"), "lemma", sized).join(sized, ["_ending", "pos", "_size"], "left_semi")
    held = cut.select(F.col("_ending").alias("ending"), "pos", none.alias("rule"), none.alias("from_suffix"), none.alias("from_pos"), "lemma", F.col("_stem").alias("stem"))
    return held.unionByName(rules.select(F.col("to_suffix").alias("ending"), F.col("to_pos").alias("pos"), "rule", "from_suffix", "from_pos", none.alias("lemma"), none.alias("stem")))


def register_views(spark: SparkSession, network: Network, words: DataFrame | None = None, rules: DataFrame | None = None) -> None:
    """Temporary views ``nodes``, ``relations``, ``edges`` and ``places`` of a network; ``rule_keys`` where words and rules are given.

    ``places`` has the parent, root and depth of every node; nodes on or below a
    cycle are not in it.
    """
    network.nodes.createOrReplaceTempView("nodes")
    network.relations.createOrReplaceTempView("relations")
    network.edges.createOrReplaceTempView("edges")
    network.edges.join(depths(network.edges), "node").createOrReplaceTempView("places")
    if words is not None and rules is not None:
        rule_keys(words, rules).createOrReplaceTempView("rule_keys")


def sql_step(text: str) -> Callable[[Network], Network]:
    """A pipeline step in SQL, over ``{nodes}``, ``{relations}`` and ``{edges}``.

    What the query gives is told by its columns: ``node`` and ``parent`` alone are
    new parents, ``target`` and ``main`` are relations, other columns with ``node``
    are nodes.  Anything else is an error, as are nodes, parents or relations
    without the columns that the network had.
    """

    def step(network: Network) -> Network:
        found = network.nodes.sparkSession.sql(text, nodes=network.nodes, relations=network.relations, edges=network.edges)
        given = set(found.columns)
        if given == {"node", "parent"}:
            return network.with_edges(found)
        if {"target", "main"} <= given:
            return Network(network.nodes, found.select(*network.relations.columns))
        if "node" in given:
            return Network(found.select(*network.nodes.columns), network.relations)
        raise ValueError(f"a step gives parents, relations or nodes, not {sorted(given)}")

    return step
