"""Registered queries for pipelines and their history."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from wordgrove.operators import edits as ed
from wordgrove.plans import pipeline as op
from wordgrove.plans.bindings import F2_SQL, F_SQL, forest, forest2
from wordgrove.plans.registry import query


def network_of(f):
    """The forest as a network: a derivation from every parent."""
    relations = f.where("parent IS NOT NULL").select(F.col("node").alias("target"), F.lit(0).alias("ord"), F.lit("Derivation").alias("type"), F.col("parent").alias("main"), F.array("parent").alias("sources"))
    return op.Network(f.select("node", "lemma", "pos", "n"), relations)


def retype(network):
    """A step on relations: those between words of one part of speech become conversions."""
    side = lambda c: network.nodes.select(F.col("node").alias(c), F.col("pos").alias(f"_{c}"))
    both = network.relations.join(side("target"), "target").join(side("main"), "main", "left")
    kind = F.when(F.col("_target") == F.col("_main"), "Conversion").otherwise(F.col("type"))
    return replace(network, relations=both.select("target", "ord", kind.alias("type"), "main", "sources"))


def drop_small(network):
    """A step on nodes: those of size 3 go, whether they have a parent or not, and their children become roots."""
    left, _ = ed.delete_nodes(network.edges, network.nodes.where("n = 3"))
    kept = op.Network(network.nodes.where("n <> 3"), network.relations.join(network.nodes.where("n = 3").select(F.col("node").alias("target")), "target", "left_anti"))
    return kept.with_edges(left)


def made(spark, sf_dir):
    f = forest(spark, sf_dir)
    replaced = forest2(spark, sf_dir).where("parent IS NOT NULL AND n % 5 = 0").select(F.col("node").alias("line"), "parent", "node")
    free = f.where("node > 0").select(F.col("node").alias("line"), F.floor(F.col("node") / 5).cast("long").alias("parent"), "node")
    steps = [
        ("replace", op.on_edges(lambda e: ed.replace_parent(e, replaced))),
        ("fill", op.on_edges(lambda e: ed.fill_parent(e, free))),
        ("detach", op.on_edges(lambda e: ed.detach(e, f.where("n = 8"), "parents"))),
        ("drop", drop_small),
        ("retype", retype),
    ]
    return op.run(network_of(f), steps, version="1")


STEPS_SQL = f"""WITH {F_SQL}, {F2_SQL}, a AS (SELECT f.node, f.n, f.pos, f.parent AS p0, CASE WHEN f2.parent IS NOT NULL AND f2.n % 5 = 0 THEN f2.parent ELSE f.parent END AS p1 FROM f LEFT JOIN f2 ON f2.node = f.node),
b AS (SELECT *, CASE WHEN p1 IS NULL AND node > 0 THEN node // 5 ELSE p1 END AS p2 FROM a), d AS (SELECT *, CASE WHEN n = 8 THEN NULL ELSE p2 END AS p3 FROM b),
g AS (SELECT d.*, CASE WHEN q.n = 3 THEN NULL ELSE d.p3 END AS p4 FROM d LEFT JOIN f q ON q.node = d.p3),
ev AS (SELECT node, 'replace' AS creator, p0 AS o, p1 AS w, '' AS kind FROM g WHERE p0 IS DISTINCT FROM p1 UNION ALL SELECT node, 'fill', p1, p2, '' FROM g WHERE p1 IS DISTINCT FROM p2 UNION ALL SELECT node, 'detach', p2, p3, '' FROM g WHERE p2 IS DISTINCT FROM p3
  UNION ALL SELECT node, 'drop', p3, NULL, 'deleted' FROM g WHERE n = 3 UNION ALL SELECT node, 'drop', p3, p4, '' FROM g WHERE n <> 3 AND p3 IS DISTINCT FROM p4),
h AS (SELECT node, creator, o, w, CASE WHEN kind <> '' THEN kind WHEN o IS NULL THEN 'connected' WHEN w IS NULL THEN 'detached' ELSE 'moved' END AS change FROM ev)"""


@query("u01_run", STEPS_SQL + " SELECT node, p4 AS parent FROM g WHERE n <> 3")
def u01(spark, sf_dir):
    return made(spark, sf_dir).network.edges


@query("u02_own_step", STEPS_SQL + " SELECT g.node AS target, g.p4 AS main, CASE WHEN q.pos = g.pos THEN 'Conversion' ELSE 'Derivation' END AS type FROM g LEFT JOIN f q ON q.node = g.p4 WHERE g.n <> 3 AND g.p4 IS NOT NULL")
def u02(spark, sf_dir):
    """Relations after steps of a user's own, on nodes and on relations."""
    return made(spark, sf_dir).network.relations.select("target", "main", "type")


@query("u03_history", STEPS_SQL + " SELECT node, creator, '' AS args, '1' AS version, change, o AS old_parent, w AS new_parent FROM h")
def u03(spark, sf_dir):
    return made(spark, sf_dir).history


@query("u04_productivity", STEPS_SQL + " SELECT creator, count(*) FILTER (WHERE change = 'connected') AS connected, count(*) FILTER (WHERE change = 'moved') AS moved, count(*) FILTER (WHERE change = 'detached') AS detached, count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'deleted') AS deleted FROM h GROUP BY creator")
def u04(spark, sf_dir):
    return op.productivity(made(spark, sf_dir).history)
