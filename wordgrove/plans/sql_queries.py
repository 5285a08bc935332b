"""Registered queries written in SQL over table functions, views and steps of a user's own."""

from __future__ import annotations

from wordgrove.plans import pipeline, sql_surface
from wordgrove.plans.bindings import F_SQL, FOREST_SQL, W_SQL, forest, kept_words
from wordgrove.plans.candidate_queries import APPLY_SQL, RULES_SQL, rules
from wordgrove.plans.pipeline_queries import network_of
from wordgrove.plans.registry import query


def session(spark, sf_dir):
    sql_surface.register_functions(spark)
    sql_surface.register_views(spark, network_of(forest(spark, sf_dir)))
    return spark


@query("u02_subtree_sql", f"{FOREST_SQL} SELECT ancestor, node, dist FROM c")
def u02_subtree(spark, sf_dir):
    """T3 as a table function."""
    return session(spark, sf_dir).sql("SELECT ancestor, node, dist FROM subtree(TABLE(places) PARTITION BY root ORDER BY depth)")


@query("u02_subtree_sums_sql", f"{FOREST_SQL} SELECT c.ancestor AS node, count(*) AS size, sum(f.n)::BIGINT AS total FROM c JOIN f ON f.node = c.node GROUP BY c.ancestor HAVING count(*) > 1")
def u02_sums(spark, sf_dir):
    """Its result joined and grouped in the same statement."""
    return session(spark, sf_dir).sql(
        "SELECT s.ancestor AS node, count(*) AS size, sum(n.n) AS total FROM subtree(TABLE(places) PARTITION BY root ORDER BY depth) s JOIN nodes n ON n.node = s.node GROUP BY s.ancestor HAVING count(*) > 1"
    )


@query("u02_rules_sql", f"WITH {W_SQL}, {RULES_SQL}, {APPLY_SQL} SELECT source, target, rule FROM ap")
def u02_rules(spark, sf_dir):
    """C2 as a table function."""
    sql_surface.register_functions(spark)
    words = kept_words(spark, sf_dir)
    keys = sql_surface.rule_keys(words, rules(spark))
    return spark.sql(
        "SELECT c.source, c.target, c.rule FROM suffix_candidates(TABLE(SELECT * FROM {keys}) PARTITION BY (ending, pos) ORDER BY rule NULLS LAST) c LEFT SEMI JOIN {words} w ON w.lemma = c.source AND w.pos = c.from_pos",
        keys=keys,
        words=words,
    )


@query("u02_places_sql", f"{FOREST_SQL} SELECT r.depth, count(*) AS nodes, count(DISTINCT r.root) AS trees FROM r GROUP BY r.depth")
def u02_places(spark, sf_dir):
    """A view over an operator."""
    return session(spark, sf_dir).sql("SELECT depth, count(*) AS nodes, count(DISTINCT root) AS trees FROM places GROUP BY depth")


@query(
    "u02_sql_steps",
    f"WITH {F_SQL}, a AS (SELECT f.node, f.n, CASE WHEN p.n % 6 = 0 THEN p.parent ELSE f.parent END AS parent FROM f LEFT JOIN f p ON p.node = f.parent) "
    "SELECT node AS target, parent AS main, 'Derivation/' || (n % 2) AS type FROM a WHERE parent IS NOT NULL",
)
def u02_steps(spark, sf_dir):
    """A pipeline of two steps in SQL: children of some nodes lifted to their grandparents, and relations typed anew."""
    steps = [
        ("lift", sql_surface.sql_step("SELECT e.node, CASE WHEN p.n % 6 = 0 THEN g.parent ELSE e.parent END AS parent FROM {edges} e LEFT JOIN {nodes} p ON p.node = e.parent LEFT JOIN {edges} g ON g.node = e.parent")),
        ("type", sql_surface.sql_step("SELECT r.target, r.ord, concat(r.type, '/', n.n % 2) AS type, r.main, r.sources FROM {relations} r JOIN {nodes} n ON n.node = r.target")),
    ]
    return pipeline.run(network_of(forest(spark, sf_dir)), steps).network.relations.select("target", "main", "type")
