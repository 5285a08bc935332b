"""Table functions, views and steps in SQL."""

import pytest

from wordgrove.operators import forest as fo
from wordgrove.plans import pipeline, sql_surface


def network(spark):
    nodes = spark.createDataFrame([(n, f"w{n}") for n in range(1, 8)], "node long, lemma string")
    up = {2: 1, 3: 1, 4: 2, 5: 4, 7: 6}
    relations = spark.createDataFrame([(n, 0, "Derivation", p, [p]) for n, p in up.items()], "target long, ord int, type string, main long, sources array<long>")
    return pipeline.Network(nodes, relations)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_subtree_equals_closure(spark):
    sql_surface.register_functions(spark)
    held = network(spark)
    sql_surface.register_views(spark, held)
    found = spark.sql("SELECT node, ancestor, dist FROM subtree(TABLE(places) PARTITION BY root ORDER BY depth)")
    assert rows(found) == rows(fo.closure(held.edges).select("node", "ancestor", "dist"))


def test_subtree_of_a_long_chain_comes_in_bounded_tables(spark, monkeypatch):
    monkeypatch.setattr(sql_surface, "ROWS_AT_A_TIME", 100)
    import pyarrow as pa

    made = list(sql_surface.Subtree().eval(pa.record_batch({"node": list(range(60)), "parent": [None, *range(59)]})))
    assert sum(t.num_rows for t in made) == 60 * 61 // 2 and max(t.num_rows for t in made) == 100


def test_suffix_candidates(spark):
    sql_surface.register_functions(spark)
    words = spark.createDataFrame([("walker", "N"), ("walk", "V"), ("er", "N"), ("talker", "N")], "lemma string, pos string")
    rules = spark.createDataFrame([("r", "", "V", "er", "N"), ("same", "er", "N", "er", "N")], "rule string, from_suffix string, from_pos string, to_suffix string, to_pos string")
    keys = sql_surface.rule_keys(words, rules)
    found = spark.sql("SELECT * FROM suffix_candidates(TABLE(SELECT * FROM {keys}) PARTITION BY (ending, pos) ORDER BY rule NULLS LAST)", keys=keys)
    assert rows(found.select("source", "target", "rule")) == [("talk", "talker", "r"), ("walk", "walker", "r")]


def test_steps(spark):
    lifted = sql_surface.sql_step("SELECT e.node, CASE WHEN e.node = 5 THEN 2 ELSE e.parent END AS parent FROM {edges} e")
    fewer = sql_surface.sql_step("SELECT * FROM {nodes} WHERE node <> 3")
    typed = sql_surface.sql_step("SELECT target, ord, upper(type) AS type, main, sources FROM {relations}")
    out = pipeline.run(network(spark), [("lift", lifted), ("fewer", fewer), ("typed", typed)]).network
    assert {(r.target, r.main, r.type) for r in out.relations.where("target IN (4, 5)").collect()} == {(4, 2, "DERIVATION"), (5, 2, "DERIVATION")}
    assert out.nodes.count() == 6


def test_a_step_of_other_columns_is_an_error(spark):
    with pytest.raises(ValueError):
        pipeline.run(network(spark), [("odd", sql_surface.sql_step("SELECT count(*) AS n FROM {nodes}"))])
