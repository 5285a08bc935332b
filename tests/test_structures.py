"""Root spans, patterns, endings and line numbers against plain versions."""

import random

import pytest

from wordgrove.operators import candidates as ca
from wordgrove.operators import morphs as mo
from wordgrove.sources import files


def carried(parent, lemma, seeds, stops, allomorphs):
    """A node after its parent, as the rule says."""
    found = {}
    for node in sorted(parent):
        up = parent[node]
        if node in stops or (up is not None and found.get(up, "cut") == "cut"):
            found[node] = "cut"
            continue
        held = [a for a in allomorphs if a in lemma[node]]
        match = (lemma[node].index(held[0]), lemma[node].index(held[0]) + len(held[0]), "allomorph") if len(held) == 1 else None
        if node in seeds:
            found[node] = (*seeds[node], "own")
        elif up is not None and found[up] and lemma[node].startswith(lemma[up][: found[up][1]]):
            found[node] = (*found[up][:2], "parent")
        else:
            found[node] = match
    return {n: v for n, v in found.items() if v and v != "cut"}


@pytest.mark.parametrize("seed", range(3))
def test_root_spans(spark, seed):
    draw = random.Random(seed)
    parent = {n: None if n < 2 else draw.randrange(max(0, n - 3), n) for n in range(80)}
    lemma = {n: "".join(draw.choices("ab", weights=(5, 1), k=draw.randrange(3, 9))) for n in parent}
    seeds = {n: (0, draw.randrange(1, len(lemma[n]) + 1)) for n in draw.sample(range(80), 12)}
    stops = set(draw.sample(range(40, 80), 5))
    allomorphs = ["ba", "bb"]
    nodes = spark.createDataFrame([(n, parent[n], lemma[n]) for n in parent], "node long, parent long, lemma string")
    found = mo.project_roots(nodes, spark.createDataFrame([(n, *v) for n, v in seeds.items()], "node long, start int, end int"), spark.createDataFrame([(n,) for n in stops], "node long"), spark.createDataFrame([(a,) for a in allomorphs], "allomorph string"))
    assert {r.node: (r.start, r.end, r.how) for r in found.collect()} == carried(parent, lemma, seeds, stops, allomorphs)


def test_patterns_in_several_automata_and_cut_up(spark, monkeypatch):
    words = spark.createDataFrame([(1, "abcabc"), (2, "bca"), (3, ""), (4, None), (5, "čač")], "lex_id long, lemma string")
    patterns = spark.createDataFrame([("abc",), ("b",), ("ca",), ("č",), ("",)], "allomorph string")
    places = lambda: sorted((r.lex_id, r.start, r.size, r.allomorph) for r in mo._occurrences(words, "lex_id", patterns).collect())
    want = [(1, 0, 3, "abc"), (1, 1, 1, "b"), (1, 2, 2, "ca"), (1, 3, 3, "abc"), (1, 4, 1, "b"), (2, 0, 1, "b"), (2, 1, 2, "ca"), (5, 0, 1, "č"), (5, 2, 1, "č")]
    assert places() == want
    monkeypatch.setattr(mo, "PATTERN_CHARACTERS", 2)
    assert places() == want
    monkeypatch.setattr(mo, "MOST_AUTOMATA", 0)
    assert places() == want


def grouped(words, most, least):
    left, found = set(words), set()
    for k in range(most, least - 1, -1):
        by = {}
        for w in left:
            if len(w) >= k:
                by.setdefault(w[-k:], []).append(w)
        for suffix, members in by.items():
            if len(members) > 1:
                found |= {(suffix, w) for w in members}
                left -= set(members)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_endings(spark, seed):
    draw = random.Random(seed)
    words = {"".join(draw.choices("abč", k=draw.randrange(1, 9))) for _ in range(300)} | {"aaaa" + "b" * k for k in range(6)}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "lemma string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(3 + 9 * seed))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [tuple(r) for r in ca.group_by_suffix(df, 6, 2).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == len(set(rows)) and set(rows) == grouped(words, 6, 2)


def test_no_words_have_no_endings(spark):
    assert ca.group_by_suffix(spark.createDataFrame([], "lemma string")).collect() == []


def test_lines_of_a_file_in_many_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{k}\n" for k in range(1, 3001)))
    (tmp_path / "b.txt").write_text("1\n2\n3")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = files.read_lines(spark, str(tmp_path))
        assert lines.count() == 3003 and lines.where("line_no <> cast(value AS bigint)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_are_numbered_in_each_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("word: one\npos: N\nword: two\npos: V\n")
    (tmp_path / "b.txt").write_text("odd: left out\nword: three\npos: A\n")
    found = files.read_records(spark, str(tmp_path))
    assert sorted((r.word, r.record, r.fields["pos"]) for r in found.collect()) == [("one", 1, "N"), ("three", 1, "A"), ("two", 2, "V")]
