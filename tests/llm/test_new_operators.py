"""Hard negatives, window dedup and whitening against plain versions; many licence lines in one text."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordgrove.llm import catalogue, licences
from wordgrove.llm import hard_negatives as hn
from wordgrove.llm import whitening as wh
from wordgrove.llm import window_dedup as wd

VECTORS = "vec_id long, embedding array<float>, label int"


# --- hard negatives --------------------------------------------------------------------------------------------------


def plain_mined(rows):
    usable = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        moved = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        usable.append((vec_id, moved, [math.floor(256 * float(np.float32(x))) for x in vector]))
    order = lambda hit: (-hit[0], hit[1] is None, hit[1] or 0)
    out = []
    for a, (anchor, label, x) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        scores = [(sum(p * q for p, q in zip(x, y)), vec_id, other == label, b != a) for b, (vec_id, other, y) in enumerate(usable)]
        for ps, positive, *_ in sorted((s for s in scores if s[2] and s[3]), key=order)[:5]:
            inside = [s for s in scores if not s[2] and 30 * ps <= 100 * s[0] <= 90 * ps]
            out += [(anchor, positive, rank, vec_id, ps, s) for rank, (s, vec_id, *_) in enumerate(sorted(inside, key=order)[:10], 1)]
    return sorted(out, key=str)


def mined(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


def vectors(seed, n, dim=12):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0.1, 0.3) for _ in range(dim)], draw.randrange(3)) for i in range(n)]


def test_hard_negatives_with_odd_rows(spark):
    rows = vectors(1, 260)
    same = rows[3][1]
    rows += [(1000 + i, same, i % 2) for i in range(40)] + [rows[100], rows[100], (None, rows[5][1], 1), (None, rows[6][1], 0)]
    rows += [(300, None, 1), (400, [None] * 12, 1), (500, [float("nan")] * 12, 1), (600, [float("inf")] * 12, 1), (700, [0.0] * 12, 1), (800, rows[8][1], None), (900, [0.5] * 4, 2), (1100, [], 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("rank", F.lit("x")).withColumn("score", F.lit(1))
    assert mined(hn.mine(df)) == plain_mined(rows)


def test_hard_negatives_by_thresholds_and_blocks(spark, monkeypatch):
    for name, value in (("FIRST_HITS", 3), ("LABELS", 10), ("MORE_HITS", 8), ("BLOCK_ANCHORS", 40), ("TILE_ROWS", 64), ("TILE_ANCHORS", 2), ("GROUP_DIMS", 4)):
        monkeypatch.setattr(hn, name, value)
    rows = [(i * 25, v, label) for i, v, label in vectors(2, 300)]
    asked = []
    threshold = hn.Moments.threshold
    monkeypatch.setattr(hn.Moments, "threshold", lambda self, v, hits: asked.append(threshold(self, v, hits)) or asked[-1])
    found = mined(hn.mine(spark.createDataFrame(rows, VECTORS).repartition(3)))
    assert found == plain_mined(rows) and any(np.isfinite(t).any() for t in asked)


def test_no_pair_that_reaches_its_threshold_is_left_out():
    draw = np.random.default_rng(3)
    for _ in range(20):
        rows, anchors = draw.integers(-90, 90, (40, 33)).astype(float), draw.integers(-90, 90, (7, 33)).astype(float)
        scores = rows @ anchors.T
        thresholds = np.quantile(scores, draw.uniform(0.5, 0.999), axis=0)
        i, j = hn.reaching_pairs(rows, anchors, thresholds)
        assert set(zip(*np.nonzero(scores >= thresholds))) <= set(zip(i.tolist(), j.tolist()))


def test_large_scores_are_exact():
    rows, anchors = np.array([[1 << 30, 1, 3]]), np.array([[1 << 30, -1, 7], [5, 1 << 29, 0]])
    assert hn.exact_scores(rows, anchors, np.array([0, 0]), np.array([0, 1])).tolist() == [(1 << 60) + 20, 5 * (1 << 30) + (1 << 29)]
    with pytest.raises(OverflowError):
        hn.exact_scores(rows << 12, anchors << 12, np.array([0]), np.array([0]))


def test_hard_negatives_of_few_rows(spark):
    assert hn.mine(spark.createDataFrame([], VECTORS)).collect() == []
    assert hn.mine(spark.createDataFrame([(100, [1.0], 1)], VECTORS)).collect() == []
    only = [(1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2)]
    assert hn.mine(spark.createDataFrame(only, VECTORS)).collect() == []
    zero = [(100, [0.0, 1.0], 1), (101, [1.0, 0.0], 1), (102, [2.0, 0.0], 2), (103, [0.0, -1.0], 2), (200, [0.0, 2.0], 3), (201, [0.0, -2.0], 3)]
    assert mined(hn.mine(spark.createDataFrame(zero, VECTORS))) == plain_mined(zero) != []


# --- window dedup ----------------------------------------------------------------------------------------------------


def plain_windows(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    first = {}
    for (doc_id, _), words in zip(rows, split):
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _), words in zip(rows, split):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if doc_id is not None and first.get(tuple(words[i : i + window]), doc_id) < doc_id:
                gone[i : i + window] = [True] * window
        left = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def shortened(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def texts(seed):
    draw = random.Random(seed)
    words = "the of and a in to is that haber thon edre x stand y reedle quorin masth".split(" ")
    prose = lambda n: "".join(draw.choice(words) + draw.choice([" ", " ", "\n", "\t ", "\v\f\r"]) for _ in range(n))
    line, passage = prose(15), prose(60)
    rows = [(i, prose(draw.randrange(0, 90))) for i in range(60)]
    rows += [(100 + i, prose(20) + line + prose(20)) for i in range(40)] + [(200 + i, prose(9) + passage + prose(5)) for i in range(5)]
    rows += [(7, passage), (7, passage), (300, rows[3][1]), (301, rows[3][1] + " more"), (None, passage), (None, passage + " end"), (302, None), (303, ""), (304, " \n "), (305, "x " * 12), (306, "x " * 13), (307, "x " * 4000), (2, "x " * 30)]
    return rows


@pytest.mark.parametrize("hot,chunk", [(20_000, 2 << 20), (3, 600)])
def test_windows(spark, hot, chunk, monkeypatch):
    monkeypatch.setattr(wd, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(wd, "INDEX_WORDS", 400 if hot == 3 else 1 << 18)
    rows = texts(hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("x")).withColumn("chunk", F.lit(1)).repartition(3)
    assert shortened(wd.remove_repeats(df, hot_pieces=hot, digest_only=True)) == plain_windows(rows, 13)


def test_short_windows_and_texts_of_what_is_kept(spark):
    rows = [(2, "a b c d e"), (1, "x a b c y"), (3, "q a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.kept for r in wd.remove_repeats(df, window=3, gram=1).collect()}
    assert found == {1: "x a b c y", 2: "d e", 3: "q"}
    assert wd.remove_repeats(df.limit(0)).collect() == []


def test_named_places(monkeypatch):
    draw = np.random.default_rng(0)
    grams = draw.integers(0, 1 << 63, 500).astype(np.uint64)
    grams[::7] = grams[0]
    want = [i + int(np.argmin(grams[i : i + 10] >> np.uint64(26))) for i in range(491)]
    assert wd.named_places(grams, 10).tolist() == want
    assert wd.named_places(grams[:9], 10).tolist() == []


def test_index_against_every_place():
    draw = random.Random(4)
    for depth in (1, 2, 5):
        pieces = [[draw.randrange(1, 5) for _ in range(draw.randrange(depth, 20))] for _ in range(12)]
        ids = [draw.randrange(6) for _ in pieces]
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes + 1) - 1
        text = np.array([s for p in pieces for s in [*p, 0]])
        found = wd.FMIndex(text, np.repeat(np.array(ids), sizes + 1), depth).least_ids(text, ends, sizes)
        for end, size in zip(ends, sizes):
            for i in range(end - size, end - depth + 1):
                key = text[i : i + depth].tolist()
                assert found[i] == min(n for n, p in zip(ids, pieces) for k in range(len(p) - depth + 1) if p[k : k + depth] == key)


# --- whitening -------------------------------------------------------------------------------------------------------


def plain_whitened(vectors_, k):
    x = np.floor(64 * np.array(vectors_, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (x - 1_000_000) - (sums - n * 1_000_000) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return ((n * x.astype(object) - sums) ** 2).sum(axis=1), centred @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_whitening_in_many_partitions(spark):
    draw = np.random.default_rng(5)
    made = (draw.normal(size=(400, 8)) * np.linspace(3, 0.5, 8) + 2).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(made)]
    odd = [(900, None, 1), (901, [None] * 8, 1), (902, [float("nan")] * 8, 1), (903, [float("-inf")] * 8, 1), (904, [1.0] * 3, 1), (905, [], 1), (906, [3e38] * 8, 1)]
    df = spark.createDataFrame(rows + odd, VECTORS).withColumn("component", F.lit("x")).repartition(70)
    learnt = wh.fit(df)
    table = wh.whiten(df, learnt).toPandas()
    deviation, whitened, shares = plain_whitened(made, 8)
    assert len(table) == 400 * 8 and set(table.n) == {400}
    ours = table.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.abs(ours) - np.abs(whitened)).max() < 1e-9
    assert table.groupby("vec_id").deviation.first().tolist() == deviation.tolist()
    assert np.allclose(table[table.vec_id == 0].explained, shares, rtol=1e-9)
    assert wh.identity_error(df, learnt) < 1e-9
    # signs are those of the columns, the same for all rows
    assert np.allclose(np.sign(ours * whitened), np.sign(ours * whitened)[0])


def test_rank_one_updates():
    draw = np.random.default_rng(6)
    values, vectors_, full = np.zeros(20), np.eye(20), np.zeros((20, 20))
    for k in range(60):
        term = draw.normal(size=20) * 10.0 ** draw.integers(-6, 3) if k % 5 else np.eye(20)[k % 20]
        full += np.outer(term, term)
        values, vectors_ = wh.rank_one(values, vectors_, term)
        assert np.abs(vectors_ * values @ vectors_.T - full).max() <= 1e-11 * np.abs(full).max()
        assert np.abs(vectors_.T @ vectors_ - np.eye(20)).max() < 1e-10


def test_whitening_of_repeats_one_row_and_none(spark):
    twice = [(1, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (None, [2.0, 1.0], None), (3, [2.0, 1.0], 2)]
    df = spark.createDataFrame(twice, VECTORS)
    found = wh.whiten(df, wh.fit(df)).collect()
    # the second dimension never changes, so there is one component
    assert sorted((r.vec_id or 0, r.component, r.n, abs(round(r.whitened, 9)), r.explained) for r in found) == [(0, 1, 4, 1.0, 1.0), (1, 1, 4, 1.0, 1.0), (1, 1, 4, 1.0, 1.0), (3, 1, 4, 1.0, 1.0)]
    for rows in ([], twice[:2], [(1, [], 1)]):
        none = spark.createDataFrame(rows, VECTORS)
        assert wh.whiten(none, wh.fit(none)).collect() == []
    assert wh.deviations(np.array([[1 << 40, 0]]), 1 << 20, np.array([0, 0])) == [None]


def test_registered_queries(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame(vectors(7, 250), VECTORS).write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame(texts(8), "doc_id long, text string").withColumn("lang", F.lit("en")).write.parquet(f"{path}/documents.parquet")
    queries = catalogue.queries()
    assert mined(queries["op11_hard_negatives"](spark, path)) == plain_mined(vectors(7, 250))
    assert shortened(queries["op12_window_dedup"](spark, path).withColumnRenamed("kept_sha256", "kept")) == plain_windows(texts(8), 13)
    found = queries["op13_whitening"](spark, path)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 250 * 12 and found.agg(F.max("identity_error")).first()[0] < 1e-4


# --- licences --------------------------------------------------------------------------------------------------------


def test_runs_apart(spark):
    draw = random.Random(9)
    cases = [[draw.random() < 0.6 for _ in range(n)] for n in (0, 1, 511, 512, 513, 1500)]
    frame = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, fits array<boolean>")
    for n in (1, 2, 6):
        for row in frame.select("k", licences._first_apart(F.col("fits"), n).alias("taken")).collect():
            free, want = 0, []
            for i, fit in enumerate(cases[row.k]):
                want.append(fit and i >= free)
                free = i + n if want[-1] else free
            assert row.taken == want


def test_many_licence_lines_in_one_text(spark):
    first = dict(licences.TEMPLATES[::-1])["mit"].split()
    rows = [(1, "\n".join(["All rights reserved."] * 4000)), (2, "\n".join([" ".join(first[: len(first) // 2]), " ".join(first[len(first) // 2 :])] * 50)), (3, "river office seldom")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lines", F.lit(1)).withColumn("licences", F.lit("x"))
    model = licences.train(df, unknown_paragraphs=50)
    found = {r.doc_id: r for r in licences.scan(df, model).collect()}
    assert len(found[1].licences) == 4000 and found[1].n_paragraphs == 4000
    assert len(found[2].licences) in (50, 100) and {x.family for x in found[2].licences} == {"mit"}
    assert found[3].licences == []
