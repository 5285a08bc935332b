"""Samples and the label classifier, which SQL can't express, against plain versions."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordgrove.operators import ml
from wordgrove.operators import stats as st


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(i, f"w{i}", i % 7) for i in range(400)], "id long, word string, n long")


def hashes(df, seed):
    return {r.id: r.h for r in df.select("id", F.xxhash64(F.lit(seed), "id").alias("h")).collect()}


def test_uniform_sample(table):
    drawn = hashes(table, 3)
    for k in (0, 1, 25, 400, 900):
        found = [r.id for r in st.sample_uniform(table, k, ["id"], 3).collect()]
        assert sorted(found) == sorted(sorted(drawn, key=lambda i: (drawn[i], i))[:k])
    assert {r.id for r in st.sample_uniform(table, 25, ["id"], 4).collect()} != {r.id for r in st.sample_uniform(table, 25, ["id"], 3).collect()}


def test_weighted_sample(table):
    drawn = hashes(table, 5)
    weight = {i: float(i % 7) for i in range(400)}
    time = {i: -math.log((drawn[i] % (1 << 52) + 1.0) / ((1 << 52) + 1)) / weight[i] for i in drawn if weight[i] > 0}
    found = {r.id for r in st.sample_weighted(table, 60, ["id"], F.col("n"), 5).collect()}
    assert found == set(sorted(time, key=lambda i: (time[i], i))[:60])
    # heavy rows are drawn in proportion to their weights
    sums = Counter()
    for seed in range(12):
        sums.update(r.n for r in st.sample_weighted(table, 40, ["id"], F.col("n"), seed).collect())
    assert sums[0] == 0 and sums[5] + sums[6] > 2 * (sums[1] + sums[2])


def test_negatives(spark, table):
    pairs = table.select("id", "word")
    labelled = table.where("id < 90").select("id", "word", F.when(F.col("id") < 60, "a").otherwise("b").alias("label"))
    found = [r.id for r in st.sample_negatives(pairs, labelled, ["id", "word"], seed=2).collect()]
    # one and a half times the mean of 60 and 30
    assert len(found) == len(set(found)) == 67 and min(found) >= 90


@pytest.fixture(scope="module")
def features(spark):
    draw = random.Random(4)
    rows = []
    for i in range(400):
        kind = draw.choice(["er", "ing", "ly"])
        rows.append((i, f"w{i}{kind}", draw.choice("NV"), kind if i % 5 else None))
    frame = spark.createDataFrame(rows, "id long, b string, b_pos string, label string")
    return frame.withColumn("b_suffix_2", F.right("b", F.lit(2)))


def test_labeller(features):
    columns = ["b_suffix_2", "b_pos"]
    train, held = ml.split_rows(features, ["id"])
    assert train.count() + held.count() == 400 and train.join(held, "id").count() == 0
    found = ml.predict_labels(ml.fit_labeller(train.where("label IS NOT NULL"), columns), features).collect()
    truth = {"er": "er", "ng": "ing", "ly": "ly"}
    assert all(r.predicted == truth[r.b[-2:]] and 1 / 3 < r.chance <= 1 for r in found)


def test_folds(features):
    found = ml.cross_validate(features, ["b_suffix_2", "b_pos"], ["id"], folds=3).collect()
    assert sorted(r.fold for r in found) == [0, 1, 2]
    assert sum(r.rows for r in found) == 320 and all(r.accuracy == 1 for r in found)


def test_rare_values_become_one(features):
    rare = features.withColumn("b_pos", F.when(F.col("id") < 3, "X").otherwise(F.col("b_pos")))
    assert {r.b_pos for r in ml.drop_rare(rare, ["b_pos"]).select("b_pos").distinct().collect()} == {"RARE", "N", "V"}
