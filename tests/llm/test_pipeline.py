"""The pipeline's stages on a small corpus, each against what it should keep."""

import random

import pytest

import corpus_pipeline as cp
from tests.llm.test_operators import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    draw = random.Random(8)
    leak = " ".join("".join(draw.choice("bcdfgk") + draw.choice("aeiou") for _ in range(4)) for _ in range(25))
    rows = [(i, prose(100 + i, 80), "en", "s", 0) for i in range(20)]
    rows += [(30, rows[3][1], "en", "s", 0), (31, None, "en", "s", 0), (32, "12 !!", None, "s", 0), (33, prose(50, 60) + " " + leak, "en", "s", 0), (34, prose(51, 60) + ' password="abcdef123456"', "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    gone = {"language_id": {31, 32}, "simhash_dedup": {30}, "decontaminate": {33}, "secrets": set()}
    kept = {r.doc_id for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        kept -= gone[name]
        assert {r.doc_id for r in after.select("doc_id").collect()} == kept, name
        docs = after
    texts = {r.doc_id: r for r in docs.collect()}
    assert "[SECRET]" in texts[34].text and "abcdef" not in texts[34].text and texts[34].n_chars == len(texts[34].text)


def test_run(spark, folder):
    found = cp.run(spark, folder)
    assert found.count() == 21 and found.where("n_tokens * 4 <> length(ids)").count() == 0
