"""Operators on input where a shortcut would lose part of the job."""

import random

import numpy as np

import corpus_pipeline
from tests.llm.test_operators import WORDS, prose
from wordgrove.llm import decontaminate, language_id, licences, secrets


def rare(draw):
    return "".join(draw.choice("bcdfgklmnprst") + draw.choice("aeiou") for _ in range(4))


def test_leaks_of_every_length(spark):
    """Items word for word in long texts, next to the words of other items, with one very long item; ids may be repeated or null."""
    draw = random.Random(12)
    texts = [" ".join(rare(draw) if i % 3 == 0 else draw.choice(WORDS) for i in range(n)) for n in (4, 7, 12, 17, 25, 40, 70, 400) for _ in range(3)]
    items = [(None if i == 1 else 4 if i == 5 else i, x) for i, x in enumerate(texts)]
    others = [w for x in texts for w in x.split()]
    noise = lambda n: " ".join(draw.choice(others) for _ in range(n))
    rows = [(i, noise(150 + 7 * i) + " " + x.upper() + ". " + noise(200)) for i, x in enumerate(texts)] + [(100 + i, prose(i, 300)) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (5000, 5):
        found = {r.doc_id: r for r in decontaminate.find_leaks(frame, benchmark, block_items=block).collect()}
        assert all(found[i].leak and found[i].leak_common == 1 for i in range(len(texts)))
        assert [found[i].leaked_item for i in range(len(texts))] == [x for x, _ in items]
        assert not any(found[100 + i].leak for i in range(20))


def test_latent_space_spans_the_items(spark):
    """Every item keeps its length, and the space doesn't depend on which texts a draw would take."""
    draw = random.Random(13)
    items = [" ".join(rare(draw) for _ in range(20)) for _ in range(150)]
    texts = spark.createDataFrame([(prose(i, 120) + " " + " ".join(items[i % 150].split()[:8]),) for i in range(600)], "text string")
    index = decontaminate.build_index(texts, list(range(150)), items)
    for own in items:
        terms, weights = decontaminate._tfidf(np.array([index.vocabulary[w] for w in own.encode().split()]), index.idf)
        assert np.linalg.norm(weights @ index.basis[terms]) >= 0.94


def test_leaks_by_cosine_lose_few_paraphrases(spark):
    """Items with words left out and others put between are found as without the bound on the cosine; items of a word or two mark nothing."""
    draw = random.Random(15)
    items = [" ".join(rare(draw) if i % 2 else draw.choice(WORDS) for i in range(30)) for _ in range(40)]
    texts = []
    for i in range(120):
        kept = [w for w in items[i % 40].split() if draw.random() < 0.8]
        spread = [x for w in kept for x in ([w, draw.choice(WORDS)] if draw.random() < 0.25 else [w])]
        texts.append(prose(i, 60) + " " + " ".join(spread) + " " + prose(500 + i, 60))
    index = decontaminate.build_index(spark.createDataFrame([(x,) for x in texts], "text string"), list(range(40)), items)
    whole, near = (decontaminate.best_matches(texts, index, least) for least in (-1.0, decontaminate.MIN_COSINE))
    # answer words are those in the fewest texts, here the ones left out most, so not all texts hold their item by the final conditions
    assert len(whole) >= 50 and len(near.keys() & whole.keys()) >= 0.9 * len(whole)
    assert all(near[i][0] == i % 40 for i in near)
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    short = spark.createDataFrame([(0, WORDS[0]), (1, " ".join(WORDS[:3]))], "item_id long, text string")
    assert not any(r.leak for r in decontaminate.find_leaks(frame, short).collect())


def test_leaks_where_no_text_has_a_word_of_an_item(spark):
    """Null, empty and unlike texts, and no text at all."""
    benchmark = spark.createDataFrame([(0, "one two three four five six")], "item_id long, text string")
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "nothing alike"), (4, "!?")], "doc_id long, text string")
    assert [r.leak for r in decontaminate.find_leaks(frame, benchmark).collect()] == [False] * 4
    assert decontaminate.find_leaks(frame.limit(0), benchmark).count() == 0


def test_running_sums_and_windows():
    rows = np.random.default_rng(1).normal(size=(50, 7)).astype(np.float32)
    for n in (0, 1, 31, 32, 33, 100):
        places = np.random.default_rng(n).integers(0, 50, n)
        plain = np.concatenate([np.zeros((1, 7)), np.cumsum(rows[places].astype(float), axis=0)])
        assert np.allclose(decontaminate._running_sums(rows, places)[: n + 1], plain, atol=1e-3)
    lengths = np.array([0, 1, 12, 13, 100])
    text, start, end = decontaminate._windows(lengths, 12)
    first = np.cumsum(lengths) - lengths
    for t, n in enumerate(lengths):
        own = [(int(a - first[t]), int(b - first[t])) for x, a, b in zip(text, start, end) if x == t]
        assert all(0 <= a < b <= n and b - a == min(n, 12) for a, b in own)
        # every run of two thirds of a window lies in one
        assert all(any(a <= i and i + 8 <= b for a, b in own) for i in range(n - 7))


def test_secrets_of_letters_only_and_short_ones(spark):
    draw = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = ["".join(draw.choice(letters) for _ in range(20 + i % 20)) for i in range(200)] + ["".join(draw.choice(letters + "0123456789") for _ in range(18)) for _ in range(200)]
    names = ["getUserNameById", "HttpServletRequestWrapperFactory", "src/main/java/org/apache/commons", "Donaudampfschifffahrtsgesellschaft", "UTF-8-BOM-encoded", "12345678901234567890"]
    frame = spark.createDataFrame([(i, f"key {x} here") for i, x in enumerate(keys + names)], "doc_id long, text string")
    found = {r.doc_id: r.n_random for r in secrets.scan(frame).collect()}
    assert sum(found[i] for i in range(200)) >= 190 and sum(found[i] for i in range(200, 400)) >= 100
    assert not any(found[400 + i] for i in range(len(names)))


def test_near_duplicates_with_null_and_repeated_ids(spark):
    """One row of each group of near duplicates stays, whatever the ids."""
    texts = [prose(300 + i, 90) for i in range(12)]
    rows = [(7, texts[i], "en", "s", 0) for i in range(4)] + [(None, texts[i], "en", "s", i) for i in range(4, 8)]
    rows += [(i, texts[i], "en", "s", 0) for i in range(8, 12)] + [(20, texts[0], "en", "s", 0), (5, texts[9], "en", "s", 0), (None, texts[10], "fr", "s", 0), rows[1], (None, texts[4], "en", "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted((r.text, r.doc_id) for r in kept.collect())
    assert [x for x, _ in found] == sorted(texts)
    ids = dict(found)
    assert [ids[x] for x in texts] == [7, 7, 7, 7, None, None, None, None, 8, 5, 10, 11]


def test_short_and_wrapped_licences(spark):
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License"
    mit = "# Permission is hereby granted,\n# free of charge, to any person\n# obtaining a copy of this software\n# and associated documentation files"
    rows = [(i, prose(i, 60)) for i in range(40)]
    rows += [(100, prose(50, 20) + "\nAll rights reserved.\n" + prose(51, 20)), (101, prose(52, 20) + "\n" + gpl + "\n" + prose(53, 20)), (102, mit), (103, mit + "\nAll rights reserved.\n\n" + gpl), (104, "the reserved seats\nof the licence office")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = licences.train(frame, unknown_paragraphs=200)
    found = {r.doc_id: [x.family for x in r.licences] for r in licences.scan(frame, model).collect()}
    assert [found[i] for i in range(100, 105)] == [["proprietary"], ["gpl"], ["mit"], ["mit", "proprietary", "gpl"], []]
    assert not any(found[i] for i in range(40))


def test_rare_languages_are_learnt(spark):
    """A language with a row or two is in the model, and long texts in it aren't outweighed by its prior."""
    made = {"en": "the of and that with for", "de": "der und die nicht mit ein", "fr": "le des une dans pour que"}
    draw = random.Random(15)
    text = lambda lang, n: " ".join(draw.choice(made[lang].split()) for _ in range(n))
    rows = [(i, text("en", 12), "en") for i in range(6000)] + [(6000 + i, text(lang, 40), lang) for i, lang in enumerate(("de", "fr", "fr"))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wanted = {100 + i: lang for i, lang in enumerate(list(made) * 10)}
    model = language_id.train(frame, max_rows=600)
    found = language_id.predict(spark.createDataFrame([(i, text(lang, 30)) for i, lang in wanted.items()], "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in found} == wanted and all(0.3 < r.score <= 1 for r in found)


def test_rows_for_each_language():
    assert language_id.rows_for_each([5, 100, 10_000], 1105, 10) == 1000
    assert language_id.rows_for_each([5, 100], 1000) == 100
    assert language_id.rows_for_each([50_000] * 4, 40_000) == 10_000
    assert language_id.rows_for_each([50_000] * 500, 40_000) == 1000
