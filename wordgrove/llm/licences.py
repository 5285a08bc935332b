"""Licence scans with a trained paragraph classifier (operator 1), in DataFrame and SQL functions only.

1. Training paragraphs come from templates of each licence family (whole
   sentences, with words of the corpus before, after and between them, and with
   words left out) and, as the class ``unknown``, from a bounded sample of the
   corpus's own paragraphs, to which some of the templates' words are added.
2. Features are word unigrams and bigrams of the templates.  A multinomial
   logistic regression over these sparse features gives a weight for each n-gram
   and class; the number of templates bounds the model.
3. The confidence below which a paragraph is ``unknown`` is calibrated on a
   held-out part of the paragraphs: the least one at which the wanted share of
   the unknown ones is left alone.
4. A prediction counts only if the paragraph holds enough of the n-grams of one
   template of the predicted family.
5. Lines near a telling word are also judged together with their neighbours, so
   that a notice that is wrapped over several lines is found whole.

Scoring stays inside each row: a text is split in paragraphs, those without a
telling word are passed over, and the rest are scored with array functions.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgrove.llm.common import checkpointed

UNKNOWN = "unknown"
#: Short notices of the common licence families, as they stand in files and pages.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("bsd", "Use of this source code is governed by a BSD-style license."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved. No part of this work may be reproduced without the prior written permission of the publisher."),
    ("proprietary", "All rights reserved."),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("mpl", "Licensed under the Mozilla Public License, version 2.0."),
    ("cc0", "Released under CC0 1.0."),
)
#: Words that stand in ordinary prose as well: they are features, but don't make a paragraph worth scoring.
ORDINARY = frozenset("a all and any are as author be by except for form forms free hereby in is it law may no not of or part person possible program project source terms the this to under use with without work you your".split())
#: Bounds of the sample of corpus paragraphs that the class unknown is learnt from, and of copies made of a template.
UNKNOWN_PARAGRAPHS, VARIANTS = 2000, 24
#: Share of held-out unknown paragraphs that calibration leaves alone.
SPECIFICITY = 0.995
#: Share of a template's n-grams that confirms a prediction.
CONFIRMED = 0.6
#: Neighbouring lines that are judged together, at most: the longest template at about 25 characters a line.
WRAPPED = 6


def words_of(text: Column) -> Column:
    """The lower-cased runs of letters and digits of a text; the first and the last may be empty."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def ngrams_of(words: Column) -> Column:
    """The distinct words and pairs of neighbouring words of an array of words."""
    fewer = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, fewer), F.slice(words, 2, fewer), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(words, pairs))


def template_ngrams(text: str) -> tuple[str, ...]:
    """The same for a template."""
    words = re.findall(r"[^\W_]+", text.lower())
    return tuple(dict.fromkeys(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))


@dataclass(frozen=True)
class LicenceModel:
    """Families in order, ``unknown`` last; n-grams and their weights by family; biases; the least confidence; templates' n-grams."""

    families: tuple[str, ...]
    vocabulary: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    biases: tuple[float, ...]
    least: float
    templates: tuple[tuple[str, tuple[str, ...]], ...]


def telling_words(templates: tuple[tuple[str, tuple[str, ...]], ...]) -> list[str]:
    """Words of templates that ordinary prose seldom has: a paragraph without any is unknown."""
    return sorted({word for _, grams in templates for word in grams if " " not in word and word not in ORDINARY and not word.isdigit()})


def _training(spark: SparkSession, sample: DataFrame, templates, telling: list[str], variants: int) -> DataFrame:
    """``paragraph``, ``family`` and ``held``: copies of templates between words of the corpus, and corpus paragraphs."""
    near = F.array_join(F.slice(F.split("paragraph", r"\s+"), 1, 12), " ")
    around = sample.orderBy(F.xxhash64("paragraph"), "paragraph").limit(variants).select(near.alias("near"))
    around = around.unionByName(spark.createDataFrame([("",)], "near string")).distinct()
    # so many templates times so many variants: both are parameters
    made = spark.createDataFrame([list(x) for x in templates], "family string, template string").join(F.broadcast(around))
    words, draw = F.split("template", " "), F.pmod(F.xxhash64("template", "near"), F.lit(12))
    gap = F.pmod(F.xxhash64("near", "template"), F.size(words).cast("long")).cast("int")
    shortened = F.when(draw % 4 == 3, F.array_join(F.concat(F.slice(words, 1, gap), F.slice(words, gap + 2, F.size(words))), " ")).otherwise(F.col("template"))
    placed = F.when(draw % 3 == 0, shortened).when(draw % 3 == 1, F.concat_ws(" ", "near", shortened)).otherwise(F.concat_ws(" ", shortened, "near"))
    word = F.element_at(F.lit(telling), (F.pmod(F.xxhash64("paragraph"), F.lit(len(telling))) + 1).cast("int"))
    strewn = sample.select(F.concat_ws(" ", "paragraph", word).alias("paragraph"))
    unknown = sample.select("paragraph").unionByName(strewn).withColumn("family", F.lit(UNKNOWN))
    return made.select(placed.alias("paragraph"), "family").unionByName(unknown).withColumn("held", F.pmod(F.xxhash64("paragraph", "family"), F.lit(4)) == 0)


def train(df: DataFrame, *, text_col: str = "text", templates=TEMPLATES, unknown_paragraphs: int = UNKNOWN_PARAGRAPHS, variants: int = VARIANTS, specificity: float = SPECIFICITY) -> LicenceModel:
    """A model from templates and a bounded sample of the corpus's paragraphs (those with the least hashes)."""
    grams = tuple((family, template_ngrams(text)) for family, text in templates)
    vocabulary = sorted({g for _, own in grams for g in own})
    telling = telling_words(grams)
    families = (*dict.fromkeys(family for family, _ in templates), UNKNOWN)
    paragraphs = df.select(F.explode(F.split(text_col, r"\n")).alias("paragraph")).where("length(paragraph) BETWEEN 1 AND 4000").select(F.xxhash64("paragraph", F.lit(7)).alias("draw"), "paragraph")
    # about four times as many different paragraphs as are wanted, by their hashes; a repeated one has one hash and comes once
    different = paragraphs.agg(F.approx_count_distinct("draw").alias("n")).first().n
    share = min(1.0, 4 * unknown_paragraphs / max(1, different))
    drawn = paragraphs.where(F.pmod("draw", F.lit(1 << 30)) < int(share * (1 << 30))).groupBy("draw").agg(F.min("paragraph").alias("paragraph"))
    sample = checkpointed(drawn.where(~F.arrays_overlap(words_of(F.col("paragraph")), F.lit(telling))).orderBy("draw").limit(unknown_paragraphs).select("paragraph"))
    rows = _training(df.sparkSession, sample, templates, telling, variants)
    rows = rows.select(ngrams_of(words_of(F.col("paragraph"))).alias("grams"), (F.array_position(F.lit(list(families)), F.col("family")) - 1).cast("double").alias("label"), "held")
    rows = checkpointed(CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True).transform(rows))
    fitted = LogisticRegression(family="multinomial", regParam=0.001, maxIter=60, standardization=False).fit(rows.where(~F.col("held")))
    weights, biases = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    model = LicenceModel(families, tuple(vocabulary), tuple(map(tuple, weights.T.tolist())), tuple(biases.tolist()), 0.0, grams)
    held = rows.where(F.col("held") & (F.col("label") == len(families) - 1)).select(_scored(F.array_intersect("grams", F.lit(vocabulary)), model).alias("s"))
    mistaken = held.select(F.when(F.col("s.place") < len(families) - 1, F.col("s.score")).otherwise(0.0).alias("score"))
    least = mistaken.agg(F.percentile("score", specificity).alias("least")).first().least
    return LicenceModel(families, model.vocabulary, model.weights, model.biases, max(float(least or 0.0), 0.5), grams)


def _scored(grams: Column, model: LicenceModel) -> Column:
    """The likeliest class (its place) and its probability, from an array of known n-grams."""
    weights = F.map_from_arrays(F.lit(list(model.vocabulary)), F.array(*[F.lit(list(w)) for w in model.weights]))
    logits = F.aggregate(grams, F.lit(list(model.biases)), lambda sums, g: F.zip_with(sums, F.element_at(weights, g), lambda a, b: a + b))
    ranked = F.transform(F.array(logits), lambda x: F.struct(x.alias("x"), F.array_max(x).alias("top")))
    place = lambda r: F.array_position(r["x"], r["top"]).cast("int") - 1
    odds = lambda r: F.aggregate(r["x"], F.lit(0.0), lambda total, x: total + F.exp(x - r["top"]))
    return F.element_at(F.transform(ranked, lambda r: F.struct(place(r).alias("place"), (F.lit(1.0) / odds(r)).alias("score"))), 1)


#: Lines that are gone through together when runs are chosen; the choice itself is copied for each of them.
_STRETCH = 512


def _kept(rows: DataFrame) -> DataFrame:
    """The same rows, their columns computed once: an optimiser that put an array's expression where an element of it is looked up would compute the array for every element."""
    return rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("_row")).select("_row.*")


def _first_apart(fits: Column, n: int) -> Column:
    """Of places in order at which runs of ``n`` lines may begin (true), those that are taken if each goes before all that overlap it."""
    stretches = F.transform(F.sequence(F.lit(0), F.floor((F.size(fits) - 1) / _STRETCH).cast("int")), lambda k: F.slice(fits, k * _STRETCH + 1, _STRETCH))

    def take(acc: Column, fit: Column) -> Column:
        free = fit & (acc["wait"] == 0)
        return F.struct(F.when(free, n - 1).otherwise(F.greatest(acc["wait"] - 1, F.lit(0))).cast("int").alias("wait"), F.concat(acc["out"], F.array(free)).alias("out"))

    def through(acc: Column, stretch: Column) -> Column:
        start = F.struct(acc["wait"].alias("wait"), F.array().cast("array<boolean>").alias("out"))
        inner = F.aggregate(stretch, start, take)
        return F.struct(inner["wait"].alias("wait"), F.concat(acc["out"], F.array(inner["out"])).alias("out"))

    start = F.struct(F.lit(0).alias("wait"), F.array().cast("array<array<boolean>>").alias("out"))
    return F.when(F.size(fits) > 0, F.flatten(F.aggregate(stretches, start, through)["out"])).otherwise(F.array().cast("array<boolean>"))


def scan(df: DataFrame, model: LicenceModel, *, id_col: str = "doc_id", text_col: str = "text", confirmed: float = CONFIRMED, wrapped: int = WRAPPED) -> DataFrame:
    """``doc_id``, ``n_paragraphs``, ``n_scored`` and ``licences`` (``family``, ``score``, ``paragraph``) of every row.

    Paragraphs are lines; blank ones don't count.  A paragraph is listed if its
    likeliest class isn't ``unknown``, the confidence is above the calibrated one
    and a template of that family confirms it.  Up to ``wrapped`` lines one after
    another are listed as one paragraph where they fulfil that together, and no
    fewer of them do; of runs of as many lines that overlap, the first.  A null or
    empty text has no paragraphs.  Equal rows each give a row; other columns are
    ignored.  The work grows with the lines, however many of them hold a licence.
    """
    vocabulary, telling = F.lit(list(model.vocabulary)), F.lit(telling_words(model.templates))
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), r"\n"), lambda p: F.trim(p) != "")
    rows = _kept(df.select(F.col(id_col).alias("doc_id"), lines.alias("lines")))
    told = F.transform("lines", lambda p: F.arrays_overlap(words_of(p), telling))
    rows = _kept(rows.select("doc_id", "lines", told.alias("told")))

    # words of the lines that may stand in one run with a line with a telling word; nothing else is looked at
    def near(i: Column) -> Column:
        first = F.greatest(i - wrapped + 1, F.lit(0))
        return F.exists(F.slice("told", first + 1, i + wrapped - first), lambda x: x)

    words = F.transform("lines", lambda p, i: F.when(near(i), F.array_remove(words_of(p), "")))
    # each line is cut in n-grams once: what it has of the templates', and the words that meet those of its neighbours
    part = lambda w: F.struct(F.array_intersect(ngrams_of(w), vocabulary).alias("grams"), F.get(w, F.lit(0)).alias("first"), F.try_element_at(w, F.lit(-1)).alias("last"))
    n_scored = F.size(F.filter("told", lambda x: x)).cast("long")
    size = F.when(F.exists("told", lambda x: x), F.size("lines")).otherwise(0)
    rows = _kept(rows.select("doc_id", "lines", "told", n_scored.alias("n_scored"), size.alias("size"), F.transform(words, part).alias("parts")))

    # a run of n lines stands in the n-th array at the place of its first line
    def grams(n: int, i: Column) -> Column:
        parts = F.filter(F.slice("parts", i, n), lambda p: p["first"].isNotNull())
        rest = F.greatest(F.size(parts) - 1, F.lit(0))
        over_ends = F.zip_with(F.slice(parts, F.lit(1), rest), F.slice(parts, F.lit(2), rest), lambda a, b: F.concat(a["last"], F.lit(" "), b["first"]))
        return F.concat(F.flatten(F.transform(parts, lambda p: p["grams"])), over_ends)

    none = F.array().cast("array<int>")
    places = lambda n: F.when(F.col("size") >= n, F.sequence(F.lit(1), F.greatest(F.col("size") - n + 1, F.lit(1)))).otherwise(none)
    run = lambda n: F.transform(places(n), lambda i: F.when(F.exists(F.slice("told", i, n), lambda x: x), grams(n, i))).alias(f"run{n}")
    held = [run(n) for n in range(1, wrapped + 1)]
    rows = _kept(rows.select("doc_id", "lines", "n_scored", "size", *held))

    place = {family: i for i, family in enumerate(model.families)}
    templates = F.array(*[F.struct(F.lit(place[family]).alias("place"), F.lit(list(own)).alias("grams")) for family, own in model.templates])
    share = lambda t, g: F.size(F.array_intersect(t["grams"], g)) >= F.lit(confirmed) * F.size(t["grams"])
    fewest = min(math.ceil(confirmed * len(own)) for _, own in model.templates)
    families = F.lit(list(model.families))

    def judged(g: Column) -> Column:
        """The family and the score of a run, null where it has none."""
        # the class is looked at first, and a template of its family confirms it
        scored = F.filter(F.array(_scored(g, model)), lambda s: (s["place"] < len(place) - 1) & (s["score"] > model.least))
        sure = F.filter(scored, lambda s: F.exists(templates, lambda t: (t["place"] == s["place"]) & share(t, g)))
        return F.when(F.size(g) >= fewest, F.get(F.transform(sure, lambda s: F.struct(F.element_at(families, s["place"] + 1).alias("family"), s["score"].alias("score"))), F.lit(0)))

    # all runs are judged in one array and dealt out again
    runs = F.transform(F.flatten(F.array(*[f"run{n}" for n in range(1, wrapped + 1)])), lambda g: F.array_intersect(g, vocabulary))
    sizes = [F.size(f"run{n}").alias(f"size{n}") for n in range(1, wrapped + 1)]
    rows = _kept(rows.select("doc_id", "lines", "n_scored", runs.alias("runs"), *sizes))
    rows = _kept(rows.select("doc_id", "lines", "n_scored", F.transform("runs", judged).alias("runs"), *[f"size{n}" for n in range(1, wrapped + 1)]))
    before, dealt = F.lit(1), []
    for n in range(1, wrapped + 1):
        dealt.append(F.slice("runs", before, F.col(f"size{n}")).alias(f"run{n}"))
        before = before + F.col(f"size{n}")
    rows = _kept(rows.select("doc_id", "lines", "n_scored", *dealt))
    any_of = lambda n: F.exists(f"run{n}", lambda x: x.isNotNull())
    found = any_of(1)
    for n in range(2, wrapped + 1):
        found = found | any_of(n)
    # fewest lines first; a line is listed once
    rows = _kept(rows.withColumn("found", found).withColumn("free", F.when(F.col("found"), F.transform("lines", lambda _: F.lit(True))).otherwise(F.array().cast("array<boolean>"))))
    for n in range(1, wrapped + 1):
        unmet = lambda i: F.forall(F.slice("free", i + 1, n), lambda x: x)
        fits = F.when(F.col("found"), F.transform(f"run{n}", lambda x, i: x.isNotNull() & unmet(i))).otherwise(F.array().cast("array<boolean>"))
        rows = _kept(rows.withColumn(f"take{n}", fits))
        rows = _kept(rows.withColumn(f"take{n}", F.when(F.exists(f"take{n}", lambda x: x), _first_apart(F.col(f"take{n}"), n)).otherwise(F.array().cast("array<boolean>"))))
        covered = lambda i: F.exists(F.slice(f"take{n}", F.greatest(i - n + 2, F.lit(1)), F.least(i + 1, F.lit(n))), lambda x: x)
        rows = _kept(rows.withColumn("free", F.when(F.size(f"take{n}") > 0, F.transform("free", lambda x, i: x & ~covered(i))).otherwise(F.col("free"))))

    def listed(i: Column) -> Column:
        at = lambda n: F.struct(F.get(f"run{n}", i)["family"].alias("family"), F.get(f"run{n}", i)["score"].alias("score"), F.array_join(F.slice("lines", i + 1, n), "\n").alias("paragraph"))
        return F.filter(F.array(*[F.when(F.coalesce(F.get(f"take{n}", i), F.lit(False)), at(n)) for n in range(1, wrapped + 1)]), lambda x: x.isNotNull())

    every = F.flatten(F.transform("lines", lambda _, i: listed(i)))
    nothing = F.array().cast("array<struct<family:string,score:double,paragraph:string>>")
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_paragraphs"), "n_scored", F.when(F.col("found"), every).otherwise(nothing).alias("licences"))


def op1_licence_scan(spark, sf_dir: str) -> DataFrame:
    """Licence families of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(documents, train(documents))
    return found.select(
        "doc_id",
        "n_paragraphs",
        "n_scored",
        F.size("licences").cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",").alias("families"),
        F.coalesce(F.array_max("licences.score"), F.lit(0.0)).alias("top_score"),
    )
