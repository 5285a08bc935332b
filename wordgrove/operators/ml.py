"""Features, baseline and classifier for the labels of relations."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordgrove.functions.text import affix_ngrams


def pair_features(pairs: DataFrame, longest: int = 3) -> DataFrame:
    """Pairs (``a``, ``a_pos``, ``b``, ``b_pos``) with parts of speech, affixes of both words, and whether starts and last letters agree."""
    columns = []
    for side in ("a", "b"):
        columns += [c.alias(f"{side}_{name}") for name, c in affix_ngrams(F.col(side), longest).items()]
    start = F.lower(F.substring("a", 1, 2)) == F.lower(F.substring("b", 1, 2))
    return pairs.select("*", *columns, start.alias("same_start"), (F.right("a", F.lit(1)) == F.right("b", F.lit(1))).alias("same_end"))


def first_known(*columns: str) -> Column:
    """The first of several sources of a feature that isn't null."""
    return F.coalesce(*columns)


def baseline_label(features: DataFrame, ladder: list[tuple[str, Column]], otherwise: str = "NONE") -> DataFrame:
    """Labels by the first rule that holds."""
    out = F.lit(otherwise)
    for name, condition in reversed(ladder):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return features.withColumn("predicted", out)


def drop_rare(features: DataFrame, columns: list[str], least: int = 6, rare: str = "RARE") -> DataFrame:
    """Values of columns that fewer than ``least`` rows have become one value."""
    for c in columns:
        kept = features.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(c, F.lit(True).alias("_kept"))
        features = features.join(kept, c, "left").withColumn(c, F.when(F.col("_kept"), F.col(c)).otherwise(rare)).drop("_kept")
    return features


def fit_labeller(features: DataFrame, columns: list[str], label: str = "label", reg: float = 0.01, max_iter: int = 40) -> PipelineModel:
    """A multinomial logistic regression over one-hot columns, fitted on labelled rows."""
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep") for c in columns]
    hot = OneHotEncoder(inputCols=[f"{c}_ix" for c in columns], outputCols=[f"{c}_hot" for c in columns])
    vector = VectorAssembler(inputCols=[f"{c}_hot" for c in columns], outputCol="features")
    target = StringIndexer(inputCol=label, outputCol="label_ix", handleInvalid="skip", stringOrderType="alphabetAsc")
    model = LogisticRegression(labelCol="label_ix", featuresCol="features", family="multinomial", regParam=reg, maxIter=max_iter)
    return Pipeline(stages=[*indexers, hot, vector, target, model]).fit(features.where(F.col(label).isNotNull()))


def predict_labels(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Rows with ``predicted`` and its ``probability``; labelled or not."""
    labels = model.stages[-2].labels
    staged = features
    for stage in [*model.stages[:-2], model.stages[-1]]:
        staged = stage.transform(staged)
    chance = vector_to_array("probability")
    return staged.select(*features.columns, F.element_at(F.lit(list(labels)), (F.col("prediction") + 1).cast("int")).alias("predicted"), F.array_max(chance).alias("chance"))


def split_rows(features: DataFrame, keys: list[str], held: float = 0.2, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows by a hash of their keys."""
    draw = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1000)) < int(held * 1000)
    return features.where(~draw), features.where(draw)


def cross_validate(features: DataFrame, columns: list[str], keys: list[str], folds: int = 5, label: str = "label", seed: int = 0) -> DataFrame:
    """``fold``, ``rows`` and ``accuracy``: each of so many parts, dealt by a hash of the keys, predicted by a model of the others."""
    known = features.where(F.col(label).isNotNull()).withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(folds)).cast("int"))
    found = None
    for fold in range(folds):
        model = fit_labeller(known.where(F.col("fold") != fold), columns)
        told = predict_labels(model, known.where(F.col("fold") == fold))
        share = told.agg(F.lit(fold).alias("fold"), F.count(F.lit(1)).alias("rows"), F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("accuracy"))
        found = share if found is None else found.unionByName(share)
    return found


def apply_thresholds(predicted: DataFrame, thresholds: dict[str, float], label: str = "predicted", chance: str = "chance", none: str = "NONE") -> DataFrame:
    """Labels below the threshold of their class become NONE; classes without one keep theirs."""
    table = F.create_map(*[F.lit(x) for k, v in thresholds.items() for x in (k, float(v))])
    return predicted.withColumn(label, F.when(F.col(chance) < F.coalesce(table[F.col(label)], F.lit(0.0)), none).otherwise(F.col(label)))
