"""Language identification by naive Bayes over hashed character n-grams (operator 9).

A multinomial model counts the n-grams of lower-cased text in a fixed number of
hashed buckets for each language.  Its matrix of log probabilities has a size
that only the number of buckets and languages sets; it is broadcast.  The
n-grams of a batch of texts are a sparse matrix of rows and buckets, of which a
bounded number of entries is held at a time; its product with the broadcast
matrix, a language after the other, gives the scores of all texts of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordgrove.llm.common import session_of

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: The model learns from about so many labelled rows at most, chosen by a hash of their id and text.
MAX_TRAINING_ROWS = 40_000
#: But each language has about so many rows at least, or all that it has.
LANGUAGE_ROWS = 1000
#: For the score, the log posterior is taken as that of so many n-grams, so that scores of long texts stay apart.
EVIDENCE = 30
UNDETERMINED = "und"
#: Code points whose n-grams are scored at once.
BLOCK_POINTS = 1 << 17
#: Bound of the broadcast matrix.
MAX_LANGUAGES = 512

_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], dtype=np.uint32)


def _hashed(points: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """The bucket of the n-gram of one order that starts at each code point."""
    hashed = np.full(len(points) - order + 1, order, dtype=np.uint32)
    for i in range(order):
        hashed = (hashed ^ points[i : len(points) - order + 1 + i]) * _MULTIPLIERS[i % len(_MULTIPLIERS)]
        hashed ^= hashed >> np.uint32(15)
    return hashed & np.uint32(buckets - 1)


def _points(text: str) -> np.ndarray:
    """The code points of a text, lower-cased and framed by spaces."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)


def buckets_of(text: str, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """The hashed buckets of all n-grams of a text, lower-cased and framed by spaces."""
    points = _points(text)
    return np.concatenate([_hashed(points, order, buckets) for order in orders if len(points) >= order])


def sparse_rows(texts: list[str], buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, block: int = BLOCK_POINTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams of texts as entries (row, bucket) of a sparse matrix, those of about ``block`` code points at a time.

    A text longer than a block is cut in pieces, each with so many more points as
    the n-grams that start in it reach over its end.
    """
    longest = max(orders)
    held: list[tuple[int, np.ndarray, int]] = []  # row, points, how many n-grams may start there
    size = 0

    def entries() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lengths = np.array([len(points) for _, points, _ in held])
        flat = np.concatenate([points for _, points, _ in held])
        row = np.repeat(np.array([r for r, _, _ in held]), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = np.repeat(lengths, lengths) - place
        starts = place < np.repeat(np.array([n for _, _, n in held]), lengths)
        for order in orders:
            if len(flat) >= order:
                kept = np.flatnonzero(starts & (left >= order))
                yield row[kept], _hashed(flat, order, buckets)[kept]

    for i, text in enumerate(texts):
        points = _points(text)
        for at in range(0, len(points), block):
            held.append((i, points[at : at + block + longest - 1], min(block, len(points) - at)))
            size += len(held[-1][1])
            if size >= block:
                yield from entries()
                held, size = [], 0
    if held:
        yield from entries()


@dataclass(frozen=True)
class Model:
    """Languages in order, their log priors, and log probabilities by bucket and language."""

    languages: tuple[str, ...]
    priors: np.ndarray
    matrix: np.ndarray


def rows_for_each(sizes: list[int], max_rows: int, least: int = LANGUAGE_ROWS) -> int:
    """The number of rows up to which every language is used, so that all together come to ``max_rows`` at most; ``least`` at least."""
    left = max_rows
    for i, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - i) > left:
            return max(left // (len(sizes) - i), least)
        left -= size
    return max(sizes)


def train(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    max_rows: int = MAX_TRAINING_ROWS,
    buckets: int = BUCKETS,
    orders: tuple[int, ...] = ORDERS,
    smoothing: float = SMOOTHING,
) -> Model:
    """A model from rows with a text and a label; without any, one without languages.

    Of rare languages all rows are used, of the others about as many as of each other.
    """
    spark = session_of(df)
    labelled = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {row.lang: row["count"] for row in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Model((), np.zeros(0), np.zeros((buckets, 0), np.float32))
    most = rows_for_each(list(sizes.values()), max_rows)
    shares = [x for lang, n in sizes.items() if n > most for x in (F.lit(lang), F.lit(int(most / n * (1 << 30))))]
    bound = F.coalesce(F.create_map(*shares)[F.col("lang")], F.lit(1 << 30)) if shares else None
    sample = labelled.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < bound) if shares else labelled
    languages = tuple(sorted(sizes))
    place = {lang: i for i, lang in enumerate(languages)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(0)):
                counts[place[lang]] += np.bincount(buckets_of(text.as_py(), buckets, orders), minlength=buckets)
        rows, columns = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array(columns.astype(np.int32)), pa.array(counts[rows, columns])], names=["place", "bucket", "n"])

    total = sample.select("text", "lang").mapInArrow(counted, "place int, bucket int, n long").groupBy("place", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((buckets, len(languages)))
    counts[total["bucket"].to_numpy(), total["place"].to_numpy()] = total["n"].to_numpy()
    matrix = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * buckets)
    priors = np.log(np.array([sizes[x] for x in languages]) / sum(sizes.values()))
    return Model(languages, priors, matrix.astype(np.float32))


def predict(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """All columns of every row, ``lang_pred`` and ``score`` (the tempered posterior, 0 to 1).

    The language is that of the highest posterior of the whole text; only the
    score is tempered.
    ``lang_pred`` is ``und``, with a score of 0, for a null text, a text without a
    letter, and a model without languages.  Ties go to the first language by name.
    Columns of those two names in the input are replaced.
    """
    spark = session_of(df)
    kept = df.drop("lang_pred", "score")
    held = spark.sparkContext.broadcast(model)
    at = kept.columns.index(text_col)
    names = [*kept.columns, "lang_pred", "score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        by_language = np.ascontiguousarray(model.matrix.T)
        for batch in batches:
            texts = [x.as_py() for x in batch.column(at)]
            told = [i for i, text in enumerate(texts) if text and model.languages and any(map(str.isalpha, text))]
            likelihood, grams = np.zeros((len(told), len(model.languages))), np.zeros(len(told), np.int64)
            for rows, found in sparse_rows([texts[i] for i in told], len(model.matrix), orders):
                first, last = int(rows[0]) if len(rows) else 0, int(rows[-1]) + 1 if len(rows) else 0
                grams[first:last] += np.bincount(rows - first, minlength=last - first)
                for j, column in enumerate(by_language):
                    likelihood[first:last, j] += np.bincount(rows - first, weights=column[found], minlength=last - first)
            names_of, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if told:
                tempered = (likelihood + model.priors) * (np.minimum(grams, EVIDENCE) / grams)[:, None]
                odds = np.exp(tempered - tempered.max(axis=1, keepdims=True))
                best = odds.argmax(axis=1)
                scores[told] = odds[np.arange(len(told)), best] / odds.sum(axis=1)
                for i, j in zip(told, best.tolist()):
                    names_of[i] = model.languages[j]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names_of, pa.string()), pa.array(scores)], names=names)

    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(scored, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: the CRC-32 of its id, as text, leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that aren't held out."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(documents.where(~held_out(F.col("doc_id"))))
    predicted = predict(documents.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
