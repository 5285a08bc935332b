"""Benchmark decontamination by latent semantic retrieval (operator 4).

1. Document frequencies of the benchmark's words are counted over the whole
   corpus.
2. A randomised SVD gives a latent space: all texts are cut in passages, the
   Gram matrix of their TF-IDF rows is sketched by one random matrix task by
   task, and the sketches are summed in a tree.  The items stand among the rows
   with a weight of their own, so that the space, whose rank is bounded, lies
   near them.  Words that no item has can't bear on a cosine and are left out.
3. Every text is cut in windows that overlap: for an item, windows of one and a
   half times its length at least, and wider ones for passages that are spread
   out.  All windows are projected, and an item is a candidate where its cosine
   with the window is high enough.  Only a window with fewer known words than the
   common subsequence needs is passed over.
4. A candidate counts if the longest common subsequence of words covers enough
   of the item, and if enough of its answer words (those with the highest inverse
   document frequency) stand in the window.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgrove.llm.common import folded, partition_states, session_of

RANK, OVERSAMPLE = 192, 32
#: Share of the items, against that of all passages of the corpus, in what the latent space is learnt from.
ITEM_WEIGHT = 0.9
#: Items of one broadcast; more are taken in blocks of this size.
BLOCK_ITEMS = 500
#: Items of fewer words are left out: too many texts hold them by chance.
MIN_ITEM_WORDS = 4
MIN_COSINE, MIN_COMMON, MIN_ANSWERS = 0.4, 0.6, 0.6
ANSWER_WORDS = 6
#: Smallest windows in words, and how much wider the next ones are: narrow ones, then wide ones.
NARROW, WIDE = (12, 1.5), (96, 2)
#: Words of a passage of the corpus.
PASSAGE = 96
#: Words that are projected at once, few enough for their rows to lie in a cache.
SPAN = 8192
#: Input splits whose passages one task sketches, so that sketches are small against what is read.
SPLITS_A_TASK = 8
#: Bytes that words are made of stay, all others become spaces.
_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased: runs of letters and digits and of characters beyond ASCII, as UTF-8."""
    return (text or "").lower().encode().translate(_WORD_BYTES).split()


def places_of(text: str | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The places in a vocabulary of a text's words, -1 for those it hasn't."""
    words = words_of(text)
    return np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))


def common_subsequence(a: list[int], b: list[int]) -> int:
    """The length of the longest common subsequence, a word of ``b`` at a time over bits for ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    rest = full
    for y in b:
        if mask := masks.get(y):
            met = rest & mask
            rest = ((rest + met) | (rest - met)) & full
    return len(a) - rest.bit_count()


@dataclass(frozen=True)
class Index:
    """What retrieval needs of a block of items: words, weights, the latent basis and the items in it."""

    vocabulary: dict[bytes, int]
    idf: np.ndarray
    basis: np.ndarray
    latent: np.ndarray
    item_ids: list
    items: list[list[int]]
    answers: list[list[int]]
    #: Windows in words, and the items held against them.
    classes: list[tuple[int, np.ndarray]]


def _classes(lengths: list[int]) -> list[tuple[int, np.ndarray]]:
    """Sizes of windows and their items; every item is in a wide one and, unless that is hardly less, in a narrow one, each of at least one and a half times its length."""

    def size_for(n: int, size: int, ratio: float) -> int:
        while 2 * size < 3 * n:
            size = math.ceil(size * ratio)
        return size

    members: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        narrow, wide = size_for(n, *NARROW), size_for(n, *WIDE)
        for size in {wide, narrow} if 3 * narrow <= 2 * wide else {wide}:
            members.setdefault(size, []).append(i)
    return [(size, np.array(members[size])) for size in sorted(members)]


def _tfidf(places: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and unit-length TF-IDF weights of the known words among places."""
    terms, counts = np.unique(places[places >= 0], return_counts=True)
    weights = counts * idf[terms]
    norm = np.sqrt((weights * weights).sum())
    return terms, weights / norm if norm else weights


def _gram_times(passage: np.ndarray, term: np.ndarray, idf: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Terms, the rows of X'X times ``test`` at them, and the number of rows of X: unit TF-IDF rows of the words' passages."""
    passages, row = np.unique(passage, return_inverse=True)
    terms, column = np.unique(term, return_inverse=True)
    # as many rows and columns as the words at hand have, a few thousand words at most
    weights = np.bincount(row * len(terms) + column, minlength=len(passages) * len(terms)).reshape(len(passages), -1) * idf[terms]
    weights = (weights / np.sqrt((weights * weights).sum(axis=1, keepdims=True))).astype(np.float32)
    return terms, weights.T @ (weights @ test[terms]), len(passages)


def document_frequencies(texts: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many texts each word of a vocabulary stands, and how many texts there are, over the whole column ``text``."""
    spark = session_of(texts)
    held = spark.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, n = held.value, np.zeros(len(held.value), np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                counts[[words[w] for w in words.keys() & set(words_of(text.as_py()))]] += 1
                n += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], n))], names=["term", "n"])

    found = texts.select("text").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    terms, numbers = found["term"].to_numpy(), found["n"].to_numpy()
    counts = np.zeros(len(vocabulary), np.int64)
    counts[terms[terms >= 0]] = numbers[terms >= 0]
    return counts, int(numbers[terms < 0].sum())


def corpus_sketch(texts: DataFrame, vocabulary: dict[bytes, int], idf: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, int]:
    """The Gram matrix of all passages' TF-IDF rows times the matrix ``test``, and the number of passages with known words.

    A task adds up matrices of terms by columns of ``test``, whose size the
    benchmark sets; they are summed in a tree.
    """
    spark = session_of(texts)
    held = spark.sparkContext.broadcast((vocabulary, idf, test))

    def sketched(batches: Iterator[pa.RecordBatch]) -> bytes:
        words, idf, test = held.value
        total, n = np.zeros(test.shape), 0
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = base = 0

        def settle() -> None:
            nonlocal n, size, base
            if size:
                terms, rows, more = _gram_times(np.concatenate([x for x, _ in waiting]), np.concatenate([x for _, x in waiting]), idf, test)
                total[terms] += rows
                n += more
            waiting.clear()
            size = base = 0

        for batch in batches:
            for text in batch.column(0):
                found = places_of(text.as_py(), words)
                # whole passages only, so that none is cut between two products
                for start in range(0, len(found), SPAN // PASSAGE * PASSAGE):
                    part = found[start : start + SPAN // PASSAGE * PASSAGE]
                    at = np.flatnonzero(part >= 0)
                    waiting.append((base + at // PASSAGE, part[at]))
                    base += len(part) // PASSAGE + 1
                    size += len(at)
                    if size >= SPAN:
                        settle()
        settle()
        at = np.flatnonzero(total.any(axis=1))
        return pickle.dumps((at, total[at].astype(np.float32), n))

    def summed(states: list[bytes]) -> bytes:
        total, n = np.zeros(test.shape), 0
        for state in states:
            at, rows, more = pickle.loads(state)
            total[at] += rows
            n += more
        at = np.flatnonzero(total.any(axis=1))
        return pickle.dumps((at, total[at].astype(np.float32), n))

    column = texts.select("text")
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(column.rdd.getNumPartitions() / SPLITS_A_TASK))
    at, rows, n = pickle.loads(folded(partition_states(column.coalesce(tasks), sketched), summed))
    whole = np.zeros(test.shape)
    whole[at] = rows
    return whole, n


def latent_basis(texts: DataFrame, vocabulary: dict[bytes, int], idf: np.ndarray, items: list[list[int]], rank: int = RANK, item_weight: float = ITEM_WEIGHT, seed: int = 0) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF rows of all passages and items, by a randomised SVD of one pass.

    The sketch Y = A Q of the weighted Gram matrix A gives its Nystrom form
    Y (Q'Y)^-1 Y', whose eigenvectors are those of Y (Q'Y)^-1/2.
    """
    n_terms = len(vocabulary)
    test = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_terms, min(rank + OVERSAMPLE, n_terms))))[0].astype(np.float32)
    sketch, n = corpus_sketch(texts, vocabulary, idf, test)
    sketch *= (1 - item_weight) / max(n, 1)
    for item in items:
        terms, rows, _ = _gram_times(np.zeros(len(item), np.int64), np.array(item), idf, test)
        sketch[terms] += rows * (item_weight / len(items))
    inner = test.T.astype(float) @ sketch
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    sound = values > 1e-6 * values[-1]
    left, _, _ = np.linalg.svd(sketch @ (vectors[:, sound] / np.sqrt(values[sound])), full_matrices=False)
    return left[:, :rank]


def build_index(texts: DataFrame, item_ids: list, item_texts: list[str], *, rank: int = RANK) -> Index:
    """An index of items, with document frequencies and a latent space of the column ``text``."""
    split = [words_of(t) for t in item_texts]
    vocabulary = {w: i for i, w in enumerate(sorted({w for words in split for w in words}))}
    frequency, n_texts = document_frequencies(texts, vocabulary)
    idf = np.log((n_texts + 1) / (frequency + 1)) + 1e-3
    items = [[vocabulary[w] for w in words] for words in split]
    basis = latent_basis(texts, vocabulary, idf, items, rank)
    latent = np.array([w @ basis[t] for t, w in (_tfidf(np.array(x, np.int64), idf) for x in items)])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    answers = [sorted(set(x), key=lambda t: (-idf[t], t))[:ANSWER_WORDS] for x in items]
    return Index(vocabulary, idf, basis.astype(np.float32), latent.astype(np.float32), list(item_ids), items, answers, _classes(list(map(len, items))))


def _windows(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text, start and end of windows a third apart over texts of these lengths laid end to end; the last of a text ends with it."""
    stride = window // 3
    each = np.where(lengths > 0, 1 + -(-np.maximum(lengths - window, 0) // stride), 0)
    text = np.repeat(np.arange(len(lengths)), each)
    number = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    start = np.minimum(number * stride, np.maximum(lengths[text] - window, 0))
    end = np.minimum(start + window, lengths[text])
    before = (np.cumsum(lengths) - lengths)[text]
    return text, start + before, end + before


def _running_sums(rows: np.ndarray, places: np.ndarray, size: int = 32) -> np.ndarray:
    """Sums of the first 0, 1, 2 ... of the rows at some places, by products of ``size`` rows with a triangle, which are faster than sums row by row."""
    padded = np.zeros((-(-(len(places) + 1) // size) * size, rows.shape[1]), np.float32)
    padded[1 : len(places) + 1] = rows[places]
    sums = np.tri(size, dtype=np.float32) @ padded.reshape(-1, size, rows.shape[1])
    sums[1:] += np.cumsum(sums[:-1, -1], axis=0)[:, None]
    return sums.reshape(padded.shape)


def candidates(found: np.ndarray, lengths: np.ndarray, index: Index, min_cosine: float = MIN_COSINE, min_common: float = MIN_COMMON) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts, starts, ends, items and cosines of all windows that are near an item in the latent space, some at a time.

    ``found`` holds the places in the vocabulary of the words of all texts, -1
    for others, and ``lengths`` the number of words of each text.
    """
    told = np.concatenate([[0], np.cumsum(found >= 0)])
    weighted = index.basis * index.idf.astype(np.float32)[:, None]
    planned = []
    for window, members in index.classes:
        text, start, end = _windows(lengths, window)
        needed = math.ceil(min_common * min(len(index.items[i]) for i in members))
        kept = told[end] - told[start] >= needed
        planned.append((window, members, index.latent[members].T, text[kept], start[kept], end[kept]))
    span = max(SPAN, *(window for window, _ in index.classes))
    for base in range(0, len(found), span):
        part = [(x, *np.searchsorted(x[4], [base, base + span])) for x in planned]
        ends = [int(x[5][high - 1]) for x, low, high in part if high > low]
        if not ends:
            continue
        known = found[base : max(ends)]
        sums = _running_sums(weighted, known[known >= 0])
        for (_, members, latent, text, start, end), low, high in part:
            places = sums[told[end[low:high]] - told[base]] - sums[told[start[low:high]] - told[base]]
            norms = np.maximum(np.sqrt(np.einsum("ij,ij->i", places, places)), 1e-12)
            cosines = places @ latent
            rows, columns = np.nonzero(cosines >= min_cosine * norms[:, None])
            yield text[low + rows], start[low + rows], end[low + rows], members[columns], cosines[rows, columns] / norms[rows]


def best_matches(texts: list[str | None], index: Index, min_cosine: float = MIN_COSINE, min_common: float = MIN_COMMON, min_answers: float = MIN_ANSWERS) -> dict[int, tuple[int, float, float]]:
    """Of every text that holds an item: the place, cosine and common share of the one that its windows hold most of."""
    split = [places_of(text, index.vocabulary) for text in texts]
    lengths = np.array([len(x) for x in split], np.int64)
    found = np.concatenate([np.zeros(0, np.int64), *split])
    # where each word stands, as keys in the order of words and places
    keys = np.sort(found * (len(found) + 1) + np.arange(len(found)))
    asked = np.array([[*x, *[-2] * (ANSWER_WORDS - len(x))] for x in index.answers])
    needed = min_answers * (asked >= 0).sum(axis=1)
    best: dict[int, tuple[int, float, float]] = {}
    for text, start, end, item, cosine in candidates(found, lengths, index, min_cosine, min_common):
        present = np.zeros(len(item), np.int64)
        for word in asked[item].T:
            first = np.searchsorted(keys, word * (len(found) + 1) + start)
            present += (word >= 0) & (keys[np.minimum(first, len(keys) - 1)] < word * (len(found) + 1) + end) & (first < len(keys))
        kept = present >= needed[item]
        for t, begin, close, i, near in zip(*(x[kept].tolist() for x in (text, start, end, item, cosine))):
            common = common_subsequence(index.items[i], found[begin:close].tolist()) / len(index.items[i])
            if common >= min_common and (t not in best or (common, near, -i) > (best[t][2], best[t][1], -best[t][0])):
                best[t] = (i, near, common)
    return best


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rank: int = RANK,
    min_cosine: float = MIN_COSINE,
    min_common: float = MIN_COMMON,
    min_answers: float = MIN_ANSWERS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """All columns of every row, ``leak`` (boolean), ``leaked_item``, ``leak_cosine`` and ``leak_common``.

    ``leaked_item`` is the item that the text holds most of (ties: the higher
    cosine, then the smaller id), null where none is found.  Null and empty texts
    hold nothing; items of fewer than ``MIN_ITEM_WORDS`` words are left out, as single
    words and short phrases stand in many texts by chance; an empty benchmark leaves
    every row clean.  Every text of an id that has several is an item, and so is
    that of a null id: a row that holds it is a leak whose ``leaked_item`` is null.  Input columns of those four names are
    replaced.  Items come to the driver in blocks of ``block_items``.
    """
    spark = session_of(df)
    df = df.drop("leak", "leaked_item", "leak_cosine", "leak_common")
    item_type = dict(benchmark.dtypes)[item_id_col]
    listed = benchmark.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("item_text")).where("item_text IS NOT NULL")
    listed = listed.distinct().where(F.col("item_text").rlike(r"[\p{L}\p{N}]"))
    blocks, last = [], None
    while True:
        more = listed
        if last is not None:
            # null ids come first
            later = F.col("item_id").isNotNull() if last.item_id is None else F.col("item_id") > F.lit(last.item_id)
            more = listed.where(later | (F.col("item_id").eqNullSafe(F.lit(last.item_id)) & (F.col("item_text") > F.lit(last.item_text))))
        rows = [r for r in more.orderBy("item_id", "item_text").limit(block_items).collect()]
        if not rows:
            break
        last = rows[-1]
        kept = [r for r in rows if len(words_of(r.item_text)) >= MIN_ITEM_WORDS]
        if kept:
            blocks.append(build_index(df.select(F.col(text_col).alias("text")), [r.item_id for r in kept], [r.item_text for r in kept], rank=rank))
        if len(rows) < block_items:
            break
    if not blocks:
        return df.select("*", F.lit(False).alias("leak"), F.lit(None).cast(item_type).alias("leaked_item"), F.lit(None).cast("double").alias("leak_cosine"), F.lit(None).cast("double").alias("leak_common"))
    for index in blocks:
        df = _marked(df, spark.sparkContext.broadcast(index), text_col, item_type, min_cosine, min_common, min_answers)
    return df


def _marked(df: DataFrame, held, text_col: str, item_type: str, min_cosine: float, min_common: float, min_answers: float) -> DataFrame:
    """The rows with the best item of one block, or of an earlier one."""
    if "leaked_item" not in df.columns:
        df = df.select("*", F.lit(False).alias("leak"), F.lit(None).cast(item_type).alias("leaked_item"), F.lit(None).cast("double").alias("leak_cosine"), F.lit(None).cast("double").alias("leak_common"))
    at, names = df.columns.index(text_col), df.columns

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            columns = [list(batch.column(i).to_pylist()) for i in (-4, -3, -2, -1)]
            texts = batch.column(at).to_pylist()
            for row, best in best_matches(texts, index, min_cosine, min_common, min_answers).items():
                if not columns[0][row] or (best[2], best[1]) > (columns[3][row], columns[2][row]):
                    columns[0][row], columns[1][row], columns[2][row], columns[3][row] = True, index.item_ids[best[0]], best[1], best[2]
            kinds = [batch.schema.field(i).type for i in range(len(names) - 4, len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-4], *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    return df.mapInArrow(matched, df.schema)


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Whether each document holds a benchmark item, and which."""
    found = find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "leak", "leaked_item", F.round("leak_cosine", 4).alias("leak_cosine"), "leak_common")
