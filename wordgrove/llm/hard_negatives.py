"""Hard negatives by threshold joins on vectors (operator 11).

For an anchor and each of its positives, the rows of other labels that score best
within a window under the positive's score.  Both searches are joins of anchors
with all rows whose score reaches a threshold, an anchor's own:

* Thresholds.  Mean and covariance of all rows tell the mean and spread of an
  anchor's scores, hence a threshold that a wanted number of rows should reach.
  Anchors whose lists or windows aren't full at it come again with a lower one,
  in the end with none, so what is returned doesn't rest on the estimate.
* Index.  Dimensions have one order for all vectors.  A row's trailing dimensions
  are left out of the index as long as their norm times the greatest norm that an
  anchor has there stays under the least threshold: such a part alone can't reach
  it.  What is left out is kept beside the index for verification.
* Partial scores.  Scores are accumulated over groups of indexed dimensions.  After
  each group, pairs go whose partial score and remaining norms can't reach the
  anchor's threshold.  The pairs that are left are scored exactly.

Rows stay where they lie: anchors are a stated set of queries, and come to all
rows in blocks of bounded size, so nothing is shuffled but what was found.  Of rows
equal in label and vector only as many as a list can hold are searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.llm.common import folded, new_path, partition_states, session_of, written

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 30, 90
#: Every row whose id is divisible by the first is an anchor; where it is by the second, its label is moved on by one of so many.
ANCHOR_STEP, MOVED_STEP, LABELS = 100, 7, 10
SCALE = 256
#: Components of this size and more have no exact integers.
MOST = float(1 << 44)
#: Anchors that are held against all rows at a time, and rows and anchors of one product of matrices.
BLOCK_ANCHORS, TILE_ROWS, TILE_ANCHORS = 16_384, 2048, 1024
#: Dimensions that are accumulated between two prunings.
GROUP_DIMS = 16
#: Rows that the first threshold should let through, and how many times more every lower one.
FIRST_HITS, MORE_HITS = 256, 8
#: Share of the pairs under which they are scored one by one.
FEW = 0.05
_EXACT = float(1 << 53)
_LAST = np.iinfo(np.int64).max


@dataclass
class Anchors:
    """A block of anchors: number, label, vector, threshold, and the scores of the positives whose windows aren't full (below 0 for no window)."""

    numbers: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    thresholds: np.ndarray
    positives: np.ndarray

    def only(self, chosen: np.ndarray) -> Anchors:
        return Anchors(self.numbers[chosen], self.labels[chosen], self.vectors[chosen], self.thresholds[chosen], self.positives[chosen])


@dataclass(frozen=True)
class Moments:
    """Rows, mean and covariance of all vectors, and the order of dimensions, the widest first."""

    n: int
    mean: np.ndarray
    covariance: np.ndarray

    @property
    def order(self) -> np.ndarray:
        return np.argsort(-(np.diag(self.covariance) + self.mean**2), kind="stable")

    def spread(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and standard deviation of the scores of vectors against all rows."""
        deviation = np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", vectors, self.covariance, vectors), 0.0))
        return vectors @ self.mean, np.maximum(deviation, 1e-9)

    def threshold(self, vectors: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Scores that so many rows should reach; minus infinity for a third of all rows or more."""
        mean, deviation = self.spread(vectors)
        share = np.clip(hits / self.n, 1e-15, 1 / 3)
        quantile = np.array([NormalDist().inv_cdf(1 - s) for s in share])
        return np.where(hits * 3 >= self.n, -np.inf, np.floor(mean + quantile * deviation))


def _partial_norms(vectors: np.ndarray, starts: list[int]) -> np.ndarray:
    """The norms of what comes from each start on, one column for each, a little rounded up."""
    squares = np.cumsum((vectors * vectors)[:, ::-1], axis=1)[:, ::-1]
    squares = np.concatenate([squares, np.zeros((len(vectors), 1))], axis=1)
    return np.sqrt(squares[:, starts]) + 1e-9 * np.sqrt(squares[:, :1])


def reaching_pairs(rows: np.ndarray, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows and anchors of all pairs whose score may reach the anchor's threshold; dimensions are in order, the widest first."""
    dim = rows.shape[1]
    starts = [*range(0, dim, GROUP_DIMS), dim]
    of_rows, of_anchors = _partial_norms(rows, starts), _partial_norms(anchors, starts)
    least = thresholds.min()
    # the index of a row ends where the rest of it can't reach any threshold with the rest of any anchor
    covered = of_rows * of_anchors.max(axis=0) < least
    ends = np.where(covered.any(axis=1), covered.argmax(axis=1), len(starts) - 1)
    order = np.argsort(-ends, kind="stable")
    alive = None
    scores, rest = np.zeros((len(rows), len(anchors))), of_rows[order]
    indexed = np.searchsorted(-ends[order], -np.arange(1, len(starts)), side="right")
    for k, held in enumerate(indexed):
        if not held:
            break
        part = order[:held]
        here = slice(starts[k], starts[k + 1])
        scores[:held] += rows[part, here] @ anchors[:, here].T
        # rows whose index ends here have no part in later groups: the bound with all that is left has been held against them
        open_ = scores[:held] + rest[:held, [k + 1]] * of_anchors[:, k + 1] >= thresholds
        alive = open_ if alive is None else np.concatenate([alive[:held] & open_, alive[held:]])
        if alive.mean() < FEW:
            break
    if alive is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # rows that aren't indexed at all can't reach a threshold, and are not among these
    i, j = np.nonzero(alive)
    return order[i], j


def exact_scores(rows: np.ndarray, anchors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs of rows of two integer arrays."""
    if not len(i):
        return np.zeros(0, np.int64)
    float_rows, float_anchors = rows.astype(np.float64), anchors.astype(np.float64)
    largest = float(np.sqrt((float_rows**2).sum(axis=1).max()) * np.sqrt((float_anchors**2).sum(axis=1).max()))
    if largest < _EXACT:
        if len(i) > FEW * len(rows) * len(anchors):
            return (float_rows @ float_anchors.T)[i, j].astype(np.int64)
        parts = [np.einsum("ij,ij->i", float_rows[i[a : a + 65536]], float_anchors[j[a : a + 65536]]) for a in range(0, len(i), 65536)]
        return np.concatenate(parts).astype(np.int64)
    products = [sum(int(x) * int(y) for x, y in zip(rows[a], anchors[b])) for a, b in zip(i, j)]
    if max(map(abs, products)) >= 1 << 63:
        raise OverflowError("scores are beyond a long")
    return np.array(products, np.int64)


class _Best:
    """The best hits of every list (anchor and window), gathered in one task."""

    def __init__(self, size: int) -> None:
        self.size, self.parts, self.held = size, [], 0

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(lists):
            self.parts.append((lists, scores, ids))
            self.held += len(lists)
            if self.held > 1 << 19:
                self.shrink()

    def shrink(self) -> None:
        if not self.parts:
            return
        lists, scores, ids = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, -scores, lists))
        lists, scores, ids = lists[order], scores[order], ids[order]
        first = np.flatnonzero(np.diff(lists, prepend=-1))
        place = np.arange(len(lists)) - np.repeat(first, np.diff(np.append(first, len(lists))))
        keep = place < self.size
        self.parts = [(lists[keep], scores[keep], ids[keep])]
        self.held = int(keep.sum())


def _search(rows: DataFrame, anchors: Anchors, order: np.ndarray, negatives: bool) -> DataFrame:
    """``number``, ``place`` (of the positive), ``score`` and ``vec_id`` of what reaches the thresholds, the best of each task.

    Without ``negatives`` the rows of the anchor's label; with them, the rows of
    other labels that lie in a positive's window.
    """
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        dim = known.vectors.shape[1]
        best = _Best(NEGATIVES if negatives else POSITIVES + 1)
        turned = known.vectors[:, order].astype(np.float64)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(at, TILE_ROWS)
                ids = part.column(0).fill_null(_LAST).to_numpy()
                labels = part.column(1).to_numpy()
                x = part.column(2).flatten().to_numpy().reshape(-1, dim)
                wide = x[:, order].astype(np.float64)
                for a in range(0, len(turned), TILE_ANCHORS):
                    tile = slice(a, a + TILE_ANCHORS)
                    if np.isneginf(known.thresholds[tile]).any():
                        i, j = (v.ravel() for v in np.indices((len(x), len(turned[tile]))))
                    else:
                        i, j = reaching_pairs(wide, turned[tile], known.thresholds[tile])
                    fits = (labels[i] != known.labels[tile][j]) if negatives else (labels[i] == known.labels[tile][j])
                    i, j = i[fits], j[fits]
                    scores = exact_scores(x, known.vectors[tile], i, j)
                    reached = scores >= known.thresholds[tile][j]
                    i, j, scores = i[reached], j[reached] + a, scores[reached]
                    if not negatives:
                        best.add(j, scores, ids[i])
                        continue
                    for place in range(known.positives.shape[1]):
                        positive = known.positives[j, place]
                        inside = (positive >= 0) & (LOWEST * positive <= 100 * scores) & (100 * scores <= HIGHEST * positive)
                        best.add(j[inside] * POSITIVES + place, scores[inside], ids[i[inside]])
        best.shrink()
        lists, scores, ids = best.parts[0] if best.parts else (np.zeros(0, np.int64),) * 3
        owner, place = (lists // POSITIVES, lists % POSITIVES) if negatives else (lists, lists * 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(known.numbers[owner], pa.int64()), pa.array(place.astype(np.int32)), pa.array(scores, pa.int64()), pa.array(ids, pa.int64(), mask=ids == _LAST)],
            names=["number", "place", "score", "vec_id"],
        )

    return rows.mapInArrow(run, "number long, place int, score long, vec_id long")


def _ranked(hits: DataFrame, size: int) -> DataFrame:
    """The first of every list with their ``rank``, higher scores first, then smaller ids, null ids last."""
    order = Window.partitionBy("number", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _moments(rows: DataFrame, dim: int) -> Moments:
    def gather(batches: Iterator[pa.RecordBatch]) -> bytes:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, dim).astype(np.float64)
            one = np.concatenate([x, np.ones((len(x), 1))], axis=1)
            total += one.T @ one
        return total.tobytes()

    raw = folded(partition_states(rows.select("x"), gather), lambda states: sum(np.frombuffer(s) for s in states).tobytes())
    total = np.frombuffer(raw).reshape(dim + 1, dim + 1)
    n = max(int(total[dim, dim]), 1)
    mean = total[dim, :dim] / n
    return Moments(n, mean, total[:dim, :dim] / n - np.outer(mean, mean))


def _positives(rows: DataFrame, block: Anchors, own: np.ndarray, moments: Moments) -> list[list[tuple[int, int | None]]]:
    """For each anchor of a block its positives, (score, id), thresholds being lowered until there are enough."""
    found: list[list[tuple[int, int | None]]] = [[] for _ in block.numbers]
    open_, hits = np.arange(len(block.numbers)), FIRST_HITS * LABELS
    place = {number: k for k, number in enumerate(block.numbers.tolist())}
    while len(open_):
        asked = block.only(open_)
        asked.thresholds = moments.threshold(asked.vectors.astype(np.float64), np.full(len(open_), float(hits)))
        lists: dict[int, list[tuple[int, int | None]]] = {}
        for row in _ranked(_search(rows, asked, moments.order, negatives=False), POSITIVES + 1).orderBy("number", "rank").collect():
            lists.setdefault(place[row.number], []).append((row.score, row.vec_id))
        left = []
        for k, threshold in zip(open_.tolist(), asked.thresholds):
            mine = lists.get(k, [])
            if len(mine) <= POSITIVES and threshold != -np.inf:
                left.append(k)
                continue
            itself = (int((block.vectors[k].astype(object) ** 2).sum()), int(own[k]))
            if itself in mine:
                mine.remove(itself)  # the anchor's own row
            found[k] = mine[:POSITIVES]
        open_, hits = np.array(left, np.int64), hits * MORE_HITS
    return found


def _negatives(rows: DataFrame, block: Anchors, moments: Moments, path: str) -> None:
    """Writes the ranked negatives of a block of anchors with their windows, thresholds being lowered until these are full."""
    spark = rows.sparkSession
    # a window under a score below zero has no rows
    block = block.only((block.positives >= 0).any(axis=1))
    windows, hits, turn = block.positives.copy(), float(FIRST_HITS), 0
    while len(block.numbers):
        vectors = block.vectors.astype(np.float64)
        mean, deviation = moments.spread(vectors)
        lowest = np.where(windows >= 0, windows, _LAST).min(axis=1)
        # rows above the windows come on top of those wanted in them
        above = np.array([1 - NormalDist().cdf(z) for z in np.clip((HIGHEST / 100 * lowest - mean) / deviation, -30, 30)]) * moments.n
        floors = np.ceil(LOWEST / 100 * lowest)
        estimate = moments.threshold(vectors, above + hits)
        block.thresholds, block.positives = np.maximum(estimate, floors), windows
        done = spark.sparkContext.broadcast((block.numbers, estimate <= floors))

        def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, whole = done.value
            for batch in batches:
                yield batch.append_column("whole", pa.array(whole[np.searchsorted(numbers, batch.column(0).to_numpy())]))

        ranked = written(_ranked(_search(rows, block, moments.order, negatives=True), NEGATIVES))
        told = ranked.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("number", "place"))).mapInArrow(full, "number long, place int, score long, vec_id long, rank int, n long, whole boolean")
        told.where(f"whole OR n = {NEGATIVES}").drop("n", "whole").write.parquet(f"{path}/turn={turn}")
        windows = windows.copy()
        windows[estimate <= floors] = -1
        for row in ranked.where(F.col("rank") == NEGATIVES).select("number", "place").collect():
            windows[np.searchsorted(block.numbers, row.number), row.place] = -1
        left = (windows >= 0).any(axis=1)
        block, windows, hits, turn = block.only(left), windows[left], hits * MORE_HITS, turn + 1


def mine(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Rows with a null label or a vector that is null or has a null, non-finite or
    very large component take no part; a component that a shorter vector doesn't
    have counts as zero.  A null id is no anchor and comes last among equal scores.
    Repeated rows and ids each count, but for the anchor's own row.  Anchors without
    positives, and windows without rows, give no rows; an empty table gives none.
    Other columns are ignored.
    """
    spark = session_of(df)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    v = F.col(vector_col).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST / SCALE))
    moved = F.when(F.col(id_col) % MOVED_STEP == 0, (F.col(label_col) + 1) % LABELS).otherwise(F.col(label_col)).cast("long")
    usable = df.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ok).select(F.col(id_col).cast("long").alias("vec_id"), moved.alias("label"), F.transform(v, lambda x: F.floor(x * SCALE)).alias("x"))
    dim = usable.agg(F.max(F.size("x"))).first()[0]
    if not dim:
        return spark.createDataFrame([], schema)
    padded = usable.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))))
    # of rows equal in label and vector no list holds more than these
    equal = Window.partitionBy("label", "x").orderBy(F.asc_nulls_last("vec_id"))
    rows = written(padded.withColumn("_k", F.row_number().over(equal)).where(F.col("_k") <= max(POSITIVES + 1, NEGATIVES)).drop("_k"))
    asked = padded.where(F.col("vec_id") % ANCHOR_STEP == 0)
    moments = _moments(rows, dim)
    blocks = max(1, -(-asked.count() // BLOCK_ANCHORS))
    # numbers of rows in a partition follow one another, so their upper bits name blocks of bounded size
    anchors = written(asked.repartition(blocks).withColumn("number", F.monotonically_increasing_id()).withColumn("block", F.floor(F.col("number") / BLOCK_ANCHORS)))
    path = new_path(spark)
    names = [row.block for row in anchors.select("block").distinct().orderBy("block").collect()]
    spark.createDataFrame([], "number long, place int, score long, vec_id long, rank int").write.parquet(f"{path}/block=-1/turn=0")
    for name in names:
        held = anchors.where(F.col("block") == name).orderBy("number").toArrow()
        own = held["vec_id"].to_numpy()
        numbers = held["number"].to_numpy()
        vectors = held["x"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        block = Anchors(numbers, held["label"].to_numpy(), vectors, np.full(len(own), -np.inf), np.full((len(own), POSITIVES), -1, np.int64))
        found = _positives(rows, block, own, moments)
        for k, listed in enumerate(found):
            block.positives[k, : len(listed)] = [score for score, _ in listed]
        _negatives(rows, block, moments, f"{path}/block={name}")
        _write_positives(spark, f"{path}-positives/block={name}", numbers, own, found)
    if not names:
        return spark.createDataFrame([], schema)
    positives = spark.read.schema("number long, place int, anchor_id long, positive_id long, positive_score long, block long").parquet(f"{path}-positives")
    negatives = spark.read.schema("number long, place int, score long, vec_id long, rank int, block long, turn int").parquet(path)
    joined = negatives.join(positives.drop("block"), ["number", "place"])
    return joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _write_positives(spark, path: str, numbers: np.ndarray, own: np.ndarray, found: list) -> None:
    rows = [(int(n), k, int(a), p, s) for n, a, listed in zip(numbers, own, found) for k, (s, p) in enumerate(listed)]
    spark.createDataFrame(rows, "number long, place int, anchor_id long, positive_id long, positive_score long").write.parquet(path)


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor in ``embeddings``."""
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP11_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS k FROM s WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.k ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10"""
