"""Approximate nearest neighbours by multi-index hashing (operator 5).

Vectors are centred, turned by their principal axes and a learned rotation, and
cut to signs, which gives binary codes.  A code is split into substrings and
indexed under each of them.  Two codes within a Hamming radius r agree, in one
of m substrings at least, up to floor(r / m) bits (pigeonhole), so probing the
buckets that many bit flips around every substring of a query finds every code
within r.

The radius grows with each query: a bounded set of queries, held against all rows
by brute force, tells how far off in code neighbours at an angle are, and a query
is done once the radius takes in its k-th best found so far; the others are
searched again with a larger radius, in the end with all rows.

The index holds codes and sketches of two bytes a component with a bound of their
error.  What can't be among the k best by these bounds is left out, and the
floats of the few others are fetched and ranked.

Buckets lie together in regions, by the first bits of a substring, so that a
query goes to a region once for all of its buckets there.  Regions are split in
blocks of a bounded number of rows; a task holds one block and the queries that
come to it pass by, however many.  Of equal vectors only the k + 1 with the least
ids can be in a result, so no more of them are indexed: a vector that fills a
third of the table isn't compared with itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.llm.common import checkpointed, session_of, written

NEIGHBOURS = 5
#: Every row whose id is divisible by this is a query.
QUERY_STEP = 50
MAX_BITS, SUBSTRING_BITS = 64, 32
#: Bounds of the samples that the rotation and the radius are learnt from.
FIT_ROWS, CALIBRATION_QUERIES = 10_000, 64
#: Share of the true neighbours in the calibration that the radius must take in.
COVERED = 0.985
ROTATIONS = 30
#: Rows of one block of a region, and queries that are held against it at a time.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 256
#: Regions are named by so many bits at most.
REGION_BITS = 16


@dataclass(frozen=True)
class Codes:
    """How a vector is coded: its length, the mean, and a projection to one column a bit."""

    dim: int
    mean: np.ndarray
    turn: np.ndarray

    @property
    def bits(self) -> int:
        return self.turn.shape[1]

    def encode(self, unit: np.ndarray) -> np.ndarray:
        signs = (unit - self.mean) @ self.turn > 0
        return (signs.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """The float64 rows of a list column of usable vectors."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two arrays, in double precision, the same for the same pair wherever it is taken."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def sketches(unit: np.ndarray) -> np.ndarray:
    """A row of bytes for each unit vector: two a component, their scale, and a bound of the error's length."""
    scale = np.abs(unit).max(axis=1, keepdims=True) / 32767
    scale = np.maximum(scale, np.finfo(np.float32).tiny).astype(np.float32)
    levels = np.clip(np.rint(unit / scale.astype(np.float64)), -32767, 32767).astype(np.int16)
    error = np.linalg.norm(unit - levels * scale.astype(np.float64), axis=1) * 1.00001 + 1e-7
    return np.concatenate([levels.view(np.uint8), scale.view(np.uint8), error.astype(np.float32)[:, None].view(np.uint8)], axis=1)


def from_sketches(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The approximate unit vectors and the bounds of their errors."""
    end = raw.shape[1] - 8
    levels, scale, error = (np.ascontiguousarray(raw[:, x:y]).view(kind) for x, y, kind in ((0, end, np.int16), (end, end + 4, np.float32), (end + 4, end + 8, np.float32)))
    return levels * scale, error[:, 0].astype(np.float64)


def _rows_of_bytes(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of equally long values as an array of bytes."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, width)


def fit(sample: np.ndarray, rotations: int = ROTATIONS, seed: int = 0) -> Codes:
    """Principal axes and an iterative-quantisation rotation of a sample of unit vectors."""
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred / len(sample))
    axes = axes[:, ::-1][:, : min(MAX_BITS, dim)]
    held = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rotations):
        u, _, v = np.linalg.svd(np.sign(held @ turn).T @ held)
        turn = (u @ v).T
    return Codes(dim, mean, axes @ turn)


def _best(scores: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row, columns in order of score, ties to the first: k, and all within rounding of the last of them."""
    if scores.shape[1] > k:
        last = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    else:
        last = np.full(len(scores), -np.inf)
    found = []
    for row, limit in zip(scores, last):
        above = np.flatnonzero(row > limit + 1e-12)
        level = np.flatnonzero((row >= limit - 1e-12) & (row <= limit + 1e-12))[:k] if np.isfinite(limit) else np.array([], dtype=np.int64)
        found.append(np.concatenate([above, level]) if np.isfinite(limit) else np.flatnonzero(np.isfinite(row)))
    return found


def _ranked(rows: DataFrame, k: int, *others: str) -> DataFrame:
    """The ``k`` best of each query; an id that has several rows counts with the nearest of them."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = rows.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), *[F.max_by(c, "score").alias(c) for c in others])
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def flips_of(bits: int, most: int) -> np.ndarray:
    """All numbers of so many bits of which at most so many are set."""
    every = np.arange(1 << bits, dtype=np.int64)
    return every[np.bitwise_count(every) <= most]


@dataclass(frozen=True)
class Layout:
    """How codes are cut in substrings, and how many of the first bits of one name its region."""

    bits: int
    substring: int
    region: int

    @property
    def shifts(self) -> range:
        return range(0, self.bits, self.substring)

    def mask(self, shift: int) -> int:
        return (1 << min(self.substring, self.bits - shift)) - 1

    def region_bits(self, shift: int) -> int:
        return min(self.region, REGION_BITS, self.substring, self.bits - shift)


def candidates(codes_a: np.ndarray, codes_b: np.ndarray, table: int, flips: int, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in both) that ``flips`` bits or fewer set apart in a substring, and more in each one before it.

    The second codes are put in buckets by the substring, which are probed by bit
    flips, or all held against the first codes where that is less.
    """
    part = lambda codes, t: (codes >> np.uint64(layout.shifts[t])) & np.uint64(layout.mask(layout.shifts[t]))
    own, other = part(codes_a, table).astype(np.int64), part(codes_b, table).astype(np.int64)
    order = np.argsort(other, kind="stable")
    values, first, counts = np.unique(other[order], return_index=True, return_counts=True)
    bits = layout.mask(layout.shifts[table]).bit_length()
    if sum(comb(bits, n) for n in range(flips + 1)) < len(values):
        masks = np.array([sum(1 << i for i in chosen) for n in range(flips + 1) for chosen in combinations(range(bits), n)], np.int64)
        wanted = own[:, None] ^ masks[None, :]
        at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
        i, j = np.nonzero(values[at] == wanted)
        bucket = at[i, j]
    else:
        i, bucket = np.nonzero(np.bitwise_count(own[:, None] ^ values[None, :]) <= flips)
    n = counts[bucket]
    a = np.repeat(i, n)
    b = order[np.repeat(first[bucket] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    for before in range(table):
        kept = np.bitwise_count(part(codes_a, before)[a] ^ part(codes_b, before)[b]) > flips
        a, b = a[kept], b[kept]
    return a, b


def _probed(index: DataFrame, queries: DataFrame, radius: int, layout: Layout, dim: int, k: int, block_rows: int, block_queries: int) -> DataFrame:
    """``query_id``, ``vec_id`` and bounds of the cosine (``low``, ``high``) of what may be among the ``k`` nearest within a radius."""
    flips = radius // len(layout.shifts)
    at = lambda shift: F.shiftrightunsigned("code", shift).bitwiseAND(F.lit((1 << layout.region_bits(shift)) - 1)).cast("int")
    entries = index.select("vec_id", "code", "sketch", F.posexplode(F.array(*[at(shift) for shift in layout.shifts])).alias("table", "region"))

    def around(table: int, shift: int) -> Column:
        """The regions within so many flips of a code's own."""
        return F.transform(F.lit(flips_of(layout.region_bits(shift), flips).tolist()), lambda x: F.struct(F.lit(table).alias("table"), at(shift).bitwiseXOR(x.cast("int")).alias("region")))

    regions = F.flatten(F.array(*[around(table, shift) for table, shift in enumerate(layout.shifts)]))
    probing = queries.select("vec_id", "code", "sketch", F.explode(regions).alias("to")).select("vec_id", "code", "sketch", "to.table", "to.region")

    # one row for each region of each substring: their number is set by the layout alone
    blocks = F.broadcast(checkpointed(entries.groupBy("table", "region").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).cast("int").alias("blocks"))))
    key = ["table", "region", "block"]
    held = ["vec_id", "code", "sketch"]
    rows = entries.join(blocks, ["table", "region"]).select("table", "region", F.pmod(F.xxhash64("vec_id", "code"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("kind"), *held)
    # each row is sent once for a substring; a query goes to every block of the regions around it
    asking = probing.join(blocks, ["table", "region"]).select("table", "region", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), *held)
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.unionByName(asking).repartition(parts, *key).sortWithinPartitions(*key, "kind")

    def nearest_of(q: tuple, x: tuple, table: int) -> tuple[np.ndarray, ...]:
        """Ids and bounds of what may be among the nearest of some queries in one block."""
        (q_ids, q_codes, q_raw), (x_ids, x_codes, x_units, x_errors) = q, x
        a, b = candidates(q_codes, x_codes, table, flips, layout)
        kept = (np.bitwise_count(q_codes[a] ^ x_codes[b]) <= radius) & (q_ids[a] != x_ids[b])
        a, b = a[kept], b[kept]
        q_units, q_errors = from_sketches(q_raw)
        if 32 * len(a) > len(q_ids) * len(x_ids):
            about = (q_units @ x_units.T)[a, b]
        else:
            about = np.einsum("ij,ij->i", q_units[a], x_units[b])
        # |qx - q'x'| <= |q - q'| |x| + |q'| |x - x'|, and the sums are in single precision
        slack = q_errors[a] + (1 + q_errors[a]) * x_errors[b] + 1e-5
        low, high = about - slack, about + slack
        order = np.lexsort((-low, a))
        a, b, low, high = a[order], b[order], low[order], high[order]
        begin, end = (np.searchsorted(a, np.arange(len(q_ids)), side=side) for side in ("left", "right"))
        least = np.full(len(q_ids), -2.0)
        enough = end - begin >= k
        least[enough] = low[begin[enough] + k - 1]
        kept = high >= least[a]
        return q_ids[a[kept]], x_ids[b[kept]], low[kept], high[kept]

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, block = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            ids, codes, raw = batch.column(4).to_numpy(), batch.column(5).to_numpy().view(np.uint64), _rows_of_bytes(batch.column(6), 2 * dim + 8)
            starts = np.flatnonzero(np.any(np.diff(keys, axis=0, prepend=keys[:1] - 1) != 0, axis=1)).tolist() if len(keys) else []
            found = []
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                place, kind = tuple(keys[start, :3].tolist()), keys[start, 3]
                if place != now:
                    now, waiting, block = place, [], None
                if kind == 0:
                    waiting.append((ids[start:end], codes[start:end], raw[start:end].copy()))
                    continue
                if block is None and waiting:
                    block = (*(np.concatenate(x) for x in list(zip(*waiting))[:2]), *from_sketches(np.concatenate([x[2] for x in waiting])))
                if block is not None:
                    for at in range(start, end, block_queries):
                        upto = min(at + block_queries, end)
                        found.append(nearest_of((ids[at:upto], codes[at:upto], raw[at:upto]), block, place[0]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["query_id", "vec_id", "low", "high"])

    found = ordered.mapInArrow(met, "query_id long, vec_id long, low double, high double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    own = Window.partitionBy("query_id")
    placed = once.withColumn("place", F.row_number().over(own.orderBy(F.desc("low"), "vec_id")))
    return placed.withColumn("kth", F.max(F.when(F.col("place") == k, F.col("low"))).over(own)).where("kth IS NULL OR high >= kth").select("query_id", "vec_id", "kth")


def search(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    step: int = QUERY_STEP,
    k: int = NEIGHBOURS,
    substring_bits: int = SUBSTRING_BITS,
    fit_rows: int = FIT_ROWS,
    covered: float = COVERED,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (cosine) of the ``k`` nearest found for each query.

    Vectors that are null, empty, zero, hold a null or a component that isn't
    finite, or are of another length than most usable ones, and rows with a null id
    take no part.  An id with several vectors counts once for each query, with the
    nearest of them, and is asked for with each of its own.  Ties go to the smaller
    id.  A query finds ``k`` rows, or all candidates where there are fewer, whatever
    the radius; an empty table gives no rows.  Other columns are ignored.
    """
    spark = session_of(df)
    out = "query_id long, rank int, vec_id long, score double"
    finite = F.forall(F.col("embedding").cast("array<double>"), lambda x: F.abs(x) < F.lit(float("inf")))
    usable = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding")).where(F.col("vec_id").isNotNull() & F.exists("embedding", lambda x: x != 0) & finite)
    common = usable.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], out)
    dim = common.dim
    vectors = usable.where(F.size("embedding") == dim)

    # Fit: so many rows with the least hashes of their ids.
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).toArrow().combine_chunks()
    drawn = _vectors(sample["embedding"].combine_chunks(), dim)
    codes = spark.sparkContext.broadcast(fit(_unit(drawn)))
    bits = codes.value.bits
    asked = spark.sparkContext.broadcast((sample["vec_id"].to_numpy()[:CALIBRATION_QUERIES], drawn[:CALIBRATION_QUERIES]))

    # Calibrate: the true neighbours of some queries among all rows, and how far off those are in code.
    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted = asked.value
        own = codes.value.encode(_unit(wanted))
        for batch in batches:
            vec_ids, held = batch.column(0).to_numpy(), _unit(_vectors(batch.column(1), dim))
            scores = _unit(wanted) @ held.T
            scores[ids[:, None] == vec_ids[None, :]] = -np.inf
            rows = [(i, j) for i, best in enumerate(_best(scores, k)) for j in best]
            q, x = np.array(rows, dtype=np.int64).reshape(-1, 2).T
            far = np.bitwise_count(own[q] ^ codes.value.encode(held[x])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(vec_ids[x]), pa.array(scores[q, x]), pa.array(far)], names=["query_id", "vec_id", "score", "far"])

    near = _ranked(vectors.mapInArrow(brute, "query_id long, vec_id long, score double, far int"), k, "far").toPandas()
    turned = lambda score: np.arccos(np.clip(score, -1, 1)) / np.pi
    spread = lambda share: np.sqrt(bits * share * (1 - share)) + 0.5
    last = turned(near.groupby("query_id")["score"].transform("min").to_numpy())
    margin = max(0.0, float(np.quantile((near["far"].to_numpy() - bits * last) / spread(last), covered, method="higher"))) if len(near) else float(bits)
    enough = np.ceil(bits * last + margin * spread(last))
    radius = min(bits, int(np.quantile(enough, 0.5))) if len(near) else bits

    # Index: codes and sketches; of equal vectors those with the least ids.
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_vectors(batch.column(3), dim))
            raw = sketches(unit)
            ends = np.arange(len(raw) + 1, dtype=np.int32) * raw.shape[1]
            sketch = pa.BinaryArray.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes.value.encode(unit).view(np.int64)), sketch], names=["vec_id", "one", "two", "code", "sketch"])

    hashed = vectors.select("vec_id", F.xxhash64("embedding").alias("one"), F.xxhash64(F.lit(1), "embedding").alias("two"), "embedding")
    table = written(hashed.mapInArrow(coded, "vec_id long, one long, two long, code long, sketch binary"))
    equal = Window.partitionBy("one", "two").orderBy("vec_id")
    many = table.groupBy("one", "two").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > k + 1).select("one", "two", F.lit(True).alias("many"))
    marked = table.join(many, ["one", "two"], "left")
    least = marked.where("many").withColumn("copy", F.dense_rank().over(equal)).where(F.col("copy") <= k + 1).dropDuplicates(["one", "two", "vec_id"])
    index = written(marked.where("many IS NULL").select("vec_id", "code", "sketch").unionByName(least.select("vec_id", "code", "sketch")))
    queries = table.where(F.col("vec_id") % step == 0).dropDuplicates(["one", "two", "vec_id"]).select("vec_id", "code", "sketch")

    # Search: with a radius that grows for the queries that it doesn't do for.
    layout = Layout(bits, substring_bits, max(0, int(np.ceil(np.log2(max(1, index.count()) / block_rows)))))
    done, todo = None, queries
    while True:
        found = written(_probed(index, todo, radius, layout, dim, k, block_rows, block_queries))
        if radius >= bits:
            done = found if done is None else done.unionByName(found)
            break
        share = F.acos(F.least(F.greatest(F.col("kth"), F.lit(-1.0)), F.lit(1.0))) / F.lit(float(np.pi))
        wanted = F.ceil(bits * share + margin * (F.sqrt(bits * share * (1 - share)) + 0.5))
        kth = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.max("kth").alias("kth"))
        state = todo.select("vec_id").distinct().join(kth, "vec_id", "left")
        state = state.select("vec_id", F.least(F.coalesce(wanted, F.lit(2 * radius + len(layout.shifts))), F.lit(bits)).alias("wanted"))
        still = checkpointed(state.where(F.col("wanted") > radius))
        finished = found.join(still.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
        done = finished if done is None else done.unionByName(finished)
        left = still.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("wanted", 0.9).alias("most"), F.max("wanted").alias("all")).first()
        if not left.n:
            break
        radius = min(bits, max(radius + 1, int(left.all) if left.all - left.most <= 2 * len(layout.shifts) else int(left.most)))
        todo = queries.join(still, "vec_id", "left_semi")

    # Rank: the vectors of the few pairs that are left.
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = cosine(_vectors(batch.column(2), dim), _vectors(batch.column(3), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(scores)], names=["query_id", "vec_id", "score"])

    asking = vectors.where(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    pairs = done.select("query_id", "vec_id").join(vectors, "vec_id").join(asking, "query_id").select("query_id", "vec_id", "query_embedding", "embedding")
    scored = pairs.mapInArrow(exact, "query_id long, vec_id long, score double")
    return _ranked(scored, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op5_nearest(spark, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every query."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
