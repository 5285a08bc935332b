"""SimHash near-duplicates by segment popcounts (operator 2).

A fingerprint of 64 bits is embedded as the bit counts of its 32 two-bit
segments.  The Manhattan distance of two such vectors never exceeds the Hamming
distance of the fingerprints, so it bounds it from below.  The vectors are laid
on a grid of unit cells over blocks of coordinates: with B blocks, two vectors
at a distance of r or less agree wholly on B - r blocks at least.  A range join
within a radius is therefore a union of joins on the cells of B - r blocks.
Pairs in a cell are held against the Manhattan bound, then verified on the bits.

Only distinct fingerprints take part.  A cell with few of them is joined with
itself.  A crowded one, as popcounts make of many unlike fingerprints, is cut
finer by the bits themselves: those within the radius agree wholly on one of
radius + 1 parts of their bits.  What is crowded even then holds near copies; it
is dealt out in pairs of chunks of a fixed size, each of which gives the links of
a spanning forest rather than all its pairs.  Links are contracted to components
by alternating star operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.llm.common import checkpointed, session_of, written

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 3
#: Blocks of the grid: 35 cells a fingerprint at a radius of 3.
BLOCKS = 7
#: Fingerprints of a cell that are joined pair by pair; beyond, chunks of so many.
CROWDED, CHUNK = 24, 2048

#: The lower bit of every segment.
_M1 = 0x5555555555555555


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str | None, words_in_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles as an unsigned integer; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < words_in_shingle:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(x), seed) for x in zip(*(words[i:] for i in range(words_in_shingle)))]
    set_bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits as a signed long) of every row; a null or blank text has the fingerprint zero."""
    session_of(df)
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(x.as_py(), words_in_shingle, seed)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return texts.mapInArrow(hashed, f"doc_id {dict(texts.dtypes)['doc_id']}, fp long")


def segment_counts(fp: Column) -> Column:
    """The bit counts of the 32 two-bit segments, two bits each, packed in a long."""
    low, high = fp.bitwiseAND(F.lit(_M1)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_M1))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseXOR(high))


def manhattan(a: Column, b: Column) -> Column:
    """The Manhattan distance of two packed vectors of counts from 0 to 2.

    |x - y| of two such counts is the number of bits in which their unary codes
    (0: 00, 1: 01, 2: 11) differ.
    """

    def unary(x: Column) -> Column:
        high = F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(_M1))
        return x.bitwiseOR(high)

    return F.bit_count(unary(a).bitwiseXOR(unary(b)))


def _cell_masks(radius: int, blocks: int) -> list[int]:
    """For each choice of blocks that must agree, the mask of their segments."""
    if not 0 <= radius < blocks <= 32:
        raise ValueError("the grid needs more blocks than the radius, and 32 at most")
    edges = [round(i * 32 / blocks) for i in range(blocks + 1)]
    masks = [sum(3 << (2 * s) for s in range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [_signed(sum(masks[i] for i in chosen)) for chosen in combinations(range(blocks), blocks - radius)]


def _bit_parts(parts: int) -> list[int]:
    """Masks that cut 64 bits in so many parts."""
    edges = [round(i * 64 / parts) for i in range(parts + 1)]
    return [_signed(sum(1 << b for b in range(edges[i], edges[i + 1]))) for i in range(parts)]


def _split(cells: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Cells of two to ``CROWDED`` fingerprints, and those of more, both with their size ``n``."""
    sized = written(cells.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key))).where("n > 1"))
    return sized.where(F.col("n") <= CROWDED), sized.where(F.col("n") > CROWDED)


def _paired(few: DataFrame, key: list[str], radius: int) -> DataFrame:
    """Every link of cells with few fingerprints."""
    left, right = (few.select(*key, *[F.col(c).alias(f"{c}_{side}") for c in ("fp", "v")]) for side in "ab")
    both = left.join(right, key).where(F.col("fp_a") < F.col("fp_b"))
    close = (manhattan(F.col("v_a"), F.col("v_b")) <= radius) & (F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= radius)
    return both.where(close).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))


def links(distinct: DataFrame, *, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Links (``a`` < ``b``) of distinct ``fp`` within a Hamming radius.

    They hold every link of a cell with few fingerprints and a spanning forest of
    each pair of chunks of a crowded one, so components are exact.
    """
    masks = _cell_masks(radius, blocks)
    vector = segment_counts(F.col("fp"))
    cells = distinct.withColumn("v", vector).select("fp", "v", F.posexplode(F.array(*[F.col("v").bitwiseAND(F.lit(m)) for m in masks])).alias("grid", "cell"))
    few, crowded = _split(cells, ["grid", "cell"])
    finer = crowded.select("fp", "v", "grid", "cell", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in _bit_parts(radius + 1)])).alias("part", "bits"))
    key = ["grid", "cell", "part", "bits"]
    few_finer, many = _split(finer, key)
    close = _paired(few, ["grid", "cell"], radius).unionByName(_paired(few_finer, key, radius))

    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    # A fingerprint's chunk comes from its own bits, so no cell is ordered in one task.
    dealt = many.withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    dealt = dealt.select("fp", "v", *key, "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select("fp", "v", *key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def forest(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows.fp.to_numpy().view(np.uint64)
        order = np.argsort(fps, kind="stable")
        fps, vectors = fps[order], rows.v.to_numpy().view(np.uint64)[order]
        unary = vectors | ((vectors >> np.uint64(1)) & np.uint64(_M1))
        parent = list(range(len(fps)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = []
        for x in range(len(fps) - 1):
            near = np.flatnonzero(np.bitwise_count(unary[x + 1 :] ^ unary[x]) <= radius) + x + 1
            for y in near[np.bitwise_count(fps[near] ^ fps[x]) <= radius]:
                p, q = root(x), root(int(y))
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    found.append((x, int(y)))
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        signed = fps.view(np.int64)
        one, two = signed[pairs[:, 0]], signed[pairs[:, 1]]
        return pd.DataFrame({"a": np.minimum(one, two), "b": np.maximum(one, two)})

    trees = dealt.groupBy(*key, "i", "j").applyInPandas(forest, "a long, b long")
    return close.unionByName(trees).distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every end of the edges ``a``, ``b``.

    Alternating large-star and small-star rounds; each is kept in the shared
    folder.  Hubs are only ever aggregated to a minimum and joined to it.
    """
    edges = checkpointed(edges.select("a", "b").where("a <> b").distinct())
    before = None
    for _ in range(max_rounds):
        # large star: of each node, every larger neighbour is linked to the smallest of the node and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: of each node, every smaller neighbour and the node are linked to the smallest of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = checkpointed(small.where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components haven't settled in {max_rounds} rounds")
    # a settled graph is made of stars: the larger end is a member, the smaller one its root
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Rows are linked if their fingerprints differ in ``radius`` bits or fewer;
    ``component_id`` is the smallest id that can be reached.  Null and blank texts
    have the fingerprint zero and are linked like any other.  Rows with a null id
    keep their row; a component of such rows alone has a null id.  Equal rows
    each give a row.
    """
    fps = written(fingerprints(df, id_col=id_col, text_col=text_col))
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = checkpointed(least)
    stars = components(links(least.select("fp"), radius=radius, blocks=blocks))
    rooted = least.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
