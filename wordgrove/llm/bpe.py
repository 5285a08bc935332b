"""Byte-level BPE encoding and decoding in overlapping chunks (operator 8).

A text is cut into chunks that overlap.  Every chunk is pre-tokenised on its
own, so that one long text is spread over many tasks.  A chunk that starts
inside a pre-token begins with wrong boundaries, but from the first boundary
that two neighbouring chunks share, both must go on alike, as the pattern never
looks back.  The text is stitched there and the pieces' ids are concatenated.
Where the overlap holds no common boundary (a run of one class longer than the
overlap), the stretch is pre-tokenised again over as many chunks as it needs.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgrove.llm.common import session_of

#: Code points of a chunk and of the stretch that it shares with the next one.
CHUNK_CHARS, OVERLAP_CHARS = 32768, 1024
#: A boundary is sure if the chunk goes on for this many code points: the longest contraction has three.
LOOK_AHEAD = 3


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a ``.tiktoken`` file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of a vocabulary file, loaded once in each Python worker."""
    return tiktoken.Encoding("wordgrove", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary file on this machine; executors have it installed at their own."""
    return public_tokenizers.path(name)


def _packed(ids: list[int]) -> bytes:
    words = array("I", ids)
    assert words.itemsize == 4
    return words.tobytes()


def _pieces(text: str, start: int, matcher: regex.Pattern, encoder: tiktoken.Encoding) -> tuple[list[int], list[list[int]]]:
    """Ends (absolute) and ids of the pre-tokens of a text that begins at ``start``."""
    ends, ids = [], []
    for match in matcher.finditer(text):
        ends.append(start + match.end())
        ids.append(encoder._core_bpe.encode_single_piece(match.group().encode()) if match.end() > match.start() else [])
    return ends, ids


class Stitcher:
    """Joins the chunks of one text, given in their order."""

    def __init__(self, name: str, pattern: str, overlap: int):
        self.encoder, self.matcher, self.overlap = encoding(vocabulary_path(name), pattern), regex.compile(pattern), overlap

    def stitch(self, chunks: list[tuple[int, str, list[int], list[list[int]]]], total: int) -> list[int]:
        """The ids of a text of ``total`` code points from (start, text, ends, ids) of its chunks."""
        out: list[int] = []
        at, k = 0, 0  # all ids up to `at` are written; chunk k goes on from there
        start, text, ends, ids = chunks[0]
        first = 0
        while True:
            last = k == len(chunks) - 1
            sure = start + len(text) - (0 if last else LOOK_AHEAD)
            if last:
                for piece in ids[first:]:
                    out.extend(piece)
                return out
            following = {end: i for i, end in enumerate(chunks[k + 1][2])}
            lower = max(at, chunks[k + 1][0])
            meet = next((i for i in range(first, len(ends)) if lower < ends[i] <= sure and ends[i] in following), None)
            if meet is not None:
                for piece in ids[first : meet + 1]:
                    out.extend(piece)
                at, k = ends[meet], k + 1
                first = following[at] + 1
                start, text, ends, ids = chunks[k]
                continue
            # No common boundary: keep what is sure and read on from there over twice as many chunks each time.
            held = [i for i in range(first, len(ends)) if ends[i] <= sure]
            for i in held:
                out.extend(ids[i])
                at = ends[i]
            step, parts, joined_end = 1, [text[at - start :]], start + len(text)
            while True:
                upto = min(k + step, len(chunks) - 1)
                for c in range(k + 1, upto + 1):
                    parts.append(chunks[c][1][joined_end - chunks[c][0] :])
                    joined_end = chunks[c][0] + len(chunks[c][1])
                k, start, text = upto, at, "".join(parts)
                ends, ids = _pieces(text, start, self.matcher, self.encoder)
                first = 0
                if k == len(chunks) - 1:
                    break
                sure = joined_end - LOOK_AHEAD
                nearby = set(chunks[k + 1][2])
                if any(chunks[k + 1][0] < end <= sure and end in nearby for end in ends):
                    break
                parts, step = [text], step * 2


def encode(
    df: DataFrame,
    *,
    vocabulary: str = "byte_bpe_50k.tiktoken",
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers), ``decoded`` bytes.

    A null text counts as an empty one and has no ids.  Rows with equal ids and
    texts each give a row; other columns are ignored.
    """
    session_of(df)
    texts = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, n_tokens long, ids binary, decoded binary"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(vocabulary_path(vocabulary), pattern)
        for batch in batches:
            counts, packed, decoded = [], [], []
            for text in batch.column(1):
                ids = encoder.encode_ordinary(text.as_py())
                counts.append(len(ids))
                packed.append(_packed(ids))
                decoded.append(encoder.decode_bytes(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    short = texts.where(F.length("text") <= chunk_chars).mapInArrow(whole, schema)
    n_chunks = F.ceil((F.length("text") - overlap_chars) / F.lit(float(chunk_chars)))
    chunks = (
        texts.where(F.length("text") > chunk_chars)
        .withColumn("digest", F.sha2("text", 256))
        .groupBy("doc_id", "digest")
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
        .select("doc_id", "digest", "copies", F.length("text").alias("total"), "text", F.explode(F.sequence(F.lit(0), F.greatest(n_chunks, F.lit(1)).cast("int") - 1)).alias("k"))
        .select("doc_id", "digest", "copies", "total", "k", F.expr(f"substring(text, k * {chunk_chars} + 1, {chunk_chars + overlap_chars})").alias("text"))
        .repartition("doc_id", "digest", "k")
    )

    def pre_tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, matcher = encoding(vocabulary_path(vocabulary), pattern), regex.compile(pattern)
        for batch in batches:
            ends, sizes, packed = [], [], []
            for k, text in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                e, ids = _pieces(text, k * chunk_chars, matcher, encoder)
                ends.append(e)
                sizes.append([len(x) for x in ids])
                packed.append(_packed([i for x in ids for i in x]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ends, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(packed, pa.binary())],
                names=[*batch.schema.names, "ends", "sizes", "packed"],
            )

    cut = chunks.mapInArrow(pre_tokenise, f"{', '.join(f'{n} {t}' for n, t in chunks.dtypes)}, ends array<bigint>, sizes array<int>, packed binary")

    def stitched(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        parts = []
        for k, text, ends, sizes, packed in zip(rows.k, rows.text, rows.ends, rows.sizes, rows.packed):
            flat, at, ids = array("I", packed), 0, []
            for n in sizes:
                ids.append(flat[at : at + n])
                at += n
            parts.append((int(k) * chunk_chars, text, list(ends), ids))
        ids = Stitcher(vocabulary, pattern, overlap_chars).stitch(parts, int(rows.total.iloc[0]))
        one = {"doc_id": rows.doc_id.iloc[0], "n_tokens": len(ids), "ids": _packed(ids), "decoded": encoding(vocabulary_path(vocabulary), pattern).decode_bytes(ids)}
        return pd.DataFrame([one] * int(rows.copies.iloc[0]))

    return short.unionByName(cut.groupBy("doc_id", "digest").applyInPandas(stitched, schema))


def decode(df: DataFrame, *, vocabulary: str = "byte_bpe_50k.tiktoken", pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes of every row's ids, concatenated; null ids give no bytes.  An id outside the vocabulary is an error."""
    session_of(df)

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(vocabulary_path(vocabulary), pattern)
        for batch in batches:
            decoded = [encoder.decode_bytes(array("I", ids or b"").tolist()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(bytes_of, f"doc_id {dict(rows.dtypes)['doc_id']}, decoded binary")


def op8_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    encoded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
