"""Removal of word windows that earlier documents hold, with compressed FM-indexes (operator 12).

A word goes if a window of N words that covers it also starts in a document with a
smaller id.

1. Chunks.  Documents are packed, a few megabytes together, as rows of a table, so
   that what is found for them comes back by the number of the chunk.
2. Shards.  Every window names one of its K-word grams, the first with the least
   hash, so equal windows name equal grams.  Windows of a document that follow one
   another and name the same gram make a piece of text.  Chunks send the hashes of
   their grams, packed, to where they are counted over the corpus; bits come back
   for those that occur again.  Pieces of these go, packed, to the shard of their
   gram.  Windows of grams that are very frequent are pieces of their own and go by
   a hash of all their words, so that no gram fills a shard.  Of equal pieces of a
   chunk only those of the least id go on: the others are repeats already.
3. Index.  A shard's distinct pieces make one text, of which the Burrows-Wheeler
   transform is kept in a wavelet matrix: bits with counts, one level for each bit
   of a word's number.
4. Matching statistics.  The pieces stream past the index from right to left, many
   at a time: a backward step takes in the next word, and when N words are reached,
   the interval falls back to that of N - 1 words (its parent).  Each interval of N
   words has the least document id in it; the window is a repeat if that is smaller
   than the document's own.
5. Runs of repeated windows return to their documents, where the words go.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgrove.llm.common import session_of, written

WINDOW, GRAM = 13, 4
#: Bytes of text in a chunk, and words of pieces that one index holds.
CHUNK_BYTES, INDEX_WORDS = 2 << 20, 1 << 18
#: Chunks whose grams one task counts, and pieces of a shard, about.
COUNTED_CHUNKS, SHARD_PIECES = 64, 60_000
#: Grams named by more pieces go by whole windows.
HOT_PIECES = 20_000
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
#: Places in a stretch of words; the other bits of a hash put grams in order.
_PLACE_BITS = 26


class _Words(dict):
    """Hashes of words, kept for as many as may be met again soon."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 16:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    total = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        total = total * _STEP + hashes[k : k + len(total)]
    return _mixed(total)


def named_places(grams: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` grams the place of its first least one."""
    bits = np.uint64(_PLACE_BITS)
    stretch, found = (1 << _PLACE_BITS) - width, [np.zeros(0, np.int64)]
    for start in range(0, len(grams) - width + 1, stretch):
        part = grams[start : start + stretch + width - 1]
        least = (part >> bits << bits) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while reach < width:
            step = min(reach, width - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        found.append((least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64) + start)
    return np.concatenate(found)


def _packed(*parts: np.ndarray | bytes) -> bytes:
    raw = [p if isinstance(p, bytes) else p.tobytes() for p in parts]
    return zstandard.compress(struct.pack(f"<{len(raw) + 1}q", len(raw), *map(len, raw)) + b"".join(raw), 3)


def _unpacked(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    n = struct.unpack_from("<q", raw)[0]
    sizes = struct.unpack_from(f"<{n}q", raw, 8)
    ends = 8 * (n + 1) + np.cumsum(sizes)
    return [raw[e - s : e] for s, e in zip(sizes, ends.tolist())]


def _chunks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``chunk`` and ``blob``: documents packed, each chunk under a number of its own."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, there, texts, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            blob = _packed(np.array(ids, np.int64), np.array(there, bool), lengths, b"".join(texts))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([blob], pa.binary())], names=["chunk", "blob"])

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_py()
                ids.append(doc_id or 0)
                there.append(doc_id is not None)
                texts.append(raw)
                size += len(raw)
                if size >= CHUNK_BYTES:
                    yield flush()
                    number, ids, there, texts, size = number + 1, [], [], [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, "chunk long, blob binary")


def _texts(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Ids, which of them are there, and texts of a chunk."""
    ids, there, lengths, raw = _unpacked(blob)
    ends = np.cumsum(np.frombuffer(lengths, np.int64))
    starts = ends - np.frombuffer(lengths, np.int64)
    return np.frombuffer(ids, np.int64), np.frombuffer(there, bool), [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


@dataclass
class _Pieces:
    """The pieces of a chunk: gram or window hash, document by its place in the chunk, first window in it, and number of windows."""

    ids: np.ndarray
    words: list[bytes]
    hashes: np.ndarray
    begins: np.ndarray
    keys: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, blob: bytes, window: int, gram: int, table: _Words) -> _Pieces:
        ids, there, texts = _texts(blob)
        words: list[bytes] = []
        sizes = np.zeros(len(ids), np.int64)
        for k, text in enumerate(texts):
            if there[k]:
                own = text.split()
                if len(own) >= window:
                    sizes[k] = len(own)
                    words += own
        hashes = np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
        grams = _grams(hashes, gram)
        named = named_places(grams, window - gram + 1)
        owner = np.repeat(np.arange(len(ids)), sizes)[: len(named)]
        begins = np.cumsum(sizes) - sizes
        # windows that reach into the next document are none
        inside = np.arange(len(named)) + window <= (begins + sizes)[owner]
        change = np.ones(len(named), bool)
        change[1:] = (named[1:] != named[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(change)
        counts = np.diff(np.append(first, len(named)))
        kept = inside[first] if len(first) else np.zeros(0, bool)
        first, counts = first[kept], counts[kept]
        return cls(ids, words, hashes, begins, grams[named[first]], owner[first], first, counts)

    def with_split(self, hot: np.ndarray, window: int) -> _Pieces:
        """Chosen pieces cut into single windows, under the hash of all their words."""
        sizes = np.where(hot, self.counts, 1)
        row = np.repeat(np.arange(len(self.keys)), sizes)
        within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        places = self.places[row] + within
        keys = self.keys[row]
        if hot.any():
            keys = np.where(hot[row], _grams(self.hashes, window)[places], keys)
        return _Pieces(self.ids, self.words, self.hashes, self.begins, keys, self.owners[row], places, np.where(hot[row], 1, self.counts[row]))

    def only(self, kept: np.ndarray) -> _Pieces:
        return _Pieces(self.ids, self.words, self.hashes, self.begins, self.keys[kept], self.owners[kept], self.places[kept], self.counts[kept])


def _dealt(values: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """An order of values by their part and themselves, the parts in it, and (part, begin, end) of each."""
    part = (_mixed(values) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((values, part))
    bounds = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
    return order, part[order], [(int(part[order[a]]), a, b) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _rows(**columns: tuple[list, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in columns.values()], names=list(columns))


def _gram_flags(chunks: DataFrame, window: int, gram: int, hot_pieces: int, parts: int) -> DataFrame:
    """For each ``chunk`` and ``part``: bits of its grams there, in order, that occur again, and that are hot; and ``n``, how many do."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Words()
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, times = np.unique(_Pieces.of(blob.as_py(), window, gram, table).keys, return_counts=True)
                order, _, bounds = _dealt(keys, parts)
                keys, times = keys[order], np.minimum(times[order], 65535).astype(np.uint16)
                held = [keys[a:b].tobytes() + times[a:b].tobytes() for _, a, b in bounds]
                yield _rows(part=([p for p, _, _ in bounds], pa.int64()), chunk=([number] * len(bounds), pa.int64()), held=(held, pa.binary()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, numbers, held = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            sizes = [len(h) // 10 for h in held]
            keys = np.concatenate([np.frombuffer(h, np.uint64, n) for h, n in zip(held, sizes)])
            times = np.concatenate([np.frombuffer(h, np.uint16, n, 8 * n) for h, n in zip(held, sizes)])
            _, back = np.unique(keys, return_inverse=True)
            total = np.bincount(back, weights=times)[back]
            again, hot = np.split(total > 1, np.cumsum(sizes)[:-1]), np.split(total > hot_pieces, np.cumsum(sizes)[:-1])
            bits = [np.packbits(a).tobytes() + np.packbits(b).tobytes() for a, b in zip(again, hot)]
            yield _rows(chunk=(numbers, pa.int64()), part=([now] * len(bits), pa.int64()), bits=(bits, pa.binary()), n=([int(t[a].sum()) for t, a in zip(np.split(times, np.cumsum(sizes)[:-1]), again)], pa.int64()))

        for batch in batches:
            for part, number, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    yield from close()
                    now, numbers, held = part, [], []
                numbers.append(number)
                held.append(blob)
        yield from close()

    sent = chunks.mapInArrow(send, "part long, chunk long, held binary").repartition(parts, "part").sortWithinPartitions("part")
    return sent.mapInArrow(count, "chunk long, part long, bits binary, n long")


def _sent_pieces(chunks: DataFrame, flags: DataFrame, window: int, gram: int, parts: int, shards: int) -> DataFrame:
    """``shard``, ``chunk`` and ``blob``: packed pieces by shard; and, under shards from ``shards`` on, spans of those that repeat another one of their chunk."""
    told = flags.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("told"))
    joined = chunks.join(told, "chunk").select("chunk", "blob", "told.part", "told.bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Words()
        for batch in batches:
            for number, blob, in_part, bits in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                pieces = _Pieces.of(blob.as_py(), window, gram, table)
                keys, back = np.unique(pieces.keys, return_inverse=True)
                order, _, bounds = _dealt(keys, parts)
                of_part = dict(zip(in_part, bits))
                again, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
                for part, a, b in bounds:
                    half = (b - a + 7) // 8
                    both = np.frombuffer(of_part[part], np.uint8)
                    again[order[a:b]] = np.unpackbits(both[:half], count=b - a)
                    hot[order[a:b]] = np.unpackbits(both[half:], count=b - a)
                pieces = pieces.only(again[back])
                pieces = pieces.with_split(hot[back][again[back]], window)
                yield _shard_rows(number, pieces, window, shards)

    return joined.mapInArrow(run, "shard long, chunk long, blob binary")


def _shard_rows(number: int, pieces: _Pieces, window: int, shards: int) -> pa.RecordBatch:
    ids, owners, words = pieces.ids, pieces.owners, pieces.words
    texts = [b" ".join(words[a:b]) for a, b in zip(pieces.places.tolist(), (pieces.places + pieces.counts + window - 1).tolist())]
    firsts = pieces.places - pieces.begins[owners]
    _, back, times = np.unique(pieces.keys, return_inverse=True, return_counts=True)
    least: dict[bytes, int] = {}
    shared = np.flatnonzero(times[back] > 1).tolist()
    docs = ids[owners].tolist()
    for k in shared:
        if docs[k] < least.get(texts[k], docs[k] + 1):
            least[texts[k]] = docs[k]
    gone = np.zeros(len(texts), bool)
    gone[shared] = [least[texts[k]] < docs[k] for k in shared]
    out = []
    if gone.any():
        out.append((shards + number % shards, _packed(owners[gone].astype(np.int32), firsts[gone].astype(np.int32), (firsts + pieces.counts + window - 1)[gone].astype(np.int32))))
    left = np.flatnonzero(~gone)
    order, _, bounds = _dealt(pieces.keys[left], shards)
    for shard, a, b in bounds:
        part = left[order[a:b]]
        out.append(
            (shard, _packed(pieces.keys[part], owners[part].astype(np.int32), firsts[part].astype(np.int32), pieces.counts[part].astype(np.int32), ids[owners[part]], b"\n".join(texts[k] for k in part.tolist())))
        )
    return _rows(shard=([s for s, _ in out], pa.int64()), chunk=([number] * len(out), pa.int64()), blob=([b for _, b in out], pa.binary()))


# --- the index -------------------------------------------------------------------------------------------------------


class WaveletMatrix:
    """Ranks of symbols in a sequence, from one level of bits, with counts, for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.levels, self.words, self.counts, self.zeros = levels, [], [], []
        now = symbols
        for level in range(levels - 1, -1, -1):
            bits = (now >> level) & 1
            padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
            padded[: len(bits)] = bits
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(int(len(bits) - bits.sum()))
            now = np.concatenate([now[bits == 0], now[bits == 1]])

    def _ones(self, level: int, places: np.ndarray) -> np.ndarray:
        word = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & below)

    def ranks(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol comes before each place, plus where the symbol's own run begins in the last level."""
        for level in range(self.levels):
            ones = self._ones(level, places)
            places = np.where((symbols >> (self.levels - 1 - level)) & 1, self.zeros[level] + ones, places - ones)
        return places


class FMIndex:
    """Backward search in a text of numbers from 1 on, 0 standing between its pieces, for patterns of ``depth`` symbols at most."""

    def __init__(self, text: np.ndarray, docs: np.ndarray, depth: int) -> None:
        n = len(text)
        levels = max(1, int(text.max(initial=0)).bit_length())
        rank, reach = text.astype(np.int64), 1
        while reach < depth:
            after = np.zeros(n, np.int64)
            after[: n - reach] = rank[reach:] + 1
            _, rank = np.unique(rank * (n + 2) + after, return_inverse=True)
            reach *= 2
        # suffixes in the order of their first ``reach`` symbols, which is all that such patterns can tell apart
        order = np.argsort(rank, kind="stable")
        before = text[order - 1]
        self.matrix = WaveletMatrix(before, levels)
        self.base = self.matrix.ranks(np.arange(int(text.max(initial=0)) + 1), np.zeros(int(text.max(initial=0)) + 1, np.int64))
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text))])
        # suffixes that agree in ``depth`` symbols, and in one fewer: where their runs begin and end
        self.depth, self.n = depth, n
        shared = self._shared(text, order)
        shared[:1] = -1
        self.parents = np.append(np.flatnonzero(shared < depth - 1), n)
        runs = np.flatnonzero(shared < depth)
        self.least = np.repeat(np.minimum.reduceat(docs[order], runs), np.diff(np.append(runs, n)))

    def _shared(self, text: np.ndarray, order: np.ndarray) -> np.ndarray:
        """How many symbols each suffix shares with the one before it in the order, ``depth`` at most."""
        padded = np.concatenate([text, np.zeros(self.depth, text.dtype)])
        shared, alike = np.zeros(self.n, np.int64), np.ones(self.n, bool)
        alike[0] = False
        for k in range(self.depth):
            alike[1:] &= padded[order[1:] + k] == padded[order[:-1] + k]
            shared += alike
        return shared

    def extend(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of patterns with one more symbol before them."""
        start = self.starts[symbols] - self.base[symbols]
        return start + self.matrix.ranks(symbols, low), start + self.matrix.ranks(symbols, high)

    def parent(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first ``depth - 1`` symbols of patterns of ``depth``."""
        k = np.searchsorted(self.parents[:-1], low, side="right")
        return self.parents[k - 1], self.parents[k]

    def least_ids(self, text: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each place of a text that windows of pieces start at, the least document id that the index has for it.

        The text streams past from right to left, all pieces at a time; elsewhere the
        result is the greatest number.
        """
        found = np.full(len(text), np.iinfo(np.int64).max)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.n)
        for step in range(int(sizes.max(initial=0))):
            going = np.flatnonzero(sizes > step)
            at = ends[going] - 1 - step
            a, b = self.extend(low[going], high[going], text[at])
            if step >= self.depth - 1:
                # matching statistics fall short of the depth where the interval is empty
                held = b > a
                found[at[held]] = self.least[a[held]]
                a, b = self.parent(a)
            low[going], high[going] = a, b
        return found


def _repeats(keys: np.ndarray, ids: np.ndarray, firsts: np.ndarray, counts: np.ndarray, texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of repeated words in the pieces of a shard: which piece, first word and end."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    alone = np.ones(len(keys), bool)
    same = ranked[1:] == ranked[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    order = order[~alone]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3]
    at = 0
    while at < len(order):
        # whole keys, as many as one index holds
        distinct: dict[bytes, int] = {}
        kinds, least, words, begin = [], [], 0, at
        while at < len(order) and (words < INDEX_WORDS or keys[order[at]] == keys[order[at - 1]]):
            k = int(order[at])
            kind = distinct.setdefault(texts[k], len(distinct))
            if kind == len(least):
                least.append(ids[k])
                words += counts[k] + window
            elif ids[k] < least[kind]:
                least[kind] = ids[k]
            kinds.append(kind)
            at += 1
        numbers: dict[bytes, int] = {}
        split = [text.split() for text in distinct]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(int(ends[-1]) + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = [numbers.setdefault(w, len(numbers) + 1) for piece in split for w in piece]
        index = FMIndex(text, np.repeat(np.array(least, np.int64), sizes + 1), window)
        lows = index.least_ids(text, ends, sizes)
        # every row's windows beside the least ids of its piece
        rows, of_kind = order[begin:at], np.array(kinds)
        n = counts[rows]
        row = np.repeat(np.arange(len(rows)), n)
        within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        hit = lows[(ends - sizes)[of_kind][row] + within] < ids[rows][row]
        row, within = row[hit], within[hit]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (within[1:] != within[:-1] + 1)
        last = np.append(np.flatnonzero(new)[1:], len(row)) - 1 if len(row) else np.zeros(0, np.int64)
        base = firsts[rows][row]
        found.append((rows[row[new]], base[new] + within[new], (base + within)[last] + window))
    return tuple(np.concatenate(x) for x in zip(*found))


def _searched(pieces: DataFrame, shards: int, window: int) -> DataFrame:
    """``chunk`` and ``spans`` (packed: document in the chunk, first word, end) of repeated words, from packed pieces in the order of ``shard``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, numbers, blobs = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if not blobs:
                return
            kinds = (np.uint64, np.int32, np.int32, np.int32, np.int64)
            parts = [_unpacked(b) for b in blobs]
            keys, owners, firsts, counts, ids = (np.concatenate([np.frombuffer(p[i], kind) for p in parts]).astype(kind if i in (0, 4) else np.int64) for i, kind in enumerate(kinds))
            chunk = np.repeat(np.arange(len(parts)), [len(p[0]) // 8 for p in parts])
            texts = [text for p in parts for text in p[5].split(b"\n")]
            own, a, b = _repeats(keys, ids, firsts, counts, texts, window)
            order = np.argsort(chunk[own], kind="stable")
            own, a, b = own[order], a[order], b[order]
            bounds = np.flatnonzero(np.diff(chunk[own], prepend=-1, append=-1)) if len(own) else np.zeros(1, np.int64)
            made = [(numbers[chunk[own[x]]], _packed(*(v[x:y].astype(np.int32) for v in (owners[own], a, b)))) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield _rows(chunk=([m[0] for m in made], pa.int64()), spans=([m[1] for m in made], pa.binary()))

        for batch in batches:
            for shard, number, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if shard >= shards:
                    yield _rows(chunk=([number], pa.int64()), spans=([blob], pa.binary()))
                    continue
                if shard != now:
                    yield from close()
                    now, numbers, blobs = shard, [], []
                numbers.append(number)
                blobs.append(blob)
        yield from close()

    return pieces.mapInArrow(run, "chunk long, spans binary")


def _shortened(chunks: DataFrame, spans: DataFrame, digest_only: bool) -> DataFrame:
    """The documents of all chunks without the words in their spans."""
    gathered = spans.groupBy("chunk").agg(F.collect_list("spans").alias("spans"))

    def left_over(words: list[bytes], spans: np.ndarray) -> list[bytes]:
        ends = np.zeros(len(words) + 1, np.int64)
        np.add.at(ends, spans[0], 1)
        np.add.at(ends, spans[1], -1)
        return [words[k] for k in np.flatnonzero(np.cumsum(ends)[:-1] == 0).tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, blobs in zip(batch.column(0), batch.column(1).to_pylist()):
                ids, there, texts = _texts(blob.as_py())
                held = [np.stack([np.frombuffer(x, np.int32) for x in _unpacked(b)]) for b in blobs or []]
                every = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int32)
                every = every[:, np.argsort(every[0], kind="stable")]
                bounds = np.searchsorted(every[0], np.arange(len(ids) + 1)).tolist()
                sizes, removed, kept = [], [], []
                for k, text in enumerate(texts):
                    words = text.split()
                    sizes.append(len(words))
                    if bounds[k] < bounds[k + 1]:
                        words = left_over(words, every[1:, bounds[k] : bounds[k + 1]])
                    removed.append(sizes[-1] - len(words))
                    rest = b" ".join(words)
                    kept.append(hashlib.sha256(rest).hexdigest() if digest_only else rest.decode())
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~there), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return chunks.join(gathered, "chunk", "left").select("blob", "spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot_pieces: int = HOT_PIECES, digest_only: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` of every row.

    Words are what stands between space, tab, line feed, vertical tab, form feed and
    carriage return; ``kept`` has those that are left, joined by one space, or the
    SHA-256 of that in lowercase hex with ``digest_only``.  A null text counts as an
    empty one.  Texts of fewer than ``window`` words lose nothing.  Rows of one id
    don't repeat each other, whatever their texts; a null id is smaller than none
    and none is smaller than it.  Equal rows each give a row, an empty table none;
    other columns are ignored.
    """
    spark = session_of(df)
    if not 1 <= gram <= window:
        raise ValueError("a gram has one word at least and no more than a window")
    chunks = written(_chunks(df, id_col, text_col))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counters = max(parts, chunks.count() // COUNTED_CHUNKS)
    flags = written(_gram_flags(chunks, window, gram, hot_pieces, counters))
    shards = max(parts, (flags.agg(F.sum("n")).first()[0] or 0) // SHARD_PIECES)
    sent = _sent_pieces(chunks, flags, window, gram, counters, shards)
    pieces = sent.repartition(max(parts, shards // 4), "shard").sortWithinPartitions("shard")
    return _shortened(chunks, _searched(pieces, shards, window), digest_only)


def op12_window_dedup(spark, sf_dir: str) -> DataFrame:
    """What stays of every document without windows of 13 words that earlier documents hold."""
    done = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_only=True)
    return done.withColumnRenamed("kept", "kept_sha256")


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
windows AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM starts),
firsts AS (SELECT x, min(doc_id) AS least FROM windows GROUP BY x),
hits AS (SELECT r, i FROM windows JOIN firsts USING (x) WHERE least < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM hits),
each AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (r, i) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)"""
