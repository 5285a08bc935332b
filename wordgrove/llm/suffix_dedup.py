"""Removal of repeated byte strings with sorted suffixes (operator 10).

A byte goes if a string of N bytes that covers it also starts anywhere else.

1. Anchors.  Every window of N bytes names one of its K-byte grams, the first
   with the least hash.  Equal windows name equal grams at equal offsets, so a
   repeat lies around two equal anchors, and an anchor whose gram occurs once in
   the corpus can be left out.  Only these anchors' contexts, no other suffixes,
   are carried on: what follows an anchor and what precedes it.
2. Deep-shallow sorting.  The contexts that share a gram are put in the order of
   their suffixes: multikey quicksort down to a shallow depth, and a blind trie
   for each group that is still undivided there.  Prefixes are sorted alike,
   read backwards.
3. Matches.  The order of prefixes is a trie whose branchings group anchors by
   how far they agree to the left; in each such group the best agreement to the
   right is with a neighbour in the order of suffixes.  If both reach N bytes
   together, the whole stretch is repeated.
4. The stretches of a document are merged and its remaining bytes hashed.

Texts that occur more than once as a whole are sorted once, for all.  A gram in
more than ``HOT_GRAM`` different texts isn't sorted in one task: the N-byte
windows of its anchors are counted across the cluster instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordgrove.llm.common import checkpointed, session_of, written

LENGTH, GRAM = 200, 100
#: Multikey quicksort goes so deep; groups that agree up to here go to blind tries.
SHALLOW = 32
HOT_GRAM = 20_000
#: Anchors that a task compares before it hands them on.
BLOCK_ANCHORS = 1 << 18

#: A place and how far its windows reach before it are packed as place * _REACH + reach.
_REACH = 1 << 16
_POSITION_BITS = 26
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int, name: str) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        size = max(n, 1 << 16)
        grown = np.full(size, base, np.uint64)
        grown[0] = 1
        _powers[name] = np.multiply.accumulate(grown)
    return _powers[name][:n]


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Mixed 64-bit hashes of all grams of a byte array, alike wherever a gram stands."""
    n = len(raw)
    weighted = (raw.astype(np.uint64) + np.uint64(1)) * _power(_P, n, "up")
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])
    hashed = (sums[gram:] - sums[:-gram]) * _power(_P_INVERSE, n - gram + 1, "down")
    hashed ^= hashed >> np.uint64(32)
    hashed *= np.uint64(0xD6E8FEB86659FD93)
    hashed ^= hashed >> np.uint64(29)
    return hashed


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, by running minima within blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors that the windows of a byte array name, how far before each its first window starts, and gram hashes.

    Every window names one anchor, so what stands farther before an anchor than
    its first window needn't be looked at with it.
    """
    width = length - gram + 1
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashed = gram_hashes(raw, gram)
    stretch = (1 << _POSITION_BITS) - width
    found = []
    for start in range(0, len(hashed) - width + 1, stretch):
        part = hashed[start : start + stretch + width - 1]
        place = np.arange(len(part), dtype=np.uint64)
        least = _sliding_min((part >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | place, width) & np.uint64((1 << _POSITION_BITS) - 1)
        first = np.flatnonzero(np.diff(least, prepend=np.uint64(1 << _POSITION_BITS)))
        found.append(np.stack([least[first].astype(np.int64), first]) + start)
    positions, firsts = np.concatenate(found, axis=1)
    positions, at = np.unique(positions, return_index=True)
    return positions, positions - firsts[at], hashed[positions]


# --- deep-shallow sorting -------------------------------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    """How many bytes two strings share from their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


class _Branching:
    """A node of a blind trie: a depth, and for each byte there (or -1, the end) a node or the places of equal strings."""

    __slots__ = ("below", "depth")

    def __init__(self, depth: int, below: dict):
        self.depth, self.below = depth, below


def _byte(text: bytes, depth: int) -> int:
    return text[depth] if depth < len(text) else -1


def _blind_trie(strings: list[bytes], members: list[int]) -> list[int]:
    """The order of strings by a blind trie.

    A descent looks only at the bytes at the branchings; one comparison with any
    string below where it ends gives the depth at which the new one branches off.
    """
    root: _Branching | list[int] = [members[0]]
    for one in members[1:]:
        text, node = strings[one], root
        while isinstance(node, _Branching):
            child = node.below.get(_byte(text, node.depth))
            node = child if child is not None else next(iter(node.below.values()))
        other = strings[node[0]]
        shared = common_prefix(other, text)
        if shared == len(text) == len(other):
            node.append(one)
            continue
        above, node = None, root
        while isinstance(node, _Branching) and node.depth < shared:
            above, key = node, _byte(text, node.depth)
            node = node.below[key]
        if isinstance(node, _Branching) and node.depth == shared:
            node.below[_byte(text, shared)] = [one]
            continue
        branching = _Branching(shared, {_byte(other, shared): node, _byte(text, shared): [one]})
        if above is None:
            root = branching
        else:
            above.below[key] = branching
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branching):
            stack.extend(node.below[b] for b in sorted(node.below, reverse=True))
        else:
            order.extend(node)
    return order


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Places of byte strings in their order: multikey quicksort, then blind tries for what agrees on ``shallow`` bytes."""
    order: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        members, depth = stack.pop()
        if len(members) == 1:
            order.append(members[0])
            continue
        if depth >= shallow:
            order.extend(_blind_trie(strings, members))
            continue
        keys = [strings[m][depth] if depth < len(strings[m]) else -1 for m in members]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less, equal, more = [], [], []
        for member, key in zip(members, keys):
            (less if key < pivot else more if key > pivot else equal).append(member)
        if more:
            stack.append((more, depth))
        if pivot == -1:
            if less:  # cannot be: nothing sorts before an end
                stack.append((less, depth))
            order.extend(equal)
            continue
        stack.append((equal, depth + 1))
        if less:
            stack.append((less, depth))
    return order


# --- matches around equal anchors -----------------------------------------------------------------------------------


def repeated_stretches(lefts: list[bytes], rights: list[bytes], length: int = LENGTH, shared_gram: int = 0) -> list[list[tuple[int, int]]]:
    """For each anchor, the stretches (bytes to the left, bytes to the right) that another anchor repeats.

    ``lefts`` hold what precedes an anchor, read backwards; ``rights`` what follows it,
    the first ``shared_gram`` bytes of which are known to be equal.
    """
    n = len(lefts)
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n < 2:
        return found
    if n == 2:
        left, right = common_prefix(lefts[0], lefts[1]), common_prefix(rights[0], rights[1])
        if left + right >= length:
            found[0].append((left, right))
            found[1].append((left, right))
        return found
    by_right = deep_shallow_sort([x[shared_gram:] for x in rights])
    rank = [0] * n
    for i, member in enumerate(by_right):
        rank[member] = i
    agree = [common_prefix(rights[a], rights[b]) for a, b in zip(by_right, by_right[1:])]  # of neighbours in the order of suffixes
    by_left = deep_shallow_sort(lefts)
    shared = [common_prefix(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:])]

    least = _RangeMin(agree)

    def group(members: list[int], depth: int) -> None:
        """Anchors that agree on ``depth`` bytes to the left, in the order of suffixes."""
        reach = [least(rank[a], rank[b]) for a, b in zip(members, members[1:])]
        for i, member in enumerate(members):
            right = max(reach[i - 1] if i else 0, reach[i] if i < len(reach) else 0)
            if depth + right >= length:
                found[member].append((depth, right))

    # Intervals of the order of prefixes by their least agreement, closed from the deepest outwards.
    stack: list[tuple[int, list[int]]] = []  # (agreement with what came before, members in the order of suffixes)
    pending = [by_left[0]]
    for i, depth in enumerate([*shared, -1]):
        while stack and stack[-1][0] > depth:
            joined_depth, parts = stack[-1][0], [pending]
            while stack and stack[-1][0] == joined_depth:
                parts.append(stack.pop()[1])
            pending = sorted((x for part in parts for x in part), key=rank.__getitem__)
            group(pending, joined_depth)
        if depth >= 0:
            stack.append((depth, pending))
            pending = [by_left[i + 1]]
    return found


class _RangeMin:
    """The least value between two places, from a table of powers of two."""

    def __init__(self, values: list[int]):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            row = self.rows[-1]
            self.rows.append([min(a, b) for a, b in zip(row, row[step:])])
            step *= 2

    def __call__(self, a: int, b: int) -> int:
        level = (b - a).bit_length() - 1
        return min(self.rows[level][a], self.rows[level][b - (1 << level)])


# --- the operator ---------------------------------------------------------------------------------------------------


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors (``gram``, ``salt``, ``text_id``, ``position``, ``marker``) of each text, once for equal texts of a block.

    A gram that stands at two places of a block is known to be repeated there:
    its anchors are salted, so that they needn't meet those of other blocks, and
    one marker row tells the others.  So a frequent gram sends a row a block, not
    one for each of its places, to where all its rows meet.
    """

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}  # places with their reach, and grams
        size = 0

        def flush() -> pa.RecordBatch:
            owner = np.repeat(np.arange(len(held)), [len(at) for at, _ in held.values()])
            ids = np.frombuffer(b"".join(held), np.int64)[::2][owner]  # the first half of each text's digest
            at = np.concatenate([x for x, _ in held.values()] or [np.zeros(0, np.int64)])
            grams = np.concatenate([x for _, x in held.values()] or [np.zeros(0, np.uint64)]).view(np.int64)
            _, first, inverse, counts = np.unique(grams, return_index=True, return_inverse=True, return_counts=True)
            salt = np.where(counts[inverse] > 1, np.where(ids == 0, 1, ids), 0)
            marked = first[counts > 1]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([grams, grams[marked]])),
                    pa.array(np.concatenate([salt, np.zeros(len(marked), np.int64)])),
                    pa.array(list(held), pa.binary()).take(pa.array(np.concatenate([owner, owner[marked]]), pa.int64())),
                    pa.array(np.concatenate([at, at[marked]])),
                    pa.array(np.concatenate([np.zeros(len(ids), np.int8), np.ones(len(marked), np.int8)])),
                ],
                names=["gram", "salt", "text_id", "position", "marker"],
            )

        for batch in batches:
            for text_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if text_id not in held:
                    at, before, grams = anchors(np.frombuffer(raw.as_buffer(), np.uint8), length, gram)
                    held[text_id] = (at * _REACH + before, grams)
                    size += len(held[text_id][0]) + 1
                    if size >= BLOCK_ANCHORS:
                        yield flush()
                        held, size = {}, 0
        yield flush()

    return texts.select("text_id", "raw").mapInArrow(anchored, "gram long, salt long, text_id binary, position long, marker byte")


def _with_text(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``text_id``, ``raw``, ``positions`` and ``values`` of each text that has a place: one row however many copies there are."""
    empty = lambda kind: F.lit(None).cast(kind)
    stream = texts.select("text_id", F.lit(0).alias("kind"), "raw", empty("long").alias("position"), empty("long").alias("value")).unionByName(
        places.select("text_id", F.lit(1).alias("kind"), empty("binary").alias("raw"), "position", "value")
    )
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stream.repartition(parts, "text_id").sortWithinPartitions("text_id", "kind", "position")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, raw, positions, values = None, None, [], []
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) or [(), (), (), ()]
            kinds = (pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["text_id", "raw", "positions", "values"])

        for batch in batches:
            for text_id, kind, held, position, value in zip(*(batch.column(i) if i == 2 else batch.column(i).to_pylist() for i in range(5))):
                if text_id != now:
                    if positions:
                        done.append((now, raw, positions, values))
                    now, raw, positions, values = text_id, None, [], []
                if kind == 0:
                    if raw is None:
                        raw = held.as_py()
                else:
                    positions.append(position)
                    values.append(value)
            yield flush()
            done = []
        if positions:
            done.append((now, raw, positions, values))
        yield flush()

    return ordered.mapInArrow(gathered, "text_id binary, raw binary, positions array<long>, values array<long>")


def _contexts(anchored: DataFrame, length: int) -> DataFrame:
    """For each anchor its gram and what stands before and after it, as far as its windows reach.

    Anchors of a text with equal contexts, as in a stretch that repeats a short
    one over and over, are one row with all their ``places``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, ids, places, lefts, rights = [], [], [], [], []
            for text_id, raw, positions, values in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                raw = raw.as_py()
                equal: dict[tuple[int, bytes, bytes], list[int]] = {}
                # a text whose copies lie in several blocks has its anchors several times over
                for packed, value in dict(zip(positions, values)).items():
                    position, before = divmod(packed, _REACH)
                    equal.setdefault((value, raw[position - before : position], raw[position : position + length]), []).append(position)
                for (value, left, right), own in equal.items():
                    grams.append(value)
                    ids.append(text_id)
                    places.append(own)
                    lefts.append(left)
                    rights.append(right)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.int64()), pa.array(ids, pa.binary()), pa.array(places, pa.list_(pa.int64())), pa.array(lefts, pa.binary()), pa.array(rights, pa.binary())],
                names=["gram", "text_id", "places", "left", "right"],
            )

    return anchored.mapInArrow(cut, "gram long, text_id binary, places array<long>, left binary, right binary")


def _matches(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """From contexts in the order of ``gram``: repeated stretches, and for ``hot`` grams the digests of their windows.

    A stretch has ``text_id``, ``position`` and ``value`` (start and end); a window
    has its start and a ``digest``.
    """

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, {}
        ids, starts, ends, digests = [], [], [], []

        def add(text_id: bytes, start: int, end: int, digest: bytes | None = None) -> None:
            ids.append(text_id)
            starts.append(start)
            ends.append(end)
            digests.append(digest)

        def whole(text_id: bytes, places: list[int], left: bytes, right: bytes) -> None:
            if len(left) + len(right) >= length:
                for position in places:
                    add(text_id, position - len(left), position + len(right))

        def close() -> None:
            # places with equal contexts repeat each other as far as these reach; one of them stands for all in the sort
            kinds = list(rows)
            found = repeated_stretches([x[0][::-1] for x in kinds], [x[1] for x in kinds], length, gram)
            for (left, right), own, texts in zip(kinds, found, rows.values()):
                repeated = len(texts) > 1 or len(texts[0][1]) > 1
                for text_id, places in texts:
                    if repeated:
                        whole(text_id, places, left, right)
                        continue
                    for a, b in own:
                        add(text_id, places[0] - a, places[0] + b)

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(digests, pa.binary())], names=["text_id", "position", "value", "digest"]
            )
            for x in (ids, starts, ends, digests):
                x.clear()
            return made

        for batch in batches:
            for key, text_id, places, left, right, hot in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if hot:
                    if len(places) > 1:
                        whole(text_id, places, left, right)
                    both = left + right
                    for i in range(min(len(left), len(both) - length) + 1):
                        start = places[0] - len(left) + i
                        add(text_id, start, start + length, hashlib.blake2b(both[i : i + length], digest_size=16).digest())
                    continue
                if key != now:
                    close()
                    now, rows = key, {}
                rows.setdefault((left, right), []).append((text_id, places))
            if ids:
                yield flush()
        close()
        yield flush()

    return contexts.mapInArrow(matched, "text_id binary, position long, value long, digest binary")


def remove_repeats(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot_gram: int = HOT_GRAM, digest_only: bool = False
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` of every row.

    ``kept`` has the remaining bytes, or their SHA-256 in lowercase hex with
    ``digest_only``.  A null text counts as an empty one.  Matches never reach over
    the end of a text; texts shorter than ``length`` lose nothing.  Equal texts
    repeat each other wholly, whether their ids are equal or not, and equal rows
    each give a row.  Other columns are ignored.
    """
    session_of(df)
    if not 8 <= gram < length <= _REACH:
        raise ValueError("a gram has 8 bytes at least and fewer than the repeats to be found, which have 65,536 at most")
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    # half of a SHA-256: different texts don't share it at any size of corpus
    texts = df.select(F.col(id_col).alias("doc_id"), F.unhex(F.substring(F.sha2(raw, 256), 1, 32)).alias("text_id"), raw.alias("raw"))
    long_enough = texts.where(F.octet_length("raw") >= length)

    meeting = Window.partitionBy("gram", "salt")
    rows = _anchor_rows(long_enough, length, gram)
    told = rows.withColumn(
        "repeated", (F.col("salt") != 0) | (F.max("marker").over(meeting) == 1) | (F.min("text_id").over(meeting) != F.max("text_id").over(meeting)) | (F.min("position").over(meeting) != F.max("position").over(meeting))
    )
    places = told.where("repeated AND marker = 0").select("text_id", "position", F.col("gram").alias("value"))
    anchored = written(_with_text(long_enough, places))

    # grams in too many texts for one task, of which there are at most as many as anchors by ``hot_gram``
    hot = anchored.select(F.explode(F.array_distinct("values")).alias("gram")).groupBy("gram").count().where(F.col("count") > hot_gram).select("gram", F.lit(True).alias("hot"))
    flagged = _contexts(anchored, length).join(checkpointed(hot), "gram", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    spread = F.when(F.col("hot"), F.xxhash64("text_id", "left", "right")).otherwise(0)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = written(_matches(flagged.repartition(parts, F.col("gram"), spread).sortWithinPartitions("gram"), length, gram))
    windows = met.where("digest IS NOT NULL").dropDuplicates(["text_id", "position"])
    repeated = windows.groupBy("digest").count().where("count > 1").select("digest")
    stretches = met.where("digest IS NULL").drop("digest").unionByName(windows.join(repeated, "digest", "left_semi").drop("digest"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for raw, starts, ends in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                raw = raw.as_py()
                parts, upto, gone, runs = [], 0, 0, 0
                for start, end in sorted(zip(starts, ends)):
                    if start > upto or not runs:
                        parts.append(raw[upto:start])
                        runs += 1
                        upto = start
                    if end > upto:
                        gone += end - upto
                        upto = end
                parts.append(raw[upto:])
                left_over = b"".join(parts)
                removed.append(gone)
                spans.append(runs)
                kept.append(hashlib.sha256(left_over).hexdigest() if digest_only else left_over)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string() if digest_only else pa.binary())], names=["text_id", "gone", "runs", "rest"]
            )

    kept_type = "string" if digest_only else "binary"
    shortened = _with_text(anchored, stretches).mapInArrow(cut, f"text_id binary, gone long, runs long, rest {kept_type}")
    whole = F.sha2("raw", 256) if digest_only else F.col("raw")
    nothing = F.sha2(F.lit(b""), 256) if digest_only else F.lit(b"")
    base = texts.select("doc_id", "text_id", F.octet_length("raw").cast("long").alias("n_bytes"), whole.alias("whole"))
    classes = base.where(F.col("n_bytes") >= length).groupBy("text_id").agg((F.count(F.lit(1)) > 1).alias("copied"))
    known = classes.join(shortened, "text_id", "left").where("copied OR gone > 0")
    final = base.join(known, "text_id", "left")
    copied = F.coalesce("copied", F.lit(False))
    return final.select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1).cast("long")).otherwise(F.coalesce("runs", F.lit(0))).alias("n_spans"),
        F.when(copied, nothing).otherwise(F.coalesce("rest", "whole")).alias("kept"),
    )


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What stays of every document without repeated byte strings."""
    done = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_only=True)
    return done.withColumnRenamed("kept", "kept_sha256")
