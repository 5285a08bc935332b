"""Token counts without ids (operator 3).

1. Every task counts the pre-tokens of its texts; the counts are summed over
   the corpus, which leaves each distinct pre-token once.
2. The library's model splits each distinct pre-token once; its number of
   pieces is kept in a table of the shared folder.
3. Per-document pre-token frequencies are joined to that table and summed.  The
   most frequent pre-tokens, of a bounded number and however long, are joined by
   broadcast inside the task; the rest go through a shuffled join, so that every
   pre-token is counted, however rare.  Long pre-tokens go by a digest of 128
   bits, which bounds the broadcast and the rows of the join in bytes.

A pre-token never reaches over a single space that follows or precedes a
character other than white space, so texts are first cut there with
``str.split`` and each distinct word is pre-tokenised once in a task.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordgrove.llm.bpe import vocabulary_path
from wordgrove.llm.common import session_of, written

#: Bound of the broadcast: so many pre-tokens, under keys of so many code points at most (see ``key_of``).
HEAD_ENTRIES, KEY_CHARS = 1 << 18, 24
#: Distinct words and pre-tokens that a task holds before it hands them on.
HELD = 300_000

#: White space beside a space, where a cut at that space might not be a boundary.
_DOUBTFUL = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ")
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: Below, Unicode's letters and digits are settled, so that any matcher finds the same pre-tokens.
_SETTLED = "\u0250"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable ones as they are, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()


class PreTokens:
    """Splits texts into the pre-tokens of a byte-level BPE tokenizer, with special strings set apart."""

    def __init__(self, name: str):
        self.path = vocabulary_path(name)
        with open(self.path) as file:
            made = json.load(file)
        before = made["pre_tokenizer"] or {}
        if made["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or made["normalizer"]:
            raise ValueError(f"{name} isn't a byte-level BPE tokenizer without normaliser and prefix space")
        self.tokenizer = Tokenizer.from_file(self.path)
        special = [x["content"] for x in made["added_tokens"]]
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in made["added_tokens"]):
            raise ValueError(f"{name} has added tokens that take in what stands beside them")
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.matcher = regex.compile(public_tokenizers.PATTERN)
        self.remembered: dict[str, tuple[str, ...]] = {}

    def split(self, text: str) -> tuple[str, ...]:
        """The pre-tokens of a text without special strings."""
        if not text or text.isascii() or max(text) < _SETTLED:
            # most are a word, or a word and a full stop or comma
            body = text[1:] if text[:1] == " " else text
            if body.isalpha():
                return (text,)
            if body[-1:] in ".,!?:;" and body[:-1].isalpha():
                return (text[:-1], text[-1])
            return tuple(self.matcher.findall(text))
        return tuple(text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def parts(self, text: str) -> tuple[int, list[str], list[str]]:
        """Special strings in a text, its stretches to be split as they are, and its words that follow a single space."""
        stretches = self.special.split(text) if self.special else [text]
        whole, words = [], []
        for stretch in stretches:
            if any(x in stretch for x in _DOUBTFUL) or not stretch.isascii() and _ODD_SPACE.search(stretch):
                whole.append(stretch)
            else:
                first, *rest = stretch.split(" ")
                whole.append(first)
                words = words + rest if words else rest
        return len(stretches) - 1, whole, words

    def of(self, word: str) -> tuple[str, ...]:
        """The pre-tokens of a word and the space before it, remembered."""
        found = self.remembered.get(word)
        if found is None:
            if len(self.remembered) >= HELD:
                self.remembered.clear()
            found = self.remembered[word] = self.split(" " + word)
        return found

    def pieces(self, pre_token: str) -> int:
        """How many tokens the model makes of a pre-token."""
        return len(self.tokenizer.model.tokenize(pre_token.encode().decode("latin-1").translate(_BYTE_LETTERS)))


def key_of(pre_token: str) -> str:
    """A pre-token itself, or 32 hex digits of a digest for a long one; none of the former is so long."""
    return pre_token if len(pre_token) <= KEY_CHARS else xxhash.xxh3_128_hexdigest(pre_token.encode())


@lru_cache(maxsize=2)
def pre_tokens(name: str) -> PreTokens:
    """The splitter of a tokenizer file, loaded once in each Python worker."""
    return PreTokens(name)


def piece_table(texts: DataFrame, tokenizer: str) -> DataFrame:
    """``key``, ``n`` (in the whole corpus) and ``pieces`` of every distinct pre-token of the column ``text``."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, counts, words = pre_tokens(tokenizer), Counter(), Counter()

        def batch_of() -> pa.RecordBatch:
            for word, n in words.items():
                for pre_token in splitter.of(word):
                    counts[pre_token] += n
            words.clear()
            made = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["pre_token", "n"])
            counts.clear()
            return made

        for batch in batches:
            for text in batch.column(0):
                _, whole, rest = splitter.parts(text.as_py())
                for stretch in whole:
                    counts.update(splitter.split(stretch))
                words.update(rest)
                if len(words) + len(counts) >= HELD:
                    yield batch_of()
        yield batch_of()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = pre_tokens(tokenizer)
        for batch in batches:
            found = batch.column(0).to_pylist()
            pieces = pa.array([splitter.pieces(x) for x in found], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(map(key_of, found), pa.string()), batch.column(1), pieces], names=["key", "n", "pieces"])

    return texts.mapInArrow(tally, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n")).mapInArrow(count, "key string, n long, pieces int")


def head_of(table: DataFrame, entries: int) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens by their keys: at most so many entries.

    Frequencies are binned first, so that only rows of the bins that fit come to the driver.
    """
    binned = table.withColumn("bin", F.floor(F.log2("n") * 16).cast("int"))
    cut, held = None, 0
    for row in binned.groupBy("bin").count().orderBy(F.desc("bin")).collect():
        held += row["count"]
        if held > entries:
            break
        cut = row.bin
    if cut is None:
        return {}
    found = binned.where(F.col("bin") >= cut).select("key", "pieces").toArrow()
    return dict(zip(found["key"].to_pylist(), found["pieces"].to_pylist()))


def count_tokens(df: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text", head_entries: int = HEAD_ENTRIES) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row.

    A null text counts as an empty one: 0 bytes, 0 tokens.  Equal rows each give
    a row.  Other columns are ignored.  ``tokenizer`` names a byte-level BPE file;
    its added tokens are set apart as the library does by default.
    """
    spark = session_of(df)
    texts = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = dict(texts.dtypes)["doc_id"]
    table = written(piece_table(texts.select("text"), tokenizer))
    known = spark.sparkContext.broadcast(head_of(table, head_entries))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row with what the head gives for each text, then one for each of its other pre-tokens."""
        splitter, pieces = pre_tokens(tokenizer), known.value
        of_word: dict[str, tuple[int, tuple[str, ...]]] = {}

        def looked_up(parts: tuple[str, ...]) -> tuple[int, tuple[str, ...]]:
            keys = [x if len(x) <= KEY_CHARS else key_of(x) for x in parts]
            return sum(pieces.get(x, 0) for x in keys), tuple(x for x in keys if x not in pieces)

        for batch in batches:
            rows, bits, n_bytes, sums, names, freqs = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                raw = text.encode()
                digest = xxhash.xxh3_64_intdigest(raw) - (1 << 63)
                total, whole, words = splitter.parts(text)
                rest: Counter[str] = Counter()
                for stretch in whole:
                    n, unknown = looked_up(splitter.split(stretch))
                    total += n
                    rest.update(unknown)
                for word, n in Counter(words).items():
                    found = of_word.get(word)
                    if found is None:
                        if len(of_word) >= HELD:
                            of_word.clear()
                        found = of_word[word] = looked_up(splitter.split(" " + word))
                    total += n * found[0]
                    for x in found[1]:
                        rest[x] += n
                m = len(rest)
                rows.extend([i] * (m + 1))
                bits.extend([digest] * (m + 1))
                n_bytes.append(len(raw))
                n_bytes.extend([None] * m)
                sums.append(total)
                sums.extend([0] * m)
                names.append(None)
                names.extend(rest.keys())
                freqs.append(0)
                freqs.extend(rest.values())
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(bits, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(sums, pa.int64()), pa.array(names, pa.string()), pa.array(freqs, pa.int64())],
                names=["doc_id", "digest", "n_bytes", "known", "key", "freq"],
            )

    rows = texts.mapInArrow(frequencies, f"doc_id {id_type}, digest long, n_bytes long, known long, key string, freq long")
    # Rows without a pre-token join nothing; a key of their own spreads them.  No other key holds letters, digits and a space.
    rows = rows.withColumn("key", F.coalesce("key", F.concat(F.lit("row"), F.col("digest").cast("string"), F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    joined = rows.join(table.select("key", "pieces"), "key", "left")
    summed = joined.groupBy("doc_id", "digest").agg(
        F.count("n_bytes").alias("copies"), F.max("n_bytes").alias("n_bytes"), F.sum(F.col("known") + F.col("freq") * F.coalesce("pieces", F.lit(0))).alias("all_tokens")
    )
    return summed.select("doc_id", "n_bytes", (F.col("all_tokens") / F.col("copies")).cast("long").alias("n_tokens"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has over 1024 tokens."""
    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
