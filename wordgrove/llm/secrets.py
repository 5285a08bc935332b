"""Secret scans by token efficiency (operator 6).

Three kinds of fixed patterns are found as they are.  Beyond them, every run of
characters that keys are made of is encoded with a byte-level BPE vocabulary:
text that a vocabulary was made for takes few tokens, a random string takes
nearly one for every character or two.  A run with a low ratio of characters to
tokens (a lower one for short runs) is reported unless it is a known digest, a
UUID, a number or an identifier made of words and numbers.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgrove.llm.bpe import encoding, vocabulary_path
from wordgrove.llm.common import session_of

VOCABULARY = "byte_bpe_50k.tiktoken"
#: A run with fewer characters a token than this is random.
MAX_RATIO = 2.0
#: Shortest run that is tried against MAX_RATIO, in code points.
MIN_RUN = 20
#: Shorter runs, down to this length, are tried against a stricter ratio.
SHORT_RUN, SHORT_RATIO = 12, 1.5
#: Letters of a part that makes a run of letters only word-like: on average and at most.
WORD_LETTERS, LONGEST_WORD = 4, 15
REPLACEMENT = "[SECRET]"

#: Order of kinds where spans start together.
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_WORDS = ("password", "passwd", "secret", "token", "api")
#: Every access key, long hex string and candidate lies in one of these.
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
#: Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hex digits.
_DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
_UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}\Z")
#: Words in one case or capitalised, and numbers, with separators.  No part is taken back once it is matched, so a long run costs its length.
_IDENTIFIER = re.compile(r"(?:[A-Z]?[a-z]++|(?>[A-Z]+(?![a-z]))|[0-9]{1,8}+(?![0-9])|[+/_=-])*+\Z")

#: The parts of a run of letters: in one case or capitalised.
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def is_known(run: str) -> bool:
    """Whether a run is a digest by its length, a UUID, a number, or an identifier of words and numbers.

    Letters alone are an identifier only if their parts are as long as words.
    """
    if len(run) in _DIGEST_LENGTHS and _DIGEST.match(run):
        return True
    if _UUID.match(run):
        return True
    if not any(c.isalpha() for c in run):
        return True
    if not any(c.isdigit() for c in run):
        parts = [len(x) for x in _PARTS.findall(run)]
        return max(parts) <= LONGEST_WORD and sum(parts) >= WORD_LETTERS * len(parts)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(run, run[1:]))
    return changes <= 2 and _IDENTIFIER.match(run) is not None


def spans(text: str, encoder, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of a text's spans in order; ends are exclusive."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    candidates = []
    for run in _RUN.finditer(text):
        at, whole = run.start(), run.group()
        if "AKIA" in whole:
            found += [(at + m.start(), 1, at + m.end()) for m in _ACCESS.finditer(whole) if len(m[0]) >= 18]
        found += [(at + m.start(), 2, at + m.end()) for m in _HEX.finditer(whole) if len(m[0]) >= 16]
        candidates += [(at + m.start(), at + m.end(), m[0]) for m in _CANDIDATE.finditer(whole) if len(m[0]) >= SHORT_RUN]
    # a candidate meets a span of the fixed patterns if, of those that start before its end, one reaches beyond its start
    base = sorted((s, e) for s, _, e in found)
    starts = [s for s, _ in base]
    reached = list(accumulate((e for _, e in base), max))
    for start, end, run in candidates:
        before = bisect_left(starts, end)
        if (before and reached[before - 1] > start) or is_known(run):
            continue
        if len(run) < (max_ratio if len(run) >= MIN_RUN else min(max_ratio, SHORT_RATIO)) * len(encoder.encode_ordinary(run)):
            found.append((start, 3, end))
    return sorted(found)


def _listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO) -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``n_random``, ``base`` and ``spans`` of every row.

    Spans are written ``kind:start:end`` in code points, ends exclusive, by start
    and then by kind, joined by commas; ``base`` has those of the fixed patterns.
    A null text counts as an empty one.  Equal rows each give a row; other columns
    are ignored.
    """
    session_of(df)
    texts = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(vocabulary_path(vocabulary), public_tokenizers.PATTERN)
        for batch in batches:
            rows = [spans(x.as_py(), encoder, max_ratio) for x in batch.column(1)]
            counts = [pa.array([sum(k == kind for _, k, _ in row) for row in rows], pa.int64()) for kind in range(4)]
            base = pa.array([_listed([x for x in row if x[1] < 3]) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, base, pa.array(map(_listed, rows), pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base", "spans"])

    return texts.mapInArrow(scanned, f"doc_id {dict(texts.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, n_random long, base string, spans string")


def redact(df: DataFrame, *, text_col: str = "text", vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO, replacement: str = REPLACEMENT) -> DataFrame:
    """The same rows with every span (overlapping ones as one) replaced in ``text_col``; a null text stays null."""
    session_of(df)
    at, names = df.columns.index(text_col), df.columns

    def cleaned(text: str | None, encoder) -> str | None:
        if not text or not (found := spans(text, encoder, max_ratio)):
            return text
        parts, upto = [], 0
        open_at, open_to = found[0][0], found[0][2]
        for start, _, end in [*found[1:], (len(text) + 1, 0, len(text) + 1)]:
            if start < open_to:
                open_to = max(open_to, end)
                continue
            parts += [text[upto:open_at], replacement]
            upto, open_at, open_to = open_to, start, end
        return "".join([*parts, text[upto:]])

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(vocabulary_path(vocabulary), public_tokenizers.PATTERN)
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([cleaned(x.as_py(), encoder) for x in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(redacted, df.schema)


def op6_secret_spans(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_random")
