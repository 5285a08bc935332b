"""Scalar functions on words, ids, key-value strings, tags and segments: columns in, a column out."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_v1_id(col: Column) -> Column:
    """A non-negative integer, else null."""
    return F.when(col.rlike(r"^\d+$"), col.try_cast("bigint"))


def parse_v2_id(col: Column) -> Column:
    """``tree.lex`` as a struct of longs, else null; numbers have no leading zeros."""
    good = col.rlike(r"^(0|[1-9]\d*)\.(0|[1-9]\d*)$")
    half = lambda i: F.split_part(col, F.lit("."), F.lit(i)).try_cast("bigint")
    return F.when(good, F.struct(half(1).alias("tree"), half(2).alias("lex")))


def kw_parse(col: Column) -> Column:
    """``k=v&k=v|k=v`` as an array of maps; an empty string has none.  A key that comes twice is an error."""
    group = lambda g: F.map_from_entries(F.transform(F.split(g, "&"), lambda p: F.struct(F.substring_index(p, "=", 1), F.regexp_replace(p, r"^[^=]*=", ""))))
    return F.when(col == "", F.array().cast("array<map<string,string>>")).otherwise(F.transform(F.split(col, r"\|"), group))


def kw_format(maps: Column) -> Column:
    """The reverse, with sorted keys."""
    pair = lambda e: F.concat(e["key"], F.lit("="), e["value"])
    return F.array_join(F.transform(maps, lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), pair), "&")), "|")


def kw_is_legal(col: Column) -> Column:
    """Whether a key or value has none of the characters that the format uses itself."""
    return ~col.rlike(r"[=&|\n\t]")


def techlemma_to_lemma(col: Column) -> Column:
    """A technical lemma without what follows ``_`` or `` ` `` and without a homonym number."""
    return F.regexp_replace(F.regexp_replace(col, r"(?s)[_`].+", ""), r"-\d+$", "")


def short_with_number(col: Column) -> Column:
    """A technical lemma without what follows ``_`` or `` ` ``, its homonym number kept."""
    return F.regexp_replace(col, r"(?s)[_`].+", "")


def homonym_number(col: Column) -> Column:
    """The homonym number of a technical lemma, else null."""
    return F.regexp_extract(short_with_number(col), r"-(\d+)$", 1).try_cast("int")


def suffix_code_parent(lemma: Column, code: Column) -> Column:
    """The parent that a code ``*nTEXT`` names: n characters cut off the lemma, the text appended; null without a code."""
    cut, added = F.regexp_extract(code, r"\*(\d+)([^)]*)", 1), F.regexp_extract(code, r"\*(\d+)([^)]*)", 2)
    left = F.length(lemma) - cut.try_cast("int")
    return F.when((cut != "") & (left >= 0), F.concat(F.substring(lemma, F.lit(1), left), added))


def is_range(start: Column, end: Column) -> Column:
    """Whether the start is before the end."""
    return start < end


def range_overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Whether two ranges share a place; null if one of them isn't a range."""
    return F.when(is_range(a_start, a_end) & is_range(b_start, b_end), (a_start < b_end) & (b_start < a_end))


def common_prefix_length(a: Column, b: Column) -> Column:
    """How many characters two words share from their start."""
    longest = F.least(F.length(a), F.length(b))
    steps = F.filter(F.sequence(F.lit(0), longest), lambda k: F.substring(a, F.lit(1), k) == F.substring(b, F.lit(1), k))
    return F.array_max(steps)


def without_prefix(word: Column, length: Column) -> Column:
    """What follows the first so many characters."""
    return F.substring(word, length + 1, F.length(word))


def merge_tags(tags: Column) -> Column:
    """A mask of an array of equally long tags: ``?`` where they differ."""
    first = F.element_at(tags, 1)
    at = lambda t, i: F.substring(t, i, F.lit(1))
    mask = F.transform(F.sequence(F.lit(1), F.length(first)), lambda i: F.when(F.forall(tags, lambda t: at(t, i) == at(first, i)), at(first, i)).otherwise("?"))
    return F.array_join(mask, "")


def tag_features(tag: Column, positions: dict[int, tuple[str, dict[str, str]]]) -> Column:
    """Features of a positional tag as a map: for each position (from 1) a name and the values of its letters."""
    parts = []
    for position, (name, values) in sorted(positions.items()):
        letter = F.substring(tag, position, 1)
        value = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[letter]
        parts.append(F.struct(F.lit(name).alias("key"), value.alias("value")))
    return F.map_from_entries(F.filter(F.array(*parts), lambda e: e["value"].isNotNull()))


def mark_features(text: Column, marks: dict[str, tuple[str, str]]) -> Column:
    """Features that marks in a text stand for, as a map; a name with two values has none."""
    found = F.filter(F.array(*[F.when(F.contains(text, F.lit(m)), F.struct(F.lit(n).alias("key"), F.lit(v).alias("value"))) for m, (n, v) in marks.items()]), lambda e: e.isNotNull())
    distinct = F.array_distinct(found)
    alone = F.filter(distinct, lambda e: F.size(F.filter(distinct, lambda o: o["key"] == e["key"])) == 1)
    return F.map_from_entries(alone)


def relation_text(kind: Column, sources: Column, main: Column, target: Column) -> Column:
    """``Type:(a+*b)->c``, the main source starred."""
    named = F.transform(sources, lambda s: F.when(s == main, F.concat(F.lit("*"), s)).otherwise(s))
    return F.concat(kind, F.lit(":("), F.array_join(named, "+"), F.lit(")->"), target)


def is_capitalised(col: Column) -> Column:
    return col.rlike(r"^\p{Lu}")


def is_lower(col: Column) -> Column:
    return (col == F.lower(col)) & col.rlike(r"\p{L}")


def title_case(col: Column) -> Column:
    """The first character in upper case, the others as they are."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.substring(col, F.lit(2), F.length(col)))


def affix_ngrams(word: Column, longest: int = 6) -> dict[str, Column]:
    """Prefixes and suffixes of 1 to ``longest`` characters by name; ``NA`` where the word is too short."""
    made = {}
    for k in range(1, longest + 1):
        enough = F.length(word) >= k
        made[f"prefix_{k}"] = F.when(enough, F.substring(word, 1, k)).otherwise("NA")
        made[f"suffix_{k}"] = F.when(enough, F.right(word, F.lit(k))).otherwise("NA")
    return made


def json_get(col: Column, path: str, default: str | None = None) -> Column:
    """A value of a JSON text by its path, or a default where it is absent."""
    return F.coalesce(F.get_json_object(col, path), F.lit(default))


def edit_distance(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def _lcs_length(a: list | None, b: list | None) -> int | None:
    if a is None or b is None:
        return None
    at: dict = {}
    for j, word in enumerate(b):
        if word is not None:
            at[word] = at.get(word, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for word in a:
        if same := at.get(word, 0):
            met = row & same
            row = (row + met | row - met) & full
    return len(b) - row.bit_count()


def lcs_length(a: Column, b: Column) -> Column:
    """The length of the longest common subsequence of two arrays of strings; a null string equals none.

    A row of the usual table is one whole number, a bit for each place of ``b``, and
    the next row comes from it by one addition.
    """

    def lengths(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_lcs_length(x, y) for x, y in zip(a, b)], dtype="Int32")

    return F.pandas_udf(lengths, "int")(a, b)


def first_rule(word: Column, pos: Column, rules: list[tuple[str, str, str | None]]) -> Column:
    """The id of the first rule (id, pattern, part of speech or none) that fits a word; null if none does."""
    out = F.lit(None).cast("string")
    for name, pattern, needed in reversed(rules):
        fits = word.rlike(pattern) if needed is None else word.rlike(pattern) & (pos == needed)
        out = F.when(fits, F.lit(name)).otherwise(out)
    return out


def transliterate(col: Column, replacements: list[tuple[str, str]]) -> Column:
    """A text after ordered replacements."""
    for old, new in replacements:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def both_forms(col: Column, replacements: list[tuple[str, str]], other: list[tuple[str, str]]) -> Column:
    """Two transliterations as an array, once if they are equal."""
    return F.array_distinct(F.array(transliterate(col, replacements), transliterate(col, other)))


def marked_root(col: Column, vowels: str) -> Column:
    """The root marked ``[...]`` in a segmented word if it ends in one of the vowels, else null."""
    root = F.regexp_extract(col, rf"\[([^\]]*[{vowels}])\]", 1)
    return F.when(root != "", root)
