"""URL filters as a sort-merge range join (operator 7).

A host's labels in reverse, each closed by a separator, make a key under which a
host and all its subdomains are one interval.  Rules and URLs are dealt out by
ranges of keys, every rule to all ranges that its interval touches, and sorted
together.  A sweep over a sorted range keeps a stack of the rule hosts that are
open at the current key; each of them holds its path prefixes.  Equal hosts are
split by the rows' ids, so one host may fill many ranges.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgrove.llm.common import session_of, written

SEPARATOR = "\x00"
#: Above every key that starts with a rule's key.
_LAST = "\U0010ffff"

#: The rules of the registered query: verdict, host, path prefix.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DEFAULT_VERDICT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://`` of a URL, without what ``?`` or ``#`` begin; empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.substring_index(F.substring_index(F.coalesce(rest, F.lit("")), "?", 1), "#", 1)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.substring_index(_rest(url), "/", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = _rest(url)
    return F.substring(rest, F.length(F.substring_index(rest, "/", 1)) + 1, F.length(rest))


def host_key(host: Column) -> Column:
    """The labels of a host in reverse, each closed by a separator; an empty host is before all."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), SEPARATOR), F.lit(SEPARATOR)))


def rule_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    """Rules as a frame of ``verdict``, ``host``, ``path``."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row.

    The longest rule (host and path together, then the longer host) that fits
    wins; of equal rules a block wins.  Where none fits, ``rule`` is null and
    ``verdict`` is ``default``.  A null URL or one without ``://`` has an empty
    host and path, which only rules with an empty host fit.  Equal rows each give
    a row; other columns are ignored.  ``rules`` may be of any number.
    """
    spark = session_of(pages)
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).withColumn("key", host_key(F.col("host")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows of one host are told apart by their place, so that neither it nor a repeated or missing id fills a range
    numbered = urls.withColumn("row", F.monotonically_increasing_id())
    dealt = written(numbered.repartitionByRange(parts, "key", F.xxhash64("row")).drop("row").withColumn("part", F.spark_partition_id()))
    # at most one range for each shuffle partition, so these are few whatever the input
    ranges = [r for r in dealt.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("part").collect()]
    held = spark.sparkContext.broadcast(([r.part for r in ranges], [r.low for r in ranges], [r.high for r in ranges]))
    keyed = rules.select("verdict", F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path")).dropDuplicates().withColumn("key", host_key(F.col("host")))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each range that a rule's interval of keys meets, found by bisection: ranges follow each other."""
        numbers, lows, highs = held.value
        for batch in batches:
            rows, parts = [], []
            for i, key in enumerate(batch.column(3).to_pylist()):
                meets = numbers[bisect_left(highs, key) : bisect_right(lows, key + _LAST)]
                rows += [i] * len(meets)
                parts += meets
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *batch.take(pa.array(rows, pa.int64())).columns], names=["part", *batch.schema.names])

    touching = keyed.mapInArrow(touched, "part int, verdict string, host string, path string, key string")
    page_type = dict(urls.dtypes)["page_id"]
    stream = dealt.select("part", "key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict")).unionByName(
        touching.select("part", "key", F.lit(0).alias("kind"), F.lit(None).cast(page_type).alias("page_id"), "host", "path", "verdict")
    )
    ordered = stream.repartitionById(parts, "part").sortWithinPartitions("part", "key", "kind", "path")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # of (key, host, {path: verdict}, lengths of paths)
        for batch in batches:
            keep, hosts, paths, fitting, verdicts = [], [], [], [], []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 6)]
            for i, (p, key, kind, host, path, verdict) in enumerate(zip(*columns)):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, set()))
                    known = stack[-1][2]
                    known[path] = "block" if known.get(path) == "block" else verdict
                    stack[-1][3].add(len(path))
                    continue
                best = None
                for _, rule_host, known, lengths in stack:
                    for n in lengths:
                        if n <= len(path) and (found := known.get(path[:n])) is not None:
                            this = (len(rule_host) + n, len(rule_host), rule_host + path[:n], found)
                            best = this if best is None or this[:2] > best[:2] else best
                keep.append(i)
                hosts.append(host)
                paths.append(path)
                fitting.append(best[2] if best else None)
                verdicts.append(best[3] if best else default)
            ids = batch.column(3).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.string()) for x in (hosts, paths, fitting, verdicts))], names=["page_id", "host", "path", "rule", "verdict"])

    return ordered.mapInArrow(sweep, f"page_id {page_type}, host string, path string, rule string, verdict string")


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_frame(spark))


OP7_SQL = """
WITH rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM cut),
fits AS (
  SELECT p.n, r.rhost || r.rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.n ORDER BY length(r.rhost) + length(r.rpath) DESC, length(r.rhost) DESC) AS k
  FROM parsed p JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN fits f ON f.n = p.n AND f.k = 1
"""
