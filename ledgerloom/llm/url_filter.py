"""URL rules found through a blocked Bloom filter and an exact hash join.

A rule has a host, which stands for itself and all its subdomains, and a beginning of a
path. The rules' keys (host, path) set bits of a blocked Bloom filter: each key chooses a
block of ``WORDS`` 64-bit words by one hash and sets one bit in every word by another, so
that a probe touches one block. A URL is probed with every ending of its host at a dot,
combined with its path's beginnings of those lengths that occur in rules. Probes that the
filter passes go to an exact join with the rules, which removes false positives; the
longest rule wins. All of it is DataFrame functions.

The filter's size is a parameter (bits per rule). Filter blocks and rules are broadcast
where they are measured to be small; beyond that they are joined by shuffle.

Defined results: a null url or one without ``://`` has an empty host and path and no rule;
a host may hold a port or user, which are then part of its text; an empty path begins with
no rule's ``/``; without a fitting rule the verdict is ``default``; rows of the same id are judged one
by one, each row once, whatever the ids; two rules of the same host and path: the smaller
action in alphabetical order counts; an empty table gives no rows, no rules give the
default everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import small, table

WORDS = 4
BITS_PER_RULE = 16

# Host, beginning of the path, action.
CONTRACT_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path as they stand in the url; empty where there is none."""
    place = F.locate("://", url)
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")
    whole = F.substring_index(F.substring_index(F.coalesce(rest, F.lit("")), "?", 1), "#", 1)
    host = F.substring_index(whole, "/", 1)
    return F.translate(host, _UPPER, _LOWER), F.substring(whole, F.length(host) + 1, F.length(whole))


def _hash(host: Column, path: Column, seed: int) -> Column:
    return F.xxhash64(host, path, F.lit(seed))


def _block(host: Column, path: Column, n_blocks: int) -> Column:
    return F.pmod(_hash(host, path, 1), F.lit(n_blocks))


def _masks(host: Column, path: Column) -> list[Column]:
    """One bit of each word; six bits of one hash choose it."""
    h = _hash(host, path, 2)
    return [_one_bit(F.shiftrightunsigned(h, 6 * w).bitwiseAND(F.lit(63))) for w in range(WORDS)]


def _one_bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def bloom_blocks(rules: DataFrame, n_blocks: int) -> DataFrame:
    """The filter: ``block`` and the words ``w0`` ... of every block that has a bit set."""
    masks = _masks(F.col("host"), F.col("path"))
    return (
        rules.select(_block(F.col("host"), F.col("path"), n_blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
        .groupBy("block")
        .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    )


def possible_hits(probes: DataFrame, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """The probes (with ``host_end`` and ``path_start``) whose bits are all set."""
    host, path = F.col("host_end"), F.col("path_start")
    keyed = probes.withColumn("block", _block(host, path, n_blocks))
    passed = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(host, path))]
    every = passed[0]
    for p in passed[1:]:
        every = every & p
    return keyed.join(small(blocks), "block").filter(every).select(*probes.columns)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", bits_per_rule: int = BITS_PER_RULE) -> DataFrame:
    """Columns ``page_id``, ``host``, ``path``, ``rule`` (host and path of the longest fitting
    rule, else null) and ``verdict``; ``rules``: host, path, action."""
    rules = rules.groupBy("host", "path").agg(F.min("action").alias("action"))
    size = rules.agg(F.count("*"), F.collect_set(F.length("path")), F.max(F.size(F.split("host", "\\.")))).first()
    n_blocks = max(1, -(-size[0] * bits_per_rule // (64 * WORDS)))
    lengths = sorted(size[1])
    host, path = host_and_path(F.col(f"`{url_col}`"))
    # url and id are all that is read; a row number stands for the row through the joins
    seen = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    dots = F.split("host", "\\.")
    # an ending has no more labels than the rules' hosts have
    nearest = F.greatest(F.lit(1), F.size(dots) - F.lit((size[2] or 1) - 1))
    ends = F.transform(F.sequence(nearest, F.size(dots)), lambda i: F.array_join(F.slice(dots, i, F.size(dots)), "."))
    starts = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    # every different (host, path) is probed once
    urls = seen.select("host", "path").distinct()
    probes = urls.select("host", "path", F.explode(ends).alias("host_end")).select("*", F.explode(F.array_compact(starts)).alias("path_start"))
    passed = possible_hits(probes, bloom_blocks(rules, n_blocks), n_blocks)
    exact = rules.select(F.col("host").alias("host_end"), F.col("path").alias("path_start"), "action")
    hits = passed.join(small(exact), ["host_end", "path_start"])
    rule = F.concat("host_end", "path_start")
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct(rule.alias("rule"), "action"), F.struct(F.length("host_end"), F.length("path_start"))).alias("best"))
    return seen.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))


def op8_url_filter(spark, d):
    rules = spark.createDataFrame(CONTRACT_RULES, "host string, path string, action string")
    return judge_urls(table(spark, d, "pages"), rules)


OP8_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^?#]*') AS whole FROM parts),
judged AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(whole, length(raw_host) + 1) AS path FROM split)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM judged)
LEFT JOIN (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')) r(rule, action) USING (rule)
"""
