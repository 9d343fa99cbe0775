"""URL filter by host-suffix and path-prefix expressions.

Each URL is expanded into expressions (a host suffix and a path prefix), the
short hash prefix of each is equi-joined with the rules' prefixes, and the full
digests confirm a match. The longest confirmed rule decides. Everything is
column expressions.

Defined results: a null URL or one without ``://`` has an empty host and path
and gets the default verdict; an empty host matches no rule. Repeated rows are
judged one by one. Columns of the pages other than the URL are passed through
under the names asked for, so clashing names do no harm. Rules with a null host
or path are ignored; the same expression ruled twice is blocked if any rule
blocks it. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.llm.base import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8  # four bytes


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column, labels: list[int]) -> Column:
    """The last labels of the host, as many as some rule has."""
    parts = F.split(host, r"\.")
    found = [F.when((host != "") & (F.size(parts) >= n), F.array_join(F.slice(parts, -n, n), ".")) for n in labels]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def path_prefixes(path: Column, slashes: list[int], lengths: list[int]) -> Column:
    """The prefixes up to the slashes that some rule ends with, and those of the given lengths."""
    count = F.size(F.split(path, "/")) - 1
    found = [F.when(count >= n, F.concat(F.substring_index(path, "/", n), F.lit("/"))) for n in slashes]
    found += [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    return F.array_distinct(F.array_compact(F.array(*found))) if found else F.array().cast("array<string>")


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge(pages: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", default: str = "allow") -> DataFrame:
    """``keep`` columns, host, path, rule and verdict of every row of ``pages``.

    ``rules`` has host, path and verdict ('allow' or 'block'). How many labels
    rule hosts have, how many slashes the paths that end with one, and how long
    the others are, is read once (as many rows as differ): only such suffixes and
    prefixes of a URL can meet a rule, so a URL of any length has a number of
    expressions that the rules bound.
    """
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").where(
        "host is not null and path is not null"
    )
    slashed = F.col("path").endswith("/")
    shapes = rules.select(
        F.size(F.split("host", r"\.")).alias("labels"),
        F.when(slashed, F.size(F.split("path", "/")) - 1).alias("slashes"),
        F.when(~slashed, F.length("path")).alias("length"),
    ).distinct().collect()
    labels, slashes, lengths = (sorted({row[i] for row in shapes} - {None}) for i in range(3))
    signed = (
        rules.groupBy("host", "path")
        .agg(F.max("verdict").alias("rule_verdict"))  # 'block' is the larger word
        .select(
            digest(F.col("host"), F.col("path")).alias("rule_digest"),
            F.concat("host", "path").alias("rule"),
            F.length("host").alias("rule_host_length"),
            "rule_verdict",
        )
        .withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX_HEX))
    )
    rows = pages.select(
        *[F.col(name).alias(f"kept_{i}") for i, name in enumerate(keep)],
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.monotonically_increasing_id().alias("row_key"),
    )
    expressions = F.flatten(
        F.transform(
            host_suffixes(F.col("host"), labels),
            lambda h: F.transform(path_prefixes(F.col("path"), slashes, lengths), lambda p: digest(h, p)),
        )
    )
    expanded = rows.withColumn("url_digest", F.explode_outer(expressions)).withColumn(
        "url_prefix", F.substring("url_digest", 1, PREFIX_HEX)
    )
    confirmed = expanded.join(
        signed, (F.col("url_prefix") == F.col("rule_prefix")) & (F.col("url_digest") == F.col("rule_digest")), "left"
    )
    # all expressions of a row lie in one task, so the partial aggregate leaves one row for the shuffle
    best = F.max(
        F.when(
            F.col("rule").isNotNull(),
            F.struct(F.length("rule").alias("l"), F.col("rule_host_length").alias("h"), F.col("rule_verdict").alias("v"), F.col("rule").alias("r")),
        )
    )
    kept = [f"kept_{i}" for i in range(len(keep))]
    return (
        confirmed.groupBy("row_key", *kept, "host", "path")
        .agg(best.alias("best"))
        .select(
            *[F.col(f"kept_{i}").alias(name) for i, name in enumerate(keep)],
            "host",
            "path",
            F.col("best.r").alias("rule"),
            F.coalesce("best.v", F.lit(default)).alias("verdict"),
        )
    )


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_SQL = r"""
WITH u AS (
  SELECT page_id, row_number() OVER () AS k, position('://' IN coalesce(url, '')) AS mark, coalesce(url, '') AS url FROM pages
), h AS (
  SELECT page_id, k, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM u
), p AS (
  SELECT page_id, k, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM h
), rules(rhost, rpath, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT k, rhost || rpath AS rule, v, row_number() OVER (PARTITION BY k ORDER BY length(rhost || rpath) DESC) AS n
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM m WHERE n = 1) USING (k)
"""


@query("op8_url_filter", _SQL)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules, ["page_id"])
