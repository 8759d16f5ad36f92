"""URL rules by host suffix and path prefix, joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import ascii_lower, table

HASH_PREFIX = 8
# Host, path, verdict.
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: from there up
    to ? # or the end. Both are empty if the url is null or has no ://."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    upto = F.substring_index(F.substring_index(rest, "#", 1), "?", 1)
    host = F.substring_index(upto, "/", 1)
    return ascii_lower(host), upto.substr(F.length(host) + 1, F.length(upto) + 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(F.encode(host, "UTF-8"), F.lit(b"\x00"), F.encode(path, "UTF-8")), 256)


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
) -> DataFrame:
    """The pages' columns with host, path, rule and verdict by the longest rule that fits.

    `rules` has host, path and verdict. A rule fits its host and all subdomains if the path
    starts with the rule's. Each different host and path is expanded into its host suffixes
    and those of its path prefixes that are as long as some rule's path. Expressions meet
    rules by the first HASH_PREFIX digits of a digest; matches are confirmed by the whole
    digest. The longest rule (host and path together) wins, of equal ones a block, and
    where none fits the verdict is `default`.

    Pages that share host and path are judged once, so a hot host costs one row. Null urls
    and urls without :// have empty host and path and fit no rule. Rules with a null host or
    verdict or an empty host are ignored, a null path is empty, a leading dot of the host and
    its case are. No rules, or no pages, give the default or an empty table. Columns of the
    pages called host, path, rule or verdict are replaced by the result's.
    """
    result = ("host", "path", "rule", "verdict")
    host, path = host_and_path(pages[url_col])
    kept = [pages[c] for c in pages.columns if c not in result]
    parsed = pages.select(*kept, host.alias("__pc_host"), path.alias("__pc_path"))

    clean = (
        rules.select(
            F.regexp_replace(ascii_lower(rules["host"]), r"^\.+", "").alias("r_host"),
            F.coalesce(rules["path"], F.lit("")).alias("r_path"),
            rules["verdict"].alias("r_verdict"))
        .where("r_host <> '' and r_verdict is not null")
        .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
        .groupBy("r_digest")
        .agg(F.first("r_host").alias("r_host"), F.first("r_path").alias("r_path"),
             F.max("r_verdict").alias("r_verdict"))
        .withColumn("r_key", F.substring("r_digest", 1, HASH_PREFIX))
    )
    # How long rule paths are: no more numbers than the longest one has characters.
    sizes = [r[0] for r in clean.select(F.length("r_path")).distinct().collect()]

    places = parsed.where("__pc_host <> ''").select("__pc_host", "__pc_path").distinct()
    labels = F.split("__pc_host", r"\.")
    suffixes = F.transform(
        labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    lengths = F.filter(
        F.array(*[F.lit(n) for n in sorted(sizes)]).cast("array<int>"),
        lambda n: n <= F.length("__pc_path"))
    expressions = (
        places.withColumn("suffixes", F.array_distinct(suffixes)).withColumn("lengths", lengths)
        .select("__pc_host", "__pc_path", F.explode("suffixes").alias("suffix"), "lengths")
        .select("__pc_host", "__pc_path", "suffix", F.explode("lengths").alias("n"))
        .withColumn("digest", _digest(
            F.col("suffix"), F.col("__pc_path").substr(F.lit(1), F.col("n"))))
        .withColumn("key", F.substring("digest", 1, HASH_PREFIX))
        .select("__pc_host", "__pc_path", "digest", "key")
    )
    fits = expressions.join(
        clean, (F.col("key") == F.col("r_key")) & (F.col("digest") == F.col("r_digest")))
    best = fits.groupBy("__pc_host", "__pc_path").agg(F.max(F.struct(
        (F.length("r_host") + F.length("r_path")).alias("size"),
        (F.col("r_verdict") == "block").alias("blocks"),
        F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"),
    )).alias("__pc_best"))
    return parsed.join(best, ["__pc_host", "__pc_path"], "left").select(
        *[c for c in pages.columns if c not in result],
        F.col("__pc_host").alias("host"), F.col("__pc_path").alias("path"),
        F.col("__pc_best.rule").alias("rule"),
        F.coalesce(F.col("__pc_best.verdict"), F.lit(default)).alias("verdict"))


def op7_url_filters(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(pages.select("page_id", "url"), rules).drop("url")


OP7_SQL = """
WITH rules(r_host, r_path, r_verdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                       ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fits AS (
  SELECT page_id, host, path, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY page_id, host, path
                            ORDER BY length(r_host || r_path) DESC) AS place
  FROM parts JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT parts.page_id, parts.host, parts.path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT DISTINCT * FROM fits WHERE place = 1) f
  ON f.page_id IS NOT DISTINCT FROM parts.page_id AND f.host = parts.host AND f.path = parts.path
"""
