"""URL filters by host-suffix and path-prefix expressions (operator 10).

Each distinct (host, path) is expanded into the expressions that a rule could have: host suffixes
with as many labels as some rule's host, joined with path prefixes as long as some rule's path.
Expressions meet rules in an equi-join on the first four bytes of their SHA-256; the full digest
confirms. The longest rule wins; among rules of the same expression `allow` wins.

Defined cases: a null URL or one without ``://`` has an empty host and path; no rule gives a null
rule and the method's verdict ``allow`` (nothing lists the URL); rules with null or empty host are
ignored, a null path is empty; repeated pages and rules give one row per page row; an empty page
table gives no rows. A host with a port or user name is compared as it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.columns import LOWER, UPPER, table
from editpulse.operators.sizing import broadcast_if_small

HOST_PATH = r"://([^/?#]*)([^?#]*)"
DEFAULT_VERDICT = "allow"

# The rules of the registered query, as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, HOST_PATH, 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, HOST_PATH, 2), F.lit(""))


def _rule_table(rules: DataFrame) -> DataFrame:
    """One row per expression, with its digest; `allow` sorts first where a rule is repeated."""
    return (
        rules.where(F.col("host") != "")
        .select("verdict", "host", F.coalesce("path", F.lit("")).alias("path"))
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .select(
            "host", "path", "verdict",
            F.concat("host", F.lit("\n"), "path").alias("expression"),
        )
        .withColumn("digest", F.sha2("expression", 256))
        .withColumn("short", F.substring("digest", 1, 8))
    )


def _shapes(rules: DataFrame) -> DataFrame:
    """The distinct (labels of the host, length of the path) of the rules."""
    labels = F.size(F.split("host", r"\."))
    return rules.select(labels.alias("labels"), F.char_length("path").alias("length")).distinct()


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``.

    ``rules`` has ``verdict, host, path``. Hot hosts are folded to their distinct (host, path)
    before anything is expanded; an URL yields one expression per shape of the rule list, and the
    number of shapes (label counts times path lengths, both bounded by the longest rule) is all that
    reaches the driver. The rules are broadcast only if measured small.
    """
    listed = _rule_table(rules)
    shapes = sorted((r.labels, r.length) for r in _shapes(listed).collect())
    urls = pages.select(
        F.col(id_col).alias("page_id"),
        url_host(F.col(url_col)).alias("host"),
        url_path(F.col(url_col)).alias("path"),
    )
    labels = F.size(F.split("host", r"\."))
    expressions = [
        F.when(
            (labels >= n) & (F.char_length("path") >= length),
            F.concat(
                F.substring_index("host", ".", -n), F.lit("\n"), F.substring("path", 1, length)
            ),
        )
        for n, length in shapes
    ]
    expanded = (
        urls.select("host", "path").distinct()
        .withColumn("expression", F.explode(F.array_compact(F.array(*expressions or [F.lit(None).cast("string")]))))
        .withColumn("digest", F.sha2("expression", 256))
        .withColumn("short", F.substring("digest", 1, 8))
    )
    known = broadcast_if_small(
        listed.select(
            F.col("short").alias("rule_short"),
            F.col("digest").alias("rule_digest"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        )
    )
    best = (
        expanded.join(known, (F.col("short") == F.col("rule_short")) & (F.col("digest") == F.col("rule_digest")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.char_length("rule").alias("n"), "rule", "verdict")).alias("best"))
    )
    return urls.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
OP10_SQL = f"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(verdict, host, path) AS (VALUES {_RULE_ROWS}),
best AS (
  SELECT u.host, u.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
    max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) u JOIN r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY ALL)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN best ON u.host = best.host AND u.path = best.path
"""
