"""URL rules by host and path: expressions of a URL meet the rules on short hash prefixes.

A URL is expanded into (host suffix, path prefix) expressions. Expressions and rules meet in an
equi-join on the first 32 bits of their SHA-256; equal full digests confirm a hit, and the longest
rule that fits decides. Only expressions as deep as the deepest rule are made, so the number of
expressions per URL is bounded by the rules and no rule can be missed.

A rule path may end anywhere, as in /ab: its expression is the path up to the last slash, and
the rest is compared after the digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import table
from tarmac.session import stored

#: Host, path, verdict.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
DEFAULT_VERDICT = "allow"
#: A rule row is at most some hundred bytes; up to this many rules go to every executor.
BROADCAST_RULES = 20_000


def host_and_path(url):
    """Columns host and path of a URL column; both empty without a scheme separator or URL."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.regexp_extract(rest, r"^(?s)([^?#]*)", 1)
    host = F.translate(
        F.substring_index(rest, "/", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz",
    )
    return host, F.substring(rest, F.length(host) + F.lit(1), F.length(rest))


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _folder(path):
    """The path up to its last slash."""
    return F.regexp_extract(path, r"^(?s)(.*/)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules with their expression's digest; of equal rules a blocking one counts."""
    rules = rules.select(
        F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    ).where("rule_host is not null and rule_path is not null and verdict is not null")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("rule_host"), _folder(F.col("rule_path")))
    return rules.select(
        "*", digest.alias("rule_digest"), F.substring(digest, 1, 8).alias("prefix")
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of `pages` (page_id, url).

    Each distinct (host, path) is judged once, then handed to its rows. Null and malformed URLs
    have empty host and path, no rule and the default verdict; so do rows of an empty rule
    table. Repeated rows stay repeated. Other columns of `pages` are not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rules = prepared_rules(rules)
    depth = rules.agg(
        F.count("*"),
        F.max(F.size(F.split("rule_host", r"\."))),
        F.max(F.length("rule_path") - F.length(F.translate("rule_path", "/", ""))),
    ).first()
    n_rules, labels, slashes = depth[0], depth[1] or 0, depth[2] or 0

    urls = rows.where("host <> '' and path like '/%'").select("host", "path").distinct()
    parts, folders = F.split("host", r"\."), F.split("path", "/", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(folders) - 1, F.lit(max(slashes, 1)))),
        lambda n: F.concat(F.array_join(F.slice(folders, 1, n), "/"), F.lit("/")),
    )
    expressions = (
        urls.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("all"))
        .select("host", "path", "suffix", F.explode("all").alias("folder"))
        .withColumn("digest", _digest(F.col("suffix"), F.col("folder")))
        .withColumn("prefix", F.substring("digest", 1, 8))
    )
    side = F.broadcast(rules) if n_rules <= BROADCAST_RULES else rules
    hits = expressions.join(side, "prefix").where(
        "digest = rule_digest and startswith(path, rule_path)"
    )
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        F.concat("rule_host", "rule_path").alias("rule"),
        "verdict",
    )
    # Stored, so that the join below can split the rows of a URL that very many share.
    best = stored(hits.groupBy("host", "path").agg(F.max(rank).alias("best")), "judged")
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


SQL = """
WITH cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0
        THEN regexp_extract(substr(url, instr(url, '://') + 3), '^([^?#]*)', 1, 's') ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, translate(split_part(coalesce(rest, ''), '/', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        substr(coalesce(rest, ''), length(split_part(coalesce(rest, ''), '/', 1)) + 1) AS path
    FROM cut
), rules(h, p, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged AS (
    SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) u
    JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN judged USING (host, path)
"""
