"""URL filters: host-suffix and path-prefix expressions, joined with rules on short hash prefixes.

A rule is a host and a path prefix with an action. It fits a URL whose host is the rule's host or below it and whose path starts with the
rule's path. Every distinct (host, path) is expanded into its host suffixes, cut at dots, times the prefixes of its path whose
lengths occur among the rules (found from the rules, so nothing is missed). Expressions and rules meet on the first ``PREFIX`` hex digits of
the SHA-256 of ``host + path``; the full digest confirms. Of the rules that fit the longest wins, at equal length the blocking one,
then the first in order.

URLs are made distinct by host and path before they are expanded, so a page that stands for a third of all rows costs
one expansion. Up to ``BROADCAST_RULES`` rules go to all workers; more are copied ``SALT`` times and joined by shuffle with salted
expressions, since nearly all expressions share suffixes such as ``com/``.

A null URL, or one without ``://``, has an empty host and path; no rule fits an empty host. Where no rule fits, the default verdict holds.
Rules with a null host, path or action are ignored. Rows are never dropped or merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import lower_az, read_table, written

PREFIX, BROADCAST_RULES, SALT = 8, 100_000, 16
DEFAULT = "allow"

#: Host, path, action.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_az(rest), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?>.*?://)[^/?#]*(/[^?#]*)", 1), F.lit(""))


def matched(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, action)`` for the distinct ``(host, path)`` of ``places`` that a rule fits."""
    rules = rules.filter("host IS NOT NULL AND host <> '' AND path IS NOT NULL AND action IS NOT NULL") \
        .select(F.concat("host", "path").alias("rule"), F.length("path").alias("cut"), "action").distinct()
    rules = written(rules.withColumn("digest", F.sha2(F.col("rule").cast("binary"), 256)).withColumn("prefix", F.substring("digest", 1, PREFIX)))
    lengths = sorted(row[0] for row in rules.select("cut").distinct().collect())  # bounded by the longest path
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    cuts = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    rows = places.filter("host <> ''").select("host", "path").distinct() \
        .select("host", "path", F.explode(suffixes).alias("suffix"), cuts.alias("cuts")) \
        .select("host", "path", "suffix", F.explode("cuts").alias("cut")) \
        .withColumn("digest", F.sha2(F.concat("suffix", F.expr("substring(path, 1, cut)")).cast("binary"), 256)) \
        .select("host", "path", "cut", "digest", F.substring("digest", 1, PREFIX).alias("prefix"))
    if rules.count() <= BROADCAST_RULES:
        side, keys = F.broadcast(rules), ["prefix"]
    else:
        side, keys = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), ["prefix", "salt"]
        rows = rows.withColumn("salt", F.expr(f"int(pmod(xxhash64(host, path), {SALT}))"))
    side = side.withColumnsRenamed({"digest": "rule_digest", "cut": "rule_cut"})
    # Different splits of one string into host and path are different rules: the cut must agree too.
    hits = rows.join(side, keys).filter("digest = rule_digest AND cut = rule_cut")
    order = F.struct(F.length("rule").alias("size"), (F.col("action") == "block").alias("blocks"), F.col("rule"), F.col("action"))
    return hits.groupBy("host", "path").agg(F.max(order).alias("best")).select("host", "path", "best.rule", "best.action")


def judged(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages(page_id, url)``."""
    places = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    best = written(matched(places, rules))
    return places.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return judged(read_table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, action string"))


ORACLE = r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                           ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM cut),
best AS (SELECT s.host, s.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
         FROM (SELECT DISTINCT host, path FROM split) s JOIN rules r
           ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY ALL)
SELECT page_id, s.host, s.path, rule, coalesce(verdict, 'allow') AS verdict FROM split s LEFT JOIN best b ON s.host = b.host AND s.path = b.path
"""
