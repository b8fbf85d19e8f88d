"""URL rules by host-suffix and path-prefix expressions (DataFrame functions only).

Each rule is (host, path, action).  It fits a URL whose host is the rule's host
or one of its subdomains and whose path starts with the rule's path.  The
longest fitting rule (host plus path, in characters) decides; among equally
long ones the longer host, then ``block``, then the path in code-point order.

Method: a rule is keyed by its host and its path up to the last ``/``.  Each
distinct (host, path) of the URLs is expanded into host suffixes x directory
prefixes, no deeper than the deepest rule.  The expressions are equi-joined
with the rules on the first 32 bits of a SHA-256 digest, then the whole digest
and the rest of the rule's path are confirmed.  Nothing is broadcast by hint;
Spark broadcasts the rules by itself when their measured size allows it, and
otherwise splits hot expressions, because the rule side of a digest is small.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and gets the default verdict.  Equal rows stay equal rows.  Any other columns
of the input are ignored.  No rules, or no URLs, give the default verdict or an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """Path after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, directory: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(" "), directory), 256)


def keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules with the digest of (host, path up to its last slash)."""
    path = F.coalesce(F.col("path"), F.lit(""))
    directory = F.regexp_extract(path, r"(?s)^(.*/)[^/]*$", 1)
    return rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), path.alias("r_path"),
                        F.col("action").alias("r_action"), directory.alias("r_dir")) \
        .filter(F.col("r_host").isNotNull()) \
        .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_dir"))) \
        .withColumn("r_short", F.substring("r_digest", 1, 8))


def expressions(urls: DataFrame, max_labels: int, max_depth: int) -> DataFrame:
    """(host, path, digest, short) for each host suffix x directory prefix of (host, path)."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.greatest(n - F.lit(max_labels - 1), F.lit(1)), n),
        lambda i: F.array_join(F.slice(labels, i, n), "."))
    parts = F.split("path", "/", max_depth + 1)
    depth = F.size(parts) - 1
    prefixes = F.transform(
        F.when(depth >= 1, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))
    return urls.select("host", "path", F.explode(suffixes).alias("suffix"),
                       F.array_union(F.array(F.lit("")), prefixes).alias("dirs")) \
        .select("host", "path", "suffix", F.explode("dirs").alias("dir")) \
        .select("host", "path", _digest(F.col("suffix"), F.col("dir")).alias("digest")) \
        .withColumn("short", F.substring("digest", 1, 8))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``pages``."""
    keyed = keyed_rules(rules)
    deepest = keyed.select(
        F.coalesce(F.max(F.size(F.split("r_host", r"\."))), F.lit(1)).alias("labels"),
        F.coalesce(F.max(F.length(F.regexp_replace("r_dir", "[^/]", ""))), F.lit(0)).alias("depth")
    ).first()
    parsed = pages.select(F.col(key), url_host(F.col(url)).alias("host"),
                          url_path(F.col(url)).alias("path"))
    urls = parsed.filter(F.col("host") != "").select("host", "path").distinct()
    fits = expressions(urls, deepest["labels"], deepest["depth"]) \
        .join(keyed, F.col("short") == F.col("r_short")) \
        .filter((F.col("digest") == F.col("r_digest"))
                & F.col("path").startswith(F.col("r_path")))
    order = F.struct((F.length("r_host") + F.length("r_path")).alias("len"),
                     F.length("r_host").alias("host_len"),
                     (F.col("r_action") == "block").cast("int").alias("blocks"),
                     F.col("r_path").alias("r_path"))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        order.alias("o"), F.concat("r_host", "r_path").alias("rule"),
        F.col("r_action").alias("action"))).alias("best"))
    return parsed.join(best, ["host", "path"], "left").select(
        F.col(key), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"))
