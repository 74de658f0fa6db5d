"""URL rules by hashed host-suffix / path-prefix expressions.

A rule is a host and a path. Each url is expanded into expressions "host suffix + folder prefix";
rules and expressions meet on a short hash prefix, then full digests, the path and precedence decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import ascii_lower

PREFIX_BYTES = 4


def url_host(url: Column) -> Column:
    """Lower-cased (A-Z) host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _folder(path: Column) -> Column:
    """The path up to its last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 0)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _depth(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _key(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, folder), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (text of the winning rule, else null) and ``verdict``.

    ``rules`` has host, path and action (allow or block). A rule fits its host and all subdomains if
    the url's path starts with the rule's path. The longest host and path win; of equally long rules
    block wins. Urls that no rule fits get ``default``, as do null urls and such without ``://``,
    whose host and path are empty. Rules with a null field or an empty host fit nothing.

    Distinct urls are expanded, so a hot url is expanded once; nothing is expanded deeper than the
    deepest rule, which is exact. Repeated pages stay repeated; existing result columns are replaced.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rule = F.concat("r_host", "r_path")
    known = rules.filter(F.col("host") != "").filter(F.col("path").isNotNull() & F.col("action").isNotNull()).select(
        ascii_lower("host").alias("r_host"), F.col("path").alias("r_path"), F.col("action").alias("r_action"))
    known = known.withColumns({"r_full": _key(F.col("r_host"), _folder(F.col("r_path"))), "r_rule": rule})
    known = known.withColumn("r_short", F.substring("r_full", 1, 2 * PREFIX_BYTES))
    deepest = known.agg(F.max(_labels(F.col("r_host"))), F.max(_depth(F.col("r_path")))).first()
    labels, depth = deepest[0] or 0, deepest[1] or 0

    address = F.col(url)
    urls = pages.select(address.alias("u")).filter(F.col("u").isNotNull()).distinct()
    split = urls.withColumns({"u_host": url_host(F.col("u")), "u_path": url_path(F.col("u"))}).filter(F.col("u_host") != "")
    parts = F.split("u_host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    folders = F.split(_folder(F.col("u_path")), "/")  # "/a/b/" gives "", "a", "b", ""
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(folders) - 1, F.lit(depth))),
        lambda n: F.when(n == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(folders, 1, n), "/"), F.lit("/"))))
    spread = split.filter(F.lit(labels) > 0).withColumn("suffix", F.explode(suffixes)) \
        .withColumn("prefix", F.explode(prefixes))
    spread = spread.select("u", "u_path", _key(F.col("suffix"), F.col("prefix")).alias("u_full"))
    spread = spread.withColumn("r_short", F.substring("u_full", 1, 2 * PREFIX_BYTES))
    fits = spread.join(known, "r_short").filter(
        (F.col("u_full") == F.col("r_full")) & F.col("u_path").startswith(F.col("r_path")))
    rank = F.struct(F.length("r_rule"), (F.col("r_action") == "block").cast("int"), F.col("r_rule"))
    best = fits.groupBy("u").agg(F.max_by(F.struct("r_rule", "r_action"), rank).alias("best"))
    # The page travels as one column, so that its own names meet none of these.
    judged = pages.select(F.struct(F.lit(0).alias("_"), *kept).alias("page"), address.alias("page_url"))
    judged = judged.join(best, F.col("page_url") == F.col("u"), "left")
    return judged.select(
        *[F.col("page").getField(c).alias(c) for c in kept], url_host(F.col("page_url")).alias("host"),
        url_path(F.col("page_url")).alias("path"),
        F.col("best.r_rule").alias("rule"), F.coalesce("best.r_action", F.lit(default)).alias("verdict"))
