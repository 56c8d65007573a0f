"""URL filters, in DataFrame operations only.

Every URL is expanded into the host-suffix and path-prefix expressions that
some rule could equal; the expressions meet the rules in an equi-join on a
short hash prefix, full digests confirm, and the longest rule decides.

The expansion is bounded by the rules' shapes (label count, path length), not
by their number: a URL yields at most one expression for each shape that it is
long enough for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, spread_join

URL_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
PREFIX_HEX = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null or without ``://``."""
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, URL_PARTS, 1)), F.regexp_extract(text, URL_PARTS, 2)


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with digests; rules without a host or with an
    action that is not allow or block are no rules.  Of equal rules block wins."""
    return (
        rules.select(ascii_lower(F.trim("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.lower("action").alias("action"))
        .where((F.col("host") != "") & F.col("action").isin("allow", "block"))
        .groupBy("host", "path")
        .agg(F.max("action").alias("rule_action"))
        .select(
            F.concat("host", "path").alias("rule"),
            "rule_action",
            F.size(F.split("host", r"\.", -1)).alias("labels"),
            F.length("path").alias("plen"),
            F.length("host").alias("hlen"),
        )
        .withColumn("digest", _digest(F.col("rule")))
        .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    )


def _shapes(ruled: DataFrame) -> DataFrame:
    """One row: the path lengths that rules of each label count have.  A host
    has at most 127 labels, so the row grows with the distinct path lengths."""
    of_labels = ruled.groupBy("labels").agg(F.collect_set("plen").alias("plens"))
    return of_labels.agg(F.collect_list(F.struct("labels", "plens")).alias("shapes"))


def _expressions(host: Column, path: Column, shapes: Column) -> Column:
    """The expressions of a URL, for the shapes that it is long enough for."""
    fits = F.filter(shapes, lambda s: (host != "") & (s["labels"] <= F.size(F.split(host, r"\.", -1))))

    def of_labels(s: Column) -> Column:
        suffix = F.call_function("substring_index", host, F.lit("."), -s["labels"])
        return F.transform(F.filter(s["plens"], lambda p: p <= F.length(path)), lambda p: F.concat(suffix, F.substring(path, F.lit(1), p)))

    return F.flatten(F.transform(fits, of_labels))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", broadcast_rules: int = 200_000) -> DataFrame:
    """One row for each row of ``pages``: id, host, path, rule, verdict.

    A rule fits its host and all subdomains when the path starts with the
    rule's.  The longest rule wins, then the longer host; without one, rule is
    null and verdict is ``default``.  Null URLs and ids pass through (empty
    host and path); repeated rows stay repeated; other columns are not read.
    Rules are broadcast up to ``broadcast_rules`` rows, else joined by shuffle,
    where expressions that many URLs share are dealt out.

    Pages are scanned once and keep a number of their own, by which a page's
    hits are reduced before they are shuffled: a URL that many rows share, or
    that none can read, is no hot key.
    """
    host, path = split_url(F.col(url_col))
    ruled = prepare_rules(rules)
    count = ruled.count()
    base = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).withColumn("uid", F.monotonically_increasing_id())
    tried = base.join(F.broadcast(_shapes(ruled)), how="cross")  # one row
    tried = tried.select("uid", "id", "host", "path", F.explode_outer(_expressions(F.col("host"), F.col("path"), F.col("shapes"))).alias("expression"))
    tried = tried.withColumn("full", _digest(F.col("expression"))).withColumn("short", F.coalesce(F.substring("full", 1, PREFIX_HEX), F.lit("")))
    known = ruled.select("short", "digest", "hlen", "rule", "rule_action")
    if count <= broadcast_rules:
        hits = tried.join(F.broadcast(known), "short", "left")
    else:
        hits = spread_join(tried, known, ["short"], "uid", tried.count(), how="left")
    rank = F.when(F.col("full") == F.col("digest"), F.struct(F.length("rule").alias("n"), "hlen", "rule", "rule_action"))
    same = [F.first(c).alias(c) for c in ("id", "host", "path")]  # equal in all rows of a number
    won = hits.groupBy("uid").agg(*same, F.max(rank).alias("won"))
    return won.select(F.col("id").alias(id_col), "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.rule_action", F.lit(default)).alias("verdict"))
