"""Allow and block rules for URLs, found by an equi-join on hash prefixes.

A rule is ``(host, path, verdict)``; it fits its host and all subdomains of it
when the URL's path starts with the rule's path. Each URL is expanded into the
``host suffix + path prefix`` expressions a rule could have, these are joined
with the rules on a short prefix of their SHA-256, and a match counts only when
the full digests agree. The longest fitting rule wins (of host and path
together, then the longer host, then ``block`` before ``allow``).

An expression is made only for the (number of host labels, path length) pairs
that some rule has, so a URL expands to at most as many expressions as there
are such pairs, however long it is. Rule tables with very many pairs are worked
through in blocks of ``SHAPES``, and the best hit is taken over all blocks. Distinct
(host, path) pairs are expanded once, which also takes the weight off a URL that
fills much of the table; a rule host like ``com`` that all pairs ask for is one key of
the join, which Spark splits where it grows (its other side is one rule).

Defined cases: a null URL, or one without ``://``, has empty host and path; no
rule fits an empty host. Pages without a fitting rule get ``default`` and a
null rule. Rules with a null or empty field other than the path, and verdicts
other than allow and block, are rejected with an error. An empty rule table
gives ``default`` everywhere. Repeated pages are repeated in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that the join compares first (32 bits).
PREFIX_DIGITS = 8
#: Distinct (labels, path length) pairs of rules that one expression tries.
SHAPES = 4096


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(?:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(?:.*?)://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id",
                default: str = "allow", block_shapes: int = SHAPES) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row of ``pages``."""
    rules = rules.select(
        F.when(F.length("host") > 0, F.lower("host")).otherwise(F.raise_error(F.lit("rule without host"))).alias("rhost"),
        F.coalesce("path", F.lit("")).alias("rpath"),
        F.when(F.col("verdict").isin("allow", "block"), F.col("verdict"))
         .otherwise(F.raise_error(F.lit("rule verdict must be allow or block"))).alias("verdict")).distinct()
    keyed = rules.withColumn("digest", _digest(F.col("rhost"), F.col("rpath")))
    shape = F.struct(F.size(F.split("rhost", r"\.", -1)).alias("labels"), F.length("rpath").alias("chars"))
    shapes = sorted(r[0] for r in rules.select(shape).distinct().collect())
    located = pages.select(F.col(f"`{id_col}`").alias("id"), url_host(F.col(f"`{url_col}`")).alias("host"),
                           url_path(F.col(f"`{url_col}`")).alias("path"))
    if not shapes:
        return located.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"),
                              F.lit(default).alias("verdict"))
    names = F.split("host", r"\.", -1)
    places = located.select("host", "path").distinct().withColumn("names", names)
    keyed = keyed.withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    hits = None
    for at in range(0, len(shapes), block_shapes):
        # one text literal, folded to an array once: a long list of literals would slow down every analysis of the plan
        pairs = ",".join(f"{s.labels} {s.chars}" for s in shapes[at:at + block_shapes])
        wanted = F.expr(f"transform(split('{pairs}', ','), p -> named_struct('labels', int(split(p, ' ')[0]), "
                        "'chars', int(split(p, ' ')[1])))")
        possible = F.filter(wanted, lambda s: (F.col("host") != "") & (s["labels"] <= F.size("names"))
                            & (s["chars"] <= F.length("path")))
        expressions = places.select("host", "path", F.explode(F.transform(possible, lambda s: F.struct(
            F.array_join(F.slice("names", F.size("names") - s["labels"] + 1, s["labels"]), ".").alias("suffix"),
            F.substring("path", F.lit(1), s["chars"]).alias("start")))).alias("e"))
        expressions = expressions.select("host", "path", _digest(F.col("e.suffix"), F.col("e.start")).alias("found"))
        found = expressions.withColumn("prefix", F.substring("found", 1, PREFIX_DIGITS)).join(
            keyed, "prefix").where(F.col("found") == F.col("digest"))
        hits = found if hits is None else hits.unionByName(found)
    rank = F.struct(F.length("rhost") + F.length("rpath"), F.length("rhost"), F.col("verdict"))
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("rhost", "rpath").alias("rule"), "verdict"), rank).alias("best"))
    return located.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
