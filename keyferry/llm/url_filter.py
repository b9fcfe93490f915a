"""URL filters: host-suffix and path-prefix expressions against a rule table.

Each URL is expanded into the expressions that could be a rule: a suffix of its
host labels joined with a prefix of its path. Expressions meet the rules in an
equi-join on a short prefix of their SHA-256, the full digest is compared
afterwards, and the longest fitting rule decides. Only label counts and path
lengths that occur in the rules are expanded, so the expansion is bounded by
the rule table and not by the URL.

Defined results: a null URL or one without ``://`` has an empty host and path
and fits no rule; a URL that fits no rule gets ``default``; equal rows give
equal results each; an empty page table gives an empty result, an empty rule
table gives ``default`` everywhere. A rule given twice counts once; of two
rules with the same expression and different verdicts ``block`` wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT = 8  # hex digits of the digest that the join compares


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str, url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per row of `urls`: id, host, path, rule, verdict.

    `rules` has columns host, path, verdict (allow or block).
    """
    rule = F.concat(F.col("host"), F.col("path"))
    known = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & (F.col("host") != ""))
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block sorts after allow
        .select(rule.alias("rule"), F.col("host").alias("rule_host"), "path", F.col("verdict").alias("rule_verdict"),
                F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))
    )
    # Bounded by the shapes of rules: distinct label counts and path lengths.
    shape = known.agg(F.collect_set("labels").alias("labels"), F.collect_set("chars").alias("chars")).first()
    depths, lengths = sorted(shape["labels"]), sorted(shape["chars"])
    digest = F.sha2(F.concat_ws("\0", "rule_host", "path"), 256)
    hashed = known.select(digest.alias("full"), F.substring(digest, 1, SHORT).alias("short"), "rule", "rule_verdict",
                          F.length("rule_host").alias("host_chars"), "chars")

    own = urls.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"),
                      url_path(F.col(url_col)).alias("path"))
    # The verdict depends on host and path only: judge each pair once.
    pairs = own.select("host", "path").where(F.col("host") != "").distinct()
    parts = F.split("host", r"\.")
    suffixes = F.array(*[F.when(F.size(parts) >= d, F.array_join(F.slice(parts, -d, d), ".")) for d in depths]) \
        if depths else F.array().cast("array<string>")
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) \
        if lengths else F.array().cast("array<string>")
    made = (
        pairs.select("host", "path", F.explode(F.array_compact(suffixes)).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode(F.array_compact("prefixes")).alias("prefix"))
        .select("host", "path", F.sha2(F.concat_ws("\0", "suffix", "prefix"), 256).alias("made"))
        .withColumn("short", F.substring("made", 1, SHORT))
    )
    best = (
        made.join(hashed, "short").where(F.col("made") == F.col("full"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "host_chars", "rule_verdict", "rule")).alias("best"))
        .select("host", "path", "best.rule", "best.rule_verdict")
    )
    return own.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
    )
