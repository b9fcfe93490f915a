"""Quality rules: whole-text statistics and a short-circuit cascade.

The cascade rejects a document if any rule does. Rules are ordered by
rejections per cost: each rule runs over one bounded sample, drawn by hash. Its
cost is its shortest time of several runs, less that of a job without a rule;
what it rejects is counted among the documents that the rules before it leave.
The rules become one CASE in that order, so that Spark stops at the first rule
that rejects. The order changes what a verdict costs, never the verdict.

Where only the verdict counts (`keep_good`), the two base rules take their place
in the cascade as well: the windows of a text, by far the dearest statistic, are
formed only if no rule before has rejected it.

Defined results: null text has no words, lines or symbols and fails the base
rule (fewer than 50 words); empty tables give empty results; repeated rows are
judged each; texts of any length are judged whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyferry.llm.common import SPACE, SPACE_CHARS, sliding, split_words, stored, text_or_empty

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _chars(text: Column, dropped: str) -> Column:
    """Number of characters of `text` that are in `dropped`."""
    return F.length(text) - F.length(F.translate(text, dropped, ""))


def n_words(text: Column) -> Column:
    return F.size(split_words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text_or_empty(text), SPACE_CHARS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return _chars(text_or_empty(text), SYMBOLS).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text_or_empty(text), "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_repeat_words(df: DataFrame, words: str, out: str, size: int = 3) -> DataFrame:
    """Adds `out`: words in `size`-word windows that occur twice or more in the array column `words`.

    Window hashes and positions are packed into one long each (as many low bits
    as the positions need) and sorted as plain longs; neighbours with equal
    hash bits count as equal only if their words are equal.
    """
    n = F.size(words)
    count = n - (size - 1)
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    folded = F.col("_h")
    for k in range(1, size):
        folded = sliding(folded, F.col("_h"), k, n - k, lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_w", folded).withColumn("_bits", F.length(F.bin(F.greatest(count, F.lit(1)))))
    packed = F.transform("_w", lambda h, i: F.call_function("shiftleft", h, F.col("_bits")).bitwiseOR(i.cast("long")))
    some = F.size(F.array_distinct("_w")) < F.size("_w")
    df = df.withColumn("_s", F.when(some, F.sort_array(packed)))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1

    def same(a: Column, b: Column) -> Column:
        p, q = (a.bitwiseAND(mask)).cast("int"), (b.bitwiseAND(mask)).cast("int")
        equal = F.call_function("shiftright", a, F.col("_bits")) == F.call_function("shiftright", b, F.col("_bits"))
        for k in range(size):
            equal = equal & (F.get(words, p + k) == F.get(words, q + k))
        return equal

    later = F.size("_s") - 1
    # Where the next in order is the same window, and where the previous is.
    pairs = F.zip_with(F.slice("_s", F.lit(1), later), F.slice("_s", F.lit(2), later), lambda a, b: F.when(
        same(a, b), F.array((a.bitwiseAND(mask)).cast("int"), (b.bitwiseAND(mask)).cast("int"))))
    found = F.flatten(F.array_compact(pairs))
    covered = F.flatten(F.transform("_at", lambda p: F.sequence(p, p + (size - 1))))
    df = df.withColumn("_at", F.when(some, F.array_distinct(found))).withColumn(
        out, F.when(some, F.size(F.array_distinct(covered))).otherwise(0).cast("long"))
    return df.drop("_h", "_w", "_bits", "_s", "_at")


@dataclass(frozen=True)
class Rule:
    """`rejects` maps the text column (never null) to a boolean column."""

    name: str
    rejects: Callable[[Column], Column] | None


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


RULES: tuple[Rule, ...] = (
    Rule("symbols per character", lambda t: _share(_chars(t, SYMBOLS), F.length(t)) > 0.04),
    Rule("exclamation marks per character", lambda t: _share(_chars(t, "!"), F.length(t)) > 0.05),
    Rule("capitals per character", lambda t: _share(_chars(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.length(t)) > 0.4),
    Rule("letters per character", lambda t: _share(F.length(F.regexp_replace(t, r"\P{L}+", "")), F.length(t)) < 0.5),
    Rule("repeated lines", lambda t: _share(n_dup_lines(t), F.size(F.split(t, "\n", -1))) > 0.6),
    Rule("words repeated in a row", lambda t: _share(
        F.length(t) - F.length(F.regexp_replace(t, rf"(?<![^{SPACE}])([^{SPACE}]++)(?=[{SPACE}]++\1(?![^{SPACE}]))", "")),
        F.length(t)) > 0.2),
    Rule("mean word length", lambda t: ~_share(word_chars(t), n_words(t)).between(2.0, 20.0)),
)


FEW_WORDS = Rule("few words", lambda t: n_words(t) < MIN_WORDS)
# Needs columns of its own, so it is no expression of the text alone (see `_repeats`).
REPEATS = Rule("repeated windows", None)


def _repeats(df: DataFrame, text: str) -> DataFrame:
    """Adds `repeats`: more words than allowed are in windows that occur twice."""
    df = with_repeat_words(df.withColumn("_words", split_words(F.col(text))), "_words", "_n")
    return df.withColumn("repeats", 100 * F.col("_n") > MAX_REPEAT_PERCENT * F.size("_words")).drop("_words", "_n")


def _sample(documents: DataFrame, rows: int) -> DataFrame:
    """About `rows` texts, at most twice as many, those of the smallest hashes."""
    own = documents.select(F.xxhash64("doc_id", "text").alias("h"), text_or_empty(F.col("text")).alias("text"))
    share = min(1.0, rows / max(documents.count(), 1))
    return own.where(F.abs(F.expr("h div 2")) <= F.lit(share * 2.0**62)).limit(2 * rows).select("text")


def rule_order(documents: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2_000, runs: int = 2) -> list[Rule]:
    """Rules by descending rejections per cost on a sample; the sample only sets the order of evaluation."""
    sample = _sample(documents, sample_rows).withColumn("id", F.monotonically_increasing_id()).persist()
    try:
        def shortest(df: DataFrame) -> float:
            times = []
            for _ in range(runs):
                started = time.perf_counter()
                df.first()
                times.append(time.perf_counter() - started)
            return min(times)

        idle = shortest(sample.agg(F.sum(F.length("text"))))
        left, rejected, cost = {r["id"] for r in sample.select("id").collect()}, {}, {}
        for rule in rules:
            verdict = _repeats(sample, "text").select("id", "repeats") if rule.rejects is None else sample.select(
                "id", rule.rejects(F.col("text")).alias("repeats"))
            # At most 2 * sample_rows rows. No filter: pushed into the projections, it would repeat their expressions.
            rejected[rule.name] = {r["id"] for r in verdict.collect() if r["repeats"]}
            cost[rule.name] = max(shortest(verdict.agg(F.count_if("repeats"))) - idle, 1e-3)
    finally:
        sample.unpersist()
    ordered, open_rules = [], list(rules)
    while open_rules:
        best = max(open_rules, key=lambda r: (len(rejected[r.name] & left) + 1) / (len(left) + 2) / cost[r.name])
        open_rules.remove(best)
        ordered.append(best)
        left -= rejected[best.name]
    return ordered


def cascade(text: Column, ordered: list[Rule]) -> Column:
    """True if a rule rejects; later rules are not evaluated after one that does."""
    verdict = F.lit(False)
    for rule in reversed(ordered):
        verdict = F.when(rule.rejects(text), F.lit(True)).otherwise(verdict)
    return verdict


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2_000) -> DataFrame:
    """Per row: `row` (the input row), the base statistics, base_failed and kept."""
    ordered = rule_order(documents, rules, sample_rows)
    df = documents.select(F.struct("*").alias("row"), text_or_empty(F.col("text")).alias("t"))
    df = with_repeat_words(df.withColumn("words", split_words(F.col("t"))), "words", "n_repeat_words")
    df = df.select("row", "t", F.size("words").cast("long").alias("n_words"), "n_repeat_words",
                   word_chars(F.col("t")).alias("word_chars"), n_symbols(F.col("t")).alias("n_symbols"),
                   n_dup_lines(F.col("t")).alias("n_dup_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~cascade(F.col("t"), ordered))
    return df.withColumn("kept", kept).drop("t")


def keep_good(documents: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2_000) -> DataFrame:
    """The rows of `documents` that are kept, unchanged: the same that `judge` keeps."""
    ordered = rule_order(documents, (*rules, FEW_WORDS, REPEATS), sample_rows)
    at = ordered.index(REPEATS)
    own = documents.select(F.struct("*").alias("row"), text_or_empty(F.col("text")).alias("t"))
    # Rejected rows go before anything is formed for the windows.
    own = _repeats(own.where(~cascade(F.col("t"), ordered[:at])), "t")
    kept = F.when(F.col("repeats"), F.lit(False)).otherwise(~cascade(F.col("t"), ordered[at + 1:]))
    # Stored before the filter: pushed into the projections, it would repeat their expressions many times over.
    return stored(own.select("row", kept.alias("kept")), "rules-kept").where("kept").select("row.*")
