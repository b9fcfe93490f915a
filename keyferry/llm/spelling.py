"""Spelling variants: words one edit apart, found over a reduced alphabet.

Every letter is hashed to one of a few symbols. Two words one edit apart have
reduced words at most one edit apart, so the full one-edit neighbourhood of
each reduced word, over the few symbols alone, is joined to the reduced
vocabulary, and the original strings of every meeting are compared. Each pair
meets once: a word's deletions reach the shorter word (the shorter one need not
insert), replacements go to lower symbols only, and equal reduced words meet
by themselves.

A neighbourhood holds strings in proportion to the word's length, so words of
more than `LONG` characters are keyed by the half that one edit leaves intact
instead, and compared the same way.

A word's form is its near word of largest n (ties: the smallest), if that is at
least `ratio` times its own n. Counts grow along forms, so they end in a root.

Defined results: a null text has no words, a null doc_id counts as empty text;
repeated rows count every time; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyferry.llm.common import discard, stored

LONG = 40
_LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
# A-Z and the characters U+00C0 to U+00FF, which all begin with the byte C3 in UTF-8.
_LETTER = rb"(?:[a-z]|\xC3[\x80-\xBF])"


@dataclass(frozen=True)
class Settings:
    min_length: int = 7
    min_count: int = 2
    ratio: int = 10
    symbols: int = 8  # of the reduced alphabet, 2 to 10
    drop_one_in: int | None = None  # delete one letter of a run in a document where this divides the hash of both

    def __post_init__(self) -> None:
        if not 2 <= self.symbols <= 10:
            raise ValueError("symbols must be 2 to 10")
        if self.min_length < 1:
            raise ValueError("min_length must be >= 1")


def _changed(run: bytes, seed: int, one_in: int) -> bytes:
    """`run` without its letter number h modulo its length, if `one_in` divides h (crc32 of "<doc_id>:<run>")."""
    h = zlib.crc32(run, seed)
    if h % one_in:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def count_words(documents: DataFrame, settings: Settings = Settings(), held: int = 1 << 18) -> DataFrame:
    """word, n of all texts: runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.

    Tasks count in a table of at most about `held` words before the shuffle.
    """
    least, one_in = settings.min_length, settings.drop_one_in
    runs = re.compile(_LETTER + b"{%d,}" % least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode() for w in counts]
            return pa.record_batch([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                own = Counter(runs.findall((text or b"").lower()))  # bytes: lowers A-Z alone
                if one_in:
                    seed = zlib.crc32(f"{doc_id or ''}:".encode())
                    for run, n in own.items():
                        counts[_changed(run, seed, one_in)] += n
                else:
                    counts.update(own)
                if len(counts) >= held:
                    yield out()
                    counts.clear()
        yield out()

    own = documents.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counted = own.mapInArrow(count, "word string, n bigint").where(F.char_length("word") >= least)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.min_count)


def reduced(word: Column, symbols: int) -> Column:
    """Every character as one of `symbols` digits."""
    image = "".join(str(ord(c) % symbols) for c in _LETTERS)
    return F.regexp_replace(F.translate(word, _LETTERS, image), f"[^0-{symbols - 1}]", "0")


def _without(r: Column, i: Column, instead: Column | None = None) -> Column:
    """`r` without, or with `instead` of, character `i` (from 1)."""
    parts = [F.substr(r, F.lit(1), i - 1), F.substr(r, i + 1)]
    return F.concat(parts[0], parts[1]) if instead is None else F.concat(parts[0], instead, parts[1])


def neighbourhood(r: Column, replace: Column, symbols: int) -> Column:
    """Distinct strings one deletion from `r`, and, where `replace`, one replacement by a lower symbol."""
    places = F.sequence(F.lit(1), F.char_length(r))
    digits = F.array(*[F.lit(str(d)) for d in range(symbols)])
    shorter = F.transform(places, lambda i: _without(r, i))
    lower = F.flatten(F.transform(places, lambda i: F.transform(
        F.slice(digits, F.lit(1), F.substr(r, i, F.lit(1)).cast("int")), lambda d: _without(r, i, d))))
    return F.array_distinct(F.when(replace, F.concat(shorter, lower)).otherwise(shorter))


def _halves(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Homes and probes of long words: keys of length, side and half.

    An edit at or behind place m leaves the first m characters, any other the rest.
    """
    size = F.char_length("word")

    def keys(length: Column, skipped: int) -> Column:
        m = F.floor(length / 2).cast("int")
        return F.array(F.concat(length.cast("string"), F.lit("<"), F.sha2(F.substr("word", F.lit(1), m), 256)),
                       F.concat(length.cast("string"), F.lit(">"), F.sha2(F.substr("word", m + 1 + skipped), 256)))

    homes = words.where(size > LONG).select(F.explode(keys(size, 0)).alias("key"), "word", "n")
    probes = words.where(size > LONG + 1).select(F.explode(keys(size - 1, 1)).alias("key"), "word", "n")
    return homes, probes


def near_pairs(words: DataFrame, symbols: int = 8) -> DataFrame:
    """a, a_n, b, b_n: every two words of (word, n) one inserted, deleted or replaced character apart, once."""
    size = F.char_length("word")
    short = words.withColumn("r", reduced(F.col("word"), symbols))
    homes = short.where(size <= LONG).select(F.col("r").alias("key"), "word", "n")
    probes = short.where(size <= LONG + 1).select(
        F.explode(neighbourhood(F.col("r"), size <= LONG, symbols)).alias("key"), "word", "n")
    long_homes, long_probes = _halves(words)

    def met(left: DataFrame, right: DataFrame, condition: str = "true") -> DataFrame:
        a = left.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
        b = right.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
        return a.join(b, "key").where(f"({condition}) and levenshtein(a, b, 1) = 1").select("a", "a_n", "b", "b_n")

    # An edit in the middle leaves both halves; such a pair counts at the first.
    once = "substr(key, instr(key, '<'), 1) = '<' or substr(a, 1, char_length(b) div 2) <> substr(b, 1, char_length(b) div 2)"
    return (met(homes, homes, "a < b").unionByName(met(probes, homes))
            .unionByName(met(long_homes, long_homes, f"a < b and ({once})")).unionByName(met(long_probes, long_homes, once)))


def _roots(links: DataFrame) -> DataFrame:
    """`links` (word, form) followed to the end: word, root. Each round doubles the step."""
    links = stored(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = stored(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                           F.col("next").isNotNull().alias("moved")), "spelling-links")
        discard(links)
        links = far.select("word", "root")
        if far.where("moved").isEmpty():
            return links
        links.stored_at = far.stored_at


def variants(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of `words` (distinct word, n)."""
    words = stored(words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words, settings.symbols)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")).alias("near")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("less"), F.col("a").alias("form")).alias("near")),
    )).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near"))
    large = F.col("near.less") <= -settings.ratio * F.col("n")
    found = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("near.form")).alias("form"), F.when(large, -F.col("near.less")).alias("form_n")), "spelling-forms")
    discard(words)
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
