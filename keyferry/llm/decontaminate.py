"""Benchmark decontamination: test windows as a hash set against all document windows.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased. A test window is `window` consecutive words of an item; an item of
fewer words, but not none, is one window of its own length. Window hashes of a
document are folded from word hashes inside the row by doubling (2, 4, 8, ...
words), exploded as bare longs and met with the set of test hashes. That set is
broadcast while its proven size (16 bytes a row, counted) is at most
`broadcast_bytes`, and else joined by a shuffle. Hits are then verified in the
document's row on the words themselves, so a hash collision cannot survive.
Hits carry the number of their test window; its items, which may be many, meet
the distinct windows of a document only after that.

Defined results: null or empty text has no words and no hits; an item without
words is no window; item ids that repeat count once, a null item id is left
out of the id list; repeated documents get equal results each; empty tables
give empty results or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyferry.llm.common import ascii_lower, sliding, split_words, stored, text_or_empty

SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
HIT = "array<struct<pos:int,len:int,words:string,window:bigint>>"


def normal_words(text: Column) -> Column:
    return split_words(ascii_lower(text), SEPARATORS)


def _with_window_hashes(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds column h<n> (hashes of all n-word windows) for each n, from column `words`."""
    df = df.withColumn("n_words", F.size("words")).withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    made = {1}

    def need(df: DataFrame, n: int) -> DataFrame:
        if n in made:
            return df
        big = 1 << (n.bit_length() - 1)
        a, b = (big, n - big) if n != big else (n // 2, n // 2)
        df = need(need(df, a), b)
        made.add(n)
        return df.withColumn(f"h{n}", sliding(F.col(f"h{a}"), F.col(f"h{b}"), a, F.col("n_words") - (n - 1),
                                              lambda x, y: F.xxhash64(x, y)))

    for n in lengths:
        df = need(df, n)
    return df


def _exploded(df: DataFrame, lengths: list[int], keys: list[str]) -> DataFrame:
    """keys, pos, len, hash: one row per window."""
    # The outer form, since Spark gives the inner one a filter on the array's
    # size, which it would compute from the text a second time.
    if len(lengths) == 1:
        return df.select(*keys, F.lit(lengths[0]).alias("len"), F.posexplode_outer(f"h{lengths[0]}").alias("pos", "hash"))
    each = F.array(*[F.struct(F.lit(n).alias("len"), F.col(f"h{n}").alias("hs")) for n in lengths])
    return df.select(*keys, F.explode(each).alias("w")).select(
        *keys, F.col("w.len").alias("len"), F.posexplode_outer("w.hs").alias("pos", "hash"))


def _key(prefix: str = "") -> list[Column]:
    # Rows with equal keys have equal texts, or hits that fail verification.
    return [F.col(f"{prefix}doc_id").alias("key_id"), F.xxhash64(text_or_empty(F.col(f"{prefix}text"))).alias("key_text")]


def find_hits(documents: DataFrame, benchmark: DataFrame, window: int = 10,
              broadcast_bytes: int = 64 << 20) -> tuple[DataFrame, DataFrame]:
    """`row` (the input row as a struct) with its key, n_words, its words and the verified `hits`; and (window, item)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), normal_words(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0)
    # At most `window` different lengths.
    length = F.least(F.size("words"), F.lit(window))
    lengths = sorted(r[0] for r in items.select(length).distinct().collect())
    row = documents.select(F.struct("*").alias("row"))
    key_id, key_text = _key("row.")
    if not lengths:
        return row.withColumn("words", normal_words(F.col("row.text"))).select(
            "row", key_id, key_text, F.size("words").cast("long").alias("n_words"), "words", F.array().cast(HIT).alias("hits")
        ), items.select(F.lit(0).cast("long").alias("window"), "item").limit(0)
    own = _with_window_hashes(items.withColumn("own_length", length), lengths)
    windows = _exploded(own, lengths, ["item", "words", "own_length"]).where((F.col("len") == F.col("own_length")) & F.col("hash").isNotNull())
    windows = windows.select("len", "hash", "item", F.array_join(F.slice("words", F.col("pos") + 1, F.col("len")), " ").alias("words"))
    listed = stored(windows.distinct(), "leak-listed")
    windows = stored(listed.select("len", "hash", "words").distinct().withColumn("window", F.monotonically_increasing_id()), "leak-windows")
    owners = listed.where(F.col("item").isNotNull()).join(windows, ["len", "hash", "words"]).select("window", "item")
    tests = windows.select("len", "hash").distinct()

    scanned = _with_window_hashes(documents.select(*_key(), normal_words(F.col("text")).alias("words")), lengths)
    probe = _exploded(scanned, lengths, ["key_id", "key_text"])  # the join drops the null row of a text without windows
    if tests.count() * 16 <= broadcast_bytes:
        tests = F.broadcast(tests)
    met = stored(probe.join(tests, ["len", "hash"]).distinct(), "leak-met")  # repeated documents meet once
    hits = met.join(windows, ["len", "hash"]).groupBy("key_id", "key_text").agg(
        F.collect_list(F.struct("pos", "len", "words", "window")).alias("met"))
    hits = stored(hits, "leak-hits")

    # By shuffle at any size, since hits grow with the documents; the words are split after it.
    both = row.select("row", key_id, key_text).join(
        hits.withColumnsRenamed({"key_id": "hit_id", "key_text": "hit_text"}).hint("merge"),
        F.col("key_id").eqNullSafe(F.col("hit_id")) & (F.col("key_text") == F.col("hit_text")), "left")
    both = both.select("row", "key_id", "key_text", "met", normal_words(F.col("row.text")).alias("words"))
    sure = F.filter("met", lambda h: F.array_join(F.slice(F.col("words"), h["pos"] + 1, h["len"]), " ") == h["words"])
    return both.select("row", "key_id", "key_text", F.size("words").cast("long").alias("n_words"), "words",
                       F.coalesce(sure, F.array().cast(HIT)).alias("hits")), owners


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: `row`, n_words, n_hit, n_items, items_sha256, contaminated."""
    covered = F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - 1))))
    found, owners = find_hits(documents, benchmark, window)
    met = F.array_distinct(F.transform("hits", lambda h: h["window"]))
    found = stored(found.select("row", "key_id", "key_text", "n_words", covered.alias("covered"), met.alias("met")), "leak-found")
    pairs = found.select("key_id", "key_text", F.explode("met").alias("window")).distinct()
    items = pairs.join(owners, "window").groupBy(F.col("key_id").alias("item_id"), F.col("key_text").alias("item_text")).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    found = found.join(items, F.col("key_id").eqNullSafe(F.col("item_id")) & (F.col("key_text") == F.col("item_text")), "left")
    found = found.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return found.select(
        "row", "n_words", F.size("covered").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("covered") > 0).alias("contaminated"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of `documents` in which no test window occurs, unchanged."""
    return contamination(documents, benchmark, window).where(~F.col("contaminated")).select("row.*")


def remove_spans(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """All rows of `documents`; texts with hits become their normalised words that are not hit."""
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - 1))))
    found = find_hits(documents, benchmark, window)[0].select(
        "row", covered.alias("covered"), "words")
    # Runs of hit words: positions whose neighbour is not hit, by hash sets in the row.
    first = F.array_sort(F.array_except("covered", F.transform("covered", lambda p: p + 1)))
    last = F.array_sort(F.array_except("covered", F.transform("covered", lambda p: p - 1)))
    found = found.withColumn("first", F.concat(first, F.array(F.size("words")))).withColumn(
        "last", F.concat(F.array(F.lit(-1)), last))
    pieces = F.zip_with("last", "first", lambda a, b: F.slice(F.col("words"), a + 2, b - a - 1))
    cleaned = F.when(F.size("covered") == 0, F.col("row.text")).otherwise(F.array_join(F.flatten(pieces), " "))
    return found.select(F.col("row").withField("text", cleaned).alias("row")).select("row.*")
