"""Personal data: direct identifiers, and terms that reveal them.

Direct identifiers (email, IPv4, payment card, phone) are found by pattern.
Then the corpus says which words of the documents that carry an identifier give
it away. With df the number of documents, p(c|t) = df(c,t) / df(t) is how likely
a document with the term t is one of the identifier c, and PMI(c; t) =
log2(p(c|t) N / df(c)) the bits about c that t discloses. For p(c|t) the lower
end of Wilson's interval is taken, so that few documents prove less than many,
but every identifier is decided, also one of a single document. A term that
discloses at least `least_bits` is generalised from p(c|t) = `generalise_at` on
and removed from `remove_at` on, wherever it stands in the documents that carry
the identifier. The bounds are probabilities, so a verdict does not drift when
documents without the term and the identifier are added.

A generalised term gives way to a broader class of the corpus: the words that
share a prefix with it. The longest prefix is taken that some word has in so many
documents that p(c|class) stays below the bound even if every carrier of c were
among them; if no prefix is that common, only the label says that a term stood
there.

All of it is SQL functions: a match's place comes from the lengths of the gaps
that `split` leaves around it. Texts are searched for identifiers once; the rows
that carry any are kept with their spans, and joined to the others at the end.
Identifiers with the same carriers reveal the same and are handled as one set,
so a list of addresses costs no more than one. Since p(c|t) is at most
df(c) / df(t), terms of more than df(c) / generalise_at documents can reveal
nothing of c; they leave before pairs are formed. Tables meet in joins that
Spark may split at hot keys.

Defined results: null text is empty and has no spans; overlapping spans of
different kinds are all reported, and the sanitised text replaces their union
under the label of the first; repeated rows (same id and text) get equal results
and count once everywhere; empty tables give empty results. Terms are words of
three letters or more, without regard to case; they never overlap identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyferry.llm.common import SPACE, stored, text_or_empty

# In the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone", "generalised", "removed")

# Every pattern takes the matches of its base form. Look-behind and possessive
# repeats only keep a scan from starting inside a run of characters where the
# base form could not match either, so that long runs stay linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_PUNCT = r"!-/:-@\[-`{-~"
TERM = rf"(?<=[{SPACE}][{_PUNCT}]{{0,4}})\p{{L}}{{3,}}+(?=[{_PUNCT}]{{0,4}}+[{SPACE}])"
# Of the identifiers only emails hold letters; taking them first keeps terms out of them.
TOKEN = rf"{PATTERNS['email']}|{TERM}(?!@-\.-)"
_CHUNK = 256
_KEY = ["key_a", "key_b"]


def running_sum(values: Column) -> Column:
    """Running sums of a long array, in chunks so that the cost stays near linear."""
    zero = F.array(F.lit(0).cast("long"))

    def sums(array: Column, of) -> Column:
        return F.aggregate(array, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + of(x))))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")),
                         lambda k: F.slice(values, k * _CHUNK + 1, _CHUNK))
    inner = F.transform(chunks, lambda c: sums(c, lambda x: x))
    both = F.zip_with(inner, sums(inner, lambda p: F.element_at(p, -1)),
                      lambda p, start: F.when(p.isNotNull(), F.transform(F.slice(p, F.lit(2), F.size(p) - 1), lambda v: v + start)))
    return F.flatten(F.array_compact(both))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    turned = F.reverse(_digits(value))

    def weighed(i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), lambda acc, i: acc + weighed(i))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _same_value(kind: str, value: Column) -> Column:
    return F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)


def _with_matches(df: DataFrame, text: str) -> DataFrame:
    """Adds one array column per kind: structs start, end, value, raw (valid matches only)."""
    for kind, pattern in PATTERNS.items():
        df = df.withColumn("_m", F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
        df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split(F.col(text), pattern, -1)))
        lengths = F.zip_with("_m", F.slice("_g", F.lit(1), F.size("_m")), lambda m, g: (F.length(m) + F.length(g)).cast("long"))
        df = df.withColumn("_l", F.when(F.size("_m") > 0, lengths))
        df = df.withColumn("_e", F.when(F.size("_m") > 0, running_sum(F.col("_l"))))
        made = F.zip_with("_m", "_e", lambda m, e: F.struct(
            (e - F.length(m)).alias("start"), e.alias("end"), _same_value(kind, m).alias("value"), m.alias("raw")))
        kept = F.filter(made, lambda s: _valid(kind, s["raw"]))
        empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string,raw:string>>")
        df = df.withColumn(kind, F.when(F.size("_m") > 0, kept).otherwise(empty)).drop("_m", "_g", "_l", "_e")
    return df


def _spaced(text: Column) -> Column:
    return F.concat(F.lit(" "), text, F.lit(" "))


def _with_terms(df: DataFrame, text: str) -> DataFrame:
    """Adds `terms`: structs term, start, end of all terms of the text."""
    df = df.withColumn("_m", F.regexp_extract_all(_spaced(F.col(text)), F.lit(TOKEN), F.lit(0)))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split(_spaced(F.col(text)), TOKEN, -1)))
    lengths = F.zip_with("_m", F.slice("_g", F.lit(1), F.size("_m")), lambda m, g: (F.length(m) + F.length(g)).cast("long"))
    df = df.withColumn("_l", F.when(F.size("_m") > 0, lengths))
    df = df.withColumn("_e", F.when(F.size("_m") > 0, running_sum(F.col("_l"))))
    # The space put in front moves every place by one.
    placed = F.zip_with("_m", "_e", lambda m, e: F.struct(
        F.lower(m).alias("term"), (e - F.length(m) - 1).alias("start"), (e - 1).alias("end")))
    return df.withColumn("terms", F.filter(placed, lambda s: ~F.contains(s["term"], F.lit("@")))).drop("_m", "_g", "_l", "_e")


def _key() -> list[Column]:
    """128 bits that tell rows apart by id and text."""
    row = [F.col("doc_id").isNull(), F.col("doc_id"), text_or_empty(F.col("text"))]
    return [F.xxhash64(F.lit(i), *row).alias(k) for i, k in enumerate(_KEY)]


def surely(k: Column, n: Column, z: float) -> Column:
    """Lower end of Wilson's interval for a share, after k of n."""
    return (k + z * z / 2 - z * F.sqrt(k * (n - k) / n + z * z / 4)) / (n + z * z)


def _carriers(documents: DataFrame) -> DataFrame:
    """key_a, key_b, t (text), e (identifiers) and base (their spans) of the distinct rows that carry an identifier."""
    found = _with_matches(documents.select(*_key(), text_or_empty(F.col("text")).alias("t")), "t")
    every = F.array_distinct(F.concat(*[F.transform(k, _named(k)) for k in PATTERNS]))
    base = F.array_sort(F.concat(*[F.transform(k, _coded(i)) for i, k in enumerate(PATTERNS)]))
    held = F.when(F.size(every) > 0, F.array(F.struct("t", every.alias("e"), base.alias("base"))))
    # Outer explodes: the inner form would get a filter that computes its array twice.
    found = found.select(*_KEY, F.explode_outer(held).alias("h")).where(F.col("h").isNotNull())
    return stored(found.select(*_KEY, "h.t", "h.e", "h.base").dropDuplicates(_KEY), "pii-holders")


def _distinct_rows(documents: DataFrame) -> tuple[DataFrame, int]:
    """key_a, key_b, text of `documents`, equal rows once, and their number.

    Only rows that do repeat are shuffled with their texts.
    """
    rows = documents.select(*_key(), F.col("text"))
    counts = stored(rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")), "pii-rows")
    again = stored(counts.where("n > 1").select(*_KEY), "pii-again")
    n = counts.count()
    if again.isEmpty():
        return rows, n
    return rows.join(again, _KEY, "left_anti").unionByName(rows.join(again, _KEY, "left_semi").dropDuplicates(_KEY)), n


PREFIXES = (6, 5, 4, 3, 2, 1)


def _classes(decided: DataFrame, group: list[str], df_term: DataFrame, generalise_at: float) -> DataFrame:
    """`decided` with label: the longest prefix that is too common to reveal the set, and a star."""
    def prefixes(shorter: int) -> Column:
        lengths = F.filter(F.array(*[F.lit(k) for k in PREFIXES]), lambda k: F.length("term") >= k + shorter)
        return F.transform(lengths, lambda k: F.substr("term", F.lit(1), k))

    # A class is in at least as many documents as the most frequent of its words.
    common = df_term.select(F.explode(prefixes(0)).alias("prefix"), "df_t").groupBy("prefix").agg(F.max("df_t").alias("df_most"))
    wanted = decided.where(F.col("code") == KINDS.index("generalised")).select(*group, "term", F.explode(prefixes(1)).alias("prefix"))
    safe = F.col("df_most") * generalise_at > F.col("df_c")
    found = wanted.join(common, "prefix").where(safe).groupBy(*group, "term").agg(F.max_by("prefix", F.length("prefix")).alias("prefix"))
    return decided.join(found, [*group, "term"], "left").withColumn("label", F.concat("prefix", F.lit("*"))).drop("prefix")


def revealing_terms(documents: DataFrame, holders: DataFrame | None = None, z: float = 1.645, generalise_at: float = 0.25,
                    remove_at: float = 0.4, least_bits: float = 3.0) -> DataFrame:
    """key_a, key_b, terms: spans (start, code, end, label) of disclosing terms, per row that has any.

    `z` is the normal quantile of the interval around p(c|t); 1.645 leaves 5 % below its lower end.
    """
    holders = _carriers(documents) if holders is None else holders
    rows, n = _distinct_rows(documents)
    entity, group = ["kind", "value"], ["set_a", "set_b", "df_c"]
    carriers = stored(holders.select(*_KEY, F.explode("e").alias("e")).select(*_KEY, "e.kind", "e.value").distinct(), "pii-carriers")
    told = F.col("df_c") <= n / 2 ** least_bits  # of the others, no term can disclose so much
    alike = carriers.groupBy(*entity).agg(
        F.count(F.lit(1)).alias("df_c"), F.bit_xor("key_a").alias("set_a"), F.bit_xor("key_b").alias("set_b")).where(told)
    sets = stored(carriers.join(alike, entity).select(*_KEY, *group).distinct(), "pii-sets")

    # Document frequency of every term of the corpus, pre-aggregated before the shuffle.
    words = F.regexp_extract_all(_spaced(text_or_empty(F.col("text"))), F.lit(TOKEN), F.lit(0))
    words = F.array_distinct(F.transform(F.array_distinct(F.filter(words, lambda w: ~F.contains(w, F.lit("@")))), F.lower))
    df_term = stored(
        rows.select(F.explode_outer(words).alias("term")).where(F.col("term").isNotNull())
        .groupBy("term").agg(F.count(F.lit(1)).alias("df_t")), "pii-frequencies")

    def most_of(df_c: Column) -> Column:
        # A little more than the bound, for rounding.
        return df_c * (1.000001 / generalise_at)

    largest = sets.agg(F.max("df_c")).first()[0] or 0
    common = stored(df_term.where(F.col("df_t") > most_of(F.lit(largest))).select("term"), "pii-common")
    places = _with_terms(holders.select(*_KEY, "t"), "t").select(*_KEY, F.explode_outer("terms").alias("w")).where(F.col("w").isNotNull())
    places = stored(places.select(*_KEY, "w.term", "w.start", "w.end").join(common, "term", "left_anti"), "pii-places")
    near = places.select(*_KEY, "term").distinct().join(df_term, "term")
    pairs = stored(sets.join(near, _KEY).where(F.col("df_t") <= most_of(F.col("df_c"))), "pii-pairs")

    df_pair = pairs.groupBy(*group, "term", "df_t").agg(F.count(F.lit(1)).alias("df_ct"))
    likely = surely(F.col("df_ct"), F.col("df_t"), z)
    bits = F.log2(likely * F.lit(float(n)) / F.col("df_c"))
    code = F.when(bits >= least_bits, F.when(likely >= remove_at, F.lit(KINDS.index("removed"))).when(
        likely >= generalise_at, F.lit(KINDS.index("generalised"))))
    decided = stored(df_pair.select(*group, "term", code.alias("code")).where(F.col("code").isNotNull()), "pii-terms")
    decided = _classes(decided, group, df_term, generalise_at)
    # Of several sets that a term reveals, the strictest verdict counts: removed, else the broadest class.
    told = pairs.join(decided, [*group, "term"]).groupBy(*_KEY, "term").agg(
        F.max("code").alias("code"), F.min(F.struct(F.coalesce(F.length("label"), F.lit(0)).alias("n"), "label")).alias("class"))
    spans = places.join(told, [*_KEY, "term"])
    label = F.when(F.col("code") == KINDS.index("generalised"), F.col("class.label")).alias("label")
    return stored(spans.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "code", "end", label)).alias("terms")), "pii-spans")


def _named(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["value"].alias("value"))


def find_spans(documents: DataFrame, **disclosure) -> DataFrame:
    """Per row: `row`, `base` and `spans`, arrays of (start, code, end, label) in order; code indexes KINDS."""
    holders = _carriers(documents)
    terms = revealing_terms(documents, holders, **disclosure)
    found = holders.select(*_KEY, "base").join(terms, _KEY, "left").select(
        *_KEY, "base", F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "terms"))).alias("spans"))
    found = stored(found, "pii-found")
    own = documents.select(F.struct("*").alias("row"), *_key()).join(found, _KEY, "left")
    none = F.array().cast("array<struct<start:bigint,code:int,end:bigint,label:string>>")
    return own.select("row", *[F.coalesce(c, none).alias(c) for c in ("base", "spans")])


def _coded(code: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(code).alias("code"), s["end"].alias("end"), F.lit(None).cast("string").alias("label"))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["code"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(documents: DataFrame, **disclosure) -> DataFrame:
    """All rows of `documents`: identifiers become labels, generalised terms their class, removed terms go."""
    labels = F.array(*[F.lit("" if k == "removed" else "[TERM]" if k == "generalised" else f"[{k.upper()}]") for k in KINDS])
    found = find_spans(documents, **disclosure)
    text = F.col("row.text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                         F.coalesce(s["label"], F.get(labels, s["code"])))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))

    cleaned = F.when(F.size("spans") == 0, text).otherwise(F.aggregate("spans", start, step, finish))
    return found.select(F.col("row").withField("text", cleaned).alias("row")).select("row.*")
