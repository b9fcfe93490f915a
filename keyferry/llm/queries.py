"""Registered queries of the training-data operators, with DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from keyferry.llm import (
    decontaminate, katz, language, merkle, mixing, near_dup, pii, quality_model, quality_rules, spelling, suffix_dedup, toxicity, url_filter,
)
from keyferry.llm.common import table

# Fixed by the query contract: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# -- 1: personal data -----------------------------------------------------------
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))

    def count(kind: str):
        code = pii.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["code"] == code)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("row.doc_id").alias("doc_id"), *[count(k) for k in pii.KINDS],
                        F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
                        pii.spans_text(F.col("spans")).alias("spans"))


# -- 2: near duplicates -----------------------------------------------------------
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.groups(table(spark, sf_dir, "documents"), near_dup.Settings(words=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


# -- 3: language model ------------------------------------------------------------
def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


# -- 4: quality classifier ----------------------------------------------------------
def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_model.score(documents, quality_model.fit(documents, table(spark, sf_dir, "labels")))


# -- 5: repeated byte strings ---------------------------------------------------------
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


# -- 6: mixing sources ----------------------------------------------------------
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


SQL_OP6 = f"""WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS queue
  FROM sized GROUP BY source),
weighed AS (SELECT *, list_extract([1.0, 2.0, 3.0], ((queue - 1) % 3 + 1)::INT)::DOUBLE AS w, 3 * source_size AS cap FROM src),
levels AS (SELECT *, (sum(source_size) OVER () - (sum(cap) OVER upto - cap))::DOUBLE
    / (sum(w) OVER () - sum(w) OVER upto + w) AS level
  FROM weighed WINDOW upto AS (ORDER BY cap / w, queue)),
target AS (SELECT source, queue, source_size,
    least(cap::DOUBLE, (SELECT level FROM levels WHERE level * w <= cap ORDER BY cap / w, queue LIMIT 1) * w) AS target FROM levels),
placed AS (SELECT s.*, t.queue, t.source_size, t.target,
    sum(size) OVER (PARTITION BY queue ORDER BY place, s.doc_id ROWS UNBOUNDED PRECEDING) AS served
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT *, (turn * source_size + served) / target AS finish
  FROM placed, (VALUES (0), (1), (2)) v(turn) WHERE size > 0 AND target > 0),
line AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, queue, turn, served ROWS UNBOUNDED PRECEDING) AS upto FROM copies),
taken AS (SELECT doc_id, sum(size) AS taken FROM line WHERE upto <= (SELECT sum(size) FROM sized) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN taken USING (doc_id)"""


# -- 7: toxicity --------------------------------------------------------------------
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


# -- 8: benchmark decontamination -------------------------------------------------
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(documents, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _sql_words(column: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), "
            "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


SQL_OP8 = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_sql_words('text')} AS w FROM documents),
b AS (SELECT item_id, {_sql_words('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, list_slice(w, p, p + n - 1) AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS p
        FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, p, list_slice(w, p, p + n - 1) AS win
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT rid, p, dw.n, item_id FROM dw JOIN bw USING (n, win)),
pos AS (SELECT rid, count(DISTINCT q) AS n_hit
  FROM (SELECT rid, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS h
  FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN items USING (rid)"""


# -- 9: quality rules ---------------------------------------------------------------
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


_SPACE = "\\x20\\x09-\\x0D"
SQL_OP9 = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^{_SPACE}]+') AS w, string_split(t, chr(10)) AS ls FROM d),
win AS (SELECT rid, p, list_slice(w, p, p + 2) AS g
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS p FROM w WHERE len(w) >= 3)),
rep AS (SELECT rid, count(DISTINCT q) AS n FROM (
  SELECT rid, unnest([p, p + 1, p + 2]) AS q
  FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS k FROM win) WHERE k > 1) GROUP BY rid),
s AS (SELECT doc_id, t, greatest(length(t), 1) AS n_chars, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[{_SPACE}]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    list_filter(ls, lambda x: regexp_matches(x, '[^{_SPACE}]')) AS lines, len(ls) AS n_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    coalesce(list_sum(list_transform(generate_series(1, len(w) - 1), lambda i: CASE WHEN w[i] = w[i + 1] THEN length(w[i]) ELSE 0 END)), 0) AS run
  FROM w LEFT JOIN rep USING (rid)),
f AS (SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols / n_chars > 0.04
    OR (length(t) - length(replace(t, '!', ''))) / n_chars > 0.05
    OR (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) / n_chars > 0.4
    OR length(regexp_replace(t, '\\PL+', '', 'g')) / n_chars < 0.5
    OR n_dup_lines / n_lines > 0.6
    OR run / n_chars > 0.2
    OR NOT (word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 20.0)) AS kept
FROM f"""


# -- 10: URL filters -------------------------------------------------------------------
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules, "page_id")


_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
SQL_OP10 = f"""WITH p AS (SELECT row_number() OVER () AS rid, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r AS (SELECT * FROM (VALUES {_RULES}) v(rule_host, rule_path, verdict)),
fit AS (SELECT rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fit USING (rid)"""


# -- 11: spelling variants -----------------------------------------------------------
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = spelling.Settings(min_length=7, min_count=2, ratio=10, drop_one_in=31)
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), settings), settings)


def _sql_crc32(text: str) -> str:
    """The CRC of the UTF-8 bytes, bit by bit: a byte enters, then eight shifts (-1)."""
    byte = f"('0x' || substr(hex({text}), 2 * b + 1, 2))::BIGINT"
    return (f"xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(0, strlen({text})), lambda b: [{byte}, -1, -1, -1, -1, -1, -1, -1, -1])), "
            "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)")


SQL_OP11 = f"""WITH RECURSIVE runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents) WHERE length(run) >= 7 GROUP BY id, run),
hashed AS (SELECT run, n, {_sql_crc32("(id || ':' || run)")} AS h FROM runs),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gaps AS (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(generate_series(1, length(word)))::INT AS i FROM words)),
pairs AS (
  SELECT a.word AS a, a.n AS a_n, b.word AS b, b.n AS b_n FROM gaps a JOIN gaps b USING (i, head, tail) WHERE a.word < b.word
  UNION SELECT g.word, g.n, w.word, w.n FROM gaps g JOIN words w ON w.word = g.head || g.tail),
near AS (SELECT a AS word, b AS other, b_n AS other_n FROM pairs UNION ALL SELECT b, a, a_n FROM pairs),
best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
formed AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (word)),
climb AS (SELECT word, coalesce(form, word) AS root, form IS NOT NULL AS on_way FROM formed
  UNION ALL SELECT c.word, f.form, true FROM climb c JOIN formed f ON c.root = f.word WHERE c.on_way AND f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM climb c JOIN formed f ON c.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""


# -- 12: Merkle manifest ---------------------------------------------------------------
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0  # null: not changed
    n_chars = F.col("n_chars").cast("decimal(38,0)") + 1
    tampered = F.when(changed, merkle.digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")))
    found = merkle.manifest(documents, carry=[tampered.alias("tampered")])
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_leaf(n_chars: str) -> str:
    cells = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}) || ':' || {c} END"
             for c in ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")]
    return f"sha256({' || '.join(cells)})"


def _sql_levels(name: str, first: str) -> str:
    """Every level of the trees (tree, list of nodes) of `first`."""
    return f"""{name} AS (SELECT tree, 0 AS level, nodes FROM {first}
  UNION ALL SELECT tree, level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM {name} WHERE len(nodes) > 1)"""


def _sql_path(name: str, pos: str) -> str:
    """Steps of the path of place `pos`, in order: side and sibling."""
    other = f"nodes[xor({pos} >> level, 1) + 1]"
    return (f"list(CASE WHEN {other} IS NULL THEN '' WHEN ({pos} >> level) % 2 = 1 THEN '<' || {other} ELSE '>' || {other} END ORDER BY level) "
            f"FILTER (WHERE len(nodes) > 1)")


SQL_OP12 = f"""WITH RECURSIVE rows AS (SELECT row_number() OVER () AS rid, doc_id, lang, {_sql_leaf('n_chars')} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_sql_crc32('doc_id::VARCHAR')} % 7 = 0 THEN {_sql_leaf('n_chars::HUGEINT + 1')} END AS tampered FROM documents),
placed AS (SELECT *, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos FROM rows),
trees AS (SELECT tree, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY tree),
{_sql_levels('levels', 'trees')},
subroots AS (SELECT tree AS member, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM levels WHERE len(nodes) = 1),
forest AS (SELECT '' AS tree, list(subroot ORDER BY pos) AS nodes FROM subroots),
{_sql_levels('tops', 'forest')},
above AS (SELECT member, subroot, coalesce({_sql_path('tops', 's.pos')}, []) AS up, max(nodes[1]) FILTER (WHERE len(nodes) = 1) AS root
  FROM subroots s, tops GROUP BY member, subroot),
below AS (SELECT rid, coalesce({_sql_path('levels', 'p.pos')}, []) AS path FROM placed p JOIN levels USING (tree) GROUP BY rid),
proofs AS (SELECT doc_id, leaf, tampered, subroot, root, path || up AS path FROM placed p JOIN below USING (rid) JOIN above a ON a.member = p.tree),
folded AS (SELECT *, list_reduce([coalesce(tampered, leaf)] || path, lambda x, s: CASE WHEN s[1] = '<' THEN sha256(s[2:] || x) ELSE sha256(x || s[2:]) END) AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


# -- 13: language identification ---------------------------------------------------------
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.predict(documents, language.fit(documents))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_pii": op1_pii,
    "op2_minhash": op2_minhash,
    "op3_katz": op3_katz,
    "op4_quality_model": op4_quality_model,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_mix_sources": op6_mix_sources,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_language_id": op13_language_id,
}

ORACLE_SQL: dict[str, str] = {
    "op6_mix_sources": SQL_OP6,
    "op8_decontaminate": SQL_OP8,
    "op9_quality_rules": SQL_OP9,
    "op10_url_filter": SQL_OP10,
    "op11_spelling_variants": SQL_OP11,
    "op12_merkle_manifest": SQL_OP12,
}
