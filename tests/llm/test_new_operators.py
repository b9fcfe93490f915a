"""Spelling variants, Merkle manifest and language identification against plain versions, and their edge cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyferry.llm import language, merkle, queries, spelling
from tests.conftest import SF001, SF01

CLASH = "word string, n int, tree string, pos int, node string, at int, key string, path string, root string, h int, nth int, share double"


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_variants(counts: dict[str, int], ratio: int) -> dict[str, tuple]:
    own = {w: sorted((-counts[v], v) for v in counts if near(w, v)) for w in counts}
    form = {w: p[0][1] if p and -p[0][0] >= ratio * counts[w] else None for w, p in own.items()}

    def root(w: str) -> str:
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), counts[w], len(own[w]), counts[form[w]] if form[w] else None) for w in counts}


def frame(spark, rows):
    clash = ("w", 1, "t", 2, "n", 3, "k", "p", "r", 4, 5, 0.5)
    return spark.createDataFrame([(*r, *clash) for r in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, " + CLASH)


def got_variants(words_df, settings):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(words_df, settings).collect()}


# -- 11 ---------------------------------------------------------------------------
def test_words_of_the_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    counts: Counter = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    want = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = spelling.count_words(spark.read.parquet(f"{SF001}/documents.parquet"), spelling.Settings(drop_one_in=31))
    assert {r["word"]: r["n"] for r in got.collect()} == want
    some = {w: n for i, (w, n) in enumerate(sorted(want.items())) if i % 4 == 0}
    df = spark.createDataFrame(list(some.items()), "word string, n bigint")
    assert got_variants(df, spelling.Settings()) == plain_variants(some, 10)


@pytest.mark.parametrize("symbols", [2, 8, 10])
def test_every_near_pair_is_found_once(spark, symbols):
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("abü"), rng.integers(1, 6))) for _ in range(250)}
    long = "".join(rng.choice(list("abcdé"), 60))
    for size in (39, 40, 41, 42, 43, 60):  # across the bound between the two ways to key a word
        w = long[:size]
        words |= {w} | {w[:i] + "z" + w[i + 1:] for i in (0, size // 2, size - 1)} | {w[:i] + w[i:][1:] for i in (0, size // 2 - 1, size // 2, size // 2 + 1)}
        words |= {w[:i] + w[i] + w[i:] for i in (0, size // 2 - 1, size // 2, size - 1)}
    counts = {w: i + 1 for i, w in enumerate(sorted(words))}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = [tuple(sorted((r["a"], r["b"]))) for r in spelling.near_pairs(df, symbols).collect()]
    want = {(a, b) for a in counts for b in counts if a < b and near(a, b)}
    assert len(found) == len(set(found)) and set(found) == want
    assert got_variants(df, spelling.Settings(symbols=symbols, ratio=3)) == plain_variants(counts, 3)


def test_forms_ties_and_chains(spark):
    counts = {"abcdefg": 1000, "abcdefx": 100, "abcdeyx": 9, "qqqqqqq": 5, "qqqqqqa": 50, "qqqqqqb": 50}
    got = got_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"), spelling.Settings())
    assert got["abcdeyx"] == ("abcdefx", "abcdefg", 9, 1, 100) and got["abcdefg"] == (None, "abcdefg", 1000, 1, None)
    assert got["qqqqqqq"] == ("qqqqqqa", "qqqqqqa", 5, 2, 50) and got["qqqqqqb"][0] is None


def test_spelling_edges(spark):
    run = "x" * 50_000
    rows = [(1, None, "en", "s", 1), (2, "", None, None, None), (None, "Éléphant ÉLÉPHANTİelephant", None, None, 1), (3, "straße-STRASSE straße's", "de", "s", 1),
            (3, "straße-STRASSE straße's", "de", "s", 1), (4, f"{run} {run} {run}y", "en", "s", 1), (5, "short", "en", "s", 1)]
    got = {r["word"]: r["n"] for r in spelling.count_words(frame(spark, rows), spelling.Settings(min_length=6)).collect()}
    assert got == {"straße": 4, "strasse": 2, run: 2}  # É is not lowered, İ ends a run, repeated rows count
    both = spelling.variants(spelling.count_words(frame(spark, rows), spelling.Settings(min_count=1)), spelling.Settings(ratio=2))
    assert {r["word"][-2:]: r["n_near"] for r in both.collect() if r["word"].startswith("xx")} == {"xx": 1, "xy": 1}
    assert spelling.variants(spelling.count_words(frame(spark, []))).count() == 0
    with pytest.raises(ValueError):
        spelling.Settings(symbols=11)
    few = spelling.count_words(frame(spark, rows), spelling.Settings(min_length=6), held=1)  # counted in many small tables
    assert {r["word"]: r["n"] for r in few.collect()} == got


# -- 12 ---------------------------------------------------------------------------
def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def cell(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, siblings) of (doc_id, source, lang, n_chars, text), sorted."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0], H(*map(cell, r))))
    trees = {g: climb([leaf for *_, leaf in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2]))]) for g, v in groups.items()}
    names = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    top, out = climb([trees[g][-1][0] for g in names]), []
    for rank, g in enumerate(names):
        for pos, (_, i, leaf) in enumerate(sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2]))):
            steps = [(lv, pos >> k) for k, lv in enumerate(trees[g][:-1])] + [(lv, rank >> k) for k, lv in enumerate(top[:-1])]
            out.append((i, leaf, trees[g][-1][0], top[-1][0], [lv[p ^ 1] for lv, p in steps if p ^ 1 < len(lv)]))
    return sorted(out, key=str)


def manifest_rows(df):
    return sorted([(r["doc_id"], r["leaf"], r["subroot"], r["root"], [s[1:] for s in r["path"] if s]) for r in df.collect()], key=str)


@pytest.mark.parametrize("every", [1, 3, 8])
def test_manifest_equals_plain_trees(spark, every):
    rows = [(i * 7 % 101, f"s{i % 3}", ["en", "en", None, "de", "é"][i % 5] if i < 90 else f"x{i}", i if i % 4 else None, f"text {i}€" if i % 6 else None) for i in range(101)]
    rows += [rows[3], rows[3], (None, None, "en", 1, ""), (None, None, "en", 2, None), (5, "s", "en", 0, "other"), (6, "s", "", 0, "empty lang")]
    df = frame(spark, [(r[0], r[4], r[2], r[1], r[3]) for r in rows])
    found = merkle.manifest(df, every=every)
    assert manifest_rows(found) == plain_manifest(rows)
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()


def test_manifest_edges(spark):
    one = frame(spark, [(1, "a", None, None, None)])
    r = merkle.manifest(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] and r["path"] == []
    assert merkle.manifest(frame(spark, [])).count() == 0
    texts = [(i, "x" * (3_000_000 if i == 1 else i), "en", "s", i) for i in range(1, 6)]
    assert manifest_rows(merkle.manifest(frame(spark, texts), every=2)) == plain_manifest([(i, s, lang, n, t) for i, t, lang, s, n in texts])
    big = [(2 ** 62 + i, "t", "en", None, None) for i in range(5)] + [(None, "t", "en", None, None)]
    assert manifest_rows(merkle.manifest(frame(spark, big))) == plain_manifest([(i, s, lang, n, t) for i, t, lang, s, n in big])
    with pytest.raises(ValueError):
        merkle.manifest(one, every=0)


def test_tampering_is_found(spark):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op12_merkle_manifest"](spark, SF001).collect()}
    for i, r in rows.items():
        assert r["verified"] == bool(zlib.crc32(str(i).encode()) % 7) == (r["folded_root"] == r["root"])
    assert 0 < sum(not r["verified"] for r in rows.values()) < len(rows)


# -- 13 ---------------------------------------------------------------------------
def test_languages_of_held_out_documents(spark):
    import pandas as pd

    got = queries.QUERIES["op13_language_id"](spark, SF01).toPandas()
    docs = pd.read_parquet(f"{SF01}/documents.parquet")
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98 and set(got.lang_pred) <= set(docs.lang)


def test_held_out_documents_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = docs.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang"))).withColumn("text", F.when(out, F.lit("zzz")).otherwise(F.col("text")))
    a, b = language.fit(docs), language.fit(other)
    assert a.families == b.families and np.array_equal(a.weights, b.weights)


def test_ngrams_do_not_depend_on_pieces():
    s = language.Settings(orders=3)
    text = "Straße 12 ÉTÉ, ЖИ a-b \U0001f600 end" * 5
    letters = [c.lower() if c.isalpha() else " " for c in text]
    want = sum(any(c != " " for c in letters[i:i + k]) for k in (1, 2, 3) for i in range(len(letters) - k + 1))
    whole = np.sort(np.concatenate(list(language.ngrams(text, s))))
    assert len(whole) == want
    for piece in (1, 2, 7, 64):
        assert np.array_equal(np.sort(np.concatenate(list(language.ngrams(text, s, piece)))), whole)
    assert list(language.ngrams(None, s)) == [] and list(language.ngrams("12 !", s)) == []


def test_hinge_machine_reaches_the_optimum():
    """The primal objective meets the dual one, so no other weights are better."""
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(200, 12)), np.where(rng.random(200) < 0.3, 1.0, -1.0)
    x[y > 0, :3] += 0.8
    rows = [(np.arange(12), v) for v in x]
    w = language.hinge(rows, y, 12, cost=1.0, epochs=2_000)
    bound = 0.5 / np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    whole = np.hstack([x, np.ones((200, 1))])

    def primal(v):
        return 0.5 * v @ v + (bound * np.maximum(0, 1 - y * (whole @ v))).sum()

    for _ in range(300):
        assert primal(w + rng.normal(scale=10 ** rng.uniform(-4, 0), size=13)) > primal(w) - 1e-3 * primal(w)


def test_families_join_the_most_alike():
    means = {"a": np.array([1.0, 0, 0]), "b": np.array([0.9, 0.1, 0]), "c": np.array([0, 1.0, 0.2]), "d": np.array([0, 0.9, 0.3])}
    assert language.families(means) == [["a", "b"], ["c", "d"]]
    assert language.families(means, 4) == [["a"], ["b"], ["c"], ["d"]]
    assert language.families({"a": means["a"]}) == [["a"]] and language.families({}) == []


def test_language_edges(spark):
    train = [(i, "the weather of the day " * 3, "en", "s", 1) for i in range(40)] + [(i + 100, "der Tag und das Wetter " * 3, "de", "s", 1) for i in range(40)]
    odd = [(None, None, "en", None, None), (900, "", "en", "s", 1), (901, "12 !?", "de", "s", 1), (902, "das Wetter", None, "s", 1), (902, "das Wetter", None, "s", 1),
           (903, "the day " * 300_000, None, "s", 1)]
    docs = frame(spark, train + odd)
    model = language.fit(docs)
    rows = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()]
    got = {i: (p, s) for i, p, s in rows}
    assert len(rows) == len(train + odd) and got[None] == got[900] == got[901] == ("und", 0.0)
    assert got[902][0] == "de" and got[903][0] == "en" and got[0][0] == "en" and got[100][0] == "de"
    none = language.fit(frame(spark, []))
    assert {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"} and language.predict(frame(spark, []), model).count() == 0
    single = language.fit(frame(spark, train[:40]))
    assert {(r["lang_pred"], r["score"]) for r in language.predict(frame(spark, train), single).collect()} == {("en", 1.0)}
    text_ids = docs.withColumn("doc_id", F.concat(F.lit("id-"), "doc_id"))
    assert language.predict(text_ids, model).schema["doc_id"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        language.fit(docs, settings=language.Settings(max_model_bytes=10))
