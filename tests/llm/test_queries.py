"""Registered queries against their DuckDB statements, or against plain versions."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest

import __spark_entry__ as se
import corpus_pipeline
from keyferry.llm import katz, queries
from tests.conftest import SF001
from tests.llm import brute
from tools.compare import digest, spark_type_name

TABLES = ("documents", "labels", "benchmark", "pages")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}


def rows(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, SF001).collect()}


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in queries.QUERIES if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.QUERIES) <= set(se.queries()) and set(queries.ORACLE_SQL) <= set(se.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "benchmark_decontamination", "pii", "mix_sources"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(queries.ORACLE_SQL[name])
    cols, types = [d[0] for d in res.description], {d[0]: str(d[1]) for d in res.description}
    assert {f.name: spark_type_name(f.dataType) for f in df.schema.fields} == types
    assert digest(df.columns, got) == digest(cols, res.fetchall())


def test_pii_base_spans(spark, docs):
    for i, r in rows(spark, "op1_pii").items():
        want = brute.pii_spans(docs[i])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if not s.startswith(("generalised", "removed"))] == want.split(",")
        assert r["n_email"] == want.count("email:") and r["n_card"] == want.count("card:")


def test_near_duplicates(spark, docs):
    want = brute.dup_components(docs, 3, 85)
    for i, r in rows(spark, "op2_minhash").items():
        assert (r["component_id"], r["kept"]) == (want[i], want[i] == i)
        assert r["n_shingles"] == len(brute.shingle_set(docs[i], 3))


def test_language_model(spark, docs):
    model = brute.Katz(docs, katz.Words, katz.good_turing, katz.MOST)
    got = rows(spark, "op3_katz")
    better = 0
    for i, r in list(got.items())[::4]:
        base, score = model.score(i)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-6)
        assert (r["n_tokens"], r["train_tokens"], r["held_out"]) == (len(model.tokens[i]), model.n, model.out[i])
        assert r["n_known"] == sum(model.one[w] > 0 for w in model.tokens[i])
        better += r["score"] > r["base_score"]
    assert better > 0.9 * len(list(got)[::4])
    for context in (brute.END, *list(model.one)[:2]):  # every context sums to one
        seen = sum(model.pair(context, w) for w in model.one)
        assert seen + model.context(context)[1] * model.words.unknown == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize(("name", "label", "least"), [("op4_quality_model", "quality", 0.9), ("op7_toxicity", "toxic", 0.85)])
def test_classifiers_on_held_out_rows(spark, name, label, least):
    import pandas as pd

    sf = "/root/testdata/sf0.01"
    got = pd.DataFrame([r.asDict() for r in queries.QUERIES[name](spark, sf).collect()])
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    both = got.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert len(got) == 1000 and got.score.between(0, 1).all() and len(held) > 30
    assert (held.predicted == held[label]).mean() >= least


def test_repeated_strings(spark, docs):
    got = rows(spark, "op5_suffix_dedup")
    ids = sorted(docs)
    for i, want in zip(ids, brute.repeats([(docs[i] or "").encode() for i in ids], 400)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want


def test_mix_comes_near_its_targets(spark):
    got = queries.QUERIES["op6_mix_sources"](spark, "/root/testdata/sf0.01").toPandas()
    assert (got.taken <= 3 * got["size"]).all()
    whole = got["size"].sum()
    assert whole - got["size"].max() <= got.taken.sum() <= whole
    for target, own in got.groupby("target"):
        assert abs(own.groupby("source_size").taken.sum() - target).max() <= 2 * got["size"].max()


def test_pipeline_against_plain_stages(spark, docs):
    got = corpus_pipeline.run(spark, SF001).toPandas()
    judged = rows(spark, "op9_quality_rules")
    left = {i: t for i, t in docs.items() if judged[i]["kept"]}
    groups = brute.dup_components(left, 5, 80)
    left = {i: t for i, t in left.items() if groups[i] == i}
    hit = rows(spark, "op8_decontaminate")
    left = {i: t for i, t in left.items() if not hit[i]["contaminated"]}
    assert set(got.doc_id) <= set(left) and len(got) > 0.6 * len(left)
    assert not got.text.map(lambda t: bool(brute.pii_spans(t))).any()
    assert {"doc_id", "text", "lang", "source", "n_chars", "taken"} <= set(got.columns) and (got.taken > 0).all()
    spent, sizes = got.taken.sum(), sum(len(t.split()) for t in left.values())
    assert 0.9 * sizes <= spent <= 1.1 * sizes
