"""The trained models against plain versions: discounts, class counts, margins, lexicon hits."""

from __future__ import annotations

import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyferry.llm import katz, labelled, quality_model, toxicity
from tests.conftest import SF001, SF01


# -- 3: Good-Turing ---------------------------------------------------------------------
def plain_discounts(n: dict[int, float], most: int) -> dict[int, float] | None:
    """Katz's ratios by the textbook, or None where they are no probabilities."""
    if any(n.get(r, 0) <= 0 for r in range(1, most + 2)):
        return None
    cut = (most + 1) * n[most + 1] / n[1]
    if cut >= 1:
        return None
    out = {r: ((r + 1) * n[r + 1] / n[r] / r - cut) / (1 - cut) for r in range(1, most + 1)}
    return out if all(0 < d < 1 for d in out.values()) else None


def test_discounts_by_the_textbook():
    rng, direct = random.Random(2), 0
    for _ in range(200):
        start, power = rng.randint(50, 10**6), rng.uniform(1.5, 3)
        n = {r: max(0, int(start * r**-power * rng.uniform(0.8, 1.2))) for r in range(1, katz.MOST + 2)}
        times = np.array([0, *[n[r] for r in range(1, katz.MOST + 2)]])
        got, want = katz.good_turing(times), plain_discounts(n, katz.MOST)
        if want is None:  # on the log-linear fit of the counts of counts
            some = [(math.log(r), math.log(c)) for r, c in n.items() if c > 0]
            if len(some) > 1:
                mx, my = sum(x for x, _ in some) / len(some), sum(y for _, y in some) / len(some)
                slope = sum((x - mx) * (y - my) for x, y in some) / sum((x - mx) ** 2 for x, _ in some)
                want = plain_discounts({r: math.exp(my + slope * (math.log(r) - mx)) for r in range(1, katz.MOST + 2)}, katz.MOST)
            want = want or {r: 1 - 0.5 / r for r in range(1, katz.MOST + 1)}
        else:
            direct += 1
        assert got[0] == 1 and got[1:] == pytest.approx([want[r] for r in range(1, katz.MOST + 1)], rel=1e-6)
    assert direct > 20


def test_word_probabilities_sum_to_one(spark):
    counts: Counter = Counter()
    for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect():
        if zlib.crc32(str(r.doc_id).encode()) % 5 != 1:
            counts.update([*re.findall(r"[^ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")), None])
    times = np.array([0, *[sum(c == r for c in counts.values()) for r in range(1, katz.MOST + 2)]])
    words = katz.Words(sum(counts.values()), times)
    whole = sum(float(words.probability(np.array([c]))[0]) for c in counts.values())
    assert whole + words.unknown == pytest.approx(1, abs=1e-9) and 0 < words.unknown < 1
    assert float(words.probability(np.array([0]))[0]) == words.unknown


# -- 4 --------------------------------------------------------------------------------
def test_class_counts_by_a_dictionary(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").where("quality is not null")
    own = {r.doc_id: r.quality for r in labels.collect()}
    known, want = quality_model._Words(), {0: Counter(), 1: Counter()}
    for r in docs.collect():
        if r.doc_id in own and zlib.crc32(str(r.doc_id).encode()) % 5 != 0:
            want[own[r.doc_id]].update(set(quality_model.indicators((r.text or "").encode(), known).tolist()))
    rows = labelled.training_texts(docs, labels, "quality", 0, None).mapInArrow(quality_model._count, "i int, n0 bigint, n1 bigint")
    got = {r.i: (r.n0, r.n1) for r in rows.groupBy("i").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()}
    got.pop(1 << quality_model.BITS)  # the number of documents
    assert got == {i: (want[0][i], want[1][i]) for i in want[0].keys() | want[1].keys()}


def test_descent_reaches_the_optimum_of_its_objective():
    """Against a subgradient method on the same hinge loss."""
    rng = np.random.default_rng(5)
    size, n = 40, 200
    ratio = rng.normal(size=size)
    rows = [np.unique(rng.integers(0, size, rng.integers(3, 12))) for _ in range(n)]
    truth = rng.normal(size=size)
    y = np.array([1.0 if truth[r] @ ratio[r] + rng.normal() > 0 else -1.0 for r in rows])
    cost = np.where(y > 0, 0.8, 0.5)
    x = np.zeros((n, size))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / math.sqrt(len(r))

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w))).sum()

    w = quality_model.dual_coordinate_descent(rows, ratio, y, cost, epochs=400)
    v, best = np.zeros(size), math.inf
    for t in range(1, 20_001):
        inside = y * (x @ v) < 1
        v -= (v - (cost * y * inside) @ x) / t
        best = min(best, loss(v)) if t > 10_000 else best
    assert loss(w) <= best * 1.001 and loss(w) >= best * 0.99


# -- 7 --------------------------------------------------------------------------------
def plain_hits(text: str, lexicon: toxicity.Lexicon) -> list[tuple[int, int, float]]:
    """Every term at every place, by comparing strings."""
    best: dict = {}
    for term, weight in lexicon.weights.items():
        for i in range(len(text)):
            if text.startswith(term, i) and (i not in best or weight > best[i][1]):
                best[i] = (i + len(term) - 1, weight)
    spared = set()
    for phrase in lexicon.exceptions:
        for i in range(len(text)):
            if text.startswith(phrase, i):
                spared |= set(range(i, i + len(phrase) - 1))
    return sorted((i, e, w) for i, (e, w) in best.items() if i not in spared)


def test_hits_by_plain_search():
    rng = random.Random(4)
    words = ["bad", "badly", "ugly", "uglier", "good", "dog", "cat", "bat"]
    lexicon = toxicity.Lexicon({" bad ": 2.0, " ugly ": 1.5, " ugli": 1.0, " bad": 0.5, " dog ": 0.7}, (" not bad ", " ugly dog "))
    machine = lexicon.automaton()
    for _ in range(300):
        text = f" {' '.join(rng.choices([*words, 'not'], k=rng.randint(0, 12)))} "
        assert sorted(toxicity._hits(text, machine)) == plain_hits(text, lexicon)
    assert toxicity._hits(" not bad ", machine) == [] and plain_hits(" bad ", lexicon) == [(0, 4, 2.0)]


@pytest.mark.parametrize(("text", "want"), [
    ("IDIOT", " idiot "), ("1d10t", " idiot "), ("id​iot", " idiot "), ("іdіоt", " idiot "), ("ｉｄｉｏｔ", " idiot "),
    ("ídïöt", " idiot "), ("id!ot!", " idiot "), ("$tup1d", " stupid "), ("a - b", " a b "), ("", "  "), (None, "  ")])
def test_folding(text, want):
    l_is_i = str.maketrans("l", "i")
    assert toxicity.folded(text, toxicity._Folds()) == want.translate(l_is_i)
    if text and text.isascii() and text.isalpha():
        assert toxicity.folded(text, toxicity._Folds()).strip() == unicodedata.normalize("NFKD", text.lower()).translate(l_is_i)


def test_lexicon_weights_by_hand(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    lexicon = toxicity.fit(docs, labels)
    own = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    rows = [(set(toxicity.folded(r.text, toxicity._Folds()).split()), own[r.doc_id]) for r in docs.collect()
            if r.doc_id in own and zlib.crc32(str(r.doc_id).encode()) % 5 != 0]
    toxic, clean = sum(y == 1 for _, y in rows), sum(y != 1 for _, y in rows)
    whole = [t for t in lexicon.weights if t.endswith(" ")]
    assert whole
    for term in whole:
        n1, n0 = (sum(term.strip() in w for w, y in rows if (y == 1) == side) for side in (True, False))
        odds = math.log((n1 + 0.5) / (toxic + 1)) - math.log((n0 + 0.5) / (clean + 1))
        assert lexicon.weights[term] == pytest.approx(odds - 1.5 * math.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5)))
        assert n1 >= 4 and lexicon.weights[term] >= 2.1


def test_clashing_columns_of_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    clash = labels.withColumns({c: F.lit("x") for c in ("text", "label", "label_id", "lang", "source", "score", "i", "word")})
    clash = clash.unionByName(clash.limit(3)).unionByName(clash.limit(1).withColumn("doc_id", F.lit(None).cast("bigint")))
    one, two = (sorted(map(tuple, toxicity.score(docs, toxicity.fit(docs, lb)).collect())) for lb in (labels, clash))
    assert one == two
    a, b = (quality_model.fit(docs, lb) for lb in (labels, clash))
    assert np.allclose(a.weights, b.weights) and (a.slope, a.offset) == (b.slope, b.offset)
