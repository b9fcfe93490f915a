"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Text is folded first: lower case, accents dropped, letters that look Latin
(Cyrillic, Greek, full width) and digits or signs that stand for letters mapped
to one form, everything else to single spaces. The lexicon holds whole words
and word beginnings, weighted by the log odds that a training document with
them is toxic, and the exception phrases: a lexicon hit with the word before or
after it that training shows in clean documents only. All are found in one
Aho-Corasick pass over whole texts; hits inside exception phrases do not count.
The sum of weights, and the same divided by length, give the score in a small
logistic model.

Lexicon and model are fitted on a bounded sample of `max_rows` training rows;
the lexicon has at most `max_terms` terms.

Defined results: null text is empty; a text without hits gets the score of no
hits; without training rows of both classes every score is the share of label 1
(0 without any). Empty tables give empty results.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyferry.llm.labelled import fold, logistic, sigmoid, training_texts

HELD_OUT_FOLD = 0
PREFIXES = (4, 5, 6)  # lengths of word beginnings that may be terms

# Look-alikes and digit substitutions, each to the letter it stands for.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "к": "k", "м": "m", "т": "t", "н": "h",
    "в": "b", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "г": "r", "п": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "ɑ": "a", "ɡ": "g", "ʟ": "l",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i",
}
# l and i are one form, since 1, ! and | stand for either.
_FINAL = {"l": "i"}
_SIGNS = "@$!|"


class _Folds(dict):
    """Code point -> folded text, filled as characters are met."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        out = ""
        for c in unicodedata.normalize("NFKD", char.lower()):
            if not unicodedata.combining(c):
                out += LOOKALIKES.get(c, c if c.isalnum() else " ")
        self[point] = out = "".join(_FINAL.get(c, c) for c in out) if out or unicodedata.combining(char) else " "
        return out


_SIGN_WORD = re.compile(rf"(?<=\w)[{re.escape(_SIGNS)}](?=\w)|(?<!\S)[{re.escape(_SIGNS)}](?=\w)")
_SIGN = re.compile(rf"[{re.escape(_SIGNS)}]+")
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]+")


def folded(text: str | None, folds: dict) -> str:
    """Folded words, each between single spaces."""
    text = _HIDDEN.sub("", text or "")
    if any(s in text for s in _SIGNS):  # a sign is a letter only inside or before a word
        text = _SIGN_WORD.sub(lambda m: LOOKALIKES[m.group()], text)
        text = _SIGN.sub(" ", text)
    return f" {' '.join(text.translate(folds).split())} "


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    model: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, 0.0]))

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            machine.add_word(term, (len(term), weight, False))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), 0.0, True))
        if len(machine):
            machine.make_automaton()
        return machine


def _hits(text: str, machine: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the heaviest term at each word, without those in exception phrases."""
    if not len(machine):
        return []
    best: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for last, (length, weight, exception) in machine.iter(text):
        start = last - length + 1
        if exception:
            spared.append((start, last))
        elif start not in best or weight > best[start][1]:
            best[start] = (last, weight)
    covered = set()
    for a, b in spared:
        covered.update(range(a, b))
    return [(s, e, w) for s, (e, w) in best.items() if s not in covered]


def _features(texts: list[str], machine: ahocorasick.Automaton) -> np.ndarray:
    out = np.zeros((len(texts), 2))
    for i, text in enumerate(texts):
        total = sum(w for _, _, w in _hits(text, machine))
        out[i] = np.log1p(total), np.log1p(100 * total / max(text.count(" ") - 1, 1))
    return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word, by class, summed over the partition's rows as far as memory allows."""
    folds, counts = _Folds(), {0: Counter(), 1: Counter()}

    def emit() -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        batch = pa.record_batch([pa.array(words, pa.string()), *(pa.array([counts[k][w] for w in words], pa.int64()) for k in (0, 1))],
                                names=["word", "n0", "n1"])
        counts[0].clear()
        counts[1].clear()
        return batch

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[1 if label == 1 else 0].update(set(folded(text, folds).split()))
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield emit()
    yield emit()


def _candidates(sample: DataFrame) -> DataFrame:
    """term, n0, n1: whole words (" w ") and word beginnings (" w") with documents of both classes.

    A beginning counts without its most frequent toxic word, so that it is a
    term only if it generalises over several words.
    """
    words = sample.mapInArrow(_word_counts, "word string, n0 bigint, n1 bigint").groupBy("word").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    whole = words.select(F.concat(F.lit(" "), "word", F.lit(" ")).alias("term"), "n0", "n1")
    starts = F.explode(F.array(*[F.lit(n) for n in PREFIXES]))
    begun = words.select("word", "n0", "n1", starts.alias("n")).where(F.length("word") >= F.col("n"))
    begun = begun.groupBy(F.concat(F.lit(" "), F.left("word", F.col("n"))).alias("term")).agg(
        F.sum("n0").alias("n0"), (F.sum("n1") - F.max("n1")).alias("n1"))
    return whole.unionByName(begun)


def fit(documents: DataFrame, labels: DataFrame, column: str = "toxic", max_rows: int = 20_000, max_terms: int = 5_000,
        min_support: int = 4, min_log_odds: float = 2.1) -> Lexicon:
    sample = training_texts(documents, labels, column, HELD_OUT_FOLD, max_rows).persist()
    try:
        docs = {r["label"]: r["n"] for r in sample.groupBy((F.col("label") == 1).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
        clean, toxic = docs.get(0, 0), docs.get(1, 0)
        if not clean or not toxic:
            share = toxic / (clean + toxic) if clean + toxic else 0.0
            return Lexicon({}, (), np.array([0.0, 0.0, np.log(max(share, 1e-6) / max(1 - share, 1e-6))]))
        # Log odds less one and a half standard errors, so that rare words need more than chance.
        odds = F.log((F.col("n1") + 0.5) / (toxic + 1)) - F.log((F.col("n0") + 0.5) / (clean + 1)) \
            - 1.5 * F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
        chosen = _candidates(sample).withColumn("w", odds).where((F.col("n1") >= min_support) & (F.col("w") >= min_log_odds))
        top = chosen.orderBy(F.col("w").desc(), F.col("n1").desc(), "term").limit(max_terms)
        lexicon = Lexicon({r["term"]: r["w"] for r in top.select("term", "w").collect()})
        lexicon.exceptions = _exceptions(sample, lexicon)

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            folds, own = _Folds(), lexicon.automaton()
            for batch in batches:
                x = _features([folded(t, folds) for t in batch.column(0).to_pylist()], own)
                yield pa.record_batch([batch.column(1).cast(pa.int32()), pa.array(x[:, 0]), pa.array(x[:, 1])], names=["label", "a", "b"])

        table = sample.mapInArrow(features, "label int, a double, b double").orderBy("label", "a", "b").toArrow()
        x = np.stack([table["a"].to_numpy(), table["b"].to_numpy()], axis=1)
        lexicon.model = logistic(x, (table["label"].to_numpy() == 1).astype(float), ridge=0.1)
        return lexicon
    finally:
        sample.unpersist()


def _exceptions(sample: DataFrame, lexicon: Lexicon, min_support: int = 3, max_phrases: int = 5_000) -> tuple[str, ...]:
    """Two-word phrases around hits that occur in clean training documents only."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds, own = _Folds(), lexicon.automaton()
        for batch in batches:
            found, label = [], []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text, seen = folded(text, folds), set()
                for start, _, _ in _hits(text, own):
                    end = text.index(" ", start + 1)
                    before, after = text.rfind(" ", 0, start) if start else -1, text.find(" ", end + 1)
                    if before >= 0:
                        seen.add(text[before:end + 1])
                    if after >= 0:
                        seen.add(text[start:after + 1])
                found += seen
                label += [int(y == 1)] * len(seen)
            yield pa.record_batch([pa.array(found, pa.string()), pa.array(label, pa.int32())], names=["phrase", "label"])

    counted = sample.mapInArrow(phrases, "phrase string, label int").groupBy("phrase").agg(
        F.sum("label").alias("n1"), F.count(F.lit(1)).alias("n"))
    rows = counted.where((F.col("n1") == 0) & (F.col("n") >= min_support)).orderBy(F.col("n").desc(), "phrase").limit(max_phrases).collect()
    return tuple(r["phrase"] for r in rows)


def score(documents: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits for every row of `documents`."""
    shared = documents.sparkSession.sparkContext.broadcast((lexicon.weights, lexicon.exceptions, lexicon.model))  # bounded by max_terms

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, folds = Lexicon(*shared.value), _Folds()
        machine = own.automaton()
        for batch in batches:
            texts = [folded(t, folds) for t in batch.column(2).to_pylist()]
            x = np.hstack([_features(texts, machine), np.ones((len(texts), 1))])
            hits = [len(_hits(t, machine)) for t in texts]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sigmoid(x @ own.model), pa.float64()), pa.array(hits, pa.int64())],
                                  names=["doc_id", "held_out", "score", "n_hits"])

    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "text")
    return own.mapInArrow(judge, "doc_id bigint, held_out boolean, score double, n_hits bigint").select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "n_hits")
