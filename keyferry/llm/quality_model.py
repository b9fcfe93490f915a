"""Quality classifier: a linear SVM on n-gram indicators scaled by log-count ratios.

Indicators are hashed n-grams of words, of word shapes (runs of capitals, small
letters and digits become one character, other characters stay) and of the
text's own repetition (tenths of words that repeat the one before, of repeated
three-word windows and of repeated lines). Class counts of every indicator come
from all training rows and give its log-count ratio r; the SVM sees r in place
of 1 and is fitted by dual coordinate descent on a bounded sample of
`max_rows` training rows. A fifth of that sample is kept back to turn margins
into probabilities.

Defined results: null text is empty; an empty text has no indicators and gets
the probability of margin 0; without training rows of both classes every score
is the share of label 1 (0.5 without any). Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyferry.llm.labelled import fold, logistic, sigmoid, training_texts
from keyferry.llm.near_dup import mixed

BITS = 18
HELD_OUT_FOLD = 0
_RUN = re.compile(r"(.)\1+", re.S)


class _Words(dict):
    """word -> 32 bits of the lower-cased word's hash << 32 | 32 bits of its shape's hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        text = word.decode("utf-8", "replace")
        shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in text)
        shape = _RUN.sub(r"\1", shape)[:12]
        value = self[word] = (xxhash.xxh32_intdigest(text.lower()) << 32) | xxhash.xxh32_intdigest(shape, 1)
        return value


def _tenths(kind: int, part: int, whole: int) -> list[int]:
    """Indicators "at least k tenths" of one kind."""
    return [kind * 16 + k for k in range(11) if 10 * part >= k * max(whole, 1)]


def indicators(text: bytes | None, known: _Words) -> np.ndarray:
    """Sorted distinct indicator numbers below 2**BITS."""
    words = (text or b"").split()
    n = len(words)
    if not n:
        return np.empty(0, np.int32)
    both = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    parts = [mixed(word + np.uint64(1 << 40)), mixed(shape + np.uint64(2 << 40))]
    again = 0
    if n > 1:
        parts.append(mixed(mixed(shape[:-1] + np.uint64(3 << 40)) + shape[1:]))
        again = int((word[:-1] == word[1:]).sum())
    repeated = 0
    if n > 2:
        windows = mixed(mixed(mixed(word[:-2]) + word[1:-1]) + word[2:])
        repeated = len(windows) - len(np.unique(windows))
    lines = [x for x in (text or b"").split(b"\n") if x.strip()]
    own = _tenths(1, again, n) + _tenths(2, repeated, max(n - 2, 1)) + _tenths(3, len(lines) - len(set(lines)), len(lines))
    parts.append(mixed(np.array(own, np.uint64) + np.uint64(5 << 40)))
    return np.unique(np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each indicator, by class, of one partition; the last number counts documents."""
    known, counts = _Words(), np.zeros((2, (1 << BITS) + 1), np.int64)
    for batch in batches:
        for text, label in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            own = counts[1 if label == 1 else 0]
            own[indicators(text, known)] += 1
            own[-1] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(counts[0][at]), pa.array(counts[1][at])], names=["i", "n0", "n1"])


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Words()
    for batch in batches:
        rows = [indicators(t, known) for t in batch.column(0).cast(pa.binary()).to_pylist()]
        yield pa.record_batch([batch.column(1).cast(pa.int32()), pa.array(rows, pa.list_(pa.int32()))], names=["label", "at"])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # r * w per indicator
    slope: float
    offset: float

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        margins = np.array([self.weights[r].sum() / np.sqrt(len(r)) if len(r) else 0.0 for r in rows])
        return sigmoid(self.slope * margins + self.offset)


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: np.ndarray,
                            epochs: int = 8, seed: int = 7) -> np.ndarray:
    """Weights of the hinge-loss SVM on rows of ratio[indices], each of length 1 / sqrt(count)."""
    w, alpha = np.zeros(len(ratio)), np.zeros(len(rows))
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    square = np.array([v @ v for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            if square[i] > 0:
                gradient = y[i] * (w[rows[i]] @ values[i]) - 1
                new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
                if new != alpha[i]:
                    w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                    alpha[i] = new
    return w


def fit(documents: DataFrame, labels: DataFrame, column: str = "quality", max_rows: int = 20_000) -> Model:
    counted = training_texts(documents, labels, column, HELD_OUT_FOLD, None).mapInArrow(_count, "i int, n0 bigint, n1 bigint")
    # 2**BITS + 1 rows at most.
    table = counted.groupBy("i").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    counts = np.zeros((2, (1 << BITS) + 1))
    counts[:, table["i"].to_numpy()] = np.stack([table["n0"].to_numpy(), table["n1"].to_numpy()])
    docs = counts[:, -1]
    none = np.zeros(1 << BITS)
    if not docs.all():
        share = docs[1] / docs.sum() if docs.sum() else 0.5
        return Model(none, 0.0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    p, q = 1 + counts[1, :-1], 1 + counts[0, :-1]
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    # At most max_rows rows of indicator numbers.
    sample = training_texts(documents, labels, column, HELD_OUT_FOLD, max_rows).mapInArrow(_sample, "label int, at array<int>").toArrow()
    rows = [r.values.to_numpy(zero_copy_only=False) for r in sample["at"]]
    y = np.where(sample["label"].to_numpy() == 1, 1.0, -1.0)
    order = sorted(range(len(rows)), key=lambda i: (y[i], rows[i].tobytes()))  # whatever order Spark returned
    rows, y = [rows[i] for i in order], y[order]
    kept_back = np.arange(len(y)) % 5 == 4
    if len(set(y[~kept_back])) < 2:
        kept_back[:] = False
    fitted = np.flatnonzero(~kept_back)
    share = np.where(y[fitted] > 0, (y[fitted] > 0).mean(), (y[fitted] < 0).mean())
    w = dual_coordinate_descent([rows[i] for i in fitted], ratio, y[fitted], 0.5 / share)
    model = Model(ratio * w, 1.0, 0.0)
    judged = np.flatnonzero(kept_back) if kept_back.any() else fitted
    margins = np.array([model.weights[rows[i]].sum() / np.sqrt(max(len(rows[i]), 1)) for i in judged])
    slope, offset = logistic(margins[:, None], (y[judged] > 0).astype(float))
    return Model(ratio * w, float(slope), float(offset))


def score(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `documents`."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            rows = [indicators(t, known) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(shared.value.scores(rows), pa.float64())],
                                  names=["doc_id", "held_out", "score"])

    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "text")
    return own.mapInArrow(judge, "doc_id bigint, held_out boolean, score double").withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
