"""Language identification in two steps: the family first, then the language within it.

Features are letter n-grams (orders 1 to `orders`) of the whole text: letters
are lower-cased, everything else is a gap, and n-grams are hashed to
2**`bits` numbers. A text is the vector of its n-gram shares, each divided by
the root of the n-gram's mean share, so that rare n-grams count.

Families are learned: languages are clustered by the likeness of their mean
vectors (complete linkage) into about the root of their number. One
linear support vector machine per family, against all others, picks the family;
inside it one machine per two languages votes, and the language with most votes
wins (ties: larger sum of margins, then the smaller name). All machines are
fitted by dual coordinate descent with the hinge loss, each in its own Spark task, on
at most `per_language` training documents of each language, those of the
smallest hashes; their whole texts count.

`score` is the probability of the predicted language, from the margins of the
family and of the votes.

Defined results: a text that is null or has no letter is "und" with score 0,
and so is every text if there is nothing to learn from; with one language
only, that is the answer, with score 1; a null doc_id counts as empty text in
the fold; repeated rows get a result each; empty tables give empty results.
Columns other than doc_id and text are not read when predicting.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyferry.llm.common import stored
from keyferry.llm.labelled import fold, sigmoid

FOLDS, HELD_OUT_FOLD = 3, 1
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1], np.uint32)


@dataclass(frozen=True)
class Settings:
    orders: int = 3
    bits: int = 16
    per_language: int = 2_000
    families: int | None = None  # by default the root of the number of languages, rounded up
    cost: float = 1.0
    epochs: int = 10
    max_model_bytes: int = 512 << 20  # of weights sent to every executor

    def __post_init__(self) -> None:
        if not 1 <= self.orders <= len(_FACTORS):
            raise ValueError(f"orders must be 1 to {len(_FACTORS)}")
        if self.per_language < 1:
            raise ValueError("per_language must be >= 1")


_FOLDED: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """code point -> its lower-case letter's code point, 0 if it is no letter."""
    if not _FOLDED:
        _FOLDED.append(np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint32))
    return _FOLDED[0]


def ngrams(text: str | None, settings: Settings, piece: int = 1 << 20) -> Iterator[np.ndarray]:
    """Feature numbers of a text, piece by piece; n-grams without a letter have none."""
    for start in range(0, len(text or ""), piece):
        own = text[max(0, start - settings.orders + 1):start + piece]  # n-grams that end in this piece
        skip = min(start, settings.orders - 1)
        letters = _folded()[np.frombuffer(own.encode("utf-32-le", "replace"), np.uint32)]
        if not letters.any():
            continue
        mixed, some = letters * _FACTORS[0], letters > 0
        yield (mixed[skip:][some[skip:]] * _FACTORS[1]) >> np.uint32(32 - settings.bits)
        for k in range(2, settings.orders + 1):
            if len(letters) < k:
                break
            mixed = ((mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * _FACTORS[k - 1]) + letters[k - 1:] * _FACTORS[0]
            some = some[:-1] | (letters[k - 1:] > 0)
            new = slice(max(0, skip - k + 1), None)
            yield (mixed[new][some[new]] * _FACTORS[1]) >> np.uint32(32 - settings.bits)


def _shares(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(1 << settings.bits)
    for part in ngrams(text, settings):
        counts += np.bincount(part, minlength=len(counts))
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at] / max(counts.sum(), 1)


def sample(documents: DataFrame, lang: str, teaches: Column, settings: Settings) -> DataFrame:
    """lang, nth, at, share: feature vectors of at most `per_language` documents of every language that teach.

    A bound on the hash first leaves a few times as many as wanted, whatever the
    size of the language, so no task sorts all of it.
    """
    rows = documents.where(teaches & F.col(lang).isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col("text"), F.xxhash64("doc_id", "text").alias("h"))
    # A row per language, as the model has: broadcast, or all texts of a language would go to one task.
    sizes = F.broadcast(stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-sizes"))
    few = F.expr(f"abs(h div 2) < 4611686018427387904D * least(1D, 4D * {settings.per_language} / n)")
    near = rows.join(sizes, "lang").where(few)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    chosen = near.withColumn("nth", first).where(F.col("nth") <= settings.per_language).select("lang", "nth", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_shares(t, settings) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([a for a, _ in found], pa.list_(pa.int32())),
                                   pa.array([s for _, s in found], pa.list_(pa.float64()))], names=["lang", "nth", "at", "share"])

    return stored(chosen.mapInArrow(vectors, "lang string, nth int, at array<int>, share array<double>"), "language-sample")


def families(means: dict[str, np.ndarray], wanted: int | None = None) -> list[list[str]]:
    """Languages in `wanted` families (by default the root of their number, rounded up).

    The two families whose least similar members are most alike join, again and again.
    """
    names = sorted(means)
    length = {n: max(1e-12, float(np.linalg.norm(means[n]))) for n in names}
    alike = {(a, b): float(means[a] @ means[b]) / (length[a] * length[b]) for a, b in combinations(names, 2)}
    found = [[n] for n in names]
    while len(found) > (wanted or math.isqrt(max(len(names) - 1, 0)) + 1):
        f, g = max(combinations(found, 2), key=lambda fg: min(alike[min(a, b), max(a, b)] for a in fg[0] for b in fg[1]))
        found = sorted([*(x for x in found if x is not f and x is not g), sorted(f + g)])
    return found


def hinge(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float, epochs: int) -> np.ndarray:
    """Weights, and the constant's last, of the linear machine on sparse rows, by dual coordinate descent.

    Both classes together weigh the same, whatever their number of rows.
    """
    rows = [(np.append(at, size), np.append(v, 1.0)) for at, v in rows]
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    bound, square = cost * 0.5 / share, np.array([v @ v for _, v in rows])
    w, alpha, order = np.zeros(size + 1), np.zeros(len(rows)), np.random.default_rng(11)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, v = rows[i]
            new = min(max(alpha[i] - (y[i] * (w[at] @ v) - 1) / square[i], 0.0), bound[i])
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y[i] * v
                moved = max(moved, abs(new - alpha[i]) / bound[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass(frozen=True)
class Model:
    settings: Settings
    families: list[list[str]]
    weights: np.ndarray  # a row per machine: families first (none if there is one family), then pairs
    pairs: list[list[tuple[int, int, int]]]  # per family: (machine, place of its first language, of its second)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for text in texts:
            total, n = np.zeros(len(self.weights)), 0
            for part in ngrams(text, self.settings):
                total += self.weights[:, part].sum(axis=1, dtype=np.float64) if len(self.weights) else 0.0
                n += len(part)
            name, score = self._choose(total / n + self.weights[:, -1]) if n and self.families else (UNKNOWN, 0.0)
            names.append(name)
            scores.append(score)
        return names, scores

    def _choose(self, margin: np.ndarray) -> tuple[str, float]:
        odds = sigmoid(2 * margin[:len(self.families)]) if len(self.families) > 1 else np.ones(1)
        which = int(np.argmax(odds))
        members, score = self.families[which], float(odds[which])
        votes, sums, least = np.zeros(len(members)), np.zeros(len(members)), np.ones(len(members))
        for machine, a, b in self.pairs[which]:
            m = margin[machine]
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
            least[a], least[b] = min(least[a], sigmoid(2 * m)), min(least[b], sigmoid(-2 * m))
        best = max(range(len(members)), key=lambda i: (votes[i], sums[i], -i))
        return members[best], min(1.0, score * float(least[best]))


def fit(documents: DataFrame, lang: str = "lang", teaches: Column | None = None, settings: Settings = Settings()) -> Model:
    """The model of the documents where `teaches` (by default those outside the held-out fold) and `lang` is not null."""
    size = 1 << settings.bits
    rows = sample(documents, lang, fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD if teaches is None else teaches, settings)
    # A language has one row here, of at most 2**bits features.
    sums = rows.select("lang", F.explode(F.arrays_zip("at", "share")).alias("f")).groupBy("lang", "f.at").agg(F.sum("f.share").alias("s"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = sums.toArrow()
    means = {name: np.zeros(size) for name in counts}
    for name, at, s in zip(table["lang"].to_pylist(), table["at"].to_numpy(), table["s"].to_numpy()):
        means[name][at] = s / counts[name]
    usual = np.mean(list(means.values()), axis=0) if means else np.zeros(size)
    scale = 1 / np.sqrt(usual + 1e-6)
    kin = families({name: m * scale for name, m in means.items()}, settings.families)
    machines = [(f, [o for g in kin if g is not f for o in g]) for f in kin] if len(kin) > 1 else []
    pairs = []
    for f in kin:
        pairs.append([(len(machines) + i, a, b) for i, (a, b) in enumerate(combinations(range(len(f)), 2))])
        machines += [((f[a],), [f[b]]) for _, a, b in pairs[-1]]
    if len(machines) * (size + 1) * 4 > settings.max_model_bytes:
        raise ValueError(f"{len(machines)} machines of {size} weights exceed max_model_bytes; choose fewer bits")
    weights = np.zeros((len(machines), size + 1), np.float32)
    if machines:
        # A side of a machine sees per_language documents, dealt evenly to its languages.
        sides = [(i, name, way, -(-settings.per_language // len(side)))
                 for i, fg in enumerate(machines) for way, side in zip((1, -1), fg) for name in side]
        named = documents.sparkSession.createDataFrame(sides, "machine int, lang string, side int, most int")

        def one(group: pd.DataFrame) -> pd.DataFrame:
            group = group.assign(order=[a.tobytes() for a in group["at"]]).sort_values(["lang", "order"])  # whatever order Spark gives
            vectors = [(at, v * scale[at]) for at, v in zip(group["at"], group["share"])]
            w = hinge(vectors, group["side"].to_numpy(float), size, settings.cost, settings.epochs)
            w[:-1] *= scale
            return pd.DataFrame({"machine": group["machine"].iloc[:1], "w": [w]})

        for r in rows.join(F.broadcast(named), "lang").where("nth <= most").groupBy("machine").applyInPandas(one, "machine int, w array<double>").toLocalIterator():
            weights[r["machine"]] = r["w"]
    return Model(settings, kin, weights, pairs)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of `documents`."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # at most max_model_bytes

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column(2).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    own = documents.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD).alias("held_out"), F.col("text").cast("string"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(judge, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
