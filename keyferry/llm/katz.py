"""Language-model scoring: a Katz backoff bigram model over whole texts.

Training documents give word and word-pair counts. Counts up to `MOST` are
discounted after Good and Turing; what the discount frees under a context is
given to the words not seen there, in proportion to their word probabilities,
by a weight that makes every context sum to exactly one. Unknown words are one
word of the vocabulary, with the mass the word counts free. Scoring recurses
per token: pair, else backoff weight and word, else unknown word.

Count tables are partitioned into buckets of a bounded number of keys: words by
hash, pairs by their context. Blocks of documents send their distinct words and
pairs with their training counts; a bucket sums them, keeps its part of the
table and answers with what scoring needs (see blocks.py). Contexts that hold
more than 1 / HOT of all tokens are spread over all buckets by the whole pair,
and their sums are combined afterwards, so no bucket is hot. From 4 * 10**10
tokens on, a context is hot from HOT_MOST tokens, so that what one task gathers
stays bounded; the sums of hot contexts, a few numbers each, are then at most
tokens / HOT_MOST rows.

Words get dense numbers from their place in the bucket, so a pair is one packed
number and pair counts are exact (two words share a 64-bit hash with a chance
of 2**-64).

Defined results: null text is empty and is one end token; documents without a
doc_id count as id '' for the split; without training tokens every token is
unknown with probability 1 (score 0). Where a context has no count that is
discounted, or no word count is, half a count is added to its total and given
to the unseen. Repeated rows count each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyferry.llm.blocks import (
    MESSAGE, BlockTable, Numbers, ask, dealt, expand, expand_keys, join_parts, messages, split_parts, squeeze, squeeze_keys,
)
from keyferry.llm.common import stored
from keyferry.llm.labelled import fold
from keyferry.llm.near_dup import WordHashes, mixed

MOST = 5  # counts above this are not discounted
HOT = 2_000
HOT_MOST = 20_000_000  # tokens under one context that one task may gather, whatever the corpus
BLOCK_TOKENS = 1_000_000
BUCKET_KEYS = 2_000_000
TEST_FOLD = 1
_END = np.uint64(0xFFFFFFFFFFFFFFFF)
_UNKNOWN = 0xFFFFFFFF
_TABLE, _TOTALS = -1, -2  # block numbers of a bucket's part of the table, and of its totals


def good_turing(times: np.ndarray) -> np.ndarray:
    """Discounts d[0..MOST] (d[0] = 1) from times[r], the number of things seen r times (r up to MOST + 1).

    Katz's form on the counts of counts; where copies in the corpus make those
    irregular, on their log-linear fit; where that fails too, 1 - 0.5 / r.
    """
    r = np.arange(1, MOST + 2)
    raw = times[1:MOST + 2].astype(float)
    tries = [raw] if (raw > 0).all() else []
    if (raw > 0).sum() >= 2:
        slope, level = np.polyfit(np.log(r[raw > 0]), np.log(raw[raw > 0]), 1)
        tries.append(np.exp(level + slope * np.log(r)))
    for n in tries:
        tail = (MOST + 1) * n[MOST] / n[0]
        if tail < 1:
            found = (r[1:] * n[1:] / (r[:-1] * n[:-1]) - tail) / (1 - tail)
            if ((found > 0) & (found < 1)).all():
                return np.concatenate([[1.0], found])
    return np.concatenate([[1.0], 1 - 0.5 / r[:-1]])


class Words:
    """Word probabilities from counts."""

    def __init__(self, tokens: int, times: np.ndarray) -> None:
        self.discount = good_turing(times)
        r = np.arange(MOST + 1)
        freed = float(((1 - self.discount) * r * times[:MOST + 1]).sum())
        self.total = tokens if freed > 0 else tokens + 0.5
        self.unknown = (freed if freed > 0 else 0.5) / self.total

    def probability(self, count: np.ndarray) -> np.ndarray:
        d = self.discount[np.where(count <= MOST, count, 0)]
        return np.where(count > 0, d * count / self.total, self.unknown)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, known, held = Numbers(), WordHashes(), []
    ids, outs, size = [], [], 0

    def block() -> pa.RecordBatch:
        sizes = np.array([len(t) for t in held])
        words, tokens = np.unique(np.concatenate(held), return_inverse=True)
        taught = np.bincount(tokens[np.repeat(~np.array(outs, bool), sizes)], minlength=len(words))
        return pa.record_batch([
            pa.array([numbers.take()], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([outs], pa.list_(pa.bool_())),
            pa.array([sizes], pa.list_(pa.int64())), pa.array([squeeze_keys(words)], pa.binary()),
            pa.array([squeeze(taught.astype(np.uint32))], pa.binary()), pa.array([squeeze(tokens.astype(np.uint32))], pa.binary()),
        ], names=["block", "ids", "outs", "sizes", "words", "taught", "tokens"])

    for batch in batches:
        for i, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
            words = (text or b"").lower().split()  # bytes: ASCII letters, ASCII white space
            hashes = np.empty(len(words) + 1, np.uint64)
            hashes[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            hashes[-1] = _END
            held.append(hashes)
            ids.append(i)
            outs.append(out)
            size += len(hashes)
            if size >= BLOCK_TOKENS:
                yield block()
                held, ids, outs, size = [], [], [], 0
    if ids:
        yield block()


_BLOCK = "block bigint, ids array<bigint>, outs array<boolean>, sizes array<bigint>, words binary, taught binary, tokens binary"


def _ask_words(buckets: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    words, taught, lo = expand_keys(row["words"]), expand(row["taught"]), 0
                    for b, part in dealt(words, buckets):
                        yield b, row["block"], join_parts([squeeze_keys(part), squeeze(taught[lo:lo + len(part)])])
                        lo += len(part)
        yield from messages(rows())
    return go


def _times(counts: np.ndarray) -> np.ndarray:
    """Number of things seen r times, for r up to MOST + 1 (0 for r = 0)."""
    return np.bincount(counts[(counts > 0) & (counts <= MOST + 1)], minlength=MOST + 2)


def _out(bucket: int, rows: list[tuple[int, bytes]]) -> pd.DataFrame:
    return pd.DataFrame({"bucket": bucket, "block": [r[0] for r in rows], "payload": [r[1] for r in rows]})


def _answer_words(frame: pd.DataFrame) -> pd.DataFrame:
    parts = [split_parts(p) for p in frame.payload]
    keys = [expand_keys(p[0]) for p in parts]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, at, np.concatenate([expand(p[1]) for p in parts]).astype(np.int64))
    seen = total > 0
    place = np.where(seen, np.cumsum(seen) - 1, -1)
    ends = np.cumsum([len(k) for k in keys])[:-1]
    rows = [(b, join_parts([squeeze(place[a]), squeeze(total[a])])) for b, a in zip(frame.block, np.split(at, ends))]
    rows.append((_TABLE, join_parts([squeeze_keys(distinct[seen]), squeeze(total[seen])])))
    rows.append((_TOTALS, np.array([seen.sum(), total.sum(), *_times(total)], np.int64).tobytes()))
    return _out(int(frame.bucket.iloc[0]), rows)


def _totals(answers: DataFrame) -> dict[int, np.ndarray]:
    """A few numbers per bucket."""
    return {r["bucket"]: np.frombuffer(bytes(r["payload"]), np.int64) for r in answers.where(F.col("block") == _TOTALS).collect()}


class _Block:
    """Tokens of a block with what the word table says about them."""

    def __init__(self, row: dict, starts: dict[int, int]) -> None:
        self.row, self.sizes = row, np.array(row["sizes"])
        number, count = [], []
        for part in row["a0"]:
            place, total = map(expand, split_parts(part["payload"]))
            number.append(np.where(place >= 0, place + starts[part["bucket"]], -1))
            count.append(total)
        self.number, self.count = np.concatenate(number), np.concatenate(count)
        self.tokens = expand(row["tokens"]).astype(np.int64)
        # Every document ends in the end token, which is also the context of the next one's first.
        before = np.concatenate([[len(self.number) - 1], self.tokens[:-1]])
        self.context = self.number[before]
        self.context_count = self.count[before]
        word = np.where(self.number >= 0, self.number, _UNKNOWN)[self.tokens]
        self.known = np.flatnonzero(self.context >= 0)
        pair = (self.context[self.known].astype(np.uint64) << np.uint64(32)) | word[self.known].astype(np.uint64)
        self.pairs, self.first, self.at = np.unique(pair, return_index=True, return_inverse=True)

    def dealt(self, buckets: int, hot_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the pairs by bucket, the buckets in that order, and which pairs have a hot context."""
        hot = self.context_count[self.known[self.first]] >= hot_count
        bucket = (mixed(np.where(hot, self.pairs, self.pairs >> np.uint64(32)) + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order], hot


def _ask_pairs(starts: dict[int, int], buckets: int, hot_count: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    block = _Block(row, starts)
                    teaches = np.repeat(~np.array(row["outs"], bool), block.sizes)[block.known]
                    taught = np.bincount(block.at[teaches], minlength=len(block.pairs))
                    # The word's own count goes along where the pair is seen: its bucket sums word probabilities.
                    own = np.where(taught > 0, block.count[block.tokens[block.known[block.first]]], 0)
                    order, bucket, hot = block.dealt(buckets, hot_count)
                    for lo, hi in _runs(bucket):
                        part = order[lo:hi]
                        hot_contexts = np.unique(block.pairs[part[hot[part]]] >> np.uint64(32))
                        yield int(bucket[lo]), row["block"], join_parts([
                            squeeze_keys(block.pairs[part]), squeeze(taught[part].astype(np.uint32)), squeeze(own[part]),
                            squeeze_keys(hot_contexts)])
        yield from messages(rows())
    return go


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal neighbours."""
    if not len(values):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return list(zip(cuts[:-1], cuts[1:]))


def _answer_pairs(words: Words):
    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [split_parts(p) for p in frame.payload]
        keys = [expand_keys(p[0]) for p in parts]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total, own = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        np.add.at(total, at, np.concatenate([expand(p[1]) for p in parts]).astype(np.int64))
        np.maximum.at(own, at, np.concatenate([expand(p[2]) for p in parts]))
        context = distinct >> np.uint64(32)
        contexts, starts = np.unique(context, return_index=True)
        # Per context: how many pairs are seen 1 .. MOST times, and the word probability of all that are seen.
        few = np.stack([np.add.reduceat((total == r).astype(np.int64), starts) for r in range(1, MOST + 1)])
        mass = np.add.reduceat(np.where(total > 0, words.probability(own), 0.0), starts)
        rows, ends = [], np.cumsum([len(k) for k in keys])[:-1]
        for b, k, a in zip(frame.block, keys, np.split(at, ends)):
            c = np.searchsorted(contexts, np.unique(k >> np.uint64(32)))
            rows.append((b, join_parts([squeeze(total[a].astype(np.uint32)), squeeze(few[:, c].astype(np.uint32).reshape(-1)), squeeze(mass[c])])))
        hot = np.unique(np.concatenate([expand_keys(p[3]) for p in parts]))
        c = np.searchsorted(contexts, hot)
        rows.append((_TABLE, join_parts([squeeze_keys(hot), squeeze(few[:, c].reshape(-1)), squeeze(mass[c])])))
        rows.append((_TOTALS, _times(total).astype(np.int64).tobytes()))
        return _out(int(frame.bucket.iloc[0]), rows)
    return answer


def _hot_contexts(answers: DataFrame) -> dict[int, tuple[np.ndarray, float]]:
    """Sums over all buckets of the hot contexts, of which there are at most HOT."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                contexts, few, mass = split_parts(payload)
                n = expand_keys(contexts).astype(np.int64)
                yield pa.record_batch([pa.array(n), pa.array(list(expand(few).reshape(MOST, -1).T), pa.list_(pa.int64())), pa.array(expand(mass))],
                                      names=["context", "few", "mass"])

    parts = answers.where(F.col("block") == _TABLE).select("payload").mapInArrow(go, "context bigint, few array<bigint>, mass double")
    sums = parts.groupBy("context").agg(*[F.sum(F.get("few", F.lit(r))).alias(f"n{r}") for r in range(MOST)], F.sum("mass").alias("mass"))
    return {r["context"]: (np.array([r[f"n{i}"] for i in range(MOST)]), r["mass"]) for r in sums.collect()}


def _scorer(starts: dict[int, int], words: Words, discount: np.ndarray, hot: dict, buckets: int, hot_count: int, tokens: int, vocabulary: int):
    def score(row: dict) -> pa.RecordBatch:
        block = _Block(row, starts)
        order, bucket, _ = block.dealt(buckets, hot_count)
        answers = {p["bucket"]: p["payload"] for p in row["a1"] or ()}
        total = np.zeros(len(block.pairs), np.int64)
        seen_few, mass = np.zeros((MOST, len(block.pairs))), np.zeros(len(block.pairs))
        for lo, hi in _runs(bucket):
            part = order[lo:hi]
            t, f, m = map(expand, split_parts(answers[int(bucket[lo])]))
            contexts, at = np.unique(block.pairs[part] >> np.uint64(32), return_inverse=True)
            total[part] = t
            seen_few[:, part] = f.reshape(MOST, -1)[:, at]
            mass[part] = m[at]
        for context, (few, m) in hot.items():
            lo, hi = np.searchsorted(block.pairs, (np.uint64(context << 32), np.uint64((context + 1) << 32)))
            seen_few[:, lo:hi], mass[lo:hi] = few[:, None], m
        # Per pair: what the discounts free under its context, and the probability of its word.
        context_count = block.context_count[block.known[block.first]]
        freed = ((1 - discount[1:]) * np.arange(1, MOST + 1)) @ seen_few
        whole = np.where(freed > 0, context_count, context_count + 0.5)
        weight = np.where(freed > 0, freed, 0.5) / whole / np.maximum(1 - mass, 1e-12)
        plain = words.probability(block.count)[block.tokens]
        pair = np.where(total > 0, discount[np.where(total <= MOST, total, 0)] * total / whole, weight * plain[block.known[block.first]])
        probability = plain.copy()
        probability[block.known] = pair[block.at]
        count = block.count[block.tokens]
        base = np.log10((count + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
        ends = np.concatenate([[0], np.cumsum(block.sizes)[:-1]])
        return pa.record_batch([
            pa.array(row["ids"], pa.int64()), pa.array(row["outs"], pa.bool_()), pa.array(block.sizes, pa.int64()),
            pa.array(np.add.reduceat((count > 0).astype(np.int64), ends)), pa.array(np.full(len(ends), tokens), pa.int64()),
            pa.array(np.add.reduceat(base, ends)), pa.array(np.add.reduceat(np.log10(probability), ends)),
        ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield score(row)
    return go


def score(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == TEST_FOLD).alias("held_out"), "text")
    blocks = BlockTable(source.mapInArrow(_gather, _BLOCK), "lm-blocks")
    try:
        size = blocks.read().select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
        word_buckets, pair_buckets = size // (4 * BUCKET_KEYS) + 1, size // BUCKET_KEYS + 1
        table = ask(blocks.read().select("block", "words", "taught").mapInArrow(_ask_words(word_buckets), MESSAGE), _answer_words, "lm-words")
        totals = _totals(table)
        starts, vocabulary, tokens, times = {}, 0, 0, np.zeros(MOST + 2, np.int64)
        for b in sorted(totals):
            starts[b] = vocabulary
            vocabulary, tokens, times = vocabulary + int(totals[b][0]), tokens + int(totals[b][1]), times + totals[b][2:]
        if vocabulary >= _UNKNOWN:
            raise ValueError("more distinct words than 32 bits number")
        words, hot_count = Words(tokens, times), min(tokens // HOT + 1, HOT_MOST)
        word_answers = table.where("block >= 0")

        asked = blocks.answered(word_answers).mapInArrow(_ask_pairs(starts, pair_buckets, hot_count), MESSAGE)
        pairs = ask(asked, _answer_pairs(words), "lm-pairs")
        discount = good_turing(sum(_totals(pairs).values(), np.zeros(MOST + 2, np.int64)))
        scorer = _scorer(starts, words, discount, _hot_contexts(pairs), pair_buckets, hot_count, tokens, vocabulary)
        return stored(blocks.answered(word_answers, pairs.where("block >= 0")).mapInArrow(
            scorer, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"), "lm-scores")
    finally:
        blocks.drop()
