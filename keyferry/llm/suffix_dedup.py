"""Removal of repeated byte strings: difference-cover sample, then one suffix bucket at a time.

A byte goes if a string of `length` bytes that covers it also starts anywhere
else. Suffixes need to be told apart to that depth only. The cover D modulo v
has, for any two positions i and j, a shift d < v with i + d and j + d both in
the sample, so two equal strings of `length` bytes agree on a sample string of
length - v + 1 bytes that starts inside their first v bytes. Hence:

1. The sample strings (about 9 % of all positions) are ranked as unique or
   repeated. A suffix none of whose sample strings is repeated is tied with no
   other to the full depth and is done.
2. The other suffixes are dealt into buckets by the fingerprint of their first
   `length` bytes; one bucket is sorted at a time, and neighbours may tie.
3. The suffixes that may tie are dealt and sorted once more, by a second
   fingerprint over prime fields, and those that tie again are repeats.

A bucket holds a bounded number of keys, whatever the input. Suffixes are
sorted by fingerprint and not by letter, which keeps the ties and is all that
removal needs. The first fingerprint alone would give n**2 / 2**64 false ties
among n suffixes, some at 30 GB; a false tie now has to pass both, of 64 and
62 bits. Equal whole texts are found first, by 64 bits over n texts, and only
one of them takes part in steps 2 and 3.

Shorter passages stay, but are reported: `n_shared` counts the bytes in strings of
`SHARED` bytes that another row of the table has as well, looked up at anchors. An
anchor is the place of the smallest hash in a window of `WINDOW` places, so equal
passages have equal anchors wherever they stand, and a passage of SHARED +
WINDOW + 7 bytes that two rows share holds at least one whole string.

Defined results: null text is empty; texts shorter than `length` keep all
bytes; equal rows repeat each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyferry.llm.blocks import MESSAGE, BlockTable, Numbers, ask, dealt, expand, expand_keys, messages, squeeze, squeeze_keys
from keyferry.llm.common import stored
from keyferry.llm.near_dup import mixed

BLOCK_BYTES = 4 << 20  # text of a block
BUCKET_KEYS = 2_000_000  # keys of a bucket, about
CHUNK = 1 << 20  # bytes hashed at once
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_EVERY_TEXT = -1  # bucket numbers below 0 are of whole texts
_ANCHORS = 1 << 28  # and from here on of strings at anchors
SHARED = 150  # bytes of such a string
WINDOW = 96


def difference_cover(r: int) -> tuple[np.ndarray, int]:
    """A cover of all differences modulo v = 24 r^2 + 36 r + 13 with 6 r + 4 members (a published construction)."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return np.cumsum([0, *steps]), 24 * r * r + 36 * r + 13


def _powers(base: int) -> np.ndarray:
    out = np.empty(CHUNK, np.uint64)
    out[0] = 1
    n = 1
    while n < CHUNK:
        out[n:2 * n] = out[:min(n, CHUNK - n)] * np.uint64(pow(base, n, 1 << 64))
        n *= 2
    return out


class Hasher:
    """Fingerprints of the strings of `length` bytes at given positions of a text."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))

    def at(self, data: np.ndarray, where: np.ndarray, length: int) -> np.ndarray:
        out, step = np.empty(len(where), np.uint64), CHUNK - length - 1
        for lo in range(0, len(data), step):
            a, b = np.searchsorted(where, (lo, lo + step))
            if a < b:
                part = data[lo:lo + step + length]
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(_TABLE[part] * self.up[:len(part)], out=sums[1:])
                own = where[a:b] - lo
                out[a:b] = mixed((sums[own + length] - sums[own]) * self.down[own])
        return out


class SecondHasher:
    """Other fingerprints of the same strings, by polynomials over two prime fields, so independent of the first."""

    primes = (2**31 - 1, 2**31 - 19)
    bases = (1_183_186_591, 1_622_650_073)

    def __init__(self) -> None:
        self.fields = []
        for k, (p, base) in enumerate(zip(self.primes, self.bases)):
            table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(k + 1)) % np.uint64(p)
            self.fields.append((np.uint64(p), table, self._powers(base, p), self._powers(pow(base, -1, p), p)))

    @staticmethod
    def _powers(base: int, p: int) -> np.ndarray:
        out = np.empty(CHUNK, np.uint64)
        out[0] = 1
        n = 1
        while n < CHUNK:
            out[n:2 * n] = out[:min(n, CHUNK - n)] * np.uint64(pow(base, n, p)) % np.uint64(p)
            n *= 2
        return out

    def at(self, data: np.ndarray, where: np.ndarray, length: int) -> np.ndarray:
        out, step = np.empty(len(where), np.uint64), CHUNK - length - 1
        for lo in range(0, len(data), step):
            a, b = np.searchsorted(where, (lo, lo + step))
            if a < b:
                part, own, both = data[lo:lo + step + length], where[a:b] - lo, np.zeros(b - a, np.uint64)
                for p, table, up, down in self.fields:
                    sums = np.zeros(len(part) + 1, np.uint64)  # below 2**20 terms of 31 bits
                    np.cumsum(table[part] * up[:len(part)] % p, out=sums[1:])
                    both = both << np.uint64(32) | (sums[own + length] - sums[own]) % p * down[own] % p
                out[a:b] = mixed(both)
        return out


def anchors(data: np.ndarray) -> np.ndarray:
    """Places of the smallest hash of eight bytes, the first of equal ones, in every window of WINDOW places."""
    found, step = [], CHUNK
    for lo in range(0, max(len(data) - SHARED + 1, 0), step):
        part = data[lo:lo + step + WINDOW + 7]
        n = len(part) - 7
        grams = np.empty((n // 8 + 1) * 8, np.uint64).reshape(-1, 8)
        padded = np.zeros(len(grams) * 8 + 8, np.uint8)
        padded[:len(part)] = part
        for k in range(8):
            grams[:, k] = padded[k:k + 8 * len(grams)].view("<u8")
        rank = grams.reshape(-1)[:n] * np.uint64(_BASE) >> np.uint64(32) << np.uint64(32) | np.arange(n, dtype=np.uint64)
        # Running minima from both ends of blocks of WINDOW places give that of any window.
        last = np.uint64(0xFFFFFFFFFFFFFFFF)
        blocks = np.concatenate([rank, np.full(-n % WINDOW, last)]).reshape(-1, WINDOW)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(behind[:n - WINDOW + 1], ahead[WINDOW - 1:n]) if n >= WINDOW else np.array([rank.min()])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        found.append(lo + place[np.concatenate([[True], np.diff(place) > 0])])
    at = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return at[at <= len(data) - SHARED]


class Plan:
    """Positions to ask about, for strings of `length` bytes."""

    def __init__(self, length: int) -> None:
        self.length = length
        r = 1
        while difference_cover(r + 1)[1] * 2 <= length:
            r += 1
        self.cover, self.v = difference_cover(r)
        if self.v >= length:
            self.cover, self.v = np.array([0]), 1
        self.depth = length - self.v + 1

    def sample(self, n: int) -> np.ndarray:
        """Sample positions whose string of `depth` bytes fits into a text of n bytes."""
        starts = np.arange(0, max(n - self.depth + 1, 0), self.v)
        at = (starts[:, None] + self.cover[None, :]).reshape(-1)
        return at[at <= n - self.depth] if n >= self.length else at[:0]

    def suffixes(self, n: int, repeated: np.ndarray) -> np.ndarray:
        """Starts of strings of `length` bytes that hold one of the `repeated` sample strings near their start."""
        marks = np.zeros(n + 1, np.int32)
        np.add.at(marks, np.maximum(repeated - self.v + 1, 0), 1)
        np.add.at(marks, repeated + 1, -1)
        return np.flatnonzero(np.cumsum(marks[:max(n - self.length + 1, 0)]) > 0)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, ids, texts, size = Numbers(), [], [], 0

    def block() -> pa.RecordBatch:
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        return pa.record_batch([pa.array([numbers.take()], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                               names=["block", "ids", "sizes", "data"])

    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            ids.append(i)
            texts.append(t or b"")
            size += len(texts[-1])
            if size >= BLOCK_BYTES or len(ids) >= 50_000:
                yield block()
                ids, texts, size = [], [], 0
    if ids:
        yield block()


class _Block:
    """One row of the block table, and what it asks."""

    def __init__(self, row: dict, plan: Plan, hasher: Hasher) -> None:
        self.number, self.ids, self.plan, self.hasher = row["block"], row["ids"], plan, hasher
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), np.uint8) if sum(row["sizes"]) else np.empty(0, np.uint8)
        self.texts = np.split(data, np.cumsum(row["sizes"])[:-1])

    def ask_samples(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Positions per text, and all their fingerprints (48 bits; chance ties only add work)."""
        where = [self.plan.sample(len(t)) for t in self.texts]
        keys = [self.hasher.at(t, w, self.plan.depth) for t, w in zip(self.texts, where)]
        return where, np.concatenate(keys) & ~np.uint64(0xFFFF)

    def text_keys(self) -> np.ndarray:
        """A fingerprint per text; 0 for texts too short to lose bytes."""
        return np.array([int.from_bytes(hashlib.blake2b(t.tobytes(), digest_size=8).digest(), "big") if len(t) >= self.plan.length else 0
                         for t in self.texts], np.uint64)

    def ask_anchors(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Anchors per text, and the fingerprints of their strings."""
        where = [anchors(t) for t in self.texts]
        return where, np.concatenate([self.hasher.at(t, w, SHARED) for t, w in zip(self.texts, where)])

    def shared(self, answer: np.ndarray) -> np.ndarray:
        """Per text: bytes in strings at anchors that another row has."""
        where, keys = self.ask_anchors()
        owner = np.repeat(np.arange(len(where)), [len(w) for w in where])
        distinct, at = np.unique(keys, return_inverse=True)
        first, last = np.full(len(distinct), len(where)), np.full(len(distinct), -1)
        np.minimum.at(first, at, owner)
        np.maximum.at(last, at, owner)
        elsewhere = ((answer > 0) | (first < last))[at] if len(keys) else np.empty(0, bool)
        out, lo = np.zeros(len(where), np.int64), 0
        for k, w in enumerate(where):
            hit = w[elsewhere[lo:lo + len(w)]]
            lo += len(w)
            if len(hit):
                out[k] = SHARED + np.minimum(np.diff(hit), SHARED).sum()
        return out

    def ask_suffixes(self, samples: np.ndarray, texts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The same for suffixes, given the answers on samples and whole texts."""
        where, keys = self.ask_samples()
        distinct, at, times = np.unique(keys, return_inverse=True, return_counts=True)
        repeated = ((samples > 0) | (times > 1))[at]
        whole = self.copies(texts)[1]
        starts, out, lo = [], [], 0
        for t, w, gone in zip(self.texts, where, whole):
            own = repeated[lo:lo + len(w)]
            lo += len(w)
            at = self.plan.suffixes(len(t), w[own]) if not gone else np.empty(0, np.int64)
            starts.append(at)
            out.append(self.hasher.at(t, at, self.plan.length))
        return starts, np.concatenate(out)

    def ask_again(self, samples: np.ndarray, texts: np.ndarray, ties: np.ndarray,
                  second: SecondHasher) -> tuple[list[np.ndarray], np.ndarray]:
        """The suffixes that tie by the first fingerprint, and their second ones."""
        starts, keys = self.ask_suffixes(samples, texts)
        tied, lo, out = _repeated(keys, ties), 0, []
        for k, (t, w) in enumerate(zip(self.texts, starts)):
            starts[k] = w[tied[lo:lo + len(w)]]
            lo += len(w)
            out.append(second.at(t, starts[k], self.plan.length))
        return starts, np.concatenate(out)

    def copies(self, answer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text: whether an equal one exists, and whether an earlier one does."""
        keys = self.text_keys()
        distinct, first, at, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        long = keys > 0
        equal = long & (((answer & 1) > 0) | (times > 1))[at]
        later = long & (((answer & 2) > 0)[at] | (np.arange(len(keys)) != first[at]))
        return equal, later


def _first_questions(plan: Plan, buckets: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()

        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    block = _Block(row, plan, hasher)
                    for kind, keys in ((0, block.ask_samples()[1]), (1, block.text_keys()), (2, block.ask_anchors()[1])):
                        yield from _dealt(np.unique(keys), buckets, block.number, kind)
        yield from messages(rows())
    return go


def _dealt(keys: np.ndarray, buckets: int, block: int, kind: int = 0):
    for b, part in dealt(keys, buckets):
        yield (b, _EVERY_TEXT - b, _ANCHORS + b)[kind], block, squeeze_keys(part)


def _second_questions(plan: Plan, first_buckets: int, buckets: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()

        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    block = _Block(row, plan, hasher)
                    yield from _dealt(np.unique(block.ask_suffixes(*_answers(row["a0"]))[1]), buckets, block.number)
        yield from messages(rows())
    return go


def _third_questions(plan: Plan, buckets: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, second = Hasher(), SecondHasher()

        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    block = _Block(row, plan, hasher)
                    keys = block.ask_again(*_answers(row["a0"]), _answers(row["a1"])[0], second)[1]
                    yield from _dealt(np.unique(keys), buckets, block.number)
        yield from messages(rows())
    return go


def _repeated(keys: np.ndarray, answer: np.ndarray) -> np.ndarray:
    """Whether a key occurs again, in its block or by the answer in another one."""
    distinct, at, times = np.unique(keys, return_inverse=True, return_counts=True)
    return ((answer > 0) | (times > 1))[at] if len(keys) else np.empty(0, bool)


def _anchor_answers(parts: list[dict] | None) -> np.ndarray:
    """Answers on strings at anchors, in key order."""
    return np.concatenate([np.empty(0, np.uint8), *[expand(p["payload"]) for p in parts or [] if p["bucket"] >= _ANCHORS]])


def _answers(parts: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Answers on keys and on whole texts, each in key order."""
    parts = parts or []
    own = [expand(p["payload"]) for p in parts if 0 <= p["bucket"] < _ANCHORS]
    whole = [expand(p["payload"]) for p in sorted(parts, key=lambda p: -p["bucket"]) if p["bucket"] < 0]
    none = np.empty(0, np.uint8)
    return np.concatenate([none, *own]), np.concatenate([none, *whole])


def _ties(frame: pd.DataFrame) -> pd.DataFrame:
    """Sort one bucket. Per key: 1 if another block has it, plus 2 if a block of a lower number does."""
    frame = frame.sort_values("block")
    keys = [expand_keys(p) for p in frame.payload]
    every = np.concatenate(keys)
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    answer = np.zeros(len(every), np.uint8)
    answer[order[1:]] |= same.astype(np.uint8) * 3
    answer[order[:-1]] |= same
    ends = np.cumsum(np.bincount(owner, minlength=len(keys)))
    return pd.DataFrame({"bucket": frame.bucket.to_numpy(), "block": frame.block.to_numpy(),
                         "payload": [squeeze(a) for a in np.split(answer, ends[:-1])]})


def _removal(plan: Plan, keep_bytes: bool):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, second = Hasher(), SecondHasher()
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row, plan, hasher)
                samples, texts = _answers(row["a0"])
                starts, keys = block.ask_again(samples, texts, _answers(row["a1"])[0], second)
                repeated = _repeated(keys, _answers(row["a2"])[0])
                equal, lo, out = block.copies(texts)[0], 0, []
                for t, w, gone, common in zip(block.texts, starts, equal, block.shared(_anchor_answers(row["a0"])).tolist()):
                    hit = w[repeated[lo:lo + len(w)]]
                    lo += len(w)
                    marks = np.zeros(len(t) + 1, np.int32)
                    if gone:
                        marks[0], marks[-1] = 1, -1
                    marks[hit] += 1
                    marks[hit + plan.length] -= 1
                    covered = np.cumsum(marks[:-1]) > 0
                    kept = t[~covered].tobytes()
                    spans = int((covered & ~np.concatenate([[False], covered[:-1]])).sum()) if len(t) else 0
                    out.append((len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest(), common, kept if keep_bytes else None))
                cols = list(zip(*out))
                yield pa.record_batch([pa.array(block.ids, pa.int64()), *(pa.array(cols[i], pa.int64()) for i in range(3)),
                                       pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.binary())],
                                      names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared", "kept"])
    return go


def remove_repeats(documents: DataFrame, length: int = 400, keep_bytes: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared and, if asked for, the kept bytes."""
    plan = Plan(length)
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = BlockTable(source.mapInArrow(_gather, "block bigint, ids array<bigint>, sizes array<bigint>, data binary"), "repeat-blocks")
    try:
        total = blocks.read().select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
        first = max(1, total * len(plan.cover) // plan.v // BUCKET_KEYS + 1)
        second = max(1, total // 4 // BUCKET_KEYS + 1)  # a quarter of all positions is a common share
        asked = blocks.read().mapInArrow(_first_questions(plan, first), MESSAGE)
        ranks = ask(asked, _ties, "repeat-ranks")
        asked = blocks.answered(ranks).mapInArrow(_second_questions(plan, first, second), MESSAGE)
        ties = ask(asked, _ties, "repeat-ties")
        asked = blocks.answered(ranks, ties).mapInArrow(_third_questions(plan, second), MESSAGE)
        sure = ask(asked, _ties, "repeat-sure")
        result = blocks.answered(ranks, ties, sure).mapInArrow(
            _removal(plan, keep_bytes), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, n_shared bigint, kept binary")
        return stored(result if keep_bytes else result.drop("kept"), "repeat-result")
    finally:
        blocks.drop()
