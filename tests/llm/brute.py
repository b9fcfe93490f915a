"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_spans(text: str | None) -> str:
    def valid(kind: str, value: str) -> bool:
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            return 14 <= len(digits) <= 19 and _luhn(digits)
        return kind == "email" or 10 <= len(digits) <= 15

    found = sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if valid(k, m.group()))
    return ",".join(f"{PATTERNS[i][0]}:{a}:{b}" for a, i, b in found)


def shingle_set(text: str | None, size: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def dup_components(docs: dict[int, str | None], size: int, percent: int) -> dict[int, int]:
    sets = {i: shingle_set(t, size) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def repeats(docs: list[bytes], length: int) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, kept_sha256 per text."""
    seen = Counter(t[i:i + length] for t in docs for i in range(len(t) - length + 1))
    out = []
    for t in docs:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                covered[i:i + length] = True
        kept = bytes(c for c, m in zip(t, covered) if not m)
        spans = sum(1 for i in range(len(t)) if covered[i] and (i == 0 or not covered[i - 1]))
        out.append((len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


END = "</s>"


class Katz:
    """The backoff model by dictionaries; discounts come from the operator under test."""

    def __init__(self, docs: dict[int, str | None], words_of, good_turing, most: int) -> None:
        self.most = most
        self.tokens = {i: [w.decode() for w in (t or "").encode().lower().split()] + [END] for i, t in docs.items()}
        self.out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
        self.one, self.two, self.after = Counter(), Counter(), defaultdict(set)
        for i, t in self.tokens.items():
            if not self.out[i]:
                self.one.update(t)
                for a, b in zip([END, *t], t):
                    self.two[a, b] += 1
                    self.after[a].add(b)
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.words = words_of(self.n, self._times(self.one))
        self.discount = good_turing(self._times(self.two))

    def _times(self, counts: Counter) -> np.ndarray:
        out = np.zeros(self.most + 2, np.int64)
        for c in counts.values():
            if c <= self.most + 1:
                out[c] += 1
        return out

    def word(self, w: str) -> float:
        return float(self.words.probability(np.array([self.one[w]]))[0])

    def context(self, a: str) -> tuple[float, float]:
        freed = sum((1 - self.discount[self.two[a, w]]) * self.two[a, w] for w in self.after[a] if self.two[a, w] <= self.most)
        total = self.one[a] if freed > 0 else self.one[a] + 0.5
        return total, (freed if freed > 0 else 0.5) / total / (1 - sum(self.word(w) for w in self.after[a]))

    def pair(self, a: str, w: str) -> float:
        if not self.one[a]:
            return self.word(w)
        total, weight = self.context(a)
        c = self.two[a, w]
        return (self.discount[c] if c <= self.most else 1) * c / total if c else weight * self.word(w)

    def score(self, i: int) -> tuple[float, float]:
        t = self.tokens[i]
        base = sum(math.log10((self.one[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in t)
        return base, sum(math.log10(self.pair(a, w)) for a, w in zip([END, *t], t))


_SPACES = " \t\n\x0b\x0c\r"


def pii_terms(text: str | None) -> list[tuple[str, int, int]]:
    """Terms with their places: words of three letters or more, at most four marks from white space on both sides."""
    t = f" {text or ''} "
    emails = [m.span() for m in re.finditer(PATTERNS[0][1], text or "")]
    out = []
    for m in re.finditer(r"[^\W\d_]+", t):
        a, b = m.span()
        left, right = a, b
        while t[left - 1] in string.punctuation:
            left -= 1
        while t[right] in string.punctuation:
            right += 1
        if b - a >= 3 and t[left - 1] in _SPACES and t[right] in _SPACES and a - left <= 4 and right - b <= 4:
            if not any(x < b - 1 and a - 1 < y for x, y in emails):
                out.append((m.group().lower(), a - 1, b - 1))
    return out


def pii_disclosed(rows: list[tuple], z: float = 1.645, generalise_at: float = 0.25, remove_at: float = 0.4,
                  least_bits: float = 3.0) -> dict[tuple, list[tuple]]:
    """(doc_id, text) to (kind, start, end, label) of its generalised and removed terms; equal rows count once."""
    docs = set(rows)
    df_t = Counter(w for _, t in docs for w in {w for w, _, _ in pii_terms(t)})
    held = defaultdict(set)
    for d in docs:
        for s in filter(None, pii_spans(d[1]).split(",")):
            kind, a, b = s.split(":")
            raw = d[1][int(a):int(b)]
            held[kind, raw.lower() if kind == "email" else raw if kind == "ip" else re.sub("[^0-9]", "", raw)].add(d)
    most = defaultdict(int)
    for w, n in df_t.items():
        for k in range(1, min(len(w), 6) + 1):
            most[w[:k]] = max(most[w[:k]], n)
    rank, out = {}, {}
    for carriers in held.values():
        df_ct = Counter(w for d in carriers for w in {w for w, _, _ in pii_terms(d[1])})
        for w, k in df_ct.items():
            n = df_t[w]
            low = (k + z * z / 2 - z * math.sqrt(k * (n - k) / n + z * z / 4)) / (n + z * z)
            if low < generalise_at or math.log2(low * len(docs) / len(carriers)) < least_bits:
                continue
            broad = next((w[:p] + "*" for p in range(min(6, len(w) - 1), 0, -1) if most[w[:p]] * generalise_at > len(carriers)), None)
            for d in carriers:
                # Removed before generalised, a broad class before a narrow one.
                strict = (0, "", None) if low >= remove_at else (1, len(broad or ""), broad)
                rank[d, w] = min(rank.get((d, w), (2,)), strict, key=lambda r: r[:2] if r[0] == 1 else (r[0], 0))
    for d in docs:
        out[d] = [("generalised" if rank[d, w][0] else "removed", a, b, rank[d, w][2]) for w, a, b in pii_terms(d[1]) if (d, w) in rank]
    return out
