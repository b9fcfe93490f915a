"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

Texts become sets of word shingles. Equal sets collapse into one node first, so
exact copies cost one row each. Every node gets a SuperMinHash signature: the
slots are visited in a random permutation per element, and a set stops as soon
as no later rank can lower a slot. Signatures are cut into bands; the number of
bands is chosen so that a pair at the threshold shares none with a chance of at
most `miss`.

A band's bucket is not expanded into pairs. Its members meet one hub, the member
that shares the most buckets with others; those links are confirmed on the full
sets and joined by union-find. Only buckets whose members are in more than one
component afterwards are looked at again: members outside the bucket's main
component meet all its members. Both times the texts come together in blocks of
bounded size, and a block compares the full sets inside, passes over pairs that
its own union-find already joins, and emits a forest of confirmed links: fewer
rows than it has members, however many pairs it looked at.

Defined results: words are runs of characters other than ASCII white space,
with A-Z lower-cased; a text with fewer words than a shingle is one shingle;
without words, or null, it has an empty set and is linked with nothing. Rows
that share a doc_id are one document, also with different texts: what is linked
with one of them is linked with all. Rows without a doc_id are documents of
their own; a group is named by its smallest doc_id, or null if no member has
one. doc_id may be of any type that can be ordered. Empty tables give empty
results.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyferry.llm.common import discard, stored, text_or_empty
from keyferry.llm.graph import components

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_BATCH = 1 << 16  # elements hashed at once
_RANK = np.uint64(48)  # a slot holds rank << 48 | 48 random bits


class WordHashes(dict):
    """64-bit hash per word, kept for repeated words up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: ASCII letters, ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    folded = hashes[: len(words) - size + 1]
    for i in range(1, size):
        folded = mixed(folded * _MULTIPLY + hashes[i: len(words) - size + 1 + i])
    return np.unique(mixed(folded + np.uint64(size)))


def _sketch(elements: np.ndarray, owner: np.ndarray, slots: np.ndarray) -> None:
    """Lower `slots` (sets x m) by the elements of the sets `owner`."""
    m = slots.shape[1]
    flat, rows, perm, first = slots.reshape(-1), np.arange(len(elements)), None, None
    for j in range(m):
        own = owner[rows]
        drawn = mixed(elements[rows] + np.uint64((2 * j + 1) * int(_MULTIPLY) % (1 << 64)))
        pick = j + (mixed(drawn + _MULTIPLY) >> np.uint64(32)).astype(np.int64) % (m - j)
        if j == 0:
            place, first = pick, pick
        else:
            if perm is None:  # the permutation of those that go on, after its first swap
                perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(rows), 1))
                at = np.full(len(elements), -1)
                at[rows] = np.arange(len(rows))
                own_first, all_rows = first[rows], np.arange(len(rows))
                perm[all_rows, own_first] = 0
                perm[all_rows, 0] = own_first
            r = at[rows]
            place = perm[r, pick].astype(np.int64)
            perm[r, pick] = perm[r, j]
            perm[r, j] = place
        np.minimum.at(flat, own * m + place, (np.uint64(j) << _RANK) | (drawn >> np.uint64(16)))
        # Later ranks are at least j + 1: full sets stop here.
        going = slots.max(axis=1) >= (np.uint64(j + 1) << _RANK)
        rows = rows[going[own]]
        if not len(rows):
            break


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Signatures (sets x m, uint64); all ones where a set is empty."""
    slots = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    lo = 0
    while lo < len(sets):
        hi, n = lo, 0
        while hi < len(sets) and (hi == lo or n + len(sets[hi]) <= _BATCH):
            n += len(sets[hi])
            hi += 1
        elements = np.concatenate(sets[lo:hi])
        owner = np.repeat(np.arange(hi - lo), [len(s) for s in sets[lo:hi]])
        for i in range(0, len(elements), _BATCH):  # one long text goes in pieces
            _sketch(elements[i:i + _BATCH], owner[i:i + _BATCH], slots[lo:hi])
        lo = hi
    return slots


@dataclass(frozen=True)
class Settings:
    """Shingle size in words; link pairs with `percent` * union <= 100 * intersection."""

    words: int = 5
    percent: int = 80
    rows: int = 5
    miss: float = 1e-7

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def size(self) -> int:
        """Slots of a signature."""
        return self.rows * self.bands


def _signer(settings: Settings):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, r, b = WordHashes(), settings.rows, settings.bands
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                sets = [shingles(t, settings.words, known) for t in part.column(2).cast(pa.binary()).to_pylist()]
                slots = superminhash(sets, settings.size)
                bands = np.full(len(sets), 0, np.uint64)
                keys = []
                for i in range(b):
                    key = bands + np.uint64(i + 1)
                    for k in range(r):
                        key = mixed(key * _MULTIPLY + slots[:, i * r + k])
                    keys.append(key)
                keys = np.stack(keys, axis=1).astype(np.int64)
                full = np.array([len(s) > 0 for s in sets], bool)
                yield pa.record_batch([
                    part.column(0), part.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([k if f else None for k, f in zip(keys, full)], pa.list_(pa.int64())),
                ], names=["doc_id", "text_hash", "n_shingles", "set_id", "bands"])
    return sign


class _Block:
    """Members of a block: their nodes, components, sets, and which are to meet all others."""

    def __init__(self, settings: Settings) -> None:
        self.settings, self.nodes, self.parent, self.own, self.sets, self.mark = settings, [], {}, [], [], []

    def add(self, node: int, comp: int, outlier: bool, shingled: np.ndarray) -> None:
        self.nodes.append(node)
        self.own.append(comp)
        self.parent[comp] = comp
        self.sets.append(shingled)
        self.mark.append(outlier)

    def _root(self, comp: int) -> int:
        while self.parent[comp] != comp:
            self.parent[comp] = self.parent[self.parent[comp]]
            comp = self.parent[comp]
        return comp

    def links(self) -> list[tuple[int, int]]:
        """Confirmed links that join the components of the outliers with those of other members: a forest."""
        outliers = [i for i, m in enumerate(self.mark) if m]
        if not outliers or len(self.nodes) < 2:
            return []
        percent, n = self.settings.percent, np.array([len(s) for s in self.sets])
        starts = np.concatenate([[0], np.cumsum(n)])
        joined = np.concatenate(self.sets)
        # Numbers of the shingles, so that one look-up per shingle compares a set with all others.
        if len(outliers) > 2:
            values, joined = np.unique(joined, return_inverse=True)
            held = np.zeros(len(values), bool)
        found = []
        for i in outliers:
            root = self._root(self.own[i])
            roots = {c: self._root(c) for c in set(self.own)}
            near = np.array([roots[c] != root for c in self.own]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
            near = np.flatnonzero(near)
            if not len(near):
                continue
            other = np.concatenate([joined[starts[j]:starts[j + 1]] for j in near])
            mine = joined[starts[i]:starts[i + 1]]
            if len(outliers) > 2:
                held[mine] = True
                same = held[other]
                held[mine] = False
            else:
                same = mine[np.minimum(np.searchsorted(mine, other), len(mine) - 1)] == other
            both = np.add.reduceat(same.astype(np.int64), np.concatenate([[0], np.cumsum(n[near])[:-1]]))
            for j in near[100 * both >= percent * (n[near] + n[i] - both)].tolist():
                a, b = self._root(self.own[i]), self._root(self.own[j])
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
                    found.append((self.nodes[i], self.nodes[j]))
        return found


def _comparer(settings: Settings):
    """Links of blocks that come one after another: rows key, ob, mb, node, comp, outlier, text."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place, block = WordHashes(), None, _Block(settings)

        def out() -> pa.RecordBatch:
            found = block.links()
            return pa.record_batch([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["u", "v"])

        for batch in batches:
            cells = [batch.column(i).to_pylist() for i in range(6)]
            texts = batch.column(6).cast(pa.binary())
            for r, (key, ob, mb, node, comp, outlier) in enumerate(zip(*cells)):
                if (key, ob, mb) != place:
                    yield out()
                    place, block = (key, ob, mb), _Block(settings)
                block.add(node, comp, outlier, shingles(texts[r].as_py(), settings.words, known))
        yield out()
    return compare


def _linked(members: DataFrame, texts: DataFrame, settings: Settings, held: int = 1 << 21) -> DataFrame:
    """Confirmed links (u, v) between the outliers and the other members of every key.

    `members`: key, node, comp, outlier, n_shingles. The outliers and the members
    of a key are cut into blocks of about `held` shingles each, by hash, and every
    block of outliers meets every block of members.
    """
    members = stored(members, "dup-members")
    weight = F.col("n_shingles") + 64
    sizes = members.groupBy("key").agg(F.sum(F.when(F.col("outlier"), weight)).alias("some"), F.sum(weight).alias("all"))
    sizes = sizes.select("key", *[F.ceil(F.col(c) / held).cast("int").alias(n) for c, n in (("some", "obs"), ("all", "mbs"))])
    sized = members.join(sizes, "key").join(texts, "node")
    slot, own = F.xxhash64("node"), ["key", "node", "comp", "text"]
    many = F.col("mbs") * F.col("obs") > 1
    fixed_mb = sized.select(*own, (F.col("outlier") & ~many).alias("outlier"),
                            F.explode(F.sequence(F.lit(0), F.col("obs") - 1)).alias("ob"), F.pmod(slot, "mbs").cast("int").alias("mb"))
    fixed_ob = sized.where(F.col("outlier") & many).select(
        *own, "outlier", F.pmod(slot, "obs").cast("int").alias("ob"), F.explode(F.sequence(F.lit(0), F.col("mbs") - 1)).alias("mb"))
    place = ["key", "ob", "mb"]
    blocks = fixed_mb.unionByName(fixed_ob).repartition(*place).sortWithinPartitions(*place)
    links = stored(blocks.select(*place, "node", "comp", "outlier", "text").mapInArrow(_comparer(settings), "u bigint, v bigint"), "dup-links")
    discard(members)
    return links


def _texts(documents: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of the `wanted` nodes: that of the node's first row."""
    need = nodes.join(wanted.distinct(), "node", "left_semi").select("node", "first_id", "first_hash")
    same = F.col("own_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    # Merged at any size: a broadcast of few nodes would turn into a shuffle of all texts as they grow.
    rows = documents.select(F.col("doc_id").alias("own_id"), _text_hash(), "text").join(stored(need, "dup-needed").hint("merge"), same)
    return stored(rows.select("node", "text").dropDuplicates(["node"]), "dup-texts")


def _nodes(signed: DataFrame) -> DataFrame:
    """One row per distinct set: node, set_id, n_shingles, bands and the id and hash of its first row (null ids last)."""
    full = signed.where(F.col("set_id").isNotNull())
    first = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    nodes = full.groupBy("set_id").agg(F.min(first).alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    return stored(nodes.select(F.monotonically_increasing_id().alias("node"), "set_id", "n_shingles", "bands",
                               F.col("first.id").alias("first_id"), F.col("first.hash").alias("first_hash")), "dup-nodes")


def _hub_members(buckets: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every bucket's hub, marked, and the members that are to meet it, each once per hub."""
    weight = buckets.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = buckets.join(weight, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("hub"))
    met = buckets.join(hubs, "key").select(F.col("hub").alias("key"), "node").distinct()
    return met.join(sizes, "node").select("key", "node", F.col("node").alias("comp"), (F.col("node") == F.col("key")).alias("outlier"), "n_shingles")


def _open_members(buckets: DataFrame, labels: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component; those outside the main one are marked."""
    own = buckets.join(labels.withColumnsRenamed({"u": "node", "v": "comp"}), "node", "left").select(
        "key", "node", F.coalesce("comp", "node").alias("comp"))
    own = stored(own, "dup-own")
    counts = own.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"))
    # Of two members, the hub has met the other.
    main = stored(main.where((F.col("n") > F.col("main.n")) & (F.col("n") > 2)).select("key", F.col("main.comp").alias("main")), "dup-open")
    return own.join(main, "key").join(sizes, "node").select("key", "node", "comp", (F.col("comp") != F.col("main")).alias("outlier"), "n_shingles")


def groups(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of `documents`: doc_id, text_hash, n_shingles, component_id, and
    group_id, which also tells groups apart that have no doc_id (null without words)."""
    source = documents.select("doc_id", _text_hash(), F.col("text").cast("string"))
    kind = source.schema["doc_id"].dataType.simpleString()
    signed = stored(source.mapInArrow(
        _signer(settings), f"doc_id {kind}, text_hash bigint, n_shingles bigint, set_id binary, bands array<bigint>"), "dup-signed")
    nodes = _nodes(signed)
    sizes = nodes.select("node", "n_shingles")

    band = nodes.select("node", F.explode("bands").alias("key")).distinct()
    shared = band.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = stored(band.join(shared, "key"), "dup-buckets")
    texts = _texts(documents, nodes, buckets.select("node"))
    # Texts under one doc_id are one document: their nodes belong together.
    placed = stored(signed.select("doc_id", "text_hash", "n_shingles", "set_id").join(nodes.select("set_id", "node"), "set_id", "left").drop("set_id"), "dup-placed")
    ids = placed.where(F.col("doc_id").isNotNull() & F.col("node").isNotNull()).groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("last"))
    ids = stored(ids.where("u <> last").select("doc_id", "u"), "dup-repeated-ids")
    same = placed.where("node is not null").join(ids, "doc_id").select("u", F.col("node").alias("v")).distinct()

    links = _linked(_hub_members(buckets, sizes), texts, settings).unionByName(same)
    labels = components(links)
    rest = _linked(_open_members(buckets, labels, sizes), texts, settings)
    if not rest.isEmpty():
        labels = components(labels.unionByName(rest))
    labels = labels.withColumnsRenamed({"u": "node", "v": "label"})
    found = stored(placed.join(labels, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("label", "node").alias("group_id")), "dup-found")
    discard(signed, nodes, buckets, texts, placed, ids)  # `found` is all that is read from here on
    names = found.where("group_id is not null").groupBy("group_id").agg(F.min("doc_id").alias("named"))
    return found.join(names, "group_id", "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(F.col("group_id").isNull(), F.col("doc_id")).otherwise(F.col("named")).alias("component_id"), "group_id")


def _text_hash():
    return F.xxhash64(text_or_empty(F.col("text"))).alias("text_hash")


def dedupe(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each group: of its smallest doc_id (a group without any: any row), and
    of that document's texts the one of the smallest hash; of equal rows, one.

    Texts without words are in no group and stay.
    """
    found = stored(groups(documents, settings), "dup-groups")
    row = ["doc_id", "text_hash"]
    order = F.struct(F.col("doc_id").isNull().alias("late"), *row)
    stay = found.where("group_id is not null").groupBy("group_id").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    stay = stay.where("n > 1").select("group_id", F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    kept = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    marked = found.join(stay, "group_id").groupBy(*row).agg(F.bool_or(kept).alias("kept"))
    marked = stored(marked.withColumnsRenamed({"doc_id": "seen_id", "text_hash": "seen_hash"}), "dup-marked")
    own = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), _text_hash().alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("seen_id")) & (F.col("own_hash") == F.col("seen_hash"))
    # One row for all rows of a group of more than one; merged at any size, as texts go along.
    marked = marked.hint("merge")
    # Rows of a group of one row are not in `marked`; equal rows that stay are one.
    alone = own.join(marked, same, "left_anti").select("row.*")
    once = own.join(marked.where("kept"), same, "left_semi").dropDuplicates(["own_id", "own_hash"]).select("row.*")
    return alone.unionByName(once)
