"""Links between distinct sets: repeated and missing ids, forests of blocks, long and many members."""

from __future__ import annotations

import numpy as np
import pytest

from keyferry.llm import near_dup
from tests.llm.brute import dup_components, shingle_set

SETTINGS = near_dup.Settings(words=3, percent=85)


def text(seed: int, n: int = 120) -> list[str]:
    return [f"w{seed}x{i}" for i in range(n)]


def changed(words: list[str], at: int) -> str:
    return " ".join([*words[:at], "other", *words[at + 1:]])


def found(spark, rows, kind="bigint"):
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    return [(r["doc_id"], r["component_id"]) for r in near_dup.groups(df, SETTINGS).collect()], near_dup.dedupe(df, SETTINGS).collect()


def test_no_link_is_lost_when_an_id_repeats(spark):
    a, b = text(1), text(2)
    got, left = found(spark, [(1, " ".join(a)), (2, changed(a, 50)), (2, " ".join(b)), (3, changed(b, 60))])
    assert got and all(c == 1 for _, c in got) and [r["doc_id"] for r in left] == [1]


def test_rows_without_an_id_are_linked(spark):
    a, b = text(1), text(2)
    got, left = found(spark, [(1, " ".join(a)), (None, changed(a, 50)), (None, changed(a, 51)), (None, " ".join(b)), (None, changed(b, 20)), (None, None), (None, "")])
    assert sorted(got, key=str) == sorted([(1, 1), (None, 1), (None, 1), (None, None), (None, None), (None, None), (None, None)], key=str)
    assert sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in left) == sorted([(0, 0), (0, 0), (0, len([r for r in left if r["doc_id"] is None and r["text"]][0]["text"])), (1, len(" ".join(a)))])
    assert sum(r["doc_id"] is None and bool(r["text"]) for r in left) == 1


def test_ids_may_be_text(spark):
    a = text(1)
    got, left = found(spark, [("b", " ".join(a)), ("a", changed(a, 50)), ("c", "no words in common")], "string")
    assert sorted(got) == [("a", "a"), ("b", "a"), ("c", "c")] and sorted(r["doc_id"] for r in left) == ["a", "c"]


def test_equal_rows_of_a_group_become_one(spark):
    a = " ".join(text(1))
    got, left = found(spark, [(2, a), (1, a), (1, a), (1, a)])
    assert {c for _, c in got} == {1} and len(left) == 1 and left[0]["doc_id"] == 1


def test_a_block_emits_a_forest():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    block = near_dup._Block(near_dup.Settings(words=3, percent=80))
    for i in range(40):  # every two are linked
        own = np.unique(np.concatenate([np.delete(base, rng.choice(400, 10, replace=False)), rng.integers(0, 2**63, 10, dtype=np.uint64)]))
        block.add(i, i, True, own)
    links = block.links()
    assert len(links) == 39 and len({x for pair in links for x in pair}) == 40
    one = near_dup._Block(SETTINGS)
    one.add(1, 1, True, base)
    assert one.links() == []


@pytest.mark.parametrize("held", [200, 1 << 21])
def test_blocks_of_any_size_find_the_same(spark, monkeypatch, held):
    rng = np.random.default_rng(8)
    base = text(0, 150)
    texts = {}
    for n in range(70):  # some link with the base alone, some with one another, some with none
        words = list(base)
        for i in rng.choice(150, rng.integers(1, 14), replace=False):
            words[i] = f"c{n % 9}x{i}"
        texts[n] = " ".join(words)
    whole = near_dup._linked
    monkeypatch.setattr(near_dup, "_linked", lambda m, t, s: whole(m, t, s, held))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.groups(df, SETTINGS).collect()}
    assert got == dup_components(texts, 3, 85) and len(set(got.values())) > 1


def test_links_grow_with_members_and_not_with_pairs(spark, monkeypatch):
    """A family in which many pairs look alike and few are linked."""
    rng = np.random.default_rng(6)
    base = text(0, 200)
    texts = {}
    for n in range(150):
        words = list(base)
        for i in rng.choice(200, 6, replace=False):
            words[i] = f"c{n}x{i}"
        texts[n] = " ".join(words)
    sizes, whole = [], near_dup._linked

    def spy(members, t, s):
        out = whole(members, t, s)
        sizes.append((members.select("node").distinct().count(), members.select("key").distinct().count(), out.count()))
        return out

    monkeypatch.setattr(near_dup, "_linked", spy)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.groups(df, SETTINGS).collect()}
    assert got == dup_components(texts, 3, 85)
    assert all(links <= keys * nodes for nodes, keys, links in sizes) and sizes[-1][2] <= sizes[-1][0] * sizes[-1][1]


def test_signature_has_the_slots_of_its_bands():
    assert SETTINGS.size == SETTINGS.rows * SETTINGS.bands
    # A pair at the threshold shares a band but for a chance of `miss`.
    assert (1 - 0.85 ** SETTINGS.rows) ** SETTINGS.bands <= SETTINGS.miss
    assert len(shingle_set("a b", 3)) == 1
