import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from corpusloom.llm import byte_index as bi
from corpusloom.llm.components import components

DOCS = "doc_id bigint, text string"


def brute_fingerprint(text, k=3):
    words = [w for w in (text or "").encode().lower().split()]
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, bits=3):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in combinations(range(len(ids)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= bits:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    members = {}
    for i in range(len(ids)):
        members.setdefault(find(i), []).append(ids[i])
    return {i: min((x for x in members[find(i)] if x is not None), default=None) for i in range(len(ids))}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a b", "A b C d", "É É É É é", "x " * 3000])
def test_fingerprint_is_the_bitwise_majority(text):
    assert bi.fingerprint((text or "").encode(), 3) == brute_fingerprint(text)


@pytest.mark.parametrize("key_bytes", [3, 4, 5])
def test_every_guaranteed_minimum_holds_a_position_set(key_bytes):
    sets = bi.position_sets(3, key_bytes)
    assert all(any(set(s) <= set(kept) for s in sets) for kept in combinations(range(8), 5))


def near_fingerprints(n, seed):
    """Families of fingerprints a few bits apart, and loose ones."""
    rng = random.Random(seed)
    made = set()
    while len(made) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 25])):
            made.add(centre)
            for _ in range(rng.randrange(1, 5)):
                centre ^= 1 << rng.randrange(64)
    return sorted(made)[:n]


@pytest.mark.parametrize("hot", [3, 256])
def test_links_connect_what_is_near(spark, monkeypatch, hot):
    monkeypatch.setattr(bi, "HOT_POSTING", hot)
    fps = near_fingerprints(150, 1)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    entries = spark.createDataFrame(list(zip(signed, range(150))), "fp bigint, rep bigint")
    got = {r["node"]: r["component"] for r in components(bi.fingerprint_links(entries)).collect()}
    want = brute_components(range(150), fps)
    assert {i: got.get(i, i) for i in range(150)} == want


def test_pairs_in_one_large_posting():
    rng = np.random.default_rng(0)
    fps = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64))
    reps = np.arange(len(fps))
    a, b = bi.posting_links(np.zeros(len(fps), int), fps, reps, 3)
    c, d = bi.mask_links(fps, reps, 0xFFFFFFFF00000000 | 0xFFFF0000, 0, 1, 3)
    for left, right in ((a, b), (c, d)):
        nodes, root = bi.roots_of(left, right)
        got = dict(zip(nodes.tolist(), root.tolist()))
        want = brute_components(reps.tolist(), fps.tolist())
        assert {i: got.get(i, i) for i in want} == want


def test_components_of_chains_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (95, 100), (7, 7), (None, 3), (2, 1)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows_of_every_kind(spark):
    long = "word and other " * 4000
    rows = [(5, None), (3, ""), (9, " \n"), (1, "a b c d e"), (1, "a b c d e"), (8, "A b c  d\te"), (None, "a b c d e"),
            (None, "nothing like it at all"), (20, long), (21, long)]
    docs = spark.createDataFrame([(i, t, 0, "x", 7) for i, t in rows],
                                 DOCS + ", fp int, component_id string, rep int")
    got = bi.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = {(5, 3), (3, 3), (9, 3), (1, 1), (8, 1), (None, 1), (None, None), (20, 20), (21, 20)}
    assert {(r["doc_id"], r["component_id"]) for r in got} == want
    kept = bi.keep_first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 20, 3, None, None]


TEXTS = ["a b c d e", "A b c  d\te", "nothing like it at all", "other words here now", "a b c d e", None]


@pytest.mark.parametrize("kind,keys", [
    ("bigint", [2 ** 63 - 1, 2 ** 60, 2 ** 62 + 5, -2 ** 63, 2 ** 61, 7]),
    ("bigint", [2 ** 60 + 3, None, None, 2 ** 60, 2 ** 60 + 1, -1]),
    ("string", ["z", "b", "10", "9", "bb", None]),
    ("int", [3, 2, 1, 0, -1, 5]),
])
def test_keys_of_any_kind(spark, kind, keys):
    docs = spark.createDataFrame(list(zip(keys, TEXTS)), f"doc_id {kind}, text string")
    got = bi.near_duplicates(docs)
    assert got.schema["component_id"].dataType == docs.schema["doc_id"].dataType
    fps = [brute_fingerprint(t) for t in TEXTS]
    want = brute_components(keys, fps)
    assert sorted(((r["doc_id"], r["component_id"]) for r in got.collect()), key=str) == sorted(
        ((k, want[i]) for i, k in enumerate(keys)), key=str)
    kept = sorted((r["doc_id"] for r in bi.keep_first_of_groups(docs).collect()), key=str)
    assert kept == sorted((k for i, k in enumerate(keys) if k is None or want[i] == k), key=str)


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert bi.near_duplicates(empty).count() == 0
    assert bi.keep_first_of_groups(empty).count() == 0
