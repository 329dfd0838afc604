import random

import numpy as np
import pytest
import xxhash

from hearth.llm import simhash_gph as S
from hearth.llm.components import connected_components


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, distance):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = list(fps)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if bin(a ^ b).count("1") <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in values}


def cases():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.randint(0, 3)):
            near = list(base)
            if near and rng.random() < 0.7:
                near[rng.randrange(len(near))] = "edited"
            rows.append((len(rows), "\t".join(near) + rng.choice(["", " ", "\n"])))
    return [*rows, (900, None), (901, ""), (902, " \n"), (903, "One"), (904, "ONE"), (905, "one two"), (906, "É é"), (906, "É é"), (None, "one")]


def test_clusters_match_brute_force(spark):
    rows = cases()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = S.cluster(df.select("doc_id", "text")).collect()
    fps = {brute_fingerprint(t) for _, t in rows}
    classes = brute_classes(sorted(fps), 2)
    smallest = {}
    for i, t in rows:
        if i is not None:
            r = classes[brute_fingerprint(t)]
            smallest[r] = min(i, smallest.get(r, i))
    expected = sorted((-1 if i is None else i, f"{brute_fingerprint(t):016x}", smallest[classes[brute_fingerprint(t)]]) for i, t in rows)
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], f"{r['fp'] & (2**64 - 1):016x}", r["component_id"]) for r in got)
    assert found == expected


@pytest.mark.parametrize("limit", [1, 1000])
@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_keep_every_connection_whatever_the_bucket_limit(spark, limit, distance):
    rng = np.random.default_rng(distance)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    values = set()
    for c in centres:  # chains of one-bit steps around a few centres, sharing most of their bits
        x = int(c)
        for _ in range(15):
            values.add(x)
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                x ^= 1 << int(b)
    fps = spark.createDataFrame([(S.signed(v),) for v in values], "fp long")
    edges = S.links(fps, len(values), distance, bucket_limit=limit)
    comp = {r["node"]: r["root"] for r in connected_components(edges, "a", "b").collect()}
    expected = brute_classes(sorted(values), distance)
    groups = {}
    for v in values:
        groups.setdefault(expected[v], set()).add(comp.get(S.signed(v), S.signed(v)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_allocation_is_the_cheapest_of_all():
    costs = [{-1: 0.0, 0: 5.0, 1: 50.0, 2: 90.0}, {-1: 0.0, 0: 40.0, 1: 60.0, 2: 200.0}, {-1: 0.0, 0: 7.0, 1: 9.0, 2: 400.0}]
    every = [(a[1] + b[1] + c[1], [a[0], b[0], c[0]]) for a in costs[0].items() for b in costs[1].items() for c in costs[2].items() if a[0] + b[0] + c[0] == 0]
    assert S.allocate(costs, 0)[0] == min(every)[0]


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (4000, 64))
    for b in range(1, 8):  # bits 0, 9, 18, ... follow bit 0
        bits[:, 9 * b] = bits[:, 0]
    sample = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.uint64).ravel()
    masks = S.group_bits(sample, 4)
    assert sum(masks) == (1 << 64) - 1
    together = sum(1 << (9 * b) for b in range(8))
    assert any(m & together == together for m in masks)


def test_near_dedup_keeps_one_of_each_group(spark):
    long = " ".join(f"word{i}" for i in range(200))
    rows = [(5, long, "a"), (3, long + " ", "b"), (3, long + " ", "b"), (7, long.upper(), "c"), (1, "quite another text here", "d"), (None, None, "e"), (None, None, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __extra string")
    kept = sorted((r["doc_id"] or -1, r["__extra"]) for r in S.near_dedup(df).collect())
    assert kept == [(-1, "e"), (1, "d"), (3, "b")]


def near_copies(distance):
    """Two texts whose fingerprints differ in ``distance`` bits."""
    base = [f"word{i}" for i in range(400)]
    for at in range(400):
        near = " ".join([*base[:at], "edited", *base[at + 1 :]])
        if bin(brute_fingerprint(" ".join(base)) ^ brute_fingerprint(near)).count("1") == distance:
            return " ".join(base), near
    raise AssertionError("no such pair")


def test_near_dedup_tells_groups_with_one_id_apart(spark):
    texts = [" ".join(f"{w}{i}" for i in range(50)) for w in ("ant", "bee", "cat")]
    one, near = near_copies(1)
    rows = [*[(5, t) for t in texts], (5, texts[0]), (5, one), (9, near)]
    kept = S.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted((5, t) for t in [*texts, one])


@pytest.mark.parametrize("distance", [1, 2])
def test_near_dedup_finds_near_copies_without_ids(spark, distance):
    one, near = near_copies(distance)
    other = "quite another text here"
    df = spark.createDataFrame([(None, one), (None, near), (None, other), (None, other)], "doc_id long, text string")
    kept = sorted(r["text"] for r in S.near_dedup(df).collect())
    assert len(kept) == 2 and other in kept


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.cluster(df).count() == 0
    assert S.near_dedup(df).count() == 0


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2001, 2000), (2000, 2001), (5, 5)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {n: got[n] for n in range(61)} == dict.fromkeys(range(61), 0)
    assert got[1049] == 1000 and got[2001] == 2000 and len(got) == 61 + 50 + 2


def test_links_of_near_copies_are_bounded_per_member(spark):
    made = []
    for n in (500, 1000, 2000):
        rng = random.Random(3)
        group = set()
        while len(group) < n:  # values within two bits of one another, and strangers
            group.add(sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2))))
        others = {rng.getrandbits(64) for _ in range(300)}
        fps = spark.createDataFrame([(S.signed(v),) for v in group | others], "fp long")
        found = S.links(fps, fps.count(), 2, bucket_limit=8)
        made.append(found.count())
        roots = {r["node"]: r["root"] for r in connected_components(found, "a", "b").collect()}
        assert len({roots[S.signed(v)] for v in group}) == 1
    assert all(m <= 64 * n for m, n in zip(made, (500, 1000, 2000), strict=True))  # a ball around each neighbour value, one link in each


def test_very_long_text_and_hot_fingerprint(spark):
    long = " ".join(f"w{i % 4999}" for i in range(200_000))
    rows = [(i, "same words in every copy") for i in range(3000)] + [(5000, long), (5001, long.upper())]
    got = {r["doc_id"]: r for r in S.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["component_id"] == 0 for i in range(3000))
    assert got[5001]["component_id"] == 5000 and got[5000]["fp"] & (2**64 - 1) == brute_fingerprint(long)
