import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import minhash_bottomk as M
from hearth.llm import queries


def shingles(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(size, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, percent=80):
    """{row number: (n, smallest id reachable)} by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            least[find(i)] = min(least.get(find(i), ident), ident)
    return [(ident, len(s), least.get(find(i)) if s else ident) for i, ((ident, _), s) in enumerate(zip(rows, sets, strict=True))]


def edited(rng, words, share):
    out = list(words)
    for _ in range(max(1, int(len(out) * share))):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def corpus(seed, groups=40, hot=0):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 20, 60, 150, 400]))]
        if rng.random() < 0.4:
            base[:0] = passage
        for _ in range(rng.randint(1, 5)):
            rows.append(" ".join(edited(rng, base, rng.choice([0.005, 0.01, 0.03, 0.06])) if rng.random() < 0.7 else base))
    for _ in range(hot):
        rows.append(" ".join(edited(rng, passage * 2, rng.choice([0.01, 0.02, 0.05]))))
    rng.shuffle(rows)
    return list(enumerate(rows))


def answer(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, SKETCH string")
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in M.cluster(df, **kw).collect()), key=repr)


@pytest.mark.parametrize(("k", "limit"), [(64, 64), (64, 3)])
def test_matches_brute_force(spark, k, limit):
    rows = corpus(k + limit, 40, hot=40)
    assert answer(spark, rows, k=k, limit=limit) == sorted(brute(rows), key=repr)


def test_edges(spark):
    long = " ".join(f"w{i % 9973}-{i}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one "), (6, "one two three"), (7, "one two"), (8, "A b C d"), (8, "a B c D"),
        (None, "one"), (9, long), (10, long + " tail"), (11, "É é é é"), (12, "É é é é É"), (13, "x y z v w"), (13, "x y z v w"),
        (None, "nobody else"), (0, "ONE TWO\x0bTHREE"),
    ]
    assert answer(spark, rows) == sorted(brute(rows), key=repr)
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    kept = {(r["doc_id"], r["kept"]) for r in M.cluster(df).collect()}
    assert (4, True) in kept and (5, False) in kept and (10, False) in kept and (1, True) in kept and (2, True) in kept
    assert M.cluster(df.limit(0)).count() == 0


def test_candidates_of_near_copies_grow_with_the_group(spark):
    made = []
    for n in (300, 900):
        rng = random.Random(1)
        base = [f"b{i}" for i in range(200)]
        rows = [(0, " ".join(base))] + [(i, " ".join([*edited(rng, base, 0.01), f"own{i}"])) for i in range(1, n)]
        df = spark.createDataFrame(rows, "id long, text string")
        sets = M.materialise(spark, M.shingle_sets(df).withColumnRenamed("id", "node"), "sets")
        lists = M.materialise(spark, M.inverted_lists(sets, 64, 80), "lists")
        stars = M.star_pairs(lists, 80)
        found = M.links(sets, lambda nodes: sets.join(nodes, "node"))
        made.append((stars.count(), found.count()))
        linked = M.connected_components(found, "a", "b")
        assert linked.count() == n and linked.select("root").distinct().count() == 1
    assert made[1][0] < 4 * made[0][0] and made[1][1] < 4 * made[0][1]  # three times the group


def test_crowded_lists_in_blocks(spark):
    rng = random.Random(8)
    hashes = {i: sorted(rng.sample(range(2**40), 90)) for i in range(6)}
    sets = [(i, 90, sorted(hashes[i % 6][: 90 - i // 30] + rng.sample(range(2**40), i // 30))) for i in range(60)]
    crowded = spark.createDataFrame([(7, i, 90, i % 4, 60) for i in range(60)], "v long, node long, n long, root long, size long")
    frame = spark.createDataFrame(sets, "node long, n long, hashes array<bigint>")
    for block in (8, 100):
        got = [(r["a"], r["b"]) for r in M.crowded_pairs(crowded, frame, block, 80, 128).collect()]
        want = {(i, j) for i in range(60) for j in range(i + 1, 60) if i % 4 != j % 4 and i % 6 == j % 6}
        assert len(got) == len(want) and set(got) == want


def test_bound_and_hashes():
    from math import comb

    for k in (16, 64, 1024):
        c = M.needed_overlap(k, 80)
        assert sum(comb(k, i) * 0.8**i * 0.2 ** (k - i) for i in range(c)) <= 1e-10
    assert M.needed_overlap(64, 80) >= 26
    known = M.WordHashes()
    rng = random.Random(0)
    words = [f"w{rng.randrange(30)}" for _ in range(20_000)]
    hashes = M.shingle_hashes(" ".join(words).encode(), 4, known)
    assert len(hashes) == len(shingles(" ".join(words))) and (np.diff(hashes) > 0).all()
    assert abs((hashes < 0).mean() - 0.5) < 0.02
    assert len({M.shingle_hashes(t, 4, known).tobytes() for t in (b"a b c", b"a b", b"b a", b"a", b"a b c a")}) == 5


def test_registered_query_equals_its_sql(spark, small_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    want = sorted(con.sql(queries.oracle_sql()["op11_minhash_dedup"]).fetchall())
    df = queries.queries()["op11_minhash_dedup"](spark, small_dir)
    assert sorted(tuple(r) for r in df.collect()) == want
    assert df.where(F.col("component_id") != F.col("doc_id")).count() > 5


@pytest.mark.parametrize("most", [1 << 27, 1 << 15])
def test_filter_keeps_every_wanted_key_and_few_others(spark, most):
    from hearth.llm.common import likely_among

    rows = spark.range(40_000).select("id", F.concat(F.lit("k"), F.col("id")).alias("row"))
    wanted = rows.where("id % 10 = 0").select("row")
    kept = {r["id"] for r in likely_among(rows.unionByName(rows.where("id < 20")), wanted, "row", most).collect()}
    assert kept >= set(range(0, 40_000, 10))
    assert len(kept) < (7_000 if most > 1 << 15 else 12_000)
    assert likely_among(rows, wanted.limit(0), "row").count() == 0
    assert likely_among(rows.where("id < 10").unionByName(rows.where("id < 10")), wanted, "row").count() == 2


def test_texts_that_meet_nobody_are_not_exchanged(spark, monkeypatch):
    """Whole sets are hashed again from the few texts that need them; the others stay where they are."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(60))) for i in range(400)]
    rows += [(500 + i, rows[i][1] + " tail") for i in range(10)] + [(500, rows[0][1] + " tail")]
    plans = []

    def watched(df, *args, **kw):
        if "node" in df.columns and "text" in df.columns:
            plans.append(df.select("text").distinct().count())
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return shingle_sets(df, *args, **kw)

    shingle_sets = M.shingle_sets
    monkeypatch.setattr(M, "shingle_sets", watched)
    assert answer(spark, rows) == sorted(brute(rows), key=repr)
    assert plans[0] == 20 and "bitmap" in plans[1]
