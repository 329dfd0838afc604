import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hearth.llm import mixing as M


def brute_targets(sizes, weights, cap):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        free -= over
    return target


SIZES = [{"b": 100, "a": 100, "c": 100}, {"a": 1, "b": 1000, "c": 50, "d": 2, "é": 700, None: 300, "Z": 5}, {"x": 10}, {"a": 0, "b": 10}, {"a": 4, "b": 4, "c": 4000, "d": 4}]


@pytest.mark.parametrize("sizes", SIZES)
def test_targets_match_repeated_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in M.source_targets(df, (5.0, 2.0, 1.0), 3.0).collect()}
    expected = brute_targets(sizes, (5.0, 2.0, 1.0), 3)
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[s], expected[s], rel_tol=1e-9, abs_tol=1e-9) for s in got)


def solve(sizes, target, cap):
    """Rates by bisection of the dual."""
    mean = sum(s * s for s in sizes) / sum(sizes)
    lo, hi = -500.0, 500.0
    for _ in range(200):
        lam = (lo + hi) / 2
        got = sum(s * min(cap, math.exp(min(50, lam * s / mean))) for s in sizes)
        lo, hi = (lam, hi) if got < target else (lo, lam)
    return [min(cap, math.exp(min(50, lam * s / mean))) for s in sizes]


def documents(spark):
    rows = []
    for i in range(400):
        source = ["s0", "s1", "s2", None][i % 4 if i % 3 else 0]
        rows.append((i, " ".join(["w"] * (i * 37 % 211)), source))
    return spark.createDataFrame([*rows, (1000, None, "s1"), (1001, "", "s9"), (7, "same row", "s2"), (7, "same row", "s2"), (None, " x y", "s0")], "doc_id long, text string, source string")


def test_rates_solve_the_dual_and_copies_meet_the_targets(spark):
    rows = M.mix(documents(spark)).collect()
    assert len(rows) == 405
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert 0 <= r["copies"] <= 3 and abs(r["copies"] - r["rate"]) < 1
    expected = brute_targets({s: sum(r["size"] for r in rs) for s, rs in by.items()}, (5.0, 2.0, 1.0), 3)
    for source, rs in by.items():
        assert all(math.isclose(r["target"], expected[source], rel_tol=1e-9) for r in rs)
        filled = [r for r in rs if r["size"]]
        if not filled:
            continue
        assert math.isclose(sum(r["size"] * r["rate"] for r in filled), expected[source], rel_tol=1e-6)
        rates = solve([r["size"] for r in filled], expected[source], 3.0)
        if expected[source] < 2.999 * sum(r["size"] for r in rs):
            assert all(math.isclose(a, r["rate"], rel_tol=1e-5) for a, r in zip(rates, filled, strict=True))
        taken = sum(r["size"] * r["copies"] for r in filled)
        assert abs(taken - expected[source]) <= max(r["size"] for r in filled)


def test_reruns_agree_whatever_the_partitions(spark):
    key = lambda rows: sorted((str(r["id"]), r["size"], r["copies"]) for r in rows)
    df = documents(spark)
    assert key(M.mix(df).collect()) == key(M.mix(df.repartition(5, F.rand(1))).collect())


def test_large_groups_are_cut_into_buckets(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 10)
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), (F.col("id") % 2).cast("string").alias("source"))
    taken = M.mix(df).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")), F.first("target")).collect()
    assert all(abs(r[1] - r[2]) <= 3 for r in taken)


def test_word_count(spark):
    texts = ["a b", " a\tb\x0b\x0c\r\nc ", "", None, "   ", "   x", "\x1cq"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", M.word_count(F.col("t")).alias("n"))
    assert [r["n"] for r in df.sort("i").collect()] == [2, 3, 0, 0, 0, 2, 1]


def test_mixed_documents_repeat_rows(spark):
    df = documents(spark).withColumn("rate", F.lit("mine"))
    plan = {}
    for r in M.mix(df).collect():
        plan[r["id"]] = plan.get(r["id"], 0) + r["copies"]
    out = M.mixed_documents(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in plan.items() if n}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(df).count() == 0 and M.mixed_documents(df).count() == 0
