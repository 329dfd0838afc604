import math
from collections import Counter

from pyspark.sql import functions as F

from hearth.llm import sharding as S


def test_draws_follow_the_hypergeometric_law(spark):
    draws = 4000
    for good, bad, sample in ((5, 7, 4), (300, 500, 200)):
        value = S.hypergeometric(F.lit(float(good)), F.lit(float(bad)), F.lit(float(sample)), F.col("id"))
        seen = Counter({int(r["x"]): r["count"] for r in spark.range(draws).select(value.alias("x")).groupBy("x").count().collect()})
        chi, cells = 0.0, 0
        for k in range(max(0, sample - bad), min(good, sample) + 1):
            expected = draws * math.comb(good, k) * math.comb(bad, sample - k) / math.comb(good + bad, sample)
            if expected >= 5:
                chi, cells = chi + (seen[k] - expected) ** 2 / expected, cells + 1
        assert sum(seen.values()) == draws and all(max(0, sample - bad) <= k <= min(good, sample) for k in seen)
        assert chi < cells + 5 * math.sqrt(2 * cells)


def test_degenerate_draws(spark):
    cases = [(0.0, 5.0, 3.0, 0.0), (5.0, 0.0, 3.0, 3.0), (4.0, 6.0, 10.0, 4.0), (4.0, 6.0, 0.0, 0.0), (1.0, 0.0, 1.0, 1.0)]
    row = spark.range(1).select(*[S.hypergeometric(F.lit(a), F.lit(b), F.lit(c)).alias(f"c{i}") for i, (a, b, c, _) in enumerate(cases)]).first()
    assert list(row) == [e for *_, e in cases]


def test_matrix_has_the_given_margins(spark):
    sizes = [3, 0, 40, 17, 5]
    caps = [10, 0, 20, 20, 15]
    blocks = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n], "block int, n long")
    rows = S.communication_matrix(blocks, len(sizes), F.array(*[F.lit(float(c)) for c in caps]), 3).collect()
    matrix = {r["block"]: list(r["caps"]) for r in rows}
    assert [sum(matrix[b]) for b in range(5)] == sizes
    assert [sum(matrix[b][c] for b in range(5)) for c in range(5)] == caps
    assert min(min(r) for r in matrix.values()) >= 0


def test_shards_are_exact_and_gapless(spark):
    df = spark.range(1003).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit("x").alias("Slot"))
    for block_rows in (8192, 90):
        rows = S.shard(df, 8, block_rows=block_rows).collect()
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert sorted(map(len, slots.values())) == [125] * 5 + [126] * 3
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert sorted(r["doc_id"] for r in rows) == list(range(1003))
        again = {(r["doc_id"], r["shard"], r["slot"]) for r in S.shard(df.repartition(7), 8, block_rows=block_rows).collect()}
        assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in rows}
    # neither shard nor slot follows the order of the input
    xs = [(r["doc_id"], r["shard"] * 126 + r["slot"]) for r in rows]
    mean = [sum(v) / len(xs) for v in zip(*xs, strict=True)]
    cov = sum((a - mean[0]) * (b - mean[1]) for a, b in xs) / len(xs)
    assert abs(cov) / (1003**2 / 12) < 0.1


def test_every_block_reaches_every_shard_evenly(spark):
    """Rows of one block spread like a random permutation: chi-square of shard by quarter of the ids."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    seen = Counter((r["doc_id"] // 1000, r["shard"]) for r in S.shard(df, 8, block_rows=300).collect())
    chi = sum((seen[q, s] - 125) ** 2 / 125 for q in range(4) for s in range(8))
    assert chi < 60  # 21 degrees of freedom


def test_nulls_repeats_and_few_rows(spark):
    rows = [(None, None), (1, "a"), (1, "a"), (2, ""), (None, None)]
    out = S.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    assert len(out) == 5 and sorted(r["slot"] for r in out) == [0] * 5 and len({r["shard"] for r in out}) == 5
    empty = S.shard(spark.createDataFrame([], "doc_id long, text string"), 8)
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "slot", "shard"]


def test_equal_rows_are_spread(spark):
    df = spark.range(300).select((F.col("id") % 100).alias("doc_id"), F.lit("t").alias("text"))
    shards = {}
    for r in S.shard(df, 8).collect():
        shards.setdefault(r["doc_id"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) > 80


def test_text_size(spark):
    row = spark.createDataFrame([("é",), ("",), (None,)], "t string").select(S.text_size(F.col("t"))).collect()
    assert [r[0] for r in row] == [3, 1, 1]
