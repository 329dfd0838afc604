import numpy as np
import pytest

from hearth.llm import multi_index as M


def brute(rows, k, is_query):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, v in ok:
        if is_query(q):
            near = sorted((-float(M.cosine(v[None], w[None])[0]), i) for i, w in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def rows(n=300, seed=0):
    rng = np.random.default_rng(seed)
    out = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(n)]
    hot = out[7][1]
    out += [(1000 + i, list(hot)) for i in range(60)]  # a hot vector: ties
    out += [(2000, None), (2005, [0.0] * 8), (2010, [1.0] * 7), (2015, [float("nan")] + [1.0] * 7), (2020, [None] + [1.0] * 7), (2025, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (2030, [1e200] * 8), (2035, [1e-200] * 8)]
    return out


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("blocks", [(8192, 2048), (40, 16)])
def test_scanning_everything_is_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(M, "ENTRY_BLOCK", blocks[0])
    monkeypatch.setattr(M, "QUERY_BLOCK", blocks[1])
    data = rows()
    df = spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA)
    got = sorted(tuple(r) for r in M.search(df, lambda i: i % 5 == 0, k=5, dim=8, centroids=6, scan=1.0).collect())
    want = brute(data, 5, lambda i: i % 5 == 0)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-15)


def test_cells_come_in_order_of_summed_distance():
    rng = np.random.default_rng(1)
    index = M.MultiIndex(8, rng.normal(size=(5, 4)), rng.normal(size=(7, 4)))
    q = rng.normal(size=(3, 8))
    sizes = rng.integers(0, 3, (5, 7))
    u = M.unit(q)
    for row, cells in enumerate(index.visit(q, sizes, sizes.sum())):
        d = [((u[row, :4] - index.first[a]) ** 2).sum() + ((u[row, 4:] - index.second[b]) ** 2).sum() for a, b in cells]
        assert d == sorted(d) and set(cells) == {(a, b) for a in range(5) for b in range(7) if sizes[a, b]}


def test_fewer_candidates_than_asked_and_empty(spark):
    two = spark.createDataFrame([(0, [1.0] * 8, 0), (3, [1.0, 2.0] * 4, 0)], SCHEMA)
    got = M.search(two, lambda i: i % 2 == 0, k=5, dim=8, centroids=4).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 3)]
    assert M.search(two.limit(0), lambda i: i % 2 == 0, dim=8).count() == 0


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows_ = table.select("vec_id", "embedding").collect()
    ids, v = np.array([r[0] for r in rows_]), np.array([r[1] for r in rows_], float)
    u = M.unit(v)
    got = {}
    for r in M.search(table, lambda i: i % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = u @ u[q]
        s[q] = -2
        hits += len(got[ids[q]] & set(ids[np.lexsort((ids, -s))[:5]].tolist()))
    assert hits / (5 * len(got)) >= 0.9


def test_width_comes_from_the_table(spark):
    rng = np.random.default_rng(3)
    for dim in (1, 3, 32):
        data = [(i, [float(x) for x in rng.normal(size=dim)], 0) for i in range(200)] + [(300, None, 0), (305, [0.0] * 7, 0)]
        got = M.search(spark.createDataFrame(data, SCHEMA), lambda i: i % 50 == 0, scan=1.0, centroids=4).collect()
        near = lambda q: sorted((-float(M.cosine(np.array([data[q][1]]), np.array([v]))[0]), i) for i, v, _ in data[:200] if i != q)[:5]  # noqa: B023,E731
        assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(q, k + 1, i) for q in (0, 50, 100, 150) for k, (_, i) in enumerate(near(q))]
    mixed = spark.createDataFrame([(0, [1.0] * 8, 0), (1, [1.0] * 9, 0)], SCHEMA)
    with pytest.raises(ValueError, match="8 to 9"):
        M.search(mixed, lambda i: i % 50 == 0)
    assert M.search(mixed.limit(0), lambda i: i % 50 == 0).count() == 0
