import hashlib
import random
import time
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import period_runs as R
from hearth.llm import queries


def brute(words, min_length=6, exponent=4):
    """Every diagonal in full; a stretch counts if no smaller lag has the same one."""
    known = {}
    w = np.array([known.setdefault(x, len(known)) for x in words], dtype=np.int64)
    n, best = len(w), {}
    for q in range(1, n // exponent + 1):
        equal = np.concatenate([[False], w[:-q] == w[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + q >= max(min_length, exponent * q):
                best.setdefault((a, b - a + q), q)
    return sorted(((a, length, q) for (a, length), q in best.items()), key=lambda r: (r[0], r[2]))


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i - q] for i in range(q, len(words))))


def dropped(n, runs):
    gone = np.zeros(n, dtype=bool)
    for s, length, q in runs:
        gone[s + q : s + length] = True
    return gone


def found(words, **kw):
    return [tuple(r) for r in R.find_runs([words], **kw)[0].tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=5), st.sampled_from([2, 3, 4, 5]))
def test_runs_match_brute_force(docs, exponent):
    got = R.find_runs(docs, 6, exponent)
    assert len(got) == len(docs)
    for words, runs in zip(docs, got, strict=True):
        assert [tuple(r) for r in runs.tolist()] == brute(words, 6, exponent)


def test_planted_repeats_of_every_period():
    rng = random.Random(3)
    docs = []
    for _ in range(200):
        out = []
        for _ in range(rng.randint(1, 4)):
            out += [b"x%d" % rng.randrange(40) for _ in range(rng.randint(0, 30))]
            block = [b"p%d" % rng.randrange(4) for _ in range(rng.randint(1, 40))]
            out += (block * 12)[: int(len(block) * rng.uniform(2, 9))]
        docs.append(out)
    for words, runs in zip(docs, R.find_runs(docs), strict=True):
        runs = [tuple(r) for r in runs.tolist()]
        assert runs == brute(words)
        assert all(smallest_period(words[s : s + n]) == q for s, n, q in runs)


def test_nested_runs_and_hidden_seeds():
    inner = [b"a"] * 8 + [b"b"]
    assert found(inner * 5) == brute(inner * 5)  # runs of a inside a run of period 9
    twice = [b"u%d" % i for i in range(6)]
    block = [*twice, b"x", *twice, b"y"]  # every short gram of the block occurs twice in it
    assert (0, 14 * 4, 14) in found(block * 4)
    assert found(block * 4) == brute(block * 4)


def test_extreme_documents_stay_fast():
    t = time.time()
    assert found([b"a"] * 300_000) == [(0, 300_000, 1)]
    block = [b"w%d" % (i * i % 977) for i in range(977)]
    assert found(block * 300)[-1][1:] == (977 * 300, smallest_period(block * 4))
    fib = [b"a", b"ab"]
    while len(fib[-1]) < 50_000:
        fib.append(fib[-1] + fib[-2])
    assert found([fib[-1][i : i + 1] for i in range(3000)]) == brute([fib[-1][i : i + 1] for i in range(3000)])
    found([fib[-1][i : i + 1] for i in range(50_000)])
    assert time.time() - t < 60


def test_rejects_small_exponents():
    with pytest.raises(ValueError):
        R.find_runs([[b"a"]], 6, 1)


def test_operator_edges(spark):
    rows = [
        (1, None, "k"), (2, "", "k"), (3, " \n\t", "k"), (4, "x " * 6, "k"), (4, "x " * 6, "k"), (None, "y y y y y", "k"),
        (5, "é ü " * 5000 + "end", "k"), (6, "A a A a A a A a", None), (7, "b b " * 7, "k"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, RUNS string")
    got = R.collapse_runs(df).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["n_words"]): r for r in got}
    assert all(by[i, 0]["collapsed"] == "" and by[i, 0]["runs"] == [] for i in (1, 2, 3))
    assert by[4, 6]["collapsed"] == "x" and [tuple(r) for r in by[4, 6]["runs"]] == [(0, 6, 1)]
    assert sum(r["doc_id"] == 4 for r in got) == 2
    assert by[None, 5]["runs"] == []
    assert by[5, 10001]["collapsed"] == "é ü end"
    assert by[6, 8]["collapsed"] == "A a"
    assert by[7, 7]["collapsed"] == "b b"
    assert R.collapse_runs(df.limit(0)).columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert R.collapse_runs(df.limit(0)).count() == 0


def test_registered_query_against_brute_force(spark, small_dir):
    got = {r["doc_id"]: r for r in queries.queries()["op12_periodic_runs"](spark, small_dir).collect()}
    docs = pq.read_table(f"{small_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = (d["text"] or "").encode().split()
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute(words)
        r = got[d["doc_id"]]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        kept = b" ".join(w for w, x in zip(words, dropped(n, runs), strict=True) if not x)
        assert r["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
    assert planted > 5
