import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hearth.llm import queries
from hearth.llm import suffix_dedup as D

LENGTH = 80


def brute(texts, length):
    seen = {}
    for t in texts:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for t in texts:
        b = (t or "").encode()
        spans = D.removed_spans([(p, 1) for p in range(len(b) - length + 1) if seen[b[p : p + length]] > 1], length)
        edges = [0, *(x for s in spans for x in s), len(b)]
        out.append((len(b), spans, b"".join(b[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))))
    return out


def corpus(seed):
    rng = random.Random(seed)
    rand = lambda n, alphabet="abcdeé ": "".join(rng.choice(alphabet) for _ in range(n))
    shared = [rand(rng.randint(60, 400)) for _ in range(6)]
    texts = [rand(rng.randint(0, 300)) for _ in range(10)]
    for _ in range(40):
        parts = [rand(rng.randint(0, 150)) for _ in range(3)]
        s = rng.choice(shared)
        cut = rng.randint(0, len(s) // 3)
        parts.insert(rng.randint(0, 3), s[cut : len(s) - rng.randint(0, len(s) // 3)])
        texts.append("".join(parts))
    texts += [shared[0] * 3, texts[-1], texts[-1] + "x", "a" * 500, "ab" * 200, "b" + "a" * 130, None, "", rand(79), rand(80, "z")]
    return texts


def check(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, A string")
    rows = sorted(D.remove_repeats(df, length=LENGTH, **options).collect(), key=lambda r: r["doc_id"])
    assert [r["A"] for r in rows] == ["e"] * len(texts)
    got = [(r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in rows]
    expected = brute(texts, LENGTH)
    assert got == expected
    return expected


@pytest.mark.parametrize("seed", [0, 1])
def test_matches_brute_force(spark, seed):
    expected = check(spark, corpus(seed))
    assert sum(0 < len(k) < n for n, _, k in expected) > 10


def test_hot_passage_over_salted_groups(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh") for _ in range(200))
    texts = ["".join(rng.choice("klmnop") for _ in range(rng.randint(80, 160))) + passage[rng.randint(0, 40) : 200 - rng.randint(0, 40)] + "".join(rng.choice("qrstuv") for _ in range(90)) for _ in range(60)]
    check(spark, texts, group=4)


def test_small_pieces_and_batches(spark, monkeypatch):
    """Long texts are cut into pieces, and groups into bounded batches, without a change of the result."""
    texts = corpus(3)
    texts.append("".join(t or "" for t in texts) + "tail")
    whole = brute(texts, LENGTH)
    finder = D.AnchorFinder(LENGTH)
    monkeypatch.setattr(D, "PIECE", 333)
    raw = [(t or "").encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    seen = {}
    for which, p, n, *_ in finder.find(np.frombuffer(b"".join(raw), np.uint8), offsets):
        for w, a, c in zip(which, p, n, strict=True):
            for i in range(a, a + c):
                seen[w, i] = seen.get((w, i), 0) + 1
    assert seen == {(t, i): 1 for t, b in enumerate(raw) for i in range(len(b) - LENGTH + 1)}
    assert len(whole) == len(texts)


def test_suffix_order_is_the_sorted_order():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, (300, 40), dtype=np.uint8)
    lengths = rng.integers(0, 41, 300)
    data[np.arange(40) >= lengths[:, None]] = 0
    groups = np.sort(rng.integers(0, 5, 300))
    order, ext = D.sort_suffixes(data, lengths, groups)
    key = lambda i: (groups[i], data[i, : lengths[i]].tobytes())
    assert [key(i) for i in order] == sorted(key(i) for i in range(300))
    for a, b, e in zip(order[:-1], order[1:], ext[1:], strict=True):
        x, y = key(a)[1], key(b)[1]
        common = next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        assert e == (common if groups[a] == groups[b] else -1)


def test_lying_hashes_are_noticed(monkeypatch):
    data = np.frombuffer(b"abcdabcexyzw", np.uint8).reshape(3, 4).copy()
    sums = D.Suffixes(data, np.full(3, 4), np.zeros(3, int), 5)
    sums.sums[1] = sums.sums[0]  # claims that rows 0 and 1 are equal
    assert sums.verified() is None


def test_empty_table(spark):
    assert D.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows_are_each_others_repeats(spark):
    long = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(200))
    rows = spark.createDataFrame([(1, long), (1, long), (None, "short")], "doc_id long, text string")
    assert sorted(len(r["kept"]) for r in D.remove_repeats(rows).collect()) == [0, 0, 5]


def test_many_equal_rows_stay_linear(spark):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghij ") for _ in range(1500))
    rows = [(1, text)] * 5000 + [(2, text[:700] + "Z" * 50), (3, "y" * 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_bytes"], len(r["kept"])) for r in D.remove_repeats(df, length=LENGTH).collect()}
    assert got == {(1, 1500, 0), (2, 750, 50), (3, 70, 70)}


def brute_words(texts, words):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    seen = Counter(tuple(w[p : p + words]) for w in split for p in range(len(w) - words + 1))
    covered = [{p + i for p in range(len(w) - words + 1) if seen[tuple(w[p : p + words])] > 1 for i in range(words)} for w in split]
    return [len(c) for c in covered]


@pytest.mark.parametrize("piece", [D.PIECE, 16])
def test_word_codes_are_equal_for_equal_words(monkeypatch, piece):
    monkeypatch.setattr(D, "PIECE", piece)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abé \t\n.") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", " ", "a", "aé " * 3, "x" * 4000 + " y " + "x" * 4000]
    codes, offsets = D.word_codes(pa.array(texts, pa.string()))
    of_word = {}
    for i, t in enumerate(texts):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        found = codes[offsets[i] : offsets[i + 1]].view(np.uint32).tolist()
        assert len(found) == len(words)
        assert all(of_word.setdefault(w, c) == c for w, c in zip(words, found, strict=True))
    assert len(set(of_word.values())) == len(of_word) > 300
    rest, _ = D.word_codes(pa.array(texts, pa.string())[5:])
    assert (rest == codes[offsets[5] :]).all()


def test_passages_of_words_under_the_byte_length(spark):
    rng = random.Random(8)
    some = lambda n: [rng.choice("éab") + str(rng.randint(0, 999)) for _ in range(n)]
    passages = [some(60), some(51), some(50), ["é"] * 53]
    texts = [" ".join(some(rng.randint(0, 40)) + passages[i % 4] + some(rng.randint(0, 40))) for i in range(24)]
    texts = [t.replace(" ", "\n \t") if i % 5 == 0 else t for i, t in enumerate(texts)]  # blanks are not compared
    texts += [" ".join(some(70)) for _ in range(6)] + ["b " * 90, texts[3], None, "", " ", "x" * 300, " ".join(passages[0])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(D.remove_repeats(df, length=400, words=51).collect(), key=lambda r: r["doc_id"])
    expected = brute_words(texts, 51)
    assert [r["n_repeated_words"] for r in rows] == expected
    assert expected[0] == 60 and expected[1] == 51 and expected[2] == 0 and expected[24:30] == [0] * 6
    whole = brute(texts, 400)
    assert [(r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in rows] == whole
    assert sum(e > 0 and not s for e, (_, s, _) in zip(expected, whole, strict=True)) > 5  # seen, though nothing has to go


def test_passages_of_words_over_salted_groups(spark):
    rng = random.Random(9)
    passage = [f"p{rng.randint(0, 99)}" for _ in range(90)]
    texts = [" ".join([f"k{rng.randint(0, 99)}" for _ in range(20)] + passage[rng.randint(0, 25) : 90 - rng.randint(0, 25)] + [f"q{rng.randint(0, 99)}" for _ in range(20)]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(D.remove_repeats(df, length=400, group=4, words=51).collect(), key=lambda r: r["doc_id"])
    assert [r["n_repeated_words"] for r in rows] == brute_words(texts, 51)


def test_too_few_words_are_refused(spark):
    with pytest.raises(ValueError, match="words"):
        D.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), words=16)


def test_query_reports_passages_of_over_50_words(spark, tmp_path):
    passage = " ".join(f"w{i}" for i in range(55))  # 219 bytes: stays, by the contract
    rows = [(1, f"one {passage} here"), (2, f"two {passage}"), (3, " ".join(f"v{i}" for i in range(80))), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: (r["n_removed"], r["n_repeated_words"]) for r in queries.op3_suffix_dedup(spark, str(tmp_path)).collect()}
    assert found == {1: (0, 55), 2: (0, 55), 3: (0, 0), 4: (0, 0)}
