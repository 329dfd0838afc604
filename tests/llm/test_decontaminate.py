import random

from pyspark.sql import functions as F

from hearth.llm import decontaminate as D


def brute(text, items, window):
    words = D.words_of((text or "").encode())
    hit, found = set(), set()
    for name, item in items:
        w = D.words_of((item or "").encode())
        n = min(window, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(name)
    return len(words), len(hit), sorted(found)


def data(seed, n_docs=80, n_items=25, vocabulary=6):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijkl"[:vocabulary])
    items = [(f"i{k}", " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 12])))) for k in range(n_items)]
    docs = []
    for i in range(n_docs):
        words = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            words[3:3] = rng.choice(items)[1].upper().split()
        docs.append((i, rng.choice([" ", "--", "\n"]).join(words)))
    return docs, items


def check(spark, docs, items, window, group_words):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = D.scan(df, bench, window=window, group_words=group_words).withColumn("n_hit", D.hit_words()).collect()
    text = dict(docs)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in rows}
    assert got == {i: brute(t, items, window) for i, t in text.items()}
    for r in rows:
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_matches_brute_force(spark):
    for seed in range(3):
        docs, items = data(seed)
        check(spark, docs, items, 4, 200_000)


def test_groups_of_items_give_the_same(spark):
    docs, items = data(7, vocabulary=4)
    check(spark, docs, items, 3, 20)


def test_edge_cases(spark):
    items = [("a", "one two three"), ("b", None), ("c", "..."), ("d", "Élan vital 42"), ("e", "x " * 40), ("a", "one two three")]
    docs = [(0, None), (1, ""), (2, "One, TWO; three!"), (3, "élan vital 42"), (4, "Élan vital 42"), (5, "x " * 50000), (6, "one two"), (7, "one two one two three")]
    check(spark, docs, items, 13, 200_000)


def test_short_items_of_one_name_that_end_alike(spark):
    docs = [(0, "x b c"), (1, "a b c"), (2, "x c"), (3, "b c a b c"), (4, "c")]
    for name in ("i", None):
        items = [(name, "a b c"), (name, "c"), (name, "d e"), ("j", "e")]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        bench = spark.createDataFrame(items, "item_id string, text string")
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in D.scan(df, bench).withColumn("n_hit", D.hit_words()).collect()}
        assert got == {i: brute(t, [(n or "", w) for n, w in items], 13) for i, t in docs}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = D.scan(docs, none).first()
    assert (row["n_words"], row["spans"], row["items"]) == (2, [], [])
    assert D.scan(docs.limit(0), none).count() == 0


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b c d", "mine", 5)], "doc_id long, text string, Spans string, n_words int")
    row = D.scan(docs, spark.createDataFrame([(1, "b c")], "item_id long, text string")).first()
    assert row["n_words"] == 4 and [tuple(s) for s in row["spans"]] == [(1, 3)]


def test_remove_spans(spark):
    bench = spark.createDataFrame([(1, "the secret question")], "item_id long, text string")
    clean = " ".join(["fine"] * 100)
    docs = spark.createDataFrame([(1, f"{clean}, The Secret, question; end"), (2, "the secret question"), (3, clean), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in D.remove_spans(docs, bench).collect()}
    assert got == {1: f"{clean}, ; end", 3: clean, 4: None}


def test_contamination_rule(spark):
    row = spark.range(1).select(*[D.contaminated(F.lit(a), F.lit(b)).alias(f"{a}_{b}") for a, b in ((0, 0), (1, 20), (1, 21), (13, 100))]).first()
    assert list(row) == [False, True, False, True]


def test_items_of_one_repeated_word_are_marked_in_linear_time():
    import time

    start = time.process_time()
    built = D.ItemAutomaton.build([("long", b"la " * 100_000), ("short", b"la la la"), ("other", b"x la la")], 13)
    assert time.process_time() - start < 20
    spans, items = built.scan([b"y"] + [b"la"] * 40)
    assert spans == [(1, 41)] and items == {"long", "short"}
    assert built.scan([b"x", b"la", b"la", b"y"]) == ([(0, 3)], {"other"})


def test_cut_texts_renew_their_length(spark):
    item = " ".join(f"w{i}" for i in range(20))
    clean = " ".join(f"c{i}" for i in range(1000))
    docs = spark.createDataFrame([(1, f"{clean} {item} end", 5, "x"), (2, item, 5, "x"), (3, None, 5, "x"), (4, clean, 5, "x"), (5, "", 0, "x")], "doc_id long, text string, n_chars int, spans string")
    items = spark.createDataFrame([("a", item), ("b", None)], "item_id string, text string")
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["spans"]) for r in D.remove_spans(docs, items, chars_col="n_chars").collect()}
    assert got == {1: (f"{clean}  end", len(clean) + 5, "x"), 3: (None, 5, "x"), 4: (clean, 5, "x"), 5: ("", 0, "x")}
