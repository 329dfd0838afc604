import math
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from hearth.llm import lang_ppm as P

SAMPLES = {
    "en": ["the quick brown fox jumps over the lazy dog and the cat", "this is the house that she has built with the others"],
    "fr": ["le renard brun saute par dessus le chien paresseux et le chat", "c'est la maison que nous avons vue hier avec les autres"],
    "de": ["der schnelle braune fuchs springt über den faulen hund und die katze", "das ist das haus, das wir mit den anderen gesehen haben"],
}


def brute_bits(text, training, order):
    """PPM code length by explicit context counts, one byte at a time."""
    counts = defaultdict(lambda: defaultdict(int))
    for t in training:
        b = bytes(order) + t.lower().encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                counts[b[i - k : i]][b[i]] += 1
    total, b = 0.0, bytes(order) + text.lower().encode()
    for i in range(order, len(b)):
        for k in range(order, -1, -1):
            seen = counts.get(b[i - k : i])
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if b[i] in seen:
                total += math.log2(whole / seen[b[i]])
                break
            total += math.log2(whole / len(seen))
        else:
            total += 8.0
    return total


def model(spark, order=3):
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in SAMPLES.items() for t in ts)]
    return P.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), order=order)


def test_code_lengths_are_those_of_the_context_trees(spark):
    m = model(spark)
    texts = ["the dog", "über die brücke", "zq§%", "", "Le CHAT et la maison " * 20]
    raw = [t.lower().encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    got = m.text_bits(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for row, text in zip(got, texts, strict=True):
        for label, bits in zip(m.labels, row, strict=True):
            assert math.isclose(bits, brute_bits(text, SAMPLES[label], 3), rel_tol=1e-5, abs_tol=1e-4)


def test_blocks_do_not_change_code_lengths(spark, monkeypatch):
    m = model(spark)
    raw = " ".join(t for ts in SAMPLES.values() for t in ts).encode()
    offsets = np.array([0, 3, 3, 50, len(raw)])
    whole = m.text_bits(np.frombuffer(raw, np.uint8), offsets)
    monkeypatch.setattr(P, "BLOCK", 7)
    assert np.allclose(m.text_bits(np.frombuffer(raw, np.uint8), offsets), whole)


def test_predictions_and_edges(spark):
    rows = [(1, "the house and the dog", "zz"), (2, "la maison et le chien", None), (3, "das haus und der hund", "en"), (4, None, "en"), (5, "", "fr"), (6, "12 34 !", "de"), (1, "THE HOUSE AND THE DOG", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Score string")
    out = P.identify(df, model(spark)).collect()
    got = [(r["doc_id"], r["lang_pred"]) for r in out]
    assert sorted(got) == [(1, "en"), (1, "en"), (2, "fr"), (3, "de"), (4, "und"), (5, "und"), (6, "und")]
    assert all(0 <= r["score"] <= 1 for r in out)
    assert [r["text"] for r in out if r["doc_id"] == 4] == [None]


def test_without_labels_everything_is_undetermined(spark):
    none = spark.createDataFrame([(1, None, "en"), (2, "text", None)], "doc_id long, text string, lang string")
    m = P.train(none)
    assert [r["lang_pred"] for r in P.identify(none, m).collect()] == ["und", "und"]
    assert P.identify(none.limit(0), m).count() == 0


def test_pieces_count_what_whole_texts_do(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE", 7)
    test_code_lengths_are_those_of_the_context_trees(spark)
    monkeypatch.setattr(P, "PIECE", 2)  # shorter than the context
    test_code_lengths_are_those_of_the_context_trees(spark)


def test_every_label_is_learned_from_few_very_long_texts(spark):
    rng = np.random.default_rng(3)
    words = {lang: [w for t in ts for w in t.split()] for lang, ts in SAMPLES.items()}
    long = [(lang, " ".join(rng.choice(words[lang], 60_000))) for lang in SAMPLES for _ in range(2)]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(long)], "doc_id long, text string, lang string")
    for budget in (30_000, 30):  # a share of several pieces, and of less than one
        labels, pieces = P.training_pieces(df, "text", "lang", 4, budget)
        got = {r["label"]: r["n"] for r in pieces.groupBy("label").agg(F.sum(F.octet_length("raw") - F.col("lead")).alias("n")).collect()}
        assert labels == sorted(SAMPLES) == sorted(got)
        assert all(0 < n <= 3 * max(budget / 3, P.PIECE) for n in got.values())
    found = P.identify(df, P.train(df, train_bytes=30_000)).select("lang", "lang_pred", "bits_per_byte").collect()
    assert all(r["lang"] == r["lang_pred"] and r["bits_per_byte"] < 4 for r in found)


def test_repeated_texts_count_once_and_labels_without_text_are_not_learned(spark):
    rows = [("en", "one repeated text " * 50)] * 500 + [("en", f"another text {i}") for i in range(20)] + [("fr", "un texte"), ("de", "")]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    labels, pieces = P.training_pieces(df, "text", "lang", 4, 100_000)
    assert labels == ["en", "fr"]
    got = sorted((r["label"], bytes(r["raw"]).decode()) for r in pieces.collect())
    assert got == sorted({(lang, t) for lang, t in rows if t})


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = P.train(docs.where(~P.held_out()))
    scored = P.identify(docs.where(P.held_out()), m).withColumn("ok", (F.col("lang") == F.col("lang_pred")).cast("double"))
    row = scored.agg(F.avg("ok"), F.min(P.accepted().cast("int"))).first()
    assert row[0] >= 0.99 and row[1] == 1


def test_scoring_holds_little_and_sends_only_the_lowered_text_to_python(spark):
    import tracemalloc

    m = model(spark)
    raw = np.frombuffer("the house and the dog, über das haus ".encode() * 60_000, np.uint8)
    tracemalloc.start()
    m.text_bits(raw, np.array([0, 1000, len(raw)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000
    rows = [(1, "the house and the dog", "zz", 2.0), (2, "LA MAISON et le chien", None, None), (3, None, "en", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, SCORE double")
    out = P.identify(df, m).where(P.accepted()).select("doc_id", "text", "`a.b`")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan  # scored once, the rows themselves stay in the JVM
    assert sorted(map(tuple, out.collect())) == [(1, "the house and the dog", "zz"), (2, "LA MAISON et le chien", None)]
