import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import toxicity as X


def corpus(seed=0, n=400):
    """Documents of harmless sentences; toxic ones hold one or two sentences with a bad word."""
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(5)]
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 12))]
        toxic = int(rng.random() < 0.35)
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(["Scoundrel", "villainous", "villainly", "ROGUE"])
        docs.append((i, ". ".join(sentences)))
        labels.append((i, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return X.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"), min_ratio=8.0)


def test_new_documents_are_told_apart_and_sentences_located(spark, fitted):
    docs, labels = corpus(seed=9, n=150)
    want = dict(labels)
    out = X.score(spark.createDataFrame(docs, "doc_id long, text string"), fitted).collect()
    assert np.mean([(r["score"] >= 0.5) == bool(want[r["doc_id"]]) for r in out]) > 0.97
    for r in out:
        for s in r["toxic_spans"]:
            assert any(b in r["text"][s["start"] : s["end"]].lower() for b in ("scoundrel", "villain", "rogue"))


def test_score_is_the_noisy_or_of_the_sentences(fitted):
    scorer = fitted.scorer()
    text = "waa wbb. you rogue\nwcc! a Scoundrel? "
    clean = 1.0
    for _, _, words in X.sentences(text):
        clean *= 1 - 1 / (1 + math.exp(-scorer.logit(words)))
    assert math.isclose(scorer.text(text)[0], 1 - clean, rel_tol=1e-9)


def test_gradient_lowers_the_loss():
    rows = [{"toxic": 1, "weight": 1.0, "plain": 3, "hits": [[0], [1]]}, {"toxic": 0, "weight": 1.0, "plain": 2, "hits": [[1], [1, 2]]}]
    w, b = X.fit(rows, 3, steps=300)
    p = lambda r: 1 - math.exp(-r["plain"] * np.logaddexp(0, b) - sum(np.logaddexp(0, b + sum(w[i] for i in h)) for h in r["hits"]))
    assert p(rows[0]) > 0.9 and p(rows[1]) < 0.1 and w[0] > w[1]


def test_edges(spark, fitted):
    rows = [(1, None, 5), (2, "", 5), (3, "...!?\n", 5), (None, "a rogue", 5), (4, "waa " * 50_000, 5)]
    out = {r["doc_id"]: r for r in X.score(spark.createDataFrame(rows, "doc_id long, text string, Score int"), fitted).collect()}
    assert [out[i]["score"] for i in (1, 2, 3)] == [0.0] * 3
    assert out[None]["score"] > 0.5 and 0 <= out[4]["score"] < 0.5
    assert X.score(spark.createDataFrame([], "doc_id long, text string"), fitted).count() == 0


def test_without_both_classes_all_scores_are_zero(spark):
    df = spark.createDataFrame([(1, "a rogue")], "doc_id long, text string")
    model = X.train(df, spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int"))
    assert X.score(df, model).first()["score"] < 1e-12


def test_held_out_documents_of_the_table(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = X.train(docs, labels.where(~X.held_out()))
    scored = X.score(docs.join(labels, "doc_id").where(X.held_out()).select("doc_id", "text", "toxic"), model)
    r = {x["toxic"]: x["p"] for x in scored.groupBy("toxic").agg(F.avg((F.col("score") >= 0.5).cast("double")).alias("p")).collect()}
    assert r[1] > 0.8 and r[0] < 0.01
