"""Toxicity: held-out accuracy, learned interactions, and edge cases."""

import math
import zlib

import numpy as np

from pyspark.sql import functions as F

from ledgerline.llm.language_id import fold
from ledgerline.llm.queries import op5_toxicity
from ledgerline.llm.toxicity import fit, learn_toxicity, score_toxicity, terms

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op5_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    pos, neg = [s for s, _, y in held if y == 1], [s for s, _, y in held if y == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    accuracy = np.mean([p == y for _, p, y in held])
    wrong = np.mean([p for _, p, y in held if y == 0])
    print("auc", auc, "accuracy", accuracy, "clean called toxic", wrong)
    assert auc > 0.9 and accuracy > 0.95 and wrong < 0.01


def test_learns_pairs():
    """Either term alone is harmless, both together are not: additive weights can't tell, the factors can."""
    rng = np.random.default_rng(0)
    texts, y = [], []
    for _ in range(2000):
        a, b = rng.random() < 0.4, rng.random() < 0.4
        texts.append(" ".join(["insultword"] * a + ["groupword"] * b + [f"w{k}" for k in rng.integers(0, 50, 5)]))
        y.append(int(a and b))
    model = fit(y, [sorted(terms(t)) for t in texts])
    both, one, other = model.scores(["insultword x groupword", "insultword", "groupword"])
    assert both > 0.8 and one < 0.2 and other < 0.2


def test_edges(spark):
    schema = "doc_id long, text string, score string, label int, lang string"
    rows = [(1, None), (2, ""), (3, "fine words"), (3, "fine words"), (None, "bad"), (4, "bad " * 50_000), (5, "🙂 日本")]
    docs = spark.createDataFrame([(d, t, "clash", 7, None) for d, t in rows], schema)
    train = spark.createDataFrame([(i, "bad thing" if i % 2 else "good thing", "", 0, "") for i in range(60)] + [(None, "bad", "", 0, ""), (99, None, "", 0, "")], schema)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)] + [(1, 0, 0), (None, 0, 1), (99, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    model = learn_toxicity(train, labels)
    got = score_toxicity(docs, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[1] == score[2] == score[3] == score[5] < 0.7  # no known term: the bias alone
    assert score[4] == score[None] > 0.9
    for nothing in (learn_toxicity(train, labels.limit(0)), learn_toxicity(train.limit(0), labels), learn_toxicity(train, labels.where("toxic = 0"))):
        assert all(r.predicted == 0 and 0 < r.score < 0.5 for r in score_toxicity(docs, nothing).collect())
    assert score_toxicity(docs.limit(0), model).collect() == []


def test_scores_against_all_pairs(spark):
    """Every document's score, from the whole text: bias, weights and the inner products of all pairs of its terms."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    usable = F.coalesce(fold(F.col("doc_id"), 5) != 0, F.lit(True))
    model = learn_toxicity(docs, labels, usable)
    got = {r.doc_id: r.score for r in op5_toxicity(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        at = [model.places[b] for b in terms(text) if b in model.places]
        logit = model.bias + sum(float(model.weights[a]) for a in at)
        for k, a in enumerate(at):
            logit += sum(sum(float(x) * float(y) for x, y in zip(model.factors[a], model.factors[b])) for b in at[k + 1 :])
        assert abs(got[i] - 1 / (1 + math.exp(-min(max(logit, -50), 50)))) < 1e-9
