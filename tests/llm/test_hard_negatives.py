"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hard_negatives as h
from ledgerline.llm.queries import op11_hard_negatives


def brute(rows, is_anchor, n_pos=5, n_neg=3, scale=256):
    best = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        own = (label, [math.floor(scale * float(x)) for x in e])
        best[i] = max(best.get(i, own), own)
    clip = lambda s: min(max(s, h.LEAST), h.MOST)
    out = []
    for a, (label, v) in best.items():
        if not is_anchor(a):
            continue
        scored = sorted((-clip(sum(x * y for x, y in zip(v, w))), i) for i, (_, w) in best.items() if i != a)
        for ps, p in [x for x in scored if best[x[1]][0] == label][:n_pos]:
            fits = [x for x in scored if best[x[1]][0] != label and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:n_neg]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fits)]
    return sorted(out)


def mined(df, condition, **options):
    return sorted(tuple(r) for r in h.mine_negatives(df, condition, F.col("label"), **options).collect())


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    read = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in read]
    assert sorted(tuple(r) for r in op11_hard_negatives(spark, sf).collect()) == brute(rows, lambda i: i % 50 == 0)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [((i * 37 + j * 11) % 17) / 8 - 1 for j in range(4)], i % 3) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.25, -1.0], i % 2) for i in range(120, 190)]  # ties, one common vector
    rows += [(200, None, 1), (202, [1.0, None], 1), (204, [nan, 0.0], 1), (206, [inf], 1), (208, [1.0, 1.0], None), (None, [1.0, 1.0], 1)]
    rows += [(210, [1.0, 2.0], 0), (212, [0.1, 0.2, 0.3, 0.4, 0.5], 1), (214, [], 2), (4, [3.0, 0.0, 0.0, 0.0], 9), (4, [3.0, 0.0, 0.0, 0.0], 9), (-6, [0.0] * 4, 0)]
    df = spark.createDataFrame([(i, e, label, 1) for i, e, label in rows], "vec_id long, embedding array<float>, label int, score int").repartition(5)
    small = {"cells": 5, "sample_rows": 40, "block_rows": 16}
    got = mined(df, F.col("vec_id") % 2 == 0, **small)
    assert got == brute(rows, lambda i: i % 2 == 0) and len(got) > 300
    assert mined(df.limit(0), F.lit(True)) == [] and mined(df, F.col("vec_id") == 10**6) == []
    assert mined(df.where("vec_id = 10"), F.lit(True)) == []


def test_components_beyond_the_exact_floats(spark):
    """Scores beyond 2^53 are integers all the same; beyond a long they are its ends."""
    rows = [(0, [2e6, 1.0, 3e9], 0), (1, [2e6, 2.0, 3e9], 0), (2, [1e6, 3.0, 2e9], 1), (3, [1e6, 4.0, 2e9], 1), (4, [1e30, 0.0, 0.0], 0), (5, [3e38, -1.0, 0.0], 1), (6, [-3e38, 7.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(df, F.lit(True)) == brute(rows, lambda i: True)


@pytest.mark.parametrize("clustered", [True, False])
def test_trees_cover_and_skip(clustered):
    """Every row lies within its nodes' radii; the search equals a scan, and reads far fewer rows of clustered data."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (40, 16))
    x = (centres[rng.integers(0, 40, 4000)] + rng.integers(-60, 60, (4000, 16)) if clustered else rng.integers(-4000, 4000, (4000, 16))).astype(float)
    greatest = float(np.sqrt((x * x).sum(1).max())) * (1 + 1e-12)
    labels, trees = np.arange(4000) % 2, []
    for k in range(0, 4000, 1000):
        points = h.augmented(x[k : k + 1000], greatest)
        order, nodes = h.cover_tree(points)
        assert sorted(order) == list(range(1000))
        for n in nodes:
            own = points[order[n["start"] : n["stop"]]]
            assert np.sqrt(((own - own[0]) ** 2).sum(1)).max() <= n["radius"] + 1e-9
        trees.append({"ids": k + order, "labels": labels[k + order], "vectors": x[k + order], "nodes": nodes})
    q = np.arange(0, 4000, 100)
    scores = (x[q] @ x.T).astype(np.int64)
    level = np.sort(scores, 1)[:, -40]
    low, high = (level // 2)[:, None], level[:, None]
    search = h.Search(q, labels[q], x[q], low, high, 3, False, greatest)
    search.through(trees)
    got = {}
    for of, s, i in zip(search.best["of"].tolist(), search.best["score"].tolist(), search.best["id"].tolist()):
        got.setdefault(of, []).append((-s, i))
    for k, a in enumerate(q):
        fits = sorted((-int(scores[k, i]), i) for i in range(4000) if i != a and labels[i] != labels[a] and low[k, 0] <= scores[k, i] <= high[k, 0])[:3]
        assert got.get(k, []) == fits
    if clustered:
        assert search.evaluated < 0.25 * len(q) * 4000


def test_share_of(spark):
    scores = [0, 1, -1, 99, 100, 101, -100, 12345, 2**63 - 1, -(2**63) + 1]
    df = spark.createDataFrame([(s,) for s in scores], "s long")
    for r in df.select("s", h.share_of(F.col("s"), 50, True).alias("up"), h.share_of(F.col("s"), 95, False).alias("down")).collect():
        assert (r.up, r.down) == (-((-r.s * 50) // 100), r.s * 95 // 100)
