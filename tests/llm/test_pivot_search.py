"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm.hard_negatives import choose_centres, distances, squares
from ledgerline.llm.pivot_search import TopK, search
from ledgerline.llm.queries import op7_pivot_search


def brute(rows, is_query, k=20, scale=64):
    best = {}
    for i, e in rows:
        if i is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(scale * float(x)) for x in e]
        best[i] = max(best.get(i, v), v)
    out = []
    for q in sorted(best):
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(best[q], v)), i) for i, v in best.items() if i != q)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    return out


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op7_pivot_search(spark, sf).collect())
    assert got == sorted(brute(rows, lambda i: i % 20 == 0))


def test_blocks_and_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [((i * 37 + j * 11) % 17) / 8 - 1 for j in range(4)]) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.25, -1.0]) for i in range(120, 150)]  # ties
    rows += [(200, None), (202, []), (204, [1.0, None, 0.0, 0.0]), (206, [nan, 0.0, 0.0, 0.0]), (208, [inf, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    rows += [(210, [1.0, 2.0]), (212, [0.1, 0.2, 0.3, 0.4, 0.5]), (4, [3.0, 0.0, 0.0, 0.0]), (4, [3.0, 0.0, 0.0, 0.0]), (-6, [0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, e, 1, "clash") for i, e in rows], "vec_id long, embedding array<float>, label int, score string").repartition(5)
    got = sorted(tuple(r) for r in search(df, F.col("vec_id") % 2 == 0, k=7, n_pivots=3, block_rows=8, chunk_rows=16, group_rows=20, sample_rows=30).collect())
    assert got == sorted(brute(rows, lambda i: i % 2 == 0, 7))
    few = df.where("vec_id in (0, 1, 2)")
    assert sorted(tuple(r) for r in search(few, F.col("vec_id") == 0).collect()) == brute([r for r in rows if r[0] in (0, 1, 2)], lambda i: i == 0)
    assert search(df, F.col("vec_id") == 10**6).collect() == [] and search(df.limit(0), F.lit(True)).collect() == []
    assert search(df.where("vec_id = 10"), F.lit(True)).collect() == []


def test_no_finite_vector_is_left_out(spark):
    """Components of any size and 1,024 of them: integer scores, no overflow in the distances."""
    rows = [(0, [1.0, 2.0]), (20, [2e6, 1.0]), (21, [3.0, -1.0]), (40, [1e30, 0.0]), (41, [-1e30, 1.0]), (60, [3e38, 3e38])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clip = lambda s: min(max(s, -(2**63) + 1), 2**63 - 1)
    got = sorted(tuple(r) for r in search(df, F.col("vec_id") % 20 == 0).collect())
    vectors = {i: [int(64 * x) for x in e] for i, e in rows}
    want = []
    for q in (0, 20, 40, 60):
        scored = sorted((-clip(sum(a * b for a, b in zip(vectors[q], v))), i) for i, v in vectors.items() if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    rng = np.random.default_rng(5)
    x = rng.integers(-(10**6), 10**6, (300, 1024))
    df = spark.createDataFrame([(i, (v / 64.0).tolist()) for i, v in enumerate(x * 64)], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in search(df, F.col("vec_id") < 5, scale=1, block_rows=64).collect())
    want = []
    for q in range(5):
        scored = sorted((-int(x[q] @ x[i]), i) for i in range(300) if i != q)[:20]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert got == sorted(want)


@pytest.mark.parametrize(("clustered", "share"), [(True, 0.15), (False, 1.0)])
def test_elimination(clustered, share):
    """Equal to a scan; on clustered rows only a small share of the pairs is evaluated, on any rows never more than all."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-3000, 3000, (50, 24))
    x = (centres[np.sort(rng.integers(0, 50, 6000))] + rng.integers(-80, 80, (6000, 24)) if clustered else rng.integers(-3000, 3000, (6000, 24))).astype(float)
    pivots = choose_centres(x[::3], 24)
    blocks = []
    for s in range(0, 6000, 250):
        part = x[s : s + 250]
        blocks.append({"ids": np.arange(s, s + 250), "vectors": part, "x2": squares(part), "pivots": distances(part, pivots)})
    q = np.arange(0, 6000, 60)
    found = TopK(q, x[q], pivots, 9)
    found.through(blocks)
    got = list(zip(found.best["of"].tolist(), found.best["id"].tolist(), found.best["score"].tolist()))
    scores = (x[q] @ x.T).astype(np.int64)
    for k, i in enumerate(q):
        want = sorted((-int(scores[k, j]), j) for j in range(6000) if j != i)[:9]
        assert [(j, s) for of, j, s in got if of == k] == [(j, -s) for s, j in want]
    assert found.evaluated <= share * scores.size
