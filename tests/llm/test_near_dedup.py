"""Near-duplicates against all pairs on full sets."""

import random
import re

import numpy as np
import pytest

from ledgerline.llm import near_dedup as nd
from ledgerline.llm.components import connected_components
from ledgerline.llm.queries import op3_near_dedup


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def brute(rows, n, percent):
    """doc_id -> (set size, smallest reachable id); candidates by an inverted index."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i, s in sets.items():
        common = {}
        for g in s:
            for j in index.get(g, []):
                common[j] = common.get(j, 0) + 1
            index.setdefault(g, []).append(i)
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def check(got, want):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(want)


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()]
    want = brute(rows, 3, 85)
    assert sum(i != c for i, (_, c) in want.items()) > 5
    check(op3_near_dedup(spark, f"/root/testdata/{sf}").collect(), want)


def test_ball_of_near_copies(spark, monkeypatch):
    """Copies with edits of every size: links are a part of the pairs, groups exceed the task bound, blocks meet."""
    monkeypatch.setattr(nd, "MAX_GROUP", 20)
    monkeypatch.setattr(nd, "SMALL_BLOCK", 16)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rnd.randrange(0, 14)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w)))
    rows += [(2000 + i, " ".join(rnd.sample(base, 40))) for i in range(20)] + [(3000 + i, rows[i % 3][1].upper()) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for n, percent in ((3, 85), (5, 80)):
        check(nd.near_duplicates(docs, n, percent).collect(), brute(rows, n, percent))


def test_edges(spark):
    short = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "A"), (6, "a b"), (7, "a  B\n"), (8, short), (9, short + " eight"), (10, short.upper()), (11, "é É"), (12, "É é"),
            (13, "nbsp x y"), (-5, "tail " * 30_000), (14, "tail " * 40_000), (15, "tail tail tail tail")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, n_shingles int, kept string")
    check(nd.near_duplicates(docs, 3, 85).collect(), brute(rows, 3, 85))
    odd = docs.where("doc_id in (4, 5)").union(docs.where("doc_id = 5")).union(docs.where("doc_id = 8").selectExpr("null", "text", "n_shingles", "kept"))
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(odd, 3, 85).collect())
    assert got == [("4", 1, 4, True), ("5", 1, 4, False), ("5", 1, 4, False), ("None", 5, None, True)]
    assert nd.near_duplicates(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        nd.near_duplicates(docs, 5, 70)


def test_sketch_estimates_similarity():
    """Registers agree with the similarity as probability, for small sets too, and the correction removes the bias."""
    rng = np.random.default_rng(3)
    for size, shared in ((8, 4), (60, 45), (1000, 850), (1000, 0)):
        got = []
        for _ in range(60):
            common, a, b = (np.sort(rng.integers(0, 2**63, k).astype(np.uint64)) for k in (shared, size - shared, size - shared))
            x, y = nd.sketch(np.concatenate([common, a])), nd.sketch(np.concatenate([common, b]))
            got.append(float(nd.estimate((x == y).sum(), size, size)))
        j = shared / (2 * size - shared)
        assert abs(np.mean(got) - j) < 0.035
    assert (nd.compressed(np.array([0, 1, (1 << 57) - 1], np.uint64)) >= 0).all()


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(rnd.randrange(2000, 3000), rnd.randrange(2000, 3000)) for _ in range(700)] + [(-4, -9), (7, 7)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {i: root(i) for i in parent if sum(root(j) == root(i) for j in parent) > 1}
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want and got.count() == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
