"""Mixing: targets against the stated reshare, exact draws, the splitting tree, and edge cases."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import source_mix as m
from ledgerline.llm.queries import MIX_WEIGHTS, op2_source_mix

SCHEMA = "doc_id long, text string, source string, size string, target int"


def brute_targets(size_of, weights, cap=3):
    """Share by weight; what exceeds a cap is reshared by weight until nothing does."""
    names = sorted(size_of, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, closed = sum(size_of.values()), {}
    while True:
        rest, open_ = total - sum(closed.values()), [s for s in names if s not in closed]
        share = {s: w[s] * rest / sum(w[x] for x in open_) for s in open_} if open_ else {}
        over = {s: cap * size_of[s] for s in open_ if share[s] > cap * size_of[s]}
        if not over:
            return closed | share
        closed |= over


def check(rows, docs, weights=MIX_WEIGHTS):
    sizes, per, goal, taken = defaultdict(int), {}, {}, defaultdict(int)
    for r in docs:
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = brute_targets(sizes, weights) if sizes else {}
    assert len(rows) == len(docs)
    by_id = {r.doc_id: r for r in docs}
    for r in rows:
        s = by_id[r.doc_id].source
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9, abs=1e-9) and 0 <= r.taken <= 3 * r.size
        per[s], goal[s] = r.source_size, r.target
        taken[s] += r.taken
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 0.5 + 1e-6
    assert sum(goal.values()) == pytest.approx(sum(sizes.values()))


def test_query_and_reruns(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    first = op2_source_mix(spark, sf).collect()
    check(first, docs)
    assert sorted(map(str, first)) == sorted(map(str, op2_source_mix(spark, sf).collect()))


def run(docs, weights, **kw):
    sizes = m.sized(docs)
    goals = m.targets(sizes, weights)
    mix = m.mix_sources(sizes, goals, **kw)
    return m.taken_words(sizes, goals, mix).collect(), mix.collect(), goals.collect()


def test_shards_and_blocks(spark):
    rows = [(i, "w " * (i * 7 % 400), ["a", "b", None, "ü", "big"][0 if i % 11 == 0 else i % 5]) for i in range(600)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got, mix, goals = run(docs, [1, 20, 3], shards=8, block_words=16)
    check(got, docs.collect(), [1, 20, 3])
    per_shard = np.bincount([r.shard for r in mix], minlength=8)
    assert per_shard.max() - per_shard.min() <= 3 and len(mix) == per_shard.sum()
    assert len({(r.row_id, r.epoch, r.block) for r in mix}) == len(mix)  # disjoint
    by_source = defaultdict(list)
    for r in mix:
        by_source[r.sid].append(r)
    for sid, draws in by_source.items():
        assert sum(r.words for r in draws) == round(next(g.target for g in goals if g.sid == sid))
        share = np.bincount([r.shard for r in draws], minlength=8) / len(draws)
        assert share.min() > 0.04 and share.max() < 0.25  # every source is spread over all shards


def test_the_tree_decides(spark, monkeypatch):
    """What is taken is the sum over the shards' blocks: other leaves, other documents. Shards are disjoint, written in
    their shuffled order, and each holds exactly what its leaf says of every source."""
    rows = [(i, "w " * (1 + i * 7 % 90), "abc"[i % 3]) for i in range(300)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    sizes = m.sized(docs)
    goals = m.targets(sizes, [1, 20, 3])
    real, leaves = m.splitting_tree, []

    def seen(*args):
        made = real(*args).cache()
        leaves.append(sorted(map(tuple, made.collect())))
        return made

    monkeypatch.setattr(m, "splitting_tree", seen)
    shards = m.write_shards(m.mix_sources(sizes, goals, 8, 16))
    mix = shards.collect()
    held = defaultdict(int)
    for r in mix:
        held[r.sid, r.shard] += 1
    assert sorted((s, k, n) for (s, k), n in held.items()) == [x for x in leaves[0] if x[2]]
    for r in m.taken_words(sizes, goals, shards).collect():
        own = [x for x in mix if x.doc_id == r.doc_id]
        assert r.taken == sum(x.words for x in own) and r.blocks == len({(x.shard, x.place) for x in own}) == len(own)
    for part in shards.rdd.glom().collect():
        places = [(r.shard, r.place) for r in part]
        assert places == sorted(places)
    order = [r.row_id for r in sorted(mix, key=lambda r: (r.shard, r.place)) if r.shard == 0]
    assert order != sorted(order) and len({x.sid for x in mix if x.shard == 0}) == 3

    def empty_right_half(quotas, shards, seed):
        return real(quotas, shards, seed).where(F.col("shard") < shards // 2)

    monkeypatch.setattr(m, "splitting_tree", empty_right_half)
    half = m.mix_sources(sizes, goals, 8, 16).collect()
    assert 0.3 * len(mix) < len(half) < 0.7 * len(mix) and {r.shard for r in half} == set(range(4))


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "one two", "a"), (4, "three " * 2000, None), (5, " \t\n", None), (6, "x y z", "empty?"), (7, "same", "a"), (8, "nbsp joins", "c")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got, _, _ = run(docs, [1, 2, 3])
    check(got, docs.collect())
    twice = docs.where("doc_id = 3 or doc_id = 4").union(docs.where("doc_id = 3")).withColumn("doc_id", F.when(F.col("doc_id") == 3, F.lit(None)).otherwise(F.col("doc_id")))
    again, _, _ = run(twice, [1, 2])
    assert len(again) == 3 and sum(r.taken for r in again) == pytest.approx(sum(r.size for r in again), abs=2)
    assert run(docs.limit(0), [1, 2, 3])[0] == []
    assert [r.taken for r in run(docs.where("doc_id in (1, 2)"), [1])[0]] == [0, 0]
    with pytest.raises(ValueError):
        run(docs, [1], shards=6)


def test_hypergeometric_distribution(spark):
    """Inversion gives the exact distribution: compare with exact probabilities over a fine grid of u."""
    from math import comb

    for N, K, n in [(20, 7, 9), (50, 49, 25), (10, 0, 5), (10, 10, 4), (1, 1, 0), (30, 3, 30)]:
        u = spark.range(2000).select(((F.col("id") + 0.5) / 2000).alias("u"))
        lit = lambda x: F.lit(x).cast("long")
        got = u.select(m.hypergeometric(lit(N), lit(K), lit(n), F.col("u")).alias("x")).groupBy("x").count().collect()
        freq = {r.x: r["count"] / 2000 for r in got}
        for x in range(max(0, n + K - N), min(n, K) + 1):
            assert abs(freq.pop(x, 0) - comb(K, x) * comb(N - K, n - x) / comb(N, n)) < 2 / 2000
        assert not freq


def test_plan_is_native(spark):
    plan = op2_source_mix(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Nested" not in plan
    assert "shard" in plan and "place" in plan  # the result is read from the shards


def test_one_text_under_two_sources(spark):
    """Each source's document counts for its own source; none is dropped or moved to the other."""
    text = "a text of seven words in all"
    docs = spark.createDataFrame([(1, text, "a", "", 0), (1, text, "b", "", 0), (2, text, "a", "", 0), (2, text + " more", "b", "", 0)], SCHEMA)
    got = m.mixed_documents(docs, [1, 1])
    assert got.columns == docs.columns and {(r.doc_id, r.source) for r in got.collect()} == {(1, "a"), (1, "b"), (2, "a"), (2, "b")}
