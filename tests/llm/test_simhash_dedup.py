"""SimHash near-duplicates against all pairs."""

import random
import re

import numpy as np
import xxhash

from ledgerline.llm import simhash_dedup as s
from ledgerline.llm.queries import op13_simhash_dedup


def plain_fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(bits):
    """Place -> smallest place reachable over pairs at distance 3 or less."""
    values = np.array(bits, np.uint64)
    parent = list(range(len(bits)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3):
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    return [root(i) for i in range(len(bits))]


def expected(rows, n):
    """Result of rows with different ids."""
    rows = sorted(rows)
    bits = [plain_fingerprint(t, n) for _, t in rows]
    return {(i, f"{b:016x}", rows[c][0]) for (i, _), b, c in zip(rows, bits, components(bits))}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op13_simhash_dedup(spark, sf).collect()
    assert {tuple(r) for r in got} == expected(rows, 3) and len(got) == len(rows)
    assert sum(r.doc_id != r.component_id for r in got) > 20


def test_edges(spark):
    rows = [(9, None), (8, ""), (7, " \t\n"), (6, "one"), (5, "One"), (4, "one two"), (3, "one  TWO"), (2, "a b c d"), (1, "a b c d " * 40000), (-1, "É b c"), (0, " x")]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, fingerprint string, bits int").repartition(3)
    assert {tuple(r) for r in s.simhash_duplicates(df, 3).collect()} == expected(rows, 3)
    more = df.union(spark.createDataFrame([(None, "one", "", 1), (5, "one", "", 1), (5, "a b c d", "", 1), (None, None, "", 1)], df.schema))
    got = [tuple(r) for r in s.simhash_duplicates(more, 3).collect()]
    assert len(got) == len(rows) + 4
    f = lambda t: f"{plain_fingerprint(t, 3):016x}"
    # null ids link nothing; rows of one id follow their own text
    assert sorted(x[1:] for x in got if x[0] is None) == sorted([(f("one"), None), (f(""), None)])
    assert sorted(x[1:] for x in got if x[0] == 5) == sorted([(f("one"), 5)] * 2 + [(f("a b c d"), min(i for i, t in rows if f(t) == f("a b c d")) if f("a b c d") != f("one") else 5)])
    assert s.simhash_duplicates(df.limit(0), 3).collect() == []


def test_links_of_dense_and_sparse_fingerprints(spark, monkeypatch):
    """Clusters in few bits, chains, and pairs that share one segment only; groups exceed their bounds and are split."""
    monkeypatch.setattr(s, "MAX_GROUP", 16)
    rnd = random.Random(4)
    bits = {rnd.getrandbits(64) for _ in range(200)}
    seed = rnd.getrandbits(64)
    bits |= {seed ^ (k << 30) for k in range(0, 300)}  # varies across the border of the segments
    bits |= {seed ^ (k * 0x0101010101) for k in range(200)}
    for b in list(bits)[:150]:
        for n in (1, 2, 3, 4):
            bits.add(b ^ sum(1 << p for p in rnd.sample(range(64), n)))
    bits |= {0, 2**64 - 1, 1 << 63, 1 << 31, 1 << 32}
    bits = sorted(bits)
    signed = [(int(np.uint64(b).astype(np.int64)),) for b in bits]
    got = [tuple(np.uint64(x & 2**64 - 1) for x in r) for r in s.links(spark.createDataFrame(signed, "bits long").repartition(4)).collect()]
    place = {np.uint64(b): i for i, b in enumerate(bits)}
    assert all(np.bitwise_count(a ^ b) <= 3 for a, b in got) and len(got) <= 40 * len(bits)
    parent = list(range(len(bits)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in got:
        x, y = sorted((root(place[a]), root(place[b])))
        parent[y] = x
    assert [root(i) for i in range(len(bits))] == components(bits)


def test_linked_splits_large_groups(monkeypatch):
    monkeypatch.setattr(s, "MAX_COMPARED", 40)
    rng = np.random.default_rng(1)
    bits = np.unique(np.concatenate([rng.integers(0, 2**20, 1500, np.uint64) << np.uint64(7), rng.integers(0, 2**63, 300, np.uint64)]))
    parent = list(range(len(bits)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in s.linked(bits):
        assert np.bitwise_count(bits[a] ^ bits[b]) <= 3
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert [root(i) for i in range(len(bits))] == components(bits.tolist())
