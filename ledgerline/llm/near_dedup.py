"""Near-duplicate detection with HyperMinHash sketches.

1. Every text becomes its set of word shingles (64-bit hashes) and a sketch of ``BUCKETS`` registers. A register keeps
   the smallest hash of its bucket in compressed form: number of leading zeros and ``MANTISSA`` bits after them. Buckets
   that a small set leaves empty are filled in further rounds with new hashes; a register also holds its round, so equal
   registers always have the set similarity as probability, whatever the set's size.
2. Equal sets are one class; its smallest document stands for it. Bands of ``ROWS`` registers are hashed; classes that
   share a band meet. 32 bands of 4 miss a pair of similarity 0.8 with probability 5e-8, of 0.85 with 4e-11.
3. In each band's group, pairs are compared by the estimated similarity, corrected for register collisions. Whatever
   reaches ``threshold`` - 0.3 (a true pair falls below that with probability under 1e-12) joins a candidate group; a
   group emits a spanning forest of it, not its pairs. Groups over ``MAX_GROUP`` classes are linked without comparing.
4. Within a candidate component every pair is verified on the full sets, in blocks of bounded size by matrix products;
   links again are emitted as spanning forests. The components of the verified links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.llm.components import connected_components

BUCKETS, BANDS, ROWS = 128, 32, 4
#: Bits of a register: round (capped), leading zeros (capped), mantissa.
ROUND, ZEROS, MANTISSA = 3, 5, 8
#: Largest band group that is compared inside one task.
MAX_GROUP = 512
#: Classes in a verification block: the least, and the most beyond SPREAD blocks.
SMALL_BLOCK, LARGE_BLOCK, SPREAD = 256, 1024, 48
SKETCHED = "doc_id long, tag long, n_shingles long, digest binary, sketch binary, bands array<long>"

_WORDS: dict[bytes, int] = {}


def mix(h):
    """Finalizer of a 64-bit hash (numpy arrays of uint64)."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]):
    import numpy as np
    import xxhash

    known = _WORDS
    if len(known) > 500_000:
        known.clear()
    for w in set(words):
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_set(text: bytes, n: int):
    """Sorted distinct 64-bit hashes of the n-word shingles of a text (A-Z lower-cased; words
    ``[^\\x20\\x09-\\x0D]+``); with fewer words their whole sequence; without words empty."""
    import numpy as np

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    width = min(n, len(words))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out + np.uint64(0x9E3779B97F4A7C15) ^ h[k : k + len(out)])
    return np.unique(out)


def sketch(hashes):
    """Registers (uint16): round, leading zeros and mantissa bits of each bucket's smallest hash."""
    import numpy as np

    registers, open_, t = np.zeros(BUCKETS, np.uint16), np.ones(BUCKETS, bool), 0
    while len(hashes) and open_.any():
        h = mix(hashes + np.uint64(t * 0xD1342543DE82EF95 & 2**64 - 1))
        # after 64 rounds one bucket per round, so that the rounds end
        bucket = (h >> np.uint64(57)).astype(np.int64) if t < 64 else np.full(len(h), t - 64)
        least = np.full(BUCKETS, 1 << 57, np.uint64)
        np.minimum.at(least, bucket, h & np.uint64((1 << 57) - 1))
        hit = open_ & (least < np.uint64(1 << 57))
        registers[hit] = min(t, (1 << ROUND) - 1) << (ZEROS + MANTISSA) | compressed(least[hit])
        open_ &= ~hit
        t += 1
    return registers


def compressed(values):
    """57-bit values as leading zeros and the MANTISSA bits after the leading one."""
    import numpy as np

    length = np.frexp(values.astype(np.float64))[1].astype(np.int64)  # bit length, one too many if rounded up
    length -= (values >> np.maximum(length - 1, 0).astype(np.uint64)) == 0
    zeros = np.clip(57 - length, 0, (1 << ZEROS) - 1)
    shift = np.maximum(56 - zeros - MANTISSA, 0).astype(np.uint64)
    return (zeros << MANTISSA) | ((values >> shift) & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)


def estimate(equal, n, m):
    """Similarity from the share of equal registers, corrected for the expected collisions of different minima: the
    HyperMinHash approximation 0.1699 * 2^-MANTISSA * 4r / (1 + r)^2 with r = n / m."""
    import numpy as np

    r = np.asarray(n, float) / np.maximum(m, 1)
    c = 0.169919487159739 * 2.0**-MANTISSA * 4 * r / (1 + r) ** 2
    return np.clip((np.asarray(equal) / BUCKETS - c) / (1 - c), 0, 1)


def sketches(docs: DataFrame, words: int, id_col: str, text_col: str, tag: Column) -> DataFrame:
    """One row per document: tag, set size, digest of the set, sketch, band keys."""

    def make(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        from ledgerline.llm.tokens import utf8

        salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                some = b.slice(k, 1024)
                sizes, digests, raw, keys = [], [], [], []
                for text in utf8(some.column(1)):
                    hashes = shingle_set(text, words)
                    registers = sketch(hashes)
                    band = salt.copy()
                    for r in registers.reshape(BANDS, ROWS).T:
                        band = mix(band ^ (r.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
                    sizes.append(len(hashes))
                    digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    raw.append(registers.tobytes())
                    keys.append(band.view(np.int64) if len(hashes) else None)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).cast(pa.int64()), some.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(raw, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "tag", "n_shingles", "digest", "sketch", "bands"],
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col), tag.cast("long").alias("tag")).mapInArrow(make, SKETCHED)


def forest(n: int, linked) -> list[tuple[int, int]]:
    """Spanning forest of ``n`` nodes; ``linked(i, others)`` says which of ``others`` link with i. Each node is compared
    with nodes that no tree has reached yet only."""
    import numpy as np

    left, out = np.arange(n), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = linked(i, left)
            out += [(i, int(j)) for j in left[hit]]
            queue += [int(j) for j in left[hit]]
            left = left[~hit]
    return out


def candidate_edges(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): spanning forests of the band groups by estimated similarity."""
    least = threshold - 0.3
    keys = classes.select("doc_id", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    sizes = sizes.select(F.shiftright("key", 0).alias("key"), "n", "first")  # an exchange of its own: see components
    met = stored(keys.join(sizes, "key"), "bands")
    large = met.where(F.col("n") > MAX_GROUP).select(F.col("doc_id").alias("a"), F.col("first").alias("b")).where("a <> b")
    small = met.where(F.col("n") <= MAX_GROUP).select("key", "doc_id").join(classes.select("doc_id", "n_shingles", "sketch"), "doc_id")

    def compare(batches: Iterator) -> Iterator:
        """Groups arrive as runs of one key; a run is bounded by MAX_GROUP."""
        import numpy as np
        import pyarrow as pa

        def edges(ids, sizes, raw) -> list[tuple[int, int]]:
            if len(ids) < 2:
                return []
            registers = np.frombuffer(b"".join(raw), "<u2").reshape(len(ids), BUCKETS)
            size = np.asarray(sizes)
            near = lambda i, o: estimate((registers[o] == registers[i]).sum(1), size[i], size[o]) >= least
            return [(ids[i], ids[j]) for i, j in forest(len(ids), near)]

        key, held = None, ([], [], [])
        for b in batches:
            found = []
            for k, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != key:
                    found += edges(*held)
                    key, held = k, ([], [], [])
                for col, x in zip(held, row, strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in found], pa.int64()), "b": pa.array([e[1] for e in found], pa.int64())})
        found = edges(*held)
        yield pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in found], pa.int64()), "b": pa.array([e[1] for e in found], pa.int64())})

    runs = small.select("key", "doc_id", "n_shingles", "sketch").repartition("key").sortWithinPartitions("key", "doc_id")
    return runs.mapInArrow(compare, "a long, b long").union(large).distinct()


def overlaps(sets: list):
    """Matrix of intersection sizes. Only hashes in two sets or more matter; they're taken in column blocks."""
    import numpy as np

    values, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = df[at] > 1
    place = np.cumsum(df > 1) - 1
    row, col = row[shared], place[at[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(col[-1]) + 1 if len(col) else 0, 4096):
        lo, hi = np.searchsorted(col, [start, start + 4096])
        x = np.zeros((len(sets), 4096), np.float32)
        x[row[lo:hi], col[lo:hi] - start] = 1
        out += x @ x.T
    return out.astype(np.int64)


def verified_edges(docs: DataFrame, members: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(a, b): spanning forests of the pairs in each candidate component with 100 * intersection >= percent * union, on
    the full sets. Large components are cut in blocks by hash; each pair of blocks is a group of bounded size."""
    count = members.groupBy("component").agg(F.count("*").alias("n"))
    n = F.col("n")
    blocks = F.greatest(F.ceil(n / LARGE_BLOCK), F.least(F.ceil(n / SMALL_BLOCK), F.lit(SPREAD).cast("long"))).cast("int")
    own = members.join(count, "component").where("n > 1").select("node", "component", blocks.alias("k"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"))

    def make_sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from ledgerline.llm.tokens import utf8

        for b in batches:
            for k in range(0, b.num_rows, 1024):
                some = b.slice(k, 1024)
                sets = [shingle_set(t, words).tobytes() for t in utf8(some.column(4))]
                yield pa.RecordBatch.from_arrays([*[some.column(i) for i in range(4)], pa.array(sets, pa.binary())], ["node", "component", "k", "own", "set"])

    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    # the ids have no size bound, so this is the same shuffle join at every size, never a broadcast of them
    with_sets = texts.join(own.hint("merge"), "node").select("node", "component", "k", "own", "text").mapInArrow(make_sets, "node long, component long, k int, own int, set binary")
    with_sets = stored(with_sets, "candidate_sets")  # once each; the ranges below are sampled from it
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    pairs = with_sets.select("node", "component", "own", other, "set").select(
        "node", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "set"
    )

    def verify(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def edges(ids, raw) -> list[tuple[int, int]]:
            if len(ids) < 2:
                return []
            sets = [np.frombuffer(x, "<u8") for x in raw]
            size = np.array([len(s) for s in sets])
            both = overlaps(sets)
            linked = lambda i, o: 100 * both[i, o] >= percent * (size[i] + size[o] - both[i, o])
            return [(ids[i], ids[j]) for i, j in forest(len(ids), linked)]

        key, ids, raw = None, [], []
        for b in batches:
            found = []
            for c, i, j, node, raw_set in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (c, i, j) != key:
                    found += edges(ids, raw)
                    key, ids, raw = (c, i, j), [], []
                ids.append(node)
                raw.append(raw_set)
            yield pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in found], pa.int64()), "b": pa.array([e[1] for e in found], pa.int64())})
        found = edges(ids, raw)
        yield pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in found], pa.int64()), "b": pa.array([e[1] for e in found], pa.int64())})

    # ranges of equal row counts, so that the groups of one large component spread evenly
    runs = pairs.select("component", "i", "j", "node", "set").repartitionByRange("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
    return runs.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", tag: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable over links, itself
    included), kept (it is that id); with ``tag`` (a long over ``docs``, such as a hash of the text) that column too, to
    find a row again where ids repeat. Two texts link if 100 * |intersection| >= percent * |union| of their shingle sets.

    ``percent`` is 80 or more: the bands are made for that. Null and empty texts have an empty set and link with
    nothing. Repeated ids: each row follows its own text, and texts whose smallest id is the same count as linked. Null
    ids are given back with component null and kept true; they link nothing. An empty table gives an empty result.
    """
    if percent < 80:
        raise ValueError("the bands find similarities of 0.8 or more")
    made = stored(sketches(docs, words, id_col, text_col, F.lit(None) if tag is None else tag), "sketches")
    some = made.where("n_shingles > 0 and doc_id is not null")
    # a class: documents with equal sets; the smallest stands for all (aggregated map-side, so copies don't gather)
    classes = some.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "sketch", "bands")).alias("c")).select("digest", "c.*")
    classes = stored(classes, "classes")
    balls = connected_components(candidate_edges(classes, percent / 100), "candidates")
    links = connected_components(verified_edges(docs, balls, words, percent, id_col, text_col), "links")
    of_class = classes.select("digest", F.col("doc_id").alias("first")).join(links.withColumnRenamed("node", "first"), "first", "left")
    of_class = of_class.select("digest", F.coalesce("component", "first").alias("component_id"))
    found = made.join(of_class, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    tags = [] if tag is None else ["tag"]
    out = found.select("doc_id", *tags, "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
