"""SimHash near-duplicates by multi-index hashing.

1. A fingerprint bit is 1 if it is set in over half of the XXH64 hashes of a text's word shingles. Equal fingerprints
   are one class, so copies never meet one another.
2. A fingerprint has two segments of 32 bits. Two fingerprints that differ in at most 3 bits differ in at most 1 bit in
   one of the segments. The index holds every segment value once, with the number of its fingerprints. Every value
   enumerates its Hamming ball of radius 1; of a pair at distance 1, the value with the 0 bit finds the other, so the
   half of the ball with one more bit is enough.
3. Values that match (a value with itself, or two at distance 1) name a group of fingerprints. A group over
   ``MAX_GROUP`` is split by the other segment: fingerprints of distance 3 or less agree on one of its four bytes, so
   each goes to four smaller groups. Complete distances are verified inside the groups, which emit spanning forests of
   the links, never their pairs.
4. The components of the links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.llm.components import connected_components

#: Most differing bits of a link. The two segments, the radius 1 and the split in four parts are made for it.
DISTANCE = 3
SEED = 42
#: Fingerprints of a group that isn't split.
MAX_GROUP = 4096
#: Fingerprints that are compared one by one with the rest of their group.
MAX_COMPARED = 1024
_LOW = (1 << 32) - 1


def fingerprint(text: bytes, n: int) -> int:
    """64-bit SimHash of the n-word shingles of a text, repeats included (A-Z lower-cased; words
    ``[^\\x20\\x09-\\x0D]+``); with fewer words of their whole sequence; without words 0."""
    import numpy as np
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(n, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts, hash_of = (ends - length)[: len(words) - width + 1], xxhash.xxh64_intdigest
    ends, ones = ends[width - 1 :], np.zeros(64, np.int64)
    for k in range(0, len(starts), 1 << 15):
        some = zip(starts[k : k + (1 << 15)].tolist(), ends[k : k + (1 << 15)].tolist(), strict=True)
        hashes = np.array([hash_of(joined[a:b], SEED) for a, b in some], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed long."""

    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from ledgerline.llm.tokens import utf8

        for b in batches:
            bits = np.array([fingerprint(t, words) for t in utf8(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(bits)], ["doc_id", "bits"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(make, "doc_id long, bits long")


def linked(bits, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Pairs of places in ``bits`` (different fingerprints) at ``distance`` or less that connect all such pairs.

    A large group is split by parts of the bits in which it varies: a pair within the distance agrees on one of
    ``distance`` + 1 parts, and each part's groups vary in fewer bits, so this ends.
    """
    import numpy as np

    out: list[tuple[int, int]] = []
    groups = [np.arange(len(bits))]
    while groups:
        at = groups.pop()
        own = bits[at]
        if len(at) <= MAX_COMPARED:
            left = np.arange(len(at))
            while len(left):
                queue, left = [left[0]], left[1:]
                while queue and len(left):
                    i = queue.pop()
                    near = np.bitwise_count(own[left] ^ own[i]) <= distance
                    out += [(int(at[i]), int(at[j])) for j in left[near]]
                    queue += left[near].tolist()
                    left = left[~near]
            continue
        varies = int(np.bitwise_or.reduce(own ^ own[0]))
        places = [p for p in range(64) if varies >> p & 1]
        for k in range(distance + 1):
            mask = sum(1 << p for p in places[k :: distance + 1])
            part = own & np.uint64(mask)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            groups += [at[g] for g in np.split(order, cuts) if len(g) > 1]
    return out


def half_ball(value: Column) -> Column:
    """The values that have one more bit than ``value`` in its lower 32 bits."""
    one_more = [F.when(value.bitwiseAND(1 << p) == 0, value.bitwiseOR(1 << p)) for p in range(32)]
    return F.array_compact(F.array(*one_more))


def links(classes: DataFrame) -> DataFrame:
    """(a, b): spanning forests of the different fingerprints (``bits``) at DISTANCE or less."""
    low = F.col("bits").bitwiseAND(_LOW)
    high = F.shiftrightunsigned("bits", 32)
    # a segment's value, the second segment's marked by bit 32; with the other segment, by which large groups are split
    segments = F.array(F.struct(high.alias("value"), low.alias("other")), F.struct(low.bitwiseOR(1 << 32).alias("value"), high.alias("other")))
    entries = classes.select("bits", F.explode(segments).alias("s")).select("bits", "s.value", "s.other")
    index = stored(entries.groupBy("value").agg(F.count("*").alias("n")), "segment_values")
    probes = index.select(F.col("value").alias("u"), F.col("n").alias("n_u"), F.explode(half_ball(F.col("value"))).alias("value"))
    met = probes.join(index.hint("merge"), "value").select("u", F.col("value").alias("v"), (F.col("n_u") + F.col("n")).alias("n"))
    alone = index.where("n > 1").select(F.col("value").alias("u"), F.col("value").alias("v"), "n")
    groups = stored(met.union(alone), "segment_groups")
    sides = groups.select(F.explode(F.array_distinct(F.array("u", "v"))).alias("of"), "u", "v", "n")
    # shiftright by 0: both sides get an exchange of their own, so that AQE can split a value with very many fingerprints
    rows = entries.join(sides.select(F.shiftright("of", 0).alias("value"), "u", "v", "n").hint("merge"), "value")
    byte = lambda p: F.shiftright("other", 8 * p).bitwiseAND(255) + 256 * p
    parts = F.when(F.col("n") > MAX_GROUP, F.array(*[byte(p) for p in range(DISTANCE + 1)])).otherwise(F.array(F.lit(-1).cast("long")))
    rows = rows.select("u", "v", F.explode(parts).alias("part"), "bits")

    def verify(batches: Iterator) -> Iterator:
        """Groups arrive as runs of one (u, v, part)."""
        import numpy as np
        import pyarrow as pa

        def edges(parts: list) -> list[tuple[int, int]]:
            own = np.unique(np.concatenate(parts))
            return [(int(own[i]), int(own[j])) for i, j in linked(own.view(np.uint64))] if len(own) > 1 else []

        key, held = None, []
        for b in batches:
            keys = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[:3]])
            bits = b.column(3).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            found = []
            for start, stop in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
                if start == stop:
                    continue
                if (now := tuple(keys[:, start])) != key:
                    found += edges(held) if held else []
                    key, held = now, []
                held.append(bits[start:stop].astype(np.int64))
            yield pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in found], pa.int64()), "b": pa.array([e[1] for e in found], pa.int64())})
        found = edges(held) if held else []
        yield pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in found], pa.int64()), "b": pa.array([e[1] for e in found], pa.int64())})

    runs = rows.repartition("u", "v", "part").sortWithinPartitions("u", "v", "part")
    return runs.mapInArrow(verify, "a long, b long").distinct()


def simhash_duplicates(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 lowercase hex digits), component_id (smallest id reachable
    over links, itself included). Two texts link if their fingerprints differ in ``DISTANCE`` bits or fewer.

    Null and empty texts and texts without words have the fingerprint zero, which links like any other. Rows that
    repeat an id each follow their own text. Null ids are given back with component null and link nothing. An empty
    table gives an empty result.
    """
    made = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    # aggregated map-side, so the copies of one text don't gather
    classes = made.where("doc_id is not null").groupBy("bits").agg(F.min("doc_id").alias("first"))
    classes = stored(classes, "fingerprint_classes")
    components = connected_components(links(classes.select("bits")), "fingerprint_links").withColumnRenamed("node", "bits")
    placed = stored(classes.join(components.hint("merge"), "bits", "left"), "fingerprint_components")
    firsts = placed.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    firsts = firsts.select(F.shiftright("component", 0).alias("component"), "least")
    of_class = placed.join(firsts.hint("merge"), "component", "left").select("bits", F.coalesce("least", "first").alias("component_id"))
    of_class = stored(of_class, "fingerprint_classes_placed")
    found = made.join(of_class.hint("merge"), "bits", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), component.alias("component_id"))
