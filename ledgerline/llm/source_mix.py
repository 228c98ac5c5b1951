"""Mixing sources to target weights, with DataFrame functions only.

1. Sources share the total number of words by weight; a target stops at ``max_epochs`` times its source's size and the
   excess goes to the others by weight. That is the water level ``l`` with ``sum(min(cap, weight * l)) = total``.
2. Every document is cut into blocks of at most ``block_words`` words. Each source's blocks are put in a random order
   (by hash) once per epoch, whole epochs first. Places in that order come from prefix sums over hash buckets of bounded
   size, so no source, however large, is sorted in one task. A source's quota is the number of blocks that reach its
   target; the last one may be taken in part.
3. The exact block quotas are split among the output shards by a tree: each node halves its capacity and draws the
   sources' parts from the multivariate hypergeometric distribution (as a random permutation of all blocks would),
   source by source, by inversion of the exact hypergeometric probabilities.
4. Each shard draws what its leaf says: its disjoint interval of every source's permuted blocks. A block in no leaf's
   interval isn't drawn. The shards are written (``write_shards``), each shuffled locally by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE, let, stored

#: Expected block rows of one hash bucket of a source and epoch.
BUCKET_ROWS = 4096
_ALL = Window.unboundedPreceding


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", row_id: Column | None = None) -> DataFrame:
    """(row_id, doc_id, source, size), stored once: later steps read no text. ``row_id`` tells repeated rows apart; None:
    rows are numbered as they're read."""
    rows = docs.select(
        (F.monotonically_increasing_id() if row_id is None else row_id).alias("row_id"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    return stored(rows, "sizes")


def targets(sizes: DataFrame, weights: list[float], max_epochs: float = 3.0) -> DataFrame:
    """One row per source: source, sid (place by code point, null last), source_size, target. ``weights`` repeat over
    the sources in that order. The windows here see one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    capped = listed.withColumn("w", w).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    every, order = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("w"), "sid")
    earlier = order.rowsBetween(_ALL, -1)
    sums = capped.select(
        "*",
        F.sum("source_size").over(every).cast("double").alias("total"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0))).alias("open_w"),
        F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)).alias("closed"),
    )
    # the level if exactly the sources before this one stop at their caps; right for the first that stays below its own
    level = sums.withColumn("l", (F.col("total") - F.col("closed")) / F.col("open_w"))
    first = level.withColumn("l", F.min(F.when(F.col("w") * F.col("l") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "sid", "l"))).over(every)["l"])
    target = F.when(F.col("total") > 0, F.least(F.col("cap"), F.col("w") * F.coalesce("l", F.lit(float("inf"))))).otherwise(0.0)
    return first.select("source", "sid", "source_size", target.alias("target"))


def permuted_blocks(sizes: DataFrame, goals: DataFrame, block_words: int = 512, seed: str = "mix") -> DataFrame:
    """Every block of the epochs that a source's target reaches into: sid, rank (0, 1, ... in the source's order, over
    all epochs), row_id, doc_id, epoch, block, words, open (words of the target that the blocks before leave open)."""
    w = F.lit(block_words).cast("long")
    # the sources' numbers meet in a table of sources first; documents join it once
    per_source = sizes.groupBy(F.col("source").alias("block_source")).agg(F.sum(F.ceil(F.col("size") / w)).alias("blocks"))
    goal = goals.join(per_source, F.col("source").eqNullSafe(F.col("block_source"))).select(
        F.col("source").alias("goal_source"), "sid", "source_size", "blocks", F.round("target").cast("long").alias("quota")
    )
    docs = sizes.where("size > 0").join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).where("quota > 0")
    epochs = F.ceil(F.col("quota") / F.col("source_size"))
    cut = docs.select("sid", "row_id", "doc_id", "size", "source_size", "quota", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)).alias("epoch"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / w) - 1)).alias("block"))
    key = F.substring(F.md5(F.concat_ws("/", F.lit(seed), "epoch", "doc_id", "block").cast("binary")), 1, 15)
    keyed = cut.select(
        "sid", "epoch", "row_id", "doc_id", "block", "source_size", "quota", F.least(w, F.col("size") - F.col("block") * w).alias("words"), key.alias("key"),
        F.floor(F.conv(F.substring(key, 1, 7), 16, 10).cast("double") / F.lit(float(16**7)) * F.ceil(F.col("blocks") / F.lit(BUCKET_ROWS))).alias("bucket"),
    )
    group = ["sid", "epoch", "bucket"]
    totals = keyed.groupBy(*group).agg(F.sum("words").alias("bucket_words"), F.count("*").alias("bucket_blocks"), F.max("source_size").alias("size_of"))
    buckets = Window.partitionBy("sid").orderBy("epoch", "bucket").rowsBetween(_ALL, -1)
    bases = totals.select(*group, F.coalesce(F.sum("bucket_words").over(buckets), F.lit(0)).alias("base_words"), F.coalesce(F.sum("bucket_blocks").over(buckets), F.lit(0)).alias("base_blocks"))
    inside = Window.partitionBy(*group).orderBy("key", "row_id", "block").rowsBetween(_ALL, -1)
    placed = keyed.withColumns({"before": F.coalesce(F.sum("words").over(inside), F.lit(0)), "number": F.count("*").over(inside)}).join(bases, group)
    start = F.col("base_words") + F.col("before")
    rank = (F.col("base_blocks") + F.col("number")).alias("rank")
    return placed.select("sid", rank, "row_id", "doc_id", "epoch", "block", "words", (F.col("quota") - start).alias("open"))


def hypergeometric(N: Column, K: Column, n: Column, u: Column) -> Column:
    """The number of marked among ``n`` drawn of ``N`` with ``K`` marked, by inversion at ``u`` in [0, 1).

    Probabilities are walked outward from the mode by their exact ratios, up and then down, to 12 standard deviations;
    what lies beyond is below double precision.
    """

    def walk(v: Column) -> Column:
        lo, hi = F.greatest(F.lit(0.0), v["drawn"] + v["marked"] - v["pool"]), F.least(v["drawn"], v["marked"])
        mode = F.least(hi, F.greatest(lo, F.floor((v["drawn"] + 1) * (v["marked"] + 1) / (v["pool"] + 2)).cast("double")))
        p = v["marked"] / F.greatest(v["pool"], F.lit(1.0))
        sd = F.sqrt(v["drawn"] * p * (1 - p))
        reach = F.ceil(12 * sd + 12).cast("double")
        up, down = F.least(hi, mode + reach), F.greatest(lo, mode - reach)
        steps = lambda a, b, by: F.when(a * by <= b * by, F.sequence(a.cast("long"), b.cast("long"), F.lit(by).cast("long"))).otherwise(F.array().cast("array<long>"))
        rising, falling = steps(mode + 1, up, 1), steps(mode - 1, down, -1)
        to_up = lambda x: (v["marked"] - x + 1) * (v["drawn"] - x + 1) / (x * (v["pool"] - v["marked"] - v["drawn"] + x))  # noqa: E731  p(x)/p(x-1)
        to_down = lambda x: (x + 1) * (v["pool"] - v["marked"] - v["drawn"] + x + 1) / ((v["marked"] - x) * (v["drawn"] - x))  # noqa: E731  p(x)/p(x+1)
        state = lambda p, c, at: F.struct(p.alias("p"), c.alias("c"), at.alias("at"))
        none = F.lit(None).cast("double")

        def run(xs: Column, ratio, start: Column, goal: Column) -> Column:
            def step(a: Column, x: Column) -> Column:
                nxt = a["p"] * ratio(x.cast("double"))
                hit = F.when(a["at"].isNull() & (a["c"] + nxt > goal), x.cast("double")).otherwise(a["at"])
                return state(nxt, a["c"] + nxt, hit)

            return F.aggregate(xs, start, step)

        one, far = F.lit(1.0), F.lit(float("inf"))
        total = run(rising, to_up, state(one, one, none), far)["c"] + run(falling, to_down, state(one, F.lit(0.0), none), far)["c"]

        def find(goal: Column) -> Column:
            above = run(rising, to_up, state(one, one, F.when(goal < 1, mode).otherwise(none)), goal)
            return let(above, lambda a: F.coalesce(run(falling, to_down, state(one, a["c"], a["at"]), goal)["at"], mode))

        return let(v["u"] * total, find).cast("long")

    d = lambda c, name: c.cast("double").alias(name)
    return let(F.struct(d(N, "pool"), d(K, "marked"), d(n, "drawn"), d(u, "u")), walk)


def splitting_tree(quotas: DataFrame, shards: int, seed: str = "mix") -> DataFrame:
    """(sid, shard, n) from (sid, n): the blocks of each source in each shard. ``shards`` is a power of two. Shard sizes
    differ by at most one per level; a node row holds one number per source."""
    root = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("sid", "n"))).alias("q")).select(F.lit(1).cast("long").alias("node"), "q")
    root = root.where(F.size("q") > 0)

    def split(node: Column, q: Column) -> Column:
        """Left child's numbers, source by source, each conditional on those before."""
        total = F.aggregate(q, F.lit(0).cast("long"), lambda a, s: a + s["n"])
        out = F.array().cast("array<struct<sid:int,n:bigint>>")

        def step(a: Column, s: Column) -> Column:
            u = F.pmod(F.xxhash64(F.lit(seed), node, s["sid"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
            return let(
                hypergeometric(a["pool"], s["n"], a["open"], u),
                lambda x: F.struct((a["pool"] - s["n"]).alias("pool"), (a["open"] - x).alias("open"), F.concat(a["out"], F.array(F.struct(s["sid"].alias("sid"), x.alias("n")))).alias("out")),
            )

        return let(total, lambda t: F.aggregate(q, F.struct(t.alias("pool"), F.floor(t / 2).alias("open"), out.alias("out")), step)["out"])

    tree, level = root, 1
    while level < shards:
        level *= 2
        halves = tree.select("node", "q", split(F.col("node"), F.col("q")).alias("left"))
        right = F.transform("q", lambda s, i: F.struct(s["sid"].alias("sid"), (s["n"] - F.get("left", i)["n"]).alias("n")))
        pair = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("q")), F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("q")))
        tree = halves.select(F.inline(pair))
    leaves = tree.select("node", F.inline("q"))
    return leaves.select("sid", (F.col("node") - shards).cast("int").alias("shard"), "n")


def mix_sources(sizes: DataFrame, goals: DataFrame, shards: int = 16, block_words: int = 512, seed: str = "mix") -> DataFrame:
    """The mix: shard, place (local shuffle key), sid, row_id, doc_id, epoch, block, words; one row per drawn block.

    ``sizes`` from ``sized``, ``goals`` from ``targets``. Every source's drawn words sum to its rounded target; a block
    is drawn at most once per epoch, so no document exceeds ``max_epochs`` times its size. Reruns over the same rows
    agree. Documents without words and sources without a target draw nothing; an empty table gives no rows.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    blocks = stored(permuted_blocks(sizes, goals, block_words, seed), "permuted")
    quotas = blocks.where("open > 0").groupBy("sid").agg(F.count("*").alias("n"))
    leaves = stored(splitting_tree(quotas, shards, seed), "tree")
    ends = leaves.withColumn("end", F.sum("n").over(Window.partitionBy("sid").orderBy("shard")))
    per_source = ends.where("n > 0").groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("ends"))  # ``shards`` at most
    # the leaves' intervals decide what is drawn, and by which shard
    shard = F.get(F.filter("ends", lambda e: e["end"] > F.col("rank")), F.lit(0))["shard"]
    place = F.xxhash64(F.lit(seed), F.lit("place"), "row_id", "epoch", "block")
    drawn = blocks.join(per_source, "sid").withColumn("shard", shard).where("shard is not null")
    words = F.least(F.col("words"), F.col("open")).alias("words")
    return drawn.select("shard", place.alias("place"), "sid", "row_id", "doc_id", "epoch", "block", words)


def write_shards(mix: DataFrame, name: str = "shards") -> DataFrame:
    """Write the shards below the shared folder and read them back: ranges of (shard, place), sorted, so a shard is a run
    of files and its rows are in their shuffled order, however large it is."""
    order = ["shard", "place", "row_id", "epoch", "block"]
    return stored(mix.repartitionByRange(*order).sortWithinPartitions(*order), name)


def taken_words(sizes: DataFrame, goals: DataFrame, mix: DataFrame) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken (words the shards hold of it, repeats counted),
    blocks (places it has in the shards)."""
    of_shard = mix.groupBy("row_id", "shard").agg(F.sum("words").alias("words"), F.count("place").alias("places"))
    taken = of_shard.groupBy("row_id").agg(F.sum("words").alias("taken"), F.sum("places").alias("blocks"))
    goal = goals.select(F.col("source").alias("goal_source"), "source_size", "target")
    rows = sizes.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).join(taken, "row_id", "left")
    number = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.select("doc_id", "size", "source_size", "target", number("taken"), number("blocks"))


def mixed_documents(docs: DataFrame, weights: list[float], max_epochs: float = 3.0, shards: int = 16, seed: str = "mix") -> DataFrame:
    """``docs`` (doc_id, source, text and any other columns) with every document as often as the mix draws it.

    Documents are blocks of their own here, so each is drawn whole; a source exceeds its target by less than one
    document. Rows equal in id, text and source count as one document: each is given out as often as that one. Documents
    without words are never drawn.
    """
    key = F.xxhash64("doc_id", "text", "source")
    sizes = stored(sized(docs, row_id=key).dropDuplicates(["row_id"]), "documents_sized")
    drawn = mix_sources(sizes, targets(sizes, weights, max_epochs), shards, 1 << 30, seed)
    copies = drawn.groupBy("row_id").agg(F.count("*").cast("int").alias("copies")).select(F.col("row_id").alias("key__"), "copies")
    # the drawn documents have no size bound: the same shuffle join at every size
    met = docs.join(copies.hint("merge"), key == F.col("key__"))
    return met.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy__")).drop("copy__")
