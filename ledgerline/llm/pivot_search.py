"""Exact top-k inner product search by pivot-table elimination.

Every vector's distances to a fixed set of pivots are computed once and stored with its block. For a query q and a
candidate x, ``max_p |d(q,p) - d(x,p)|`` is a lower bound of d(q,x), and so ``(|q|^2 + |x|^2 - bound^2) / 2`` an upper
bound of their inner product. A row's level is the k-th best score it has so far (at first among a bounded sample of
rows, which are rows like any other): candidates whose bound is below it can't be among the k best.

* Rows lie in the cell of their nearest pivot; cells are cut in blocks, and a block keeps the interval of its rows'
  distances to every pivot. Cells, then blocks, that no query's bound reaches are skipped.
* A query takes its blocks in the order of their bounds, in rounds; in a block, its candidates in the order of theirs:
  the best 4k first, then those whose bound still reaches its level. What is evaluated is counted per query.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerline.llm.common import stored
from ledgerline.llm.hard_negatives import LEAST, choose_centres, distances, exact_scores, matrix, squares

BLOCK = "cell int, chunk int, n long, ids binary, vectors binary, pivots binary"


def quantized(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): floor(scale * x) per component, as integer-valued doubles. Left out: null ids, null or empty vectors,
    vectors with null or non-finite components. Of rows with one id, the greatest vector in array order stays."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double") * scale)
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.coalesce((F.size("x") > 0) & F.forall("x", fits), F.lit(False))
    )
    # beyond 2^53 a double is an integer already, and floor() to a long would leave the range
    whole = lambda c: F.when(F.abs(c) < float(2**53), F.floor(c).cast("double")).otherwise(c)
    return rows.groupBy("vec_id").agg(F.max(F.transform("x", whole)).alias("v"))


def upper_bounds(q2, x2, gap):
    """Greatest inner products of vectors with squared norms ``q2`` and ``x2`` whose distance is at least ``gap``. The
    margin is far over the rounding of squares and roots; a bound that is no number eliminates nothing."""
    import numpy as np

    both = q2 + x2
    most = (both - np.maximum(gap * (1 - 1e-9), 0) ** 2) / 2 + 1e-6 * both
    # scores stop at the ends of a long, and so do bounds
    return np.clip(np.where(np.isnan(most), np.inf, most), -(2.0**63), 2.0**63)


class TopK:
    """The ``k`` best rows of every query so far; ``level`` is what a score must reach to matter."""

    def __init__(self, ids, vectors, pivots, k: int):
        import numpy as np

        self.ids, self.q, self.q2, self.k = ids, vectors, squares(vectors), k
        self.near = distances(vectors, pivots)
        self.level = np.full(len(ids), LEAST, np.int64)
        self.best = {"of": np.zeros(0, np.int64), "score": np.zeros(0, np.int64), "id": np.zeros(0, np.int64)}
        self.evaluated = 0

    def add(self, of, ids, scores) -> None:
        """Merge scores of single (query, row) pairs."""
        import numpy as np

        self.evaluated += len(of)
        keep = (scores >= self.level[of]) & (ids != self.ids[of])
        merged = {c: np.concatenate([self.best[c], v[keep]]) for c, v in (("of", of), ("score", scores), ("id", ids))}
        order = np.lexsort((merged["id"], -merged["score"], merged["of"]))
        of_all = merged["of"][order]
        rank = np.arange(len(order)) - np.searchsorted(of_all, of_all)
        self.best = {c: v[order][rank < self.k] for c, v in merged.items()}
        full = order[rank == self.k - 1]
        self.level[merged["of"][full]] = merged["score"][full]

    def evaluate(self, of, block: dict, mask) -> None:
        """Scores of the pairs in ``mask`` (queries ``of`` x rows of the block)."""
        import numpy as np

        i, j = np.nonzero(mask)
        if len(i) > mask.size // 8:
            scores = exact_scores(self.q[of], block["vectors"])[i, j]
        else:  # few of them: pair by pair
            scores = np.empty(len(i), np.int64)
            for s in range(0, len(i), 1 << 13):
                part = slice(s, s + (1 << 13))
                x, y = self.q[of[i[part]]], block["vectors"][j[part]]
                large = len(x) and np.sqrt(squares(x).max()) * np.sqrt(squares(y).max()) >= 2.0**52
                scores[part] = np.array([exact_scores(a[None], b[None])[0, 0] for a, b in zip(x, y)], np.int64) if large else (x * y).sum(1)
        self.add(of[i], block["ids"][j], scores)

    def reach(self, low, high, x2):
        """Bounds for rows whose distances to the pivots lie within ``low`` and ``high``, with squared norms to ``x2``."""
        import numpy as np

        gap = np.zeros(len(self.ids))
        for p in range(self.near.shape[1]):
            gap = np.maximum(gap, np.maximum(self.near[:, p] - high[p], low[p] - self.near[:, p]))
        return upper_bounds(self.q2, x2, gap)

    def in_block(self, of, block: dict) -> None:
        """Candidates of a block for the queries ``of``, in the order of their bounds."""
        import numpy as np

        for s in range(0, len(of), 512):  # bounded memory
            some = of[s : s + 512]
            gap = np.zeros((len(some), len(block["ids"])))
            for p in range(self.near.shape[1]):
                np.maximum(gap, np.abs(self.near[some, p][:, None] - block["pivots"][:, p][None, :]), out=gap)
            bound = upper_bounds(self.q2[some][:, None], block["x2"][None, :], gap)
            open_ = bound >= self.level[some][:, None]
            first = open_
            if bound.shape[1] > 8 * self.k:
                first = open_ & (bound >= -np.partition(-bound, 4 * self.k, axis=1)[:, 4 * self.k][:, None])
            if first.any():
                self.evaluate(some, block, first)
            rest = open_ & ~first & (bound >= self.level[some][:, None])
            if rest.any():
                self.evaluate(some, block, rest)

    def through(self, blocks: list[dict]) -> None:
        import numpy as np

        bound = np.stack([self.reach(b["pivots"].min(0), b["pivots"].max(0), b["x2"].max()) for b in blocks], 1)
        order, n = np.argsort(-bound, axis=1, kind="stable"), len(blocks)
        start, width = 0, 1
        while start < n:
            now = order[:, start : start + width]
            on = np.take_along_axis(bound, now, 1) >= self.level[:, None]
            for b in np.unique(now[on]):
                self.in_block(np.flatnonzero(((now == b) & on).any(1)), blocks[b])
            start, width = start + width, 2 * width


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, n_pivots: int = 24, block_rows: int = 512,
    chunk_rows: int = 16_384, group_rows: int = 8_192, sample_rows: int = 2048, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest integer inner products of each query with every other row.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller id; with fewer than k candidates all are returned.
    Vectors of different length: missing components count as 0. Scores are exact integers, those beyond the range of a
    long are its ends. See ``quantized`` for rows that take no part and for repeated ids. No queries, or an empty table: an
    empty result. The pivots and first levels come from the first ``sample_rows`` rows in hash order (they set the speed,
    never the result). A task searches ``chunk_rows`` rows of a cell for ``group_rows`` queries.
    """
    import numpy as np

    rows = stored(quantized(vectors, scale, id_col, vec_col), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if not width:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vec_id", "v").toArrow()
    sample_ids, sample = picked.column(0).to_numpy(), matrix(picked.column(1).combine_chunks(), width)
    pivots = choose_centres(sample, n_pivots)

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            near = distances(matrix(b.column(1), width), pivots)
            cell = near.argmin(1) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], ["vec_id", "v", "cell"])

    def build(batches: Iterator) -> Iterator:
        """Blocks of rows of one cell, which arrive as runs; a partition's blocks of a cell are dealt to chunks."""
        import pyarrow as pa
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            cell, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 0))
            x = matrix(b.column(1), width)
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), b.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                for s in range(start, stop, block_rows):
                    some = slice(s, min(s + block_rows, stop))
                    c = int(cell[s])
                    seen[c] = seen.get(c, 0) + some.stop - some.start
                    chunk = (part << 12) + (seen[c] - 1) // chunk_rows
                    arrays = (ids[some].astype("<i8"), x[some].astype("<f8"), distances(x[some], pivots).astype("<f8"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c], pa.int32()), pa.array([chunk], pa.int32()), pa.array([some.stop - some.start], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)],
                        [f.split()[0] for f in BLOCK.split(", ")],
                    )

    placed = stored(rows.select("vec_id", "v").mapInArrow(place, "vec_id long, v array<double>, cell int"), "placed")
    tie = F.xxhash64("vec_id")  # splits a cell that holds any share of the rows
    runs = placed.repartitionByRange("cell", tie).sortWithinPartitions("cell", tie)
    blocks = stored(runs.select("vec_id", "v", "cell").mapInArrow(build, BLOCK), "blocks")
    chunks = stored(blocks.select("cell", "chunk").distinct(), "chunks")

    def facts(batches: Iterator) -> Iterator:
        """Per batch and cell: the intervals of the distances to the pivots, and the greatest squared norm."""
        import pyarrow as pa

        for b in batches:
            for c, n, raw, vec in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                near = np.frombuffer(raw, "<f8").reshape(n, -1)
                x2 = float(squares(np.frombuffer(vec, "<f8").reshape(n, -1)).max())
                low, high = near.min(0).tolist(), near.max(0).tolist()
                yield pa.RecordBatch.from_pydict({"cell": pa.array([c] * len(low), pa.int32()), "pivot": pa.array(range(len(low)), pa.int32()), "low": low, "high": high, "x2": [x2] * len(low)})

    spans = blocks.select("cell", "n", "pivots", "vectors").mapInArrow(facts, "cell int, pivot int, low double, high double, x2 double")
    spans = spans.groupBy("cell", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("x2").alias("x2"))
    cells: dict[int, tuple] = {}
    for r in spans.orderBy("cell", "pivot").collect():  # at most n_pivots squared rows
        low, high, x2 = cells.setdefault(r["cell"], ([], [], []))
        low.append(r["low"]), high.append(r["high"]), x2.append(r["x2"])

    def route(batches: Iterator) -> Iterator:
        """The cells that a query's bound can reach, given its level in the sample."""
        import pyarrow as pa

        for b in batches:
            for s in range(0, b.num_rows, 1024):
                some = b.slice(s, 1024)
                found = TopK(some.column(0).to_numpy(zero_copy_only=False), matrix(some.column(1), width), pivots, k)
                for r in range(0, len(sample), 256):
                    scores = exact_scores(found.q, sample[r : r + 256])
                    of = np.repeat(np.arange(some.num_rows), scores.shape[1])
                    found.add(of, np.tile(sample_ids[r : r + 256], some.num_rows), scores.ravel())
                for c, (low, high, x2) in cells.items():
                    go = np.flatnonzero(found.reach(low, high, max(x2)) >= found.level)
                    taken = some.take(pa.array(go))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(found.level[go]), pa.array(np.full(len(go), c, np.int32))], ["vec_id", "v", "level", "cell"])

    queries = stored(rows.where(is_query), "queries")
    groups = max(1, -(-queries.count() // group_rows))
    routed = queries.select("vec_id", "v").mapInArrow(route, "vec_id long, v array<double>, level long, cell int")
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("part")
    left = routed.join(chunks, "cell").select("cell", "chunk", dealt, "vec_id", "v", "level")
    right = blocks.select("cell", "chunk", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "ids", "vectors", "pivots")

    def meet(left, right):
        """One group of queries (about ``group_rows`` at most) and the blocks of one chunk."""
        import pyarrow as pa

        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        held = []
        for r in right.to_pylist():
            ids = np.frombuffer(r["ids"], "<i8")
            x = np.frombuffer(r["vectors"], "<f8").reshape(len(ids), -1)
            held.append({"ids": ids, "vectors": x, "x2": squares(x), "pivots": np.frombuffer(r["pivots"], "<f8").reshape(len(ids), -1)})
        found = TopK(left.column("vec_id").to_numpy(), matrix(left.column("v").combine_chunks(), width), pivots, k)
        found.level = left.column("level").to_numpy().copy()
        found.through(held)
        columns = {"query_id": found.ids[found.best["of"]], "vec_id": found.best["id"], "score": found.best["score"]}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in columns.items()})

    met = left.groupBy("cell", "chunk", "part").cogroup(right.groupBy("cell", "chunk", "part"))
    best = met.applyInArrow(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
