"""Hard-negative mining with cover trees over norm-augmented candidates.

Candidates get one more component, ``sqrt(M^2 - |x|^2)`` with M the greatest norm, and queries a 0 there. Then
``d(q, x)^2 = |q|^2 + M^2 - 2 q.x``, so a ball of covering radius r around a tree node's centre bounds the inner
products of all rows below it from both sides.

* Every row lies in the cell of its nearest of at most ``cells`` centres (chosen from a bounded sample; they set the
  speed, never the result). Cells are cut in blocks of at most ``block_rows`` rows; each block is a cover tree: on a level
  the centres are more than the level's scale apart, every row is within it of its centre, and a node keeps the true
  covering radius of its rows.
* A search has windows of scores per query (lowest, highest, how many). Cells, trees and nodes are skipped if their
  bounds lie outside every window, or below the last score that a full window already holds; the leaves that remain are
  evaluated in the order of their bounds, in rounds, and their rows are compared exactly.
* Mining searches twice: an anchor's positives (one open window, rows of the same label), then for each positive the
  window of its negatives (rows of other labels).

Scores are integers. They are computed in float64 where no partial sum can pass 2^53, else in Python's integers; scores
beyond the range of a long are given as its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerline.llm.common import stored

LEAST, MOST = -(2**63) + 1, 2**63 - 1
#: Rows of a leaf that is not split any more. A node also stays a leaf if its split left mostly single rows (or none).
LEAF = 32
TREE = "cell int, chunk int, n long, reach double, ids binary, labels binary, vectors binary, nodes binary"
#: One tree node: level by level; rows [start, stop), children [first, last), covering radius. Its centre is row start.
NODE = [("start", "<i4"), ("stop", "<i4"), ("first", "<i4"), ("last", "<i4"), ("radius", "<f8")]


def quantized(vectors: DataFrame, label: Column, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, label, v): floor(scale * x) per component, as integer-valued doubles. Left out: null ids or labels, null
    vectors, vectors with null or non-finite components. Of rows with one id, the greatest (label, vector) stays."""
    raw = F.transform(F.col(vec_col), lambda c: c.cast("double") * scale)
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), raw.alias("x"))
    rows = rows.where("vec_id is not null and label is not null").where(F.coalesce(F.forall("x", fits), F.lit(False)))
    # beyond 2^53 a double is an integer already, and floor() to a long would leave the range
    whole = lambda c: F.when(F.abs(c) < float(2**53), F.floor(c).cast("double")).otherwise(c)
    best = rows.groupBy("vec_id").agg(F.max(F.struct("label", F.transform("x", whole).alias("v"))).alias("r"))
    return best.select("vec_id", "r.label", "r.v")


def matrix(column, width: int):
    """An Arrow column of lists as one matrix; missing components count as 0."""
    import numpy as np

    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values[offsets[0] : offsets[-1]].astype(np.float64).reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values[offsets[0] : offsets[-1]]
    return out


def squares(x):
    return (x * x).sum(1)


def augmented(x, greatest: float):
    """Candidates with the component that gives all of them the norm ``greatest``."""
    import numpy as np

    return np.hstack([x, np.sqrt(np.maximum(greatest * greatest - squares(x), 0))[:, None]])


def distances(x, y):
    """Distances of every row of ``x`` to every row of ``y``, from differences (no cancellation)."""
    import numpy as np

    return np.stack([np.sqrt(squares(x - c)) for c in y], 1) if len(y) else np.zeros((len(x), 0))


def cover_tree(points):
    """(order of the rows, nodes) of a cover tree over a block's points; a node's rows are neighbours in that order."""
    import numpy as np

    order, nodes = np.arange(len(points)), np.zeros(1, NODE)
    away = np.sqrt(squares(points - points[0]))
    nodes[0]["stop"], nodes[0]["radius"] = len(points), away.max()
    level = [(0, away.max())]
    while level:
        below = []
        for i, scale in level:
            start, stop = int(nodes[i]["start"]), int(nodes[i]["stop"])
            if stop - start <= LEAF or nodes[i]["radius"] == 0:
                continue
            rows, children = order[start:stop], []
            # the scale halves until the node's rows split; its centre stays the centre of its first child
            while len(children) < 2:
                scale, left, children = scale / 2, rows, []
                while len(left):
                    d = np.sqrt(squares(points[left] - points[left[0]]))
                    near = d <= scale
                    near[0] = True
                    children.append((left[near], float(d[near].max())))
                    left = left[~near]
            if 4 * len(children) > len(rows):  # nothing is near anything else here: the node stays a leaf
                continue
            order[start:stop] = np.concatenate([c for c, _ in children])
            new = np.zeros(len(children), NODE)
            new["start"] = start + np.cumsum([0, *(len(c) for c, _ in children[:-1])])
            new["stop"], new["radius"] = new["start"] + [len(c) for c, _ in children], [r for _, r in children]
            nodes[i]["first"], nodes[i]["last"] = len(nodes), len(nodes) + len(new)
            below += [(len(nodes) + k, scale) for k in range(len(new))]
            nodes = np.concatenate([nodes, new])
        level = below
    return order, nodes


def choose_centres(sample, n: int):
    """Farthest-first choice of at most ``n`` rows of a bounded sample."""
    import numpy as np

    picked, gap = [0], np.sqrt(squares(sample - sample[0]))
    while len(picked) < min(n, len(sample)) and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, np.sqrt(squares(sample - sample[picked[-1]])))
    return sample[picked]


def bounds(products, q2, greatest: float, radius):
    """Least and greatest inner product of a query with rows within ``radius`` of a centre, from the inner product with
    the centre. The margin is far over the rounding of the squares (1e-16) and of the root (1e-8)."""
    import numpy as np

    both = q2 + greatest * greatest
    d = np.sqrt(np.maximum(both - 2 * products, 0))
    least, most = (both - (d + radius) ** 2) / 2 - 1e-6 * both, (both - np.maximum(d - radius, 0) ** 2) / 2 + 1e-6 * both
    return np.clip(least, -(2.0**63), 2.0**63), np.clip(most, -(2.0**63), 2.0**63)


def exact_scores(q, x):
    """Integer inner products as int64: exact where they fit, else the ends of the range."""
    import numpy as np

    if len(q) and len(x) and np.sqrt(squares(q).max()) * np.sqrt(squares(x).max()) >= 2.0**52:
        whole = lambda m: np.array([[int(c) for c in row] for row in m.tolist()], object).reshape(m.shape)
        return np.clip(whole(q) @ whole(x).T, LEAST, MOST).astype(np.int64)
    return (q @ x.T).astype(np.int64)


class Search:
    """Windows of scores per query: ``low`` and ``high`` (queries x windows, inclusive; an empty window has low > high),
    the ``k`` best rows of each; rows of the query's label (``same``) or of other labels; never the query's own id."""

    def __init__(self, ids, labels, vectors, low, high, k: int, same: bool, greatest: float):
        import numpy as np

        self.ids, self.labels, self.q, self.low, self.high = ids, labels, vectors, low, high
        self.k, self.same, self.greatest, self.q2 = k, same, greatest, squares(vectors)
        n = low.size
        self.best = {"of": np.zeros(0, np.int64), "score": np.zeros(0, np.int64), "id": np.zeros(0, np.int64)}
        self.level = np.full(n, LEAST, np.int64).reshape(low.shape)  # a row must reach it to matter
        self.evaluated = 0

    def wanted(self, of, least, most):
        """Whether rows with scores between ``least`` and ``most`` can matter to the queries ``of``."""
        import numpy as np

        floor = np.maximum(self.low[of], self.level[of])
        return ((floor <= self.high[of]) & (most[:, None] >= floor) & (least[:, None] <= self.high[of])).any(1)

    def take(self, of, ids, labels, scores) -> None:
        """Merge evaluated rows: ``scores`` of the queries ``of`` with the rows ``ids``."""
        import numpy as np

        self.evaluated += scores.size
        fits = (labels[None, :] == self.labels[of][:, None]) == self.same
        fits &= ids[None, :] != self.ids[of][:, None]
        found = [self.best]
        for w in range(self.low.shape[1]):
            floor = np.maximum(self.low[of, w], self.level[of, w])
            i, j = np.nonzero(fits & (scores >= floor[:, None]) & (scores <= self.high[of, w][:, None]))
            found.append({"of": of[i] * self.low.shape[1] + w, "score": scores[i, j], "id": ids[j]})
        merged = {c: np.concatenate([f[c] for f in found]) for c in self.best}
        order = np.lexsort((merged["id"], -merged["score"], merged["of"]))
        of_all = merged["of"][order]
        rank = np.arange(len(order)) - np.searchsorted(of_all, of_all)
        self.best = {c: v[order][rank < self.k] for c, v in merged.items()}
        full = order[rank == self.k - 1]
        self.level.reshape(-1)[merged["of"][full]] = merged["score"][full]

    def through(self, trees: list[dict]) -> None:
        """Search trees: the nodes of each level, the leaves that remain in rounds by their greatest bound."""
        import numpy as np

        leaves = []
        for t, tree in enumerate(trees):
            nodes, x = tree["nodes"], tree["vectors"]
            of, at = np.arange(len(self.q)), np.zeros(len(self.q), np.int64)
            while len(of):
                products = np.empty(len(of))
                for s in range(0, len(of), 1 << 14):  # bounded memory
                    part = slice(s, s + (1 << 14))
                    products[part] = (self.q[of[part]] * x[nodes["start"][at[part]]]).sum(1)
                least, most = bounds(products, self.q2[of], self.greatest, nodes["radius"][at])
                on = self.wanted(of, least, most)
                of, at, least, most = of[on], at[on], least[on], most[on]
                inner = nodes["last"][at] > 0
                if len(rest := np.flatnonzero(~inner)):
                    leaves.append(np.stack([of[rest], np.full(len(rest), t), at[rest], least[rest], most[rest]], 1))
                first, n = nodes["first"][at[inner]].astype(np.int64), (nodes["last"] - nodes["first"])[at[inner]].astype(np.int64)
                of = np.repeat(of[inner], n)
                at = np.repeat(first, n) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        if not leaves:
            return
        left = np.concatenate(leaves)
        # best first: bounds above every window of a query say nothing, so they are cut to its highest
        reach = np.minimum(left[:, 4], self.high.max(1)[left[:, 0].astype(np.int64)])
        left = left[np.lexsort((-reach, left[:, 0]))]
        width = 1
        while len(left):
            of = left[:, 0].astype(np.int64)
            now = np.arange(len(left)) - np.searchsorted(of, of) < width
            some, left, width = left[now], left[~now], 2 * width
            some = some[np.lexsort((some[:, 2], some[:, 1]))]
            cuts = np.flatnonzero((np.diff(some[:, 1]) != 0) | (np.diff(some[:, 2]) != 0)) + 1
            for group in np.split(some, cuts):
                tree = trees[int(group[0, 1])]
                node, of = tree["nodes"][int(group[0, 2])], group[:, 0].astype(np.int64)
                rows = slice(int(node["start"]), int(node["stop"]))
                for s in range(0, len(of), 2048):  # bounded memory
                    some_of = of[s : s + 2048]
                    self.take(some_of, tree["ids"][rows], tree["labels"][rows], exact_scores(self.q[some_of], tree["vectors"][rows]))
            if len(left):
                left = left[self.wanted(left[:, 0].astype(np.int64), left[:, 3], left[:, 4])]


class Index:
    """Cover trees of all rows, below the shared folder, with the bounded facts that searches need in the driver."""

    def __init__(self, rows: DataFrame, cells: int = 64, sample_rows: int = 2048, block_rows: int = 1024, least_chunks: int = 12):
        """``rows``: (vec_id, label, v). A chunk is what one task searches: up to 65,536 rows of one cell, fewer where
        that would leave less than ``least_chunks`` tasks."""
        import numpy as np

        self.rows = rows
        facts = rows.agg(F.count("*"), F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))).first()
        self.n, self.width, self.greatest = facts[0], facts[1] or 0, float(np.sqrt(facts[2] or 0.0)) * (1 + 1e-12)
        if not self.n:
            return
        width, greatest = self.width, self.greatest
        picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vec_id", "label", "v").toArrow()
        self.sample = {"ids": picked.column(0).to_numpy(), "labels": picked.column(1).to_numpy(), "vectors": matrix(picked.column(2).combine_chunks(), width)}
        centres = choose_centres(augmented(self.sample["vectors"], greatest), cells)
        chunk_rows = int(min(65_536, max(4 * block_rows, self.n / least_chunks)))

        def place(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for b in batches:
                x = augmented(matrix(b.column(2), width), greatest)
                cell = distances(x, centres).argmin(1) if b.num_rows else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], ["vec_id", "label", "v", "cell"])

        def build(batches: Iterator) -> Iterator:
            """Rows arrive as runs of one cell; a run is cut in blocks, and a partition's blocks of a cell in chunks."""
            import pyarrow as pa
            from pyspark import TaskContext

            part, seen, held = TaskContext.get().partitionId(), {}, []

            def tree(cell, ids, labels, x):
                order, nodes = cover_tree(augmented(x, greatest))
                taken = seen[cell] = seen.get(cell, 0) + len(ids)
                chunk = (part << 12) + (taken - 1) // chunk_rows
                reach = float(distances(augmented(x, greatest), centres[cell : cell + 1]).max())
                arrays = (ids[order].astype("<i8"), labels[order].astype("<i8"), x[order].astype("<f8"), nodes)
                return pa.RecordBatch.from_arrays(
                    [pa.array([cell], pa.int32()), pa.array([chunk], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([reach]), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)],
                    [c.split()[0] for c in TREE.split(", ")],
                )

            def flush(upto: int) -> Iterator:
                """Blocks of the held rows of one cell, while ``upto`` rows or more are held."""
                nonlocal held
                if held and sum(len(h[1]) for h in held) >= upto:
                    ids, labels, x = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
                    stop = len(ids) if upto == 1 else len(ids) // block_rows * block_rows
                    for k in range(0, stop, block_rows):
                        some = slice(k, min(k + block_rows, stop))
                        yield tree(held[0][0], ids[some], labels[some], x[some])
                    held = [(held[0][0], ids[stop:], labels[stop:], x[stop:])] if stop < len(ids) else []

            for b in batches:
                cell, ids, labels = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 0, 1))
                x = matrix(b.column(2), width)
                cuts = np.flatnonzero(np.diff(cell)) + 1
                for start, stop in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
                    if start == stop:
                        continue
                    if held and held[0][0] != int(cell[start]):
                        yield from flush(1)
                    held.append((int(cell[start]), ids[start:stop], labels[start:stop], x[start:stop]))
                    yield from flush(block_rows)
            yield from flush(1)

        placed = stored(rows.select("vec_id", "label", "v").mapInArrow(place, "vec_id long, label long, v array<double>, cell int"), "placed")
        tie = F.xxhash64("vec_id")  # splits a cell that holds any share of the rows
        runs = placed.repartitionByRange("cell", tie).sortWithinPartitions("cell", tie)
        self.trees = stored(runs.select("vec_id", "label", "v", "cell").mapInArrow(build, TREE), "trees")
        # one row per cell: how far its rows reach from its centre
        reach = {r[0]: r[1] for r in self.trees.groupBy("cell").agg(F.max("reach")).collect()}
        self.cells = {"id": np.array(sorted(reach), np.int64)}
        self.cells |= {"centre": centres[self.cells["id"]][:, :-1], "radius": np.array([reach[c] for c in sorted(reach)])}
        self.chunks = stored(self.trees.select("cell", "chunk").distinct(), "chunks")

    def search(self, queries: DataFrame, k: int, same: bool, group_rows: int = 16_384) -> DataFrame:
        """(query_id, window, vec_id, score): the ``k`` best rows of each window of each query.

        ``queries``: (vec_id, label, v, low array<long>, high array<long>), all with the same number of windows.
        """
        sample, cells, greatest, width = self.sample, self.cells, self.greatest, self.width

        def of_batch(columns) -> Search:
            import numpy as np

            ids, labels = (columns[i].to_numpy(zero_copy_only=False) for i in (0, 1))
            low, high = (np.array(columns[i].to_pylist(), np.int64).reshape(len(ids), -1) for i in (3, 4))
            return Search(ids, labels, matrix(columns[2], width), low, high, k, same, greatest)

        def route(batches: Iterator) -> Iterator:
            """Cells that can hold a row of a query's windows; the sample's rows already give them a level."""
            import numpy as np
            import pyarrow as pa

            for b in batches:
                for s in range(0, b.num_rows, 1024):
                    some = b.slice(s, 1024)
                    search = of_batch(some.columns)
                    every = np.arange(some.num_rows)
                    for r in range(0, len(sample["ids"]), 256):
                        part = slice(r, r + 256)
                        search.take(every, sample["ids"][part], sample["labels"][part], exact_scores(search.q, sample["vectors"][part]))
                    go = []
                    for c in range(len(cells["id"])):
                        least, most = bounds(search.q @ cells["centre"][c], search.q2, greatest, cells["radius"][c])
                        go.append(search.wanted(every, least, most))
                    which, of = np.nonzero(np.stack(go))
                    level = [row.tolist() for row in search.level]
                    taken = pa.RecordBatch.from_arrays([*some.columns, pa.array(level, pa.list_(pa.int64()))], [*some.schema.names, "level"]).take(pa.array(of))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells["id"][which].astype(np.int32))], [*taken.schema.names, "cell"])

        shape = "vec_id long, label long, v array<double>, low array<long>, high array<long>"
        picked = stored(queries.select("vec_id", "label", "v", "low", "high"), "queries")
        groups = max(1, -(-picked.count() // group_rows))
        routed = picked.mapInArrow(route, f"{shape}, level array<long>, cell int")
        dealt = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("part")
        left = routed.join(self.chunks, "cell").select("chunk", "cell", dealt, "vec_id", "label", "v", "low", "high", "level")
        right = self.trees.select("chunk", "cell", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "ids", "labels", "vectors", "nodes")

        def meet(left, right):
            """One group of queries (at most about ``group_rows``) and the trees of one chunk."""
            import numpy as np
            import pyarrow as pa

            empty = {c: pa.array([], pa.int64()) for c in ("query_id", "window", "vec_id", "score")}
            if not left.num_rows or not right.num_rows:
                return pa.table(empty)
            trees = []
            for t in right.to_pylist():
                ids = np.frombuffer(t["ids"], "<i8")
                trees.append({"ids": ids, "labels": np.frombuffer(t["labels"], "<i8"), "vectors": np.frombuffer(t["vectors"], "<f8").reshape(len(ids), -1), "nodes": np.frombuffer(t["nodes"], NODE)})
            search = of_batch([left.column(c).combine_chunks() for c in ("vec_id", "label", "v", "low", "high")])
            search.level = np.array(left.column("level").to_pylist(), np.int64).reshape(search.low.shape)
            search.through(trees)
            windows = search.low.shape[1]
            found = {"query_id": search.ids[search.best["of"] // windows], "window": search.best["of"] % windows, "vec_id": search.best["id"], "score": search.best["score"]}
            return pa.table({c: pa.array(v, pa.int64()) for c, v in found.items()})

        met = left.groupBy("chunk", "cell", "part").cogroup(right.groupBy("chunk", "cell", "part"))
        best = met.applyInArrow(meet, "query_id long, window long, vec_id long, score long")
        order = Window.partitionBy("query_id", "window").orderBy(F.desc("score"), "vec_id")
        return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def share_of(score: Column, percent: int, up: bool) -> Column:
    """score * percent / 100 rounded up or down, for 0 <= percent <= 100: hundreds and rest apart, so that the product
    stays in the range of a long."""
    hundred = F.lit(100).cast("long")
    div = lambda x: F.call_function("div", x, hundred)
    part = (score % hundred) * percent + (99 if up else 0)
    return div(score) * percent + div(part - F.pmod(part, hundred))


def mine_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, n_negatives: int = 3, least_percent: int = 50,
    most_percent: int = 95, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", **index_options,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its
    ``n_positives`` best rows of the same label, the ``n_negatives`` best rows of other labels whose score is at least
    ``least_percent`` and at most ``most_percent`` of the positive's (all, if fewer; no row, if none).

    ``is_anchor`` is a condition on ``vec_id``; ``label`` an expression over ``vectors``. Ties go to the smaller id. A
    negative positive_score leaves an empty window. Vectors of different length: missing components count as 0, so an
    empty vector scores 0 with every row. See ``quantized`` for rows that take no part and for repeated ids. No anchors, or
    an empty table: an empty result.
    """
    rows = stored(quantized(vectors, label, scale, id_col, vec_col), "mined_vectors")
    index = Index(rows, **index_options)
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not index.n:
        return vectors.sparkSession.createDataFrame([], shape)
    anchors = rows.where(is_anchor)
    one = lambda v: F.array(F.lit(v).cast("long"))
    positives = stored(index.search(anchors.select("*", one(LEAST).alias("low"), one(MOST).alias("high")), n_positives, True), "positives")
    each = positives.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))  # n_positives at most
    pad = lambda f, empty: F.concat(F.transform("p", f), F.array_repeat(F.lit(empty).cast("long"), F.lit(n_positives) - F.size("p")))
    low = pad(lambda p: share_of(p["score"], least_percent, True), MOST).alias("low")
    high = pad(lambda p: share_of(p["score"], most_percent, False), LEAST).alias("high")
    queries = anchors.join(each.hint("merge"), F.col("vec_id") == F.col("query_id")).select("vec_id", "label", "v", low, high)
    negatives = index.search(queries, n_negatives, False)
    named = positives.select(F.col("query_id").alias("anchor_id"), (F.col("rank") - 1).cast("long").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = negatives.select(F.col("query_id").alias("anchor_id"), "window", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(named.hint("merge"), ["anchor_id", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
