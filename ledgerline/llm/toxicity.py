"""Toxicity: a factorization machine over hashed terms.

A text is the set of its lower-case words, each hashed to one of 2^20 buckets. Buckets whose presence differs between
the labels beyond chance (z test on the training sample) get a weight and a factor vector; the factors add a learned
weight for each pair of terms in a text (an insult together with a group mention), which additive weights can't express.

Training takes a bounded sample (``max_rows`` labelled rows, drawn by hash) as hashed terms, never texts, and fits on
the driver. Scoring is row-local.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 20
_TERM = re.compile(rb"[a-z0-9'\x80-\xff]+")


def terms(text: str | None) -> set[int]:
    """Buckets of the distinct words of a whole text; null: none."""
    return {crc32(w) & (BUCKETS - 1) for w in set(_TERM.findall((text or "").lower().encode("utf-8", "replace")))}


@dataclass
class FactorizationMachine:
    """places: bucket -> row of ``weights`` and ``factors``."""

    bias: float
    places: dict[int, int]
    weights: object
    factors: object

    def rows(self, texts: list) -> tuple:
        """(text number, place) of every known term."""
        import numpy as np

        known, row, at = self.places, [], []
        for i, text in enumerate(texts):
            hits = [known[b] for b in terms(text) if b in known]
            row += [i] * len(hits)
            at += hits
        return np.array(row, np.int64), np.array(at, np.int64)

    def logits(self, row, at, n: int):
        import numpy as np

        out = self.bias + np.bincount(row, self.weights[at], n)
        for f in self.factors.T:
            out += 0.5 * (np.bincount(row, f[at], n) ** 2 - np.bincount(row, f[at] ** 2, n))
        return out

    def scores(self, texts: list):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.logits(*self.rows(texts), len(texts)), -50, 50)))


def fit(labels, docs_terms: list, n_factors: int = 6, max_terms: int = 4096, least_z: float = 4.0, steps: int = 250, l2: float = 1e-3) -> FactorizationMachine:
    """Fit on label 0/1 and arrays of buckets with Adam on the mean log loss. No rows: a constant below one half."""
    import numpy as np

    y = np.asarray(labels, float)
    n, pos = len(y), float(y.sum())
    bias = float(np.log((pos + 0.5) / (n - pos + 1.5)))
    none = FactorizationMachine(bias, {}, np.zeros(0), np.zeros((0, n_factors)))
    if pos == 0 or pos == n:
        return none
    row = np.repeat(np.arange(n), [len(t) for t in docs_terms])
    buckets, at = np.unique(np.concatenate([np.asarray(t, np.int64) for t in docs_terms]), return_inverse=True)
    df, hit = np.bincount(at, minlength=len(buckets)), np.bincount(at, y[row], len(buckets))
    p = df / n
    z = (hit / pos - (df - hit) / (n - pos)) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / pos + 1 / (n - pos)))
    order = np.lexsort((buckets, -np.abs(z)))
    chosen = np.array([k for k in order[:max_terms] if abs(z[k]) >= least_z and df[k] >= 3], np.int64)
    if not len(chosen):
        return none
    place = np.full(len(buckets), -1)
    place[chosen] = np.arange(len(chosen))
    on = place[at] >= 0
    row, at = row[on], place[at[on]]
    m = len(chosen)
    x = [np.array([bias]), np.zeros(m), np.random.default_rng(7).normal(0, 0.05, (m, n_factors))]
    first, second = [np.zeros_like(v) for v in x], [np.zeros_like(v) for v in x]
    for t in range(1, steps + 1):
        model = FactorizationMachine(float(x[0][0]), {}, x[1], x[2])
        g = (1 / (1 + np.exp(-np.clip(model.logits(row, at, n), -50, 50))) - y) / n
        grads = [np.array([g.sum()]), np.bincount(at, g[row], m) + l2 / m * x[1], np.empty_like(x[2])]
        for k in range(n_factors):
            f = x[2][:, k]
            sums = np.bincount(row, f[at], n)
            grads[2][:, k] = np.bincount(at, g[row] * (sums[row] - f[at]), m) + 10 * l2 / m * f
        for v, d, a, b in zip(x, grads, first, second, strict=True):
            a += 0.1 * (d - a)
            b += 0.001 * (d * d - b)
            v -= 0.05 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-10)
    return FactorizationMachine(float(x[0][0]), {int(buckets[k]): i for i, k in enumerate(chosen)}, x[1], x[2])


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, max_rows: int = 16_000, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic",
) -> FactorizationMachine:
    """Fit on ``labels`` (id, 0/1) joined with ``docs``; ``usable`` is a condition on ``doc_id``.

    An id labelled more than once counts as toxic if any label says so; null ids, labels and texts are left out. The
    first ``max_rows`` labelled ids in hash order are taken, so the joined side is bounded and broadcast; what comes
    back are their hashed terms.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = (known.where(usable) if usable is not None else known).groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64(F.lit("tox"), "doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())

    def hashed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            packed = [np.array(sorted(terms(t.as_py())), "<i4").tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["doc_id", "label", "terms"])

    # broadcast: at most max_rows pairs of (id, label)
    joined = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    rows = joined.mapInArrow(hashed, "doc_id long, label int, terms binary").collect()
    rows.sort(key=lambda r: (r[0], bytes(r[2])))
    import numpy as np

    return fit([r[1] for r in rows], [np.frombuffer(r[2], "<i4") for r in rows])


def score_toxicity(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1), predicted (score >= 0.5). Null and empty texts get the score of
    a text without known terms. Only the text is an input; whole texts are read; nothing is shuffled."""

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for k in range(0, b.num_rows, 256):  # one batch's texts as Python strings at a time
                some = b.slice(k, 256)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(model.scores(some.column(1).to_pylist()), pa.float64())], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(id_col, text_col).mapInArrow(score, f"`{id_col}` {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(model: FactorizationMachine):
    """The score as a column function of a text column, to filter a table in place."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.scores(text.tolist()))

    return score
