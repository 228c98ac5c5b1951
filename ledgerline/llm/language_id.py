"""Language identification with bit-sliced Bloom filters over character n-grams.

Each slot of the table holds one bit per language. An n-gram is looked up at ``hashes`` slots; the AND of the slots is
the mask of all languages that contain it. A text's popcount for a language is corrected for that language's
false-positive rate (share of set bits to the power of ``hashes``), and the greatest corrected hit rate decides.

Learning counts the n-grams of a bounded sample in Spark (``docs_per_language`` documents of each language, drawn by
hash); an n-gram belongs to a language if it's at least ``least_share`` times as frequent there as where it's most
frequent, among the language's ``grams_per_language`` most frequent ones. The driver gets those sets only, which are
bounded by the parameters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
_OTHER = re.compile(r"[\W\d_]+")
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def gram_hashes(text: str, n: int):
    """64-bit hashes of all n-grams of the lower-case text; anything between letters counts as one space."""
    import numpy as np

    letters = f" {_OTHER.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "replace")
    c = np.frombuffer(letters, "<u4").astype(np.uint64)
    h = np.zeros(max(0, len(c) - n + 1), np.uint64)
    for k in range(n):
        h = (h ^ c[k : k + len(h)]) * np.uint64(_MIX[k % 4])
        h ^= h >> np.uint64(29)
    return h


@dataclass
class LanguageFilters:
    """languages in order; table: (slots, bytes per mask); false_positive: rate of each language's slice."""

    languages: list[str]
    table: object
    false_positive: object
    n: int
    hashes: int

    @staticmethod
    def build(languages: list[str], sets: list, n: int, slots: int, hashes: int) -> LanguageFilters:
        import numpy as np

        out = LanguageFilters(languages, np.zeros((slots, -(-max(1, len(languages)) // 8)), np.uint8), None, n, hashes)
        for k, grams in enumerate(sets):
            for at in out.places(np.asarray(grams, np.uint64)):
                out.table[at, k // 8] |= np.uint8(1 << (k % 8))
        fill = [float((out.table[:, k // 8] >> np.uint8(k % 8) & 1).mean()) for k in range(len(languages))]
        out.false_positive = np.array(fill) ** hashes
        return out

    def places(self, grams) -> list:
        import numpy as np

        step, slots = (grams >> np.uint64(32)) | np.uint64(1), np.uint64(len(self.table))
        return [((grams + np.uint64(j) * step) % slots).astype(np.int64) for j in range(self.hashes)]

    def hit_rates(self, text: str):
        """Per language the share of the text's n-grams it contains, corrected for false positives; None: no letter."""
        import numpy as np

        if not any(map(str.isalpha, text)):
            return None
        grams = gram_hashes(text, self.n)
        if not len(grams):
            return np.zeros(len(self.languages))
        mask = None
        for at in self.places(grams):
            row = self.table[at]
            mask = row if mask is None else mask & row
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        counts = np.concatenate([np.bincount(mask[:, b], minlength=256) @ bits for b in range(mask.shape[1])])
        counts = counts[: len(self.languages)]
        n, f = len(grams), self.false_positive
        return np.clip((counts - n * f) / np.maximum(n * (1 - f), 1e-9), 0, 1)


def learn_languages(
    docs: DataFrame, usable: Column | None = None, docs_per_language: int = 2000, grams_per_language: int = 50_000,
    least_share: float = 0.2, n: int = 3, slots: int = 1 << 20, hashes: int = 3, lang_col: str = "lang", text_col: str = "text",
    id_col: str = "doc_id",
) -> LanguageFilters:
    """Fit the filters on rows with text and language (and ``usable``). Rows with a null in either are left out."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.where(usable) if usable is not None else rows
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # one row per language
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, docs_per_language / sizes[k])]) if languages else None
    draw = F.pmod(F.xxhash64(F.lit("lang"), F.col(id_col)), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def counts(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: dict[str, list] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(lang, []).append(np.unique(gram_hashes(text, n), return_counts=True))
        for lang, parts in held.items():
            grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            total = np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(total)], ["lang", "gram", "n"])

    sets: dict[str, list] = {k: [] for k in languages}
    if languages:
        sample = rows.where(draw < share[F.col(lang_col)]).select(lang_col, text_col)
        found = sample.mapInArrow(counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        found = found.where("n > 1")
        totals = found.groupBy("lang").agg(F.sum("n").alias("total"))
        rate = found.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))  # one row per language
        most = rate.withColumn("most", F.max("rate").over(Window.partitionBy("gram")))  # a group: one row per language
        ranked = most.where(F.col("rate") >= least_share * F.col("most")).withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
        )
        for r in ranked.where(F.col("rank") <= grams_per_language).select("lang", "gram").toLocalIterator():
            sets[r[0]].append(r[1] & (2**64 - 1))
    return LanguageFilters.build(languages, [sets[k] for k in languages], n, slots, hashes)


def identify_languages(docs: DataFrame, model: LanguageFilters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score (0.5 to 1: best rate against the two best; 0 where no learned
    n-gram is found), hit_rate (corrected share of n-grams that the predicted language contains).

    Null text or text without a letter: ``und``, score 0. Equal rates: the first language by code point. A model that
    has learned no language gives ``und`` throughout. Whole texts are used; nothing is shuffled.
    """

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            found = [decide(model, text.as_py()) for text in b.column(1)]
            cols = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], [id_col, "lang_pred", "score", "hit_rate"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(predict, f"`{id_col}` {kind}, lang_pred string, score double, hit_rate double")


def decide(model: LanguageFilters, text: str | None) -> tuple[str, float, float]:
    """(language, score, hit rate) of one whole text."""
    import numpy as np

    rates = model.hit_rates(text) if text and model.languages else None
    if rates is None:
        return UNDETERMINED, 0.0, 0.0
    best = int(np.argmax(rates))
    top, rest = float(rates[best]), float(np.max(np.delete(rates, best), initial=0.0))
    return model.languages[best], top / (top + rest) if top > 0 else 0.0, top


def language(model: LanguageFilters):
    """struct(lang_pred, score, hit_rate) as a column function of a text column, to filter a table in place."""
    @F.pandas_udf("lang_pred string, score double, hit_rate double")
    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decide(model, t) for t in text], columns=["lang_pred", "score", "hit_rate"])

    return predict


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds
