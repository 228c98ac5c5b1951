"""The pipeline's stages, each against brute force on its own input."""

import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as p
from ledgerline.llm.common import stored, table
from tests.llm.test_near_dedup import brute
from tests.llm.test_source_mix import brute_targets
from tests.llm.test_tokens import exact

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in p.STAGES:
        made = stored(stage(spark, docs, SF), name)
        out.append((docs, made))
        docs = made
    return {name: x for (name, _), x in zip(p.STAGES, out, strict=True)}


def test_columns_and_names(steps):
    assert [n for n, _ in p.STAGES] == ["toxicity", "language", "near_duplicates", "source_mix", "packing"]
    for name, (_, made) in steps.items():
        assert name == "packing" or made.columns == COLUMNS


def test_toxicity(spark, steps):
    before, after = steps["toxicity"]
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after.collect()}
    gone = {r.doc_id for r in before.collect()} - kept
    toxic, clean = [i for i, y in labels.items() if y == 1], [i for i, y in labels.items() if y == 0]
    assert sum(i in gone for i in toxic) / len(toxic) > 0.6 and sum(i in gone for i in clean) / len(clean) < 0.02


def test_language(steps):
    before, after = steps["language"]
    rows = {r.doc_id: r.text for r in before.collect()}
    gone = rows.keys() - {r.doc_id for r in after.collect()}
    assert len(gone) <= 0.01 * len(rows) and all(i in gone for i, t in rows.items() if not re.search(r"[^\W\d_]", t or ""))


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    want = brute([(r.doc_id, r.text) for r in before.collect()], p.NEAR_WORDS, p.NEAR_PERCENT)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_source_mix(steps):
    before, after = steps["source_mix"]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before.collect()}
    source = {r.doc_id: r.source for r in before.collect()}
    per, got = Counter(), Counter()
    for i, n in size.items():
        per[source[i]] += n
    rows = after.collect()
    for r in rows:
        got[r.source] += size[r.doc_id]
    goal = brute_targets(per, p.MIX_WEIGHTS)
    for s, t in goal.items():
        assert -1 <= got[s] - t <= max(size[i] for i in size if source[i] == s)
    assert max(Counter(r.doc_id for r in rows).values()) <= 3


def test_packing(steps):
    before, after = steps["packing"]
    rows = before.collect()
    n = dict(zip((r.doc_id for r in rows), (len(x) + 1 for x in exact([r.text for r in rows])), strict=True))
    pieces = sorted(after.collect(), key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in pieces:
        assert divmod(at, p.WINDOW) == (r.sequence_id, r.offset) and r.doc_tokens == n[r.doc_id] and len(r.ids) == 4 * r.length
        at += r.length
    assert at == sum(n[r.doc_id] for r in rows)


def test_repeated_ids_lose_no_text(spark):
    """Every distinct text of an id is judged by itself; rows equal in id and text are one document."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    a, b, c = (f"{x} document has its own words and more of them than five " * 3 for x in ("this", "another", "the last"))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (2, a, "en", "s", 1), (2, c, "en", "s", 1), (1, a, "en", "t", 1), (1, a, None, None, None)]
    rows += [(None, a, "en", "s", 1), (None, a, "en", "s", 1), (3, None, "en", "s", 1), (3, "", "en", "s", 1)]
    for order in (rows, rows[::-1]):
        made = p.drop_near_duplicates(spark, spark.createDataFrame(order, schema).repartition(3), SF)
        got = Counter((r.doc_id, r.text) for r in made.collect())
        assert got == Counter([(1, a), (1, b), (2, c), (None, a), (None, a), (3, None), (3, "")])
        assert [r.source for r in made.where((made.doc_id == 1) & (made.text == a)).collect()] == [None]  # whatever their order


def test_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "The text of this document is plain and it has words enough. "
    rows = [(1, text * 3, "en", "a", 1), (1, text * 3, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "b", 0), (None, text + "Another one.", "en", None, 2), (4, text * 3000, "en", "b", 3), (5, "12 34", "en", "b", 3)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for name, stage in p.STAGES:
            docs = stored(stage(spark, docs, "/root/testdata/sf0.001"), "edge")
        assert (docs.count() > 0) == (n > 0)
    assert np.all([r.length > 0 for r in docs.collect()])
