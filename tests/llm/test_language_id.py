"""Language identification: held-out accuracy, the filters themselves, and edge cases."""

import zlib

import numpy as np

from ledgerline.llm.language_id import LanguageFilters, gram_hashes, identify_languages, learn_languages
from ledgerline.llm.queries import op10_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op10_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    hits, n = 0, 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert (r.lang_pred == "und") == (not letters)
        if r.held_out and letters:
            n += 1
            hits += r.lang_pred == docs[r.doc_id].lang
    assert n > 100 and hits / n > 0.95


def test_filters_return_every_language_of_a_gram():
    rng = np.random.default_rng(1)
    languages = [f"l{i:02d}" for i in range(19)]  # more than two mask bytes
    sets = [rng.integers(0, 2**63, 300).astype(np.uint64) for _ in languages]
    sets[3][:50] = sets[17][:50]
    model = LanguageFilters.build(languages, sets, 3, 1 << 14, 3)
    mask = None
    for at in model.places(sets[3][:50]):
        mask = model.table[at] if mask is None else mask & model.table[at]
    for k in (3, 17):
        assert ((mask[:, k // 8] >> (k % 8)) & 1).all()
    assert (model.false_positive < 0.01).all()
    assert len(gram_hashes("ab", 3)) == 2 and len(gram_hashes("", 9)) == 0


def test_edges(spark):
    schema = "doc_id long, text string, lang string, lang_pred string, score string"
    train = spark.createDataFrame(
        [(i, t, lang, "x", None) for i, (t, lang) in enumerate([("der die das und nicht", "de"), ("the and that with this", "en"), (None, "en"), ("le la", None)] * 5)],
        schema,
    )
    model = learn_languages(train)
    assert model.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "123 !? 🙂"), (4, "the and that " * 50_000), (5, "und nicht"), (5, "und nicht"), (None, "this"), (7, "ЖЖЖ"), (8, "²"), (9, "①②"), (10, "Ⅷ 4"), (11, "¼ _")]
    got = identify_languages(spark.createDataFrame([(d, t, None, "clash", "clash") for d, t in rows], schema), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (5, "de"), (None, "en"), (7, "de"), *[(i, "und") for i in (8, 9, 10, 11)]]
    assert [r.score for r in got][:3] == [0, 0, 0] and got[-1].score == 0 and all(0.5 <= r.score <= 1 for r in got[3:7])
    nothing = learn_languages(train.limit(0))
    assert [r.lang_pred for r in identify_languages(train, nothing).collect()] == ["und"] * train.count()
    assert identify_languages(train.limit(0), model).collect() == []


def test_filters_against_exact_sets(spark, monkeypatch):
    """Every document's rates, from the whole text, against the very sets the filters hold: the correction is as close as
    the filters' false positives allow, and the language is the exact one wherever that is clear."""
    seen = {}
    real = LanguageFilters.build

    def build(languages, sets, *args):
        seen.update(zip(languages, (set(s) for s in sets), strict=True))
        return real(languages, sets, *args)

    monkeypatch.setattr(LanguageFilters, "build", staticmethod(build))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = learn_languages(docs)
    found = {r.doc_id: r for r in identify_languages(docs, model).collect()}
    clear = 0
    for r in docs.collect():
        rates = model.hit_rates(r.text or "")
        if rates is None:
            assert found[r.doc_id].lang_pred == "und"
            continue
        grams = [int(g) for g in gram_hashes(r.text, model.n)]
        exact = [sum(g in seen[lang] for g in grams) / max(1, len(grams)) for lang in model.languages]
        assert max(abs(a - b) for a, b in zip(rates, exact)) < 0.02
        top, second = sorted(exact)[-1], sorted(exact)[-2]
        if top - second > 0.04:
            clear += 1
            assert found[r.doc_id].lang_pred == model.languages[exact.index(top)]
    assert clear > 0.9 * len(found)
