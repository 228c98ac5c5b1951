"""Token counts, token files and packing against the library on whole texts."""

import functools
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
NASTY = [
    "", " ", "\n\n", "a", "A  b\tc\x0bd\x0ce\rf", "it's we'll 12345 x²  ﬁ", "<|endoftext|> a<|startoftext|>b <|end", "é é ́x",
    "nb sp em　id\u0085nel\x1cfs", "ΑΣ ΟΔΟΣ Σ", "İstanbul ǅ", "x" * 5000, "word " * 3000, "日本語 テスト 한국어", "🙂🙂 a‍b",
    "don 't 's 's's", "̈ ̈a b̈", "à̖ c", "-- ... !?!", "0x1F a1b2",
]


@functools.cache
def library(name="word_bpe_49k.json"):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


def exact(texts, name="word_bpe_49k.json"):
    return [e.ids for e in library(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("piece_bytes", [16, 1 << 20])
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name, piece_bytes):
    from ledgerline.llm.tokens import Encoder

    enc = Encoder(tokenizer_path(name), piece_bytes)
    texts = [t.encode() for t in NASTY]
    want = exact(NASTY, name)
    assert [ids(x) for x in enc.encode(texts)] == want
    assert enc.count(texts) == list(map(len, want))


def test_encoder_forgets_within_bounds(monkeypatch):
    from ledgerline.llm import tokens

    monkeypatch.setattr(tokens, "MAX_REMEMBERED", 5)
    enc = tokens.Encoder(tokenizer_path(), 64)
    assert [ids(x) for x in enc.encode([t.encode() for t in NASTY])] == exact(NASTY)
    assert len(enc._known) <= 5 and len(enc._pieces) <= 2


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoder_equals_library_on_any_text(text):
    from ledgerline.llm.tokens import encoder

    assert [ids(x) for x in encoder(tokenizer_path()).encode([text.encode("utf-8", "replace")])] == exact([text.encode("utf-8", "replace").decode()])


PLAIN = st.text(st.characters(max_codepoint=0x17F), max_size=60) | st.lists(
    st.sampled_from(["don't", "it''s", "'S", "'ll", "x'd", "A1b22", "--", "...", "<|endoftext|>", "<|", "a", "_", "\x1c", "\x00", "Hello", "zzzzqq", "ÉTÉ", "größe", "ß", "ÿ×÷", "naïve", "Ñ²", "µª", "e\u0301", "İ", "\x80"]), max_size=8
).map("".join)


@settings(max_examples=500, deadline=None)
@given(PLAIN)
def test_merged_words_equal_the_library(text):
    from ledgerline.llm.tokens import encoder

    own = encoder(tokenizer_path())
    assert own._merge is not None and [ids(x) for x in own.encode([text.encode()])] == exact([text])


def changed(tmp_path, change):
    import json

    with open(tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    change(spec)
    path = tmp_path / "changed.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    return str(path)


def spaced(spec):
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\s*[\p{L}]+|[^\s\p{L}]+"


def stripping(spec):
    spec["added_tokens"][0]["lstrip"] = True


def accents(spec):
    spec["normalizer"]["normalizers"].append({"type": "StripAccents"})


def cased(spec):
    spec["normalizer"]["normalizers"].pop()


def shuffled(spec):
    spec["model"]["merges"][5], spec["model"]["merges"][900] = spec["model"]["merges"][900], spec["model"]["merges"][5]


@pytest.mark.parametrize(("change", "by_word", "merges"), [(spaced, False, False), (stripping, False, False), (accents, False, False), (cased, True, True), (shuffled, True, False)])
def test_rules_are_read_from_the_file(tmp_path, change, by_word, merges):
    """A file that is changed in any part is encoded as the library does: word by word only where that part allows it."""
    from tokenizers import Tokenizer

    from ledgerline.llm.tokens import Encoder

    path = changed(tmp_path, change)
    own, lib = Encoder(path, 64), Tokenizer.from_file(path)
    assert own.by_word is by_word and (own._merge is not None) is merges
    for _, text in enumerate(NASTY + ["It's  THE a\tb  12 <|startoftext|> x"]):
        if by_word or len(text) <= 64:
            assert ids(own.encode([text.encode()])[0]) == lib.encode(text, add_special_tokens=False).ids, text[:40]


def test_sentencepiece_counts():
    import sentencepiece

    from ledgerline.llm.tokens import Encoder

    path = tokenizer_path("piece_bpe_32k.model")
    texts = ["", "Hello  world", "a\nb"]
    want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    assert Encoder(path).count([t.encode() for t in texts]) == want


def edge_docs(spark):
    """Nulls everywhere, repeated ids and rows, long texts, and extra columns named like the outputs."""
    rows = [(i, t) for i, t in enumerate(NASTY)] + [(3, "a second text"), (3, "a"), (None, "no id"), (90, None), (91, "many words " * 9000)]
    return spark.createDataFrame([(d, t, -1, "x", -1, None) for d, t in rows], "doc_id long, text string, n_tokens int, part string, start int, lang string")


def test_counts(spark):
    from ledgerline.llm.token_counts import count_tokens

    docs = edge_docs(spark)
    got = count_tokens(docs, tokenizer_path(), 100).collect()
    rows = docs.collect()
    want = exact([r.text for r in rows])
    key = lambda x: (x[0] is None, x)
    assert sorted([tuple(r) for r in got], key=str) == sorted(
        [(r.doc_id, len((r.text or "").encode()), len(w), len(w) > 100) for r, w in zip(rows, want)], key=str
    )
    assert key and count_tokens(docs.limit(0), tokenizer_path()).collect() == []


def brute_documents(rows, end_id=2):
    """(doc_id, ids) in ascending id order, nulls last."""
    coded = [(r.doc_id, w + [end_id]) for r, w in zip(rows, exact([r.text for r in rows]))]
    return sorted(coded, key=lambda x: (x[0] is None, x[0] or 0))


@pytest.mark.parametrize("shards", [None, 1, 5])
def test_token_files(spark, tmp_path, shards):
    from ledgerline.llm.token_files import read_token_files, write_token_files

    docs = edge_docs(spark)
    manifest = write_token_files(docs, f"file://{tmp_path}/t", tokenizer_path(), 2, shards)
    got = sorted(read_token_files(spark, f"file://{tmp_path}/t").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [d for d, _ in brute_documents(docs.collect())]
    at = 0
    want = {}
    for d, w in brute_documents(docs.collect()):
        want.setdefault(d, []).append(w)
    for r in got:
        assert r.start == at and ids(r.ids) in want[r.doc_id] and r.n_tokens == len(ids(r.ids)) and r.ids_crc32 == zlib.crc32(r.ids)
        want[r.doc_id].remove(ids(r.ids))
        at += r.n_tokens
    assert not any(want.values())
    flat = b"".join(open(f"{tmp_path}/t/{x}", "rb").read() for x in sorted(os.listdir(f"{tmp_path}/t")) if x.endswith(".bin"))
    assert np.frombuffer(flat, "<u2").size == at == sum(r.n_tokens for r in manifest.collect())
    assert not [x for x in os.listdir(f"{tmp_path}/t") if x.endswith(".part")]


def test_token_files_empty(spark, tmp_path):
    from ledgerline.llm.token_files import read_token_files, write_token_files

    write_token_files(edge_docs(spark).limit(0), f"file://{tmp_path}/t", tokenizer_path())
    assert read_token_files(spark, f"file://{tmp_path}/t").collect() == []


@pytest.mark.parametrize(("window", "partitions"), [(7, 3), (4096, None), (1, 2)])
def test_packing(spark, window, partitions):
    from ledgerline.llm.packing import pack_documents

    docs = edge_docs(spark)
    if window == 1:
        docs = docs.where("doc_id < 12 and doc_id <> 11")
    pieces = sorted(pack_documents(docs, tokenizer_path(), 2, window, partitions).collect(), key=lambda r: (r.sequence_id, r.offset))
    total = sum(len(w) for _, w in brute_documents(docs.collect()))
    at = 0
    for p in pieces:
        assert (p.sequence_id, p.offset) == divmod(at, window) and p.length == len(ids(p.ids)) > 0
        at += p.length
    assert at == total
    whole = {}
    for p in pieces:  # pieces of a document follow each other
        if p.start == 0:
            whole.setdefault(p.doc_id, []).append([])
        doc = whole[p.doc_id][-1]
        assert p.start == len(doc)
        doc += ids(p.ids)
        assert p.start + p.length <= p.doc_tokens
    want = {}
    for d, w in brute_documents(docs.collect()):
        want.setdefault(d, []).append(w)
    assert {d: sorted(x) for d, x in whole.items()} == {d: sorted(x) for d, x in want.items()}
    assert pack_documents(docs.limit(0), tokenizer_path()).collect() == []


def test_queries(spark):
    """The three queries over a whole table against the library."""
    from ledgerline.llm import queries as q
    from ledgerline.llm.common import table

    rows = table(spark, SF, "documents").collect()
    coded = brute_documents(rows)
    at, want = 0, []
    for d, w in coded:
        want.append((d, at, len(w), zlib.crc32(np.array(w, "<u4").tobytes())))
        at += len(w)
    assert sorted(tuple(r) for r in q.op8_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == sorted(want)
    counts = {r.doc_id: r for r in q.op9_token_counts(spark, SF).collect()}
    assert {d: counts[d].n_tokens + 1 for d, *_ in want} == {d: n for d, _, n, _ in want}
    assert all(counts[r.doc_id].n_bytes == len((r.text or "").encode()) for r in rows)
    tokens = dict(coded)
    for p in q.op6_packing(spark, SF).collect():
        part = tokens[p.doc_id][p.start : p.start + p.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32 and p.doc_tokens == len(tokens[p.doc_id])
        assert p.offset + p.length <= 4096
