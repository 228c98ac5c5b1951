"""Cross-tokenizer alignment against whole-text encodings and a plain walk over both token lists."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import token_align as t
from ledgerline.llm.queries import op12_token_align, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    bytes_a, bytes_b = t.token_bytes(A), t.token_bytes(B)

    def walk(text):
        """(n_a, n_b, groups, links) by taking the side that is behind until both are level."""
        if not text:
            return 0, 0, "", []
        x, y, raw = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
        if b"".join(bytes_a[i] for i in x) != raw or b"".join(bytes_b[i] for i in y) != raw:
            return 0, 0, "", []
        groups, links, i, j = [], [], 0, 0
        while i < len(x):
            ga, gb, ends = [x[i]], [y[j]], [len(bytes_a[x[i]]), len(bytes_b[y[j]])]
            i, j = i + 1, j + 1
            while ends[0] != ends[1]:
                if ends[0] < ends[1]:
                    ga, ends[0], i = [*ga, x[i]], ends[0] + len(bytes_a[x[i]]), i + 1
                else:
                    gb, ends[1], j = [*gb, y[j]], ends[1] + len(bytes_b[y[j]]), j + 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            links.append((ga[-1], gb[-1]))
        return len(x), len(y), ";".join(groups), links

    return walk


def same(plain, text, got):
    n_a, n_b, groups, links = plain(text)
    want = Counter(a << t.SHIFT | b for a, b in links)
    assert (got[0], got[1], got[2], got[3], got[4]) == (n_a, n_b, len(links), len(links), groups), repr(text)
    assert dict(zip(np.asarray(got[5]).tolist(), np.asarray(got[6]).tolist())) == want


def test_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    counts = Counter(link for r in rows.values() for link in r[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    got = op12_token_align(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        n_a, n_b, groups, links = rows[r.doc_id]
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        want = (r.doc_id, n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest)
        assert tuple(r) == want


def test_edges(spark, plain):
    texts = [None, "", " ", "a ", "\n", "▁", "a ▁b", "x" * 300, "word, word. " * 5000, "<s> <|endoftext|> </s>", "\x00", "日本語", "a᠎\n\nb"]
    rows = [(i, x, "clash", 1) for i, x in enumerate(texts)] + [(3, "a ", "", 2), (None, "b", "", 3), (3, "c", "", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, groups string, n_a int").repartition(3)
    got = t.align_documents(df, A, B).collect()
    assert Counter((r.doc_id, r.groups) for r in got) == Counter((i, plain(x)[2]) for i, x, *_ in rows)
    assert t.align_documents(df.limit(0), A, B).collect() == []


def test_pieces_equal_whole_texts(plain, monkeypatch):
    parts = ["the", "don't", " ", "  ", "\n", "\n\n", "\t", "(foo)", "bar,", "x.", "'s", "'", "naïve", "日本語", "<s>", "<|endoftext|>", "▁", " ", "᠎"]
    parts += ["\x1c", "1234", "a1b2", "--", "².", "é", "😀", "<0x0A>", "_a_", "\r\n", " ,", " ", "\x85"]
    rnd = random.Random(1)
    texts = [None] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    for run, remembered in ((1 << 20, 250_000), (40, 30)):
        monkeypatch.setattr(t, "RUN", run)
        monkeypatch.setattr(t, "MAX_REMEMBERED", remembered)
        own = t.Aligner(A, B)
        assert own.in_pieces and own.one_word
        for k in range(0, len(texts), 500):
            for text, got in zip(texts[k : k + 500], own.align(texts[k : k + 500]), strict=True):
                same(plain, text, got)


OWN = {}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_any_unicode(plain, texts):
    own = OWN.setdefault("aligner", t.Aligner(A, B) if not OWN else None)
    for text, got in zip(texts, own.align(texts), strict=True):
        same(plain, text, got)


def test_files_without_sure_cuts_get_whole_texts(plain, tmp_path, monkeypatch):
    with open(A, encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["use_regex"] = False
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    assert not t.cuts_surely(str(other), B) and t.cuts_surely(A, B)
    monkeypatch.setattr(t, "cuts_surely", lambda a, b: False)
    own = t.Aligner(A, B)
    for text, got in zip(["word, word\nx  y.", "", "▁"], own.align(["word, word\nx  y.", "", "▁"])):
        same(plain, text, got)


def test_pointers_end_at_common_ends():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = (np.array(sorted({n, *rng.integers(1, n + 1, rng.integers(0, 30)).tolist()})) for _ in range(2))
        group_a, group_b = t.terminals(a, b)
        common = np.array(sorted(set(a) & set(b)))
        assert np.array_equal(b[group_a], common[np.searchsorted(common, a)]) and np.array_equal(b[group_b], common[np.searchsorted(common, b)])


def test_pair_bound(spark):
    sf = "/root/testdata/sf0.001"
    aligned = t.align_documents(spark.read.parquet(f"{sf}/documents.parquet"), A, B)
    bound = t.most_pairs(A, B)
    assert t.link_counts(aligned).count() <= bound <= t.MAX_BROADCAST_PAIRS
