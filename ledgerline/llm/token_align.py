"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers A and B cut the same bytes (a space and the text). Every token points to its farthest-right overlapping
token of the other side; a token pair that ends together is the end of its component. Doubling the pointers
(``succ = succ[succ]``) brings every token to the terminal token of its component, which labels its group: the smallest
runs of A and B tokens that cover the same bytes.

Texts are cut where both tokenizers surely cut, which is read from the files (``cuts_surely``): before white space that
starts with a space or a line feed, and between ASCII letters and the ASCII punctuation that ends a word. Pieces repeat,
so a worker remembers the groups of the first ``MAX_REMEMBERED`` short ones; new pieces of a batch are encoded by the
libraries and labelled together. Without that proof a text is one piece.

A link is a pair of an A and a B token occurrence that end together. ``link_counts`` counts the id pairs over the
corpus. One token's bytes end with the other's, so the number of different pairs is bounded by the vocabularies, not by
the corpus (``most_pairs``); that bound decides between a broadcast and a shuffle join.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tokens import byte_alphabet, merge_ranks

MAX_REMEMBERED, MAX_PIECE = 250_000, 48
#: Characters of a text that are taken at once; a longer text is cut at the next border.
RUN = 1 << 20
#: Rows of the pair table up to which it may be broadcast (two longs and a flag each).
MAX_BROADCAST_PAIRS = 4_000_000
#: An id pair as one long.
SHIFT = 32
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"

_PUNCTUATION = r"[!-/:-@\[-`{-~]"
#: Before white space that starts with a space or a line feed; within a word, before the punctuation that ends it.
_BORDER = re.compile(r"(?<=[^\s\u180e])(?=[ \n])")
_INNER = re.compile(rf"(?<=[^\s\u180e])(?=[ \n])|(?<=[A-Za-z])(?={_PUNCTUATION}+(?:[ \n]|$))")
#: White space that two pieces can't be cut out of by looking at single spaces only.
_ODD_SPACE = re.compile(r"  | [^\S ]|[^\S ] |^\s|\s$|\u180e")
#: What stands for a piece whose joined token bytes differ from it.
DIFFERS = (-1, "", ())

_LOADED: dict[tuple, Aligner] = {}


def token_bytes(path: str) -> list[bytes]:
    """Bytes of every id of a tokenizer file: byte-level ``.json`` or sentencepiece ``.model``."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        out = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            as_byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
            out.append(bytes([int(as_byte[1], 16)]) if as_byte else piece.replace("▁", " ").encode())
        return out
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet, ids = byte_alphabet(), {i: t for t, i in spec["model"]["vocab"].items()}
    added = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    level = lambda t: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
    return [added[i] if i in added else level(ids[i]) if i in ids else b"" for i in range(max([*ids, *added]) + 1)]


def cuts_surely(path_a: str, path_b: str) -> bool:
    """Whether both files cut at every border above: A's pre-tokenizer is the byte-level one with its own pattern; B
    leaves texts as they are but for a space in front, and no piece of its vocabulary crosses a border."""
    with open(path_a, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    a = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    if not a:
        return False
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    rules = proto.normalizer_spec
    plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
    usual, user_defined = [p.piece for p in proto.pieces if p.type == 1], any(p.type == 4 for p in proto.pieces)
    crosses = re.compile(rf"[^▁]▁|\n|[A-Za-z]{_PUNCTUATION}")
    return bool(plain and proto.trainer_spec.model_type == 2 and not user_defined and not any(map(crosses.search, usual)))


def terminals(ends_a, ends_b):
    """For tokens of A and B that cover the same bytes (their ends, ascending): each token's terminal token, as an index
    into the B tokens. The terminal of a component is its last B token."""
    import numpy as np

    n_a, n_b = len(ends_a), len(ends_b)
    over_a = np.searchsorted(ends_b, ends_a)  # the B token over A's last byte: it reaches as far as A or farther
    over_b = np.searchsorted(ends_a, ends_b)
    own = np.arange(n_a, n_a + n_b)
    succ = np.concatenate([n_a + over_a, np.where(ends_a[over_b] > ends_b, over_b, own)])
    while True:
        farther = succ[succ]
        if np.array_equal(farther, succ):
            return succ[:n_a] - n_a, succ[n_a:] - n_a
        succ = farther


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = token_bytes(path_a), token_bytes(path_b)
        self.len_a, self.len_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.written = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))
        self.in_pieces = cuts_surely(path_a, path_b)
        # a space and ASCII letters are one pre-token, which the same merges cut in the same way, only faster
        ranks = merge_ranks(path_a) if self.in_pieces else None
        self.one_word = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary if ranks else None
        #: Words (what stands between two single spaces) and other pieces (with their white space in front, or none).
        self.words: dict[str, tuple] = {}
        self.others: dict[str, tuple] = {}

    def runs(self, text: str) -> Iterator[tuple[list[str], bool]]:
        """(words or pieces, which) of a text; a long text in several runs, all but the first as pieces."""
        if not self.in_pieces:
            yield [" " + text], False
        elif len(text) <= RUN and not _ODD_SPACE.search(text):
            yield text.split(" "), True
        else:
            text, start = " " + text, 0
            while len(text) - start > RUN + 1 and (cut := _BORDER.search(text, start + RUN)):
                yield _INNER.split(text[start : cut.start()]), False
                start = cut.start()
            yield _INNER.split(text[start:]), False

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """ids of A and B of pieces, as in the middle of a text. B puts a space in front of what it gets; a piece without
        one gets a line feed, which B always gives an id of its own, and both ids are taken off again."""
        ids_a: list = [None] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            if self.one_word and p[0] == " " and p.isascii() and p[1:].isalpha():
                ids_a[i] = self.one_word(p)
            else:
                rest.append(i)
        for i, e in zip(rest, self.a.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            ids_a[i] = e.ids
        given = [(p[1:], 0) if p[0] == " " and len(p) > 1 else (p, 1) if p[0] == "\n" else ("\n" + p, 2) for p in pieces]
        ids_b = self.b.encode([t for t, _ in given], num_threads=1)
        return ids_a, [ids[off:] if off else ids for ids, (_, off) in zip(ids_b, given, strict=True)]

    def label(self, pieces: list[str]) -> Iterator[tuple]:
        """(n_a << 32 | n_b, groups text, pairs of its links) of each piece; DIFFERS if the bytes of a side differ."""
        import numpy as np

        ids_a, ids_b = self.encode(pieces)
        flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (ids_a, ids_b))
        raw = [p.encode() for p in pieces]
        whole, limits = b"".join(raw), np.cumsum([len(r) for r in raw])
        sides = ((flat_a, self.bytes_a, self.len_a), (flat_b, self.bytes_b, self.len_b))
        if not all(b"".join(map(of.__getitem__, f.tolist())) == whole and np.isin(limits, lens[f].cumsum()).all() for f, of, lens in sides):
            if len(pieces) == 1:
                yield DIFFERS
                return
            half = len(pieces) // 2  # the pieces that differ are found by halving
            yield from self.label(pieces[:half])
            yield from self.label(pieces[half:])
            return
        group_a, group_b = terminals(self.len_a[flat_a].cumsum(), self.len_b[flat_b].cumsum())
        last_b = np.flatnonzero(np.r_[group_b[1:] != group_b[:-1], True])  # a group's tokens are neighbours
        last_a = np.searchsorted(group_a, last_b, side="right") - 1
        pairs = (flat_a[last_a] << SHIFT | flat_b[last_b]).tolist()
        say = self.written.__getitem__
        text_a, text_b = list(map(say, flat_a.tolist())), list(map(say, flat_b.tolist()))
        stop_a, stop_b = (last_a + 1).tolist(), (last_b + 1).tolist()
        groups = [
            f"{text_a[i]}|{text_b[k]}" if j - i == 1 == m - k else ",".join(text_a[i:j]) + "|" + ",".join(text_b[k:m])
            for i, j, k, m in zip([0, *stop_a], stop_a, [0, *stop_b], stop_b, strict=False)
        ]
        last_group = (np.searchsorted(last_b, np.cumsum([len(y) for y in ids_b]) - 1) + 1).tolist()
        for x, y, i, j in zip(ids_a, ids_b, [0, *last_group], last_group, strict=False):
            yield len(x) << 32 | len(y), groups[i] if j - i == 1 else ";".join(groups[i:j]), tuple(pairs[i:j])

    def learn(self, texts: set[str], as_words: bool) -> dict[str, tuple]:
        """What is not remembered of the words (or pieces), labelled; as much as fits is remembered."""
        known = self.words if as_words else self.others
        new = [t for t in texts if t not in known]
        found: dict[str, tuple] = {}
        if as_words and new:
            cut = {t: _INNER.split(" " + t) for t in new}
            alone = {p[0][1:] for p in cut.values()} - known.keys()
            found = dict(zip(alone, self.label([" " + t for t in alone]), strict=True)) if alone else {}
            rest = self.learn({p for ps in cut.values() for p in ps[1:]}, False)
            joined = {}
            for t, p in cut.items():
                if len(p) > 1:
                    first = known.get(p[0][1:]) or found[p[0][1:]]
                    parts = [first, *(self.others.get(x) or rest[x] for x in p[1:])]
                    joined[t] = self.joined(parts)
            found |= joined
        elif new:
            for k in range(0, len(new), 8192):
                found.update(zip(new[k : k + 8192], self.label(new[k : k + 8192]), strict=True))
        room = MAX_REMEMBERED // (1 if as_words else 4) - len(known)
        if room > 0:
            known.update((t, v) for t, v in list(found.items())[:room] if len(t) <= MAX_PIECE)
        return found

    @staticmethod
    def joined(parts: list[tuple]) -> tuple:
        if DIFFERS in parts:
            return DIFFERS
        counts, groups, pairs = zip(*parts, strict=True)
        return sum(counts), ";".join(groups), tuple(chain.from_iterable(pairs))

    def align(self, texts: list[str | None]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text; the new words of some are learned together."""
        batch: list[tuple[list[str], bool] | None] = []
        held = 0
        for text in texts:
            if not text or len(text) <= RUN:
                batch.append(next(self.runs(text)) if text else None)
                held += len(text or "")
                if held <= RUN:
                    continue
            yield from self.together(batch)
            batch, held = [], 0
            if text and len(text) > RUN:
                yield self.put_together(self.parts(run, which, self.learn(set(run), which)) for run, which in self.runs(text))
        yield from self.together(batch)

    def together(self, batch: list) -> Iterator[tuple]:
        of = {which: self.learn(set(chain.from_iterable(b[0] for b in batch if b and b[1] == which)), which) for which in (True, False)}
        for b in batch:
            yield self.put_together([self.parts(*b, of[b[1]])] if b else [])

    def parts(self, pieces: list[str], as_words: bool, found: dict[str, tuple]) -> list[tuple]:
        parts = list(map((self.words if as_words else self.others).get, pieces))
        return [p or found[t] for p, t in zip(parts, pieces, strict=True)] if None in parts else parts

    def put_together(self, runs) -> tuple:
        import numpy as np

        n_a, n_b, written, pairs = 0, 0, [], []
        for parts in runs:
            joined = self.joined(parts)
            if joined is DIFFERS:
                return 0, 0, 0, 0, "", [], []
            n_a, n_b = n_a + (joined[0] >> 32), n_b + (joined[0] & (1 << 32) - 1)
            written.append(joined[1])
            pairs.append(np.array(joined[2], np.int64))
        if not written:
            return 0, 0, 0, 0, "", [], []
        of_doc, times = np.unique(np.concatenate(pairs), return_counts=True)
        n = int(times.sum())
        return n_a, n_b, n, n, ";".join(written), of_doc, times


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of two files; loaded once per Python worker."""
    if (path_a, path_b) not in _LOADED:
        _LOADED.clear()
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b (tokens), n_groups, n_links, ``groups`` (``a1,a2|b1;a3|b2``: ids in
    order), and the id pairs of its links with how often each occurs (``pairs``: ``a << 32 | b``, ``times``).

    Null and empty texts, and texts whose joined token bytes of a side differ from a space and the text, have no tokens:
    zeros, empty groups, no pairs. Rows that repeat an id are aligned each; an empty table gives an empty result.
    """

    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = aligner(path_a, path_b)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                some = b.slice(k, 256)
                rows = list(own.align(some.column(1).to_pylist()))
                counts = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
                lists = []
                for i in (5, 6):
                    offsets = np.cumsum([0, *(len(r[i]) for r in rows)], dtype=np.int32)
                    values = np.concatenate([np.asarray(r[i], np.int64) for r in rows])
                    lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
                arrays = [some.column(0).cast(pa.int64()), *counts, pa.array([r[4] for r in rows], pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in ALIGNED.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(make, ALIGNED)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, is_best): how many links of the corpus hold an id pair, and whether no pair of its B id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    b = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    best = counts.groupBy(b.alias("b")).agg(F.max("count").alias("best"))
    return counts.withColumn("b", b).join(best, "b").select("pair", "count", (F.col("count") == F.col("best")).alias("is_best"))


def most_pairs(path_a: str, path_b: str) -> int:
    """Bound of the different id pairs that can end together: one token's bytes end with the other's."""
    a, b = ({t: 0 for t in token_bytes(p) if t} for p in (path_a, path_b))
    copies: dict[bytes, list[int]] = {}
    for side, path in enumerate((path_a, path_b)):
        for t in token_bytes(path):
            if t:
                copies.setdefault(t, [0, 0])[side] += 1
    within = sum(copies[t][0] * copies[t[k:]][1] for t in a for k in range(len(t)) if t[k:] in b)
    return within + sum(copies[t][1] * copies[t[k:]][0] for t in b for k in range(1, len(t)) if t[k:] in a)


def score_links(aligned: DataFrame, counts: DataFrame, pairs_bound: int, row_id: str = "row_id") -> DataFrame:
    """(row_id, n_best, count_sum) for the rows of ``aligned`` that have links: how many of a row's links hold a pair
    that is its B id's most frequent (ties included), and the sum of the counts over its links."""
    each = aligned.select(row_id, F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    each = each.select(row_id, F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    met = each.join(F.broadcast(counts) if pairs_bound <= MAX_BROADCAST_PAIRS else counts, "pair")
    best = F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0))
    return met.groupBy(row_id).agg(best.cast("long").alias("n_best"), F.sum(F.col("times") * F.col("count")).cast("long").alias("count_sum"))
