"""Tokenizer access inside tasks.

A tokenizer file whose rules drop white space (``piece_rules``: read from its normalizer, pattern and added tokens)
encodes a text as the concatenation of the encodings of its white-space separated words. Such texts are cut at ASCII
white space, and the ids of distinct words are put together again: the same ids as from the whole text (tested against
it), at a fraction of the time, as most words repeat. New words of ASCII characters and Latin-1 letters are cut further
by the file's own pattern, after its own lower-casing (composing leaves them as they are); their pieces are merged by
the file's ranks, which must be in the order of its merges (``merge_ranks``). All other words go to the library. Other ``.json`` files are given whole texts, or for texts above
``piece_bytes`` pieces cut before a space that stands between two ASCII letters, a boundary that byte-level
pre-tokenizers always cut at. sentencepiece models get whole texts.

The ids of the first ``MAX_REMEMBERED`` distinct words (and half as many pieces) of at most ``MAX_PIECE`` bytes are
remembered per Python worker (frequent ones come early). So memory is bounded, and the result doesn't depend on it.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack

MAX_REMEMBERED = 400_000
MAX_PIECE = 32
#: Longest piece that is merged here; the library takes longer ones.
MAX_MERGED = 256

_LOADED: dict[tuple, object] = {}
_LETTER_GAP = re.compile(rb"(?<=[A-Za-z]) (?=[A-Za-z])")
#: What composing leaves alone, and whose letters and lower-casing are the same in every version of Unicode.
_PLAIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]+")
#: End of a word in the ranks; no byte of UTF-8.
_END = b"\xff"
#: Alternatives of a pattern that match no white space, and what they are for plain words (%s: the letters).
_ALTERNATIVES = [
    (re.compile(r"'[a-z]+"), None),
    (re.compile(r"\[?\\p\{L\}\]?\+"), "[%s]+"),
    (re.compile(r"\[?\\p\{N\}\]?\+"), "[0-9]+"),
    (re.compile(r"\[?\\p\{N\}\]?"), "[0-9]"),
    (re.compile(r"\[\^\\s\\p\{L\}\\p\{N\}\]\+"), "[^%s0-9]+"),
]


@dataclass
class PieceRules:
    """What a file does to a plain word: lower-casing, its pattern; what it leaves to the library (added tokens)."""

    lower: bool
    pattern: re.Pattern
    added: re.Pattern


def piece_rules(path: str) -> PieceRules | None:
    """The rules of a file that encodes words one by one; None unless each of its parts is known to allow that.

    The normalizer may compose (NFC), put one space for white space and lower-case; the pre-tokenizer keeps only matches
    of a pattern whose alternatives match no white space, then maps bytes; added tokens hold no white space and take none.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = steps.get("normalizers", [steps])
    one_space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if any(x != one_space and x != {"type": "NFC"} and x != {"type": "Lowercase"} for x in steps):
        return None
    pre = spec.get("pre_tokenizer") or {}
    first, *rest = pre.get("pretokenizers", [pre])
    if first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert"):
        return None
    if any(x.get("type") != "ByteLevel" or x.get("add_prefix_space") or x.get("use_regex") for x in rest) or len(rest) != 1:
        return None
    lower = {"type": "Lowercase"} in steps
    letters, alternatives = "a-zß-öø-ÿ" if lower else "A-Za-zÀ-ÖØ-öø-ÿ", []
    for part in first["pattern"].get("Regex", "").split("|"):
        known = next(((text, of) for text, of in _ALTERNATIVES if text.fullmatch(part)), None)
        if known is None:
            return None
        alternatives.append(re.escape(part) if known[1] is None else known[1].replace("%s", letters))
    added = spec.get("added_tokens", [])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") or re.search(r"\s", t["content"]) for t in added):
        return None
    return PieceRules(lower, re.compile("|".join(alternatives)), re.compile("|".join(re.escape(t["content"]) for t in added) or "(?!)"))


def byte_alphabet() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes -> id of a byte-level BPE file whose ids are in the order of its merges, so that an id is a merge's rank.
    Where a word's last character is a symbol of its own (``end_of_word_suffix``), such tokens end with ``_END``: these
    symbols come before all merges, so ``_END`` always joins the last byte first."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges", "byte_fallback")):
        return None
    vocab, end, alphabet = model["vocab"], model.get("end_of_word_suffix") or "", byte_alphabet()
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    merged = [vocab.get(t, -1) for t in joined]
    singles = set(vocab) - set(joined)
    if merged != sorted(set(merged)) or any(vocab[t] > merged[0] for t in singles if t in alphabet or t.removesuffix(end) in alphabet):
        return None
    ranks: dict[bytes, int] = {}
    for t, i in vocab.items():
        ends = bool(end) and t.endswith(end)
        raw = t.removesuffix(end) if ends else t
        if not all(c in alphabet for c in raw) or not raw:
            continue
        ranks[bytes(map(alphabet.__getitem__, raw)) + (_END if ends else b"")] = i
    if end:
        if not all(bytes([x]) + _END in ranks for x in range(255)):
            return None
        ranks[_END] = max(vocab.values()) + 1  # never left over
    return ranks


def cut(text: bytes, piece_bytes: int) -> Iterator[bytes]:
    """Cut at ASCII white space into pieces of about ``piece_bytes``; a longer run without white space stays whole."""
    start = 0
    while len(text) - start > piece_bytes:
        space = re.compile(rb"[ \t-\r]").search(text, start + piece_bytes)
        if not space:
            break
        yield text[start : space.start()]
        start = space.end()
    yield text[start:]


class Encoder:
    """ids of texts as little-endian unsigned 32-bit bytes, or their number."""

    def __init__(self, path: str, piece_bytes: int = 1 << 20):
        self.piece_bytes, self.by_word, self._merge = piece_bytes, False, None
        #: ids of words, and of the pieces of plain words
        self._known: dict[bytes, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size, self._batch = model.vocab_size(), lambda texts: model.encode(texts, num_threads=1)
            self.cuts_long = False
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self.size = tok.get_vocab_size(with_added_tokens=True)
            self._batch = lambda texts: [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
            self.rules = piece_rules(path)
            self.by_word = self.rules is not None
            self.cuts_long = True
            ranks = merge_ranks(path) if self.by_word else None
            if ranks:
                import tiktoken

                self._ends = _END in ranks
                self._merge = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def _ids(self, texts: list[list[bytes]]) -> Iterator[list[bytes]]:
        """ids of each text's words. Short words are remembered as long as there is room."""
        known = self._known
        ids = [list(map(known.get, words)) for words in texts]
        new = {w for words, found in zip(texts, ids, strict=True) if None in found for w, x in zip(words, found, strict=True) if x is None}
        made: dict[bytes, bytes] = {}
        if self._merge:
            made = {w: m for w in new if (m := self._merged(w)) is not None}
        rest = [w for w in new if w not in made]
        for k in range(0, len(rest), 8192):
            some = rest[k : k + 8192]
            coded = self._batch([w.decode("utf-8", "replace") for w in some])
            made.update((w, pack(f"<{len(i)}I", *i)) for w, i in zip(some, coded, strict=True))
        if (room := MAX_REMEMBERED - len(known)) > 0:
            known.update((w, b) for w, b in list(made.items())[:room] if len(w) <= MAX_PIECE)
        for words, found in zip(texts, ids, strict=True):
            yield [made[w] if x is None else x for w, x in zip(words, found, strict=True)] if None in found else found

    def _merged(self, word: bytes) -> bytes | None:
        """ids of a plain word: its pieces, each merged by the ranks; None for any other word."""
        try:
            text = word.decode()
        except UnicodeDecodeError:
            return None
        if len(word) > MAX_MERGED or not _PLAIN.fullmatch(text) or self.rules.added.search(text):
            return None
        pieces, out = self._pieces, []
        for p in self.rules.pattern.findall(text.lower() if self.rules.lower else text):
            ids = pieces.get(p)
            if ids is None:
                tokens = self._merge(p.encode() + _END if self._ends else p.encode())
                ids = pack(f"<{len(tokens)}I", *tokens)
                if len(pieces) < MAX_REMEMBERED // 2 and len(p) <= MAX_PIECE:
                    pieces[p] = ids
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def _whole(self, text: bytes) -> list[bytes]:
        if self.cuts_long and len(text) > self.piece_bytes:
            out, start = [], 0
            while m := _LETTER_GAP.search(text, start + self.piece_bytes):
                out.append(text[start : m.start()])
                start = m.start()
            return [*out, text[start:]]
        return [text]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """ids of each text. Texts are taken in batches balanced by bytes."""
        return [b"".join(parts) for parts in self._parts(texts)]

    def count(self, texts: list[bytes]) -> list[int]:
        """Number of ids of each text; the ids themselves are not put together."""
        return [sum(map(len, parts)) // 4 for parts in self._parts(texts)]

    def _parts(self, texts: list[bytes]) -> Iterator[list[bytes]]:
        """For each text the ids of its pieces. One batch holds about ``piece_bytes`` of text: short texts share one,
        long texts are cut into several."""
        if not self.by_word:
            for text in texts:
                ids = self._batch([p.decode("utf-8", "replace") for p in self._whole(text)])
                yield [pack(f"<{len(i)}I", *i) for i in ids]
            return
        batch, held = [], 0
        for text in texts:
            if len(text) > self.piece_bytes:
                yield from self._ids(batch)
                batch, held, parts = [], 0, []
                for piece in cut(text, self.piece_bytes):
                    words = piece.split()
                    parts.append(b"".join(next(self._ids([words]))))
                yield parts
                continue
            batch.append(text.split())
            held += len(text)
            if held >= self.piece_bytes:
                yield from self._ids(batch)
                batch, held = [], 0
        yield from self._ids(batch)

def encoder(path: str) -> Encoder:
    """The worker's encoder of a file; loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def utf8(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null: empty."""
    import pyarrow as pa

    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]
