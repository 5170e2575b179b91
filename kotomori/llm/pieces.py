"""Pre-tokens: the pieces that a public tokenizer merges one by one.

Two pre-token patterns are needed, byte-level and word-end. Both split text by
character class alone, so each has a fast form over Latin-1 text, a Unicode form
for other text, and the tokenizer itself for characters whose class depends on the
Unicode version (``DISPUTED``) and for texts that hold a special token.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import regex

from kotomori.llm.common import load_tokenizer

# The two published pre-token patterns.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Letters, numbers and white space of Latin-1.
_L, _N, _S = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\\t-\\r \\x85\\xa0"

DISPUTED = re.compile("[՘֋֌࢏౜೜₏₝-₟Ɤ-ꟿ꭬꭭\U00010000-\U0010ffff]")


def latin(pattern: str) -> re.Pattern:
    """``pattern`` for text that is known to be Latin-1."""
    for long, short in ((r"[^\s\p{L}\p{N}]", f"[^{_S}{_L}{_N}]"), (r"[\p{L}]", f"[{_L}]"), (r"[\p{N}]", f"[{_N}]"), (r"\p{L}", f"[{_L}]"), (r"\p{N}", f"[{_N}]"), (r"(?!\S)", f"(?![^{_S}])"), (r"\s", f"[{_S}]")):
        pattern = pattern.replace(long, short)
    return re.compile(pattern)


def is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_pieces(path: str, special: str = "<|endoftext|>") -> Callable[[str], tuple[list[str], int]]:
    """A function from a text to its pre-tokens and the number of special tokens in it."""
    fast, wide = latin(BYTE_PATTERN).findall, regex.compile(BYTE_PATTERN).findall
    pre = load_tokenizer(path).pre_tokenizer

    def plain(text: str) -> list[str]:
        if is_latin(text):
            return fast(text)
        if DISPUTED.search(text):
            return [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)]
        return wide(text)

    def split(text: str) -> tuple[list[str], int]:
        if special not in text:
            return plain(text), 0
        parts = text.split(special)
        return [p for part in parts for p in plain(part)], len(parts) - 1

    return split


def token_counts(path: str, pieces: list[str]) -> list[int]:
    """The number of ids of each pre-token."""
    return [len(e.ids) for e in merges_only(path, at_spaces=False).encode_batch_fast(pieces, add_special_tokens=False)]


def merges_only(path: str, at_spaces: bool):
    """The tokenizer's merges without its normal forms and pattern, for text that is a
    pre-token, or pre-tokens with spaces between them."""
    key = (path, at_spaces)
    if key not in _MERGES:
        from tokenizers import Tokenizer, pre_tokenizers

        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        _MERGES[key] = Tokenizer(load_tokenizer(path).model)
        _MERGES[key].pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), to_bytes]) if at_spaces else to_bytes
    return _MERGES[key]


_MERGES: dict = {}


class WordIds(dict):
    """Pre-token of the word-end tokenizer -> its ids as little-endian 32-bit bytes.

    Words are tokenized many at a time, with spaces between them; their ids are told
    apart by the ends of words. ``limit`` bounds the number of words kept; the table
    starts afresh beyond it.
    """

    SPECIALS = ("<|startoftext|>", "<|endoftext|>")
    TOGETHER = 500

    def __init__(self, path: str, limit: int = 300_000):
        super().__init__()
        self.tokenizer, self.limit = load_tokenizer(path), limit
        self.merges = merges_only(path, at_spaces=True)
        self.fast, self.wide = latin(WORD_PATTERN).findall, regex.compile(WORD_PATTERN).findall
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        chunks = [words[k : k + self.TOGETHER] for k in range(0, len(words), self.TOGETHER)]
        for chunk, found in zip(chunks, self.merges.encode_batch_fast([" ".join(c) for c in chunks], add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) == len(chunk):
                raw, start = ids.tobytes(), 0
                for word, stop in zip(chunk, stops):
                    self[word] = raw[4 * start : 4 * stop]
                    start = stop
            else:
                self.update((word, self.encoded(word)) for word in chunk)

    def words(self, text: str) -> list[str] | None:
        """The pre-tokens of a text; None if the tokenizer itself has to read it."""
        if is_latin(text) and "<|" not in text:
            return self.fast(text.lower())
        if any(s in text for s in self.SPECIALS) or DISPUTED.search(low := self.tokenizer.normalizer.normalize_str(text)):
            return None
        return self.wide(low)

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts."""
        split = [self.words(t) for t in texts]
        needed = set().union(*(w for w in split if w is not None))
        new = [w for w in needed if w not in self]
        if len(self) + len(new) > self.limit:
            self.clear()
            new = list(needed)
        self.learn(new)
        get = self.__getitem__
        return [self.encoded(t) if w is None else b"".join(map(get, w)) for w, t in zip(split, texts)]


class ByteIds(dict):
    """Pre-token of the byte-level tokenizer -> its ids as little-endian 32-bit bytes.

    New pre-tokens are tokenized many at a time, with a separator between them that is in
    none. ``limit`` bounds the number kept; beyond it those not used since the last time
    it was reached go.
    """

    SEPARATOR = "\0"
    TOGETHER = 500

    def __init__(self, path: str, limit: int = 200_000, special: str = "<|endoftext|>"):
        super().__init__()
        from tokenizers import Tokenizer, pre_tokenizers

        self.limit, self.special, self.older = limit, special, {}
        self.single, self.split = merges_only(path, at_spaces=False), byte_pieces(path, special)
        self.merges = Tokenizer(load_tokenizer(path).model)
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(self.SEPARATOR, "removed"), to_bytes])
        self.special_id = load_tokenizer(path).token_to_id(special).to_bytes(4, "little")

    def learn(self, pieces: list[str]) -> None:
        odd = [p for p in pieces if self.SEPARATOR in p]
        if odd:
            pieces = [p for p in pieces if self.SEPARATOR not in p]
            self.update((p, np.array(f.ids, dtype="<u4").tobytes()) for p, f in zip(odd, self.single.encode_batch_fast(odd, add_special_tokens=False)))
        chunks = [pieces[k : k + self.TOGETHER] for k in range(0, len(pieces), self.TOGETHER)]
        for chunk, found in zip(chunks, self.merges.encode_batch(list(map(self.SEPARATOR.join, chunks)), add_special_tokens=False)):
            raw = np.array(found.ids, dtype="<u4").tobytes()
            stops = (4 * (np.flatnonzero(np.diff(np.array(found.word_ids, dtype=np.int64), append=-1)) + 1)).tolist()
            start = 0
            for piece, stop in zip(chunk, stops, strict=True):
                self[piece] = raw[start:stop]
                start = stop

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts."""
        parts = [[self.split(p)[0] for p in (t.split(self.special) if self.special in t else (t,))] for t in texts]
        needed = set()
        for ps in parts:
            needed.update(*ps)
        new = needed.difference(self)
        if len(self) + len(new) > self.limit:
            self.older = dict(self)
            self.clear()
            new = needed
        if self.older:
            known = [p for p in new if p in self.older]
            self.update(zip(known, map(self.older.__getitem__, known)))
            new = new.difference(known)
        self.learn(list(new))
        get = self.__getitem__
        return [self.special_id.join([b"".join(map(get, p)) for p in ps]) for ps in parts]
