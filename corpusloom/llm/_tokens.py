"""Token ids of whole texts by a public byte-level BPE, with a bounded memory of words.

The tokenizer's pattern never joins a character other than white space with a single space or
line feed that follows it. So a text is cut before such spaces and around such line feeds, and
each distinct word is encoded once. Texts with other white space are encoded whole. For single
words the same vocabulary and pattern are applied through a second library, which is three times
as fast on short strings and gives the same ids (tests compare them).
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as ranks.
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Words that a worker remembers, and the longest of them in characters.
MEMORY, LONGEST = 200_000, 40


class _Whole(Exception):
    """This text can't be cut into words."""


class _Words(dict):
    def __init__(self, encode, before: str):
        self.encode, self.before = encode, before

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Whole
        ids = self.encode(self.before + word)
        if len(word) <= LONGEST:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = ids
        return ids


def encoding(path: str = BYTE_RANKS, ranks: int | None = None) -> tiktoken.Encoding:
    """The vocabulary of ``path``, or its first ``ranks``: a smaller one by the same merges."""
    with open(path, "rb") as f:
        ranked = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks={k: v for k, v in ranked.items() if ranks is None or v < ranks}, special_tokens={})


@functools.cache
def small_bpe(ranks: int = 1024) -> tiktoken.Encoding:
    return encoding(ranks=ranks)


def spaced_ids(ranks: int) -> np.ndarray:
    """Whether each id of the small vocabulary begins with a space."""
    return np.array([small_bpe(ranks).decode_single_token_bytes(i).startswith(b" ") for i in range(ranks)])


class WordTokenizer:
    def __init__(self, path: str = BYTE_BPE, ranks: str = BYTE_RANKS):
        self._tokenizer = Tokenizer.from_file(path)
        self._words = encoding(ranks)
        self._first, self._later = _Words(self._word, ""), _Words(self._word, " ")
        self._feed = self.encode("\n")

    def encode(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if "<|" in word:  # may be a special token
            return self.encode(word)
        return np.array(self._words.encode_ordinary(word), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        first, later = self._first, self._later
        try:
            lines = []
            for line in text.split("\n"):
                words = line.split(" ")
                lines.append(first[words[0]] + b"".join([later[w] for w in words[1:]]))
            return self._feed.join(lines)
        except _Whole:
            return self.encode(text)


_MADE: dict[str, WordTokenizer] = {}


def tokenizer(path: str = BYTE_BPE) -> WordTokenizer:
    """One tokenizer for each worker process and file."""
    if path not in _MADE:
        _MADE[path] = WordTokenizer(path)
    return _MADE[path]
