"""Exact tokenization with the `tokenizers` library, word by word with a memory.

The two vocabularies used here never build a token across the blank before a word: byte-level BPE glues one blank to
the word behind it, word-level BPE drops white space. A text is therefore cut before its blanks, and its ids are the
joined ids of its pieces. Pieces of plain Latin text are cut once more, by the tokenizer's own rule for words, and a
worker hands each word to the tokenizer's model once. A text for which a cut might matter (a blank followed by more
white space) is encoded whole, and so is a piece with other scripts, control characters or what might be a special
token's string. The memory is bounded: a worker that knows `KNOWN` pieces keeps those and works the others out anew.

Edge cases: a null text counts as empty and has no ids.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

KNOWN = 500_000
#: A blank and more white space: byte-level pieces on both sides of such a place aren't independent.
UNSAFE = re.compile(r" \s")
#: Pieces that any library cuts into the same words.
PLAIN = re.compile("[!-~\n ¡-ÿ]*")
#: How the two tokenizers cut a text into words, as their public descriptions state it.
GLUED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOOSE = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


def byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    odd = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(odd)) for b in range(256)}


LETTERS = byte_letters()


class Memo:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, glued: bool, known: int | None = None):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.glued, self.most = glued, KNOWN if known is None else known
        self.cut_words = regex.compile(GLUED if glued else LOOSE).findall
        self.tokenize = self.tokenizer.model.tokenize
        #: Ids of pieces: by the piece, or where blanks are glued on, by what follows the blank; `heads` holds those without a blank.
        self.known: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {} if glued else self.known

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        return map(self.encode, texts)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.glued:
            pieces = text.replace("\n", " ").split(" ")
        elif UNSAFE.search(text):
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            pieces = text.split(" ")
        found = list(map(self.known.get, pieces))
        if self.glued:  # no blank stands before the first piece
            found[0] = self.heads.get(pieces[0]) or self.learn(pieces[0], self.heads, pieces[0])
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            x = pieces[at]
            found[at] = self.known.get(x) or self.learn(x, self.known, " " + x if self.glued else x)
        return b"".join(found)

    def keep(self, where: dict[str, bytes], key: str, ids: bytes) -> bytes:
        if len(self.known) + self.glued * len(self.heads) < self.most:
            where[key] = ids
        return ids

    def learn(self, key: str, where: dict[str, bytes], x: str) -> bytes:
        """Ids of a piece that isn't known yet."""
        plain = x.isascii() or PLAIN.fullmatch(x)
        w = x.lower() if plain and not self.glued else x
        body = w[1:] if self.glued and w[:1] == " " else w
        if plain and body.isalpha():
            ids = self.word(w)
        elif plain and body[-1:] in (".", ",") and body[:-1].isalpha():
            ids = self.word(w[:-1]) + self.word(w[-1])
        elif plain and "<|" not in x and PLAIN.fullmatch(x):
            ids = b"".join([self.word(y) for y in self.cut_words(w)])
        else:
            ids = packed(self.tokenizer.encode(x, add_special_tokens=False).ids)
        return self.keep(where, key, ids)

    def word(self, word: str) -> bytes:
        """Ids of one word, as the tokenizer's rule cuts them: what its model makes of the word's bytes, each written as a letter."""
        where, key = (self.known, word[1:]) if self.glued and word[:1] == " " else (self.heads, word)
        found = where.get(key)
        if found is None:
            if word.isascii():
                letters = word.replace(" ", "\u0120").replace("\n", "\u010a")
            else:
                letters = word.encode().decode("latin-1").translate(LETTERS)
            found = self.keep(where, key, packed([t.id for t in self.tokenize(letters)]))
        return found

    def byte_lengths(self) -> np.ndarray:
        """By id of a byte-level vocabulary: how many bytes of text a token stands for (its letters each stand for one)."""
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        out = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            out[i] = len(special[i].encode()) if i in special else len(token)
        return out


def packed(ids: list[int]) -> bytes:
    a = array("I", ids)
    if array("H", [1]).tobytes() != b"\x01\x00":
        a.byteswap()
    return a.tobytes()


@lru_cache(maxsize=4)
def memo(path: str, glued: bool, known: int | None = None) -> Memo:
    """The worker's memory for a tokenizer file, of at most `known` pieces (default: `KNOWN`); it outlives tasks where workers are reused."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Memo(path, glued, known)


@lru_cache(maxsize=4)
def byte_lengths(path: str) -> np.ndarray:
    return memo(path, True).byte_lengths()


def token_starts(text: str, ids: bytes, lengths: np.ndarray) -> np.ndarray:
    """The character in which each token of a byte-level encoding begins, ascending."""
    size = lengths[np.frombuffer(ids, "<u4")]
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    at = np.cumsum(size) - size
    return at if len(raw) == len(text) else (np.cumsum((raw & 0xC0) != 0x80) - 1)[at]
