"""Token ids of whole texts with a public tokenizer, its model called once per different word.

A text is cut at its spaces, where none of the two tokenizers' pre-tokens can
cross. Words of Latin letters with trailing ASCII punctuation go straight to the
library's BPE model, everything else through the library's whole encoder. The ids
of letters, of punctuation and of whole words whose letters came before are
remembered (up to ``MEMO`` letters and ``PAIRS`` words per worker, which bounds memory
and changes no result). Single line breaks inside a word part it: one tokenizer drops
white space, the other makes a token of its own of them.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np

from .common import held

MEMO = 450_000
PAIRS = 250_000
# ASCII punctuation without the apostrophe, which the pre-tokenizers treat apart
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PAIR_OF_SPACES = re.compile(r"\s\s")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level BPE: printable Latin-1 as is, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """``encode(text)``: ids as little-endian unsigned 32-bit bytes, equal to the library's ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.whole.model
        self.lower = self.whole.normalizer is not None  # the lower-casing tokenizer drops white space
        self.letters = _byte_letters()
        self.lead = "" if self.lower else self.letters[0x20]
        self.memo: dict[str, bytes] = {}  # words after a space
        self.room, self.pair_room = MEMO, PAIRS
        self.marks: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}  # words after a line break
        self.line = b"" if self.lower else self._library("\n")

    def _library(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _model(self, piece: str, lead: str = "") -> bytes:
        if not piece.isascii():  # printable ASCII stands for itself
            piece = "".join([self.letters[b] for b in piece.encode()])
        ids = [t.id for t in self.model.tokenize(lead + piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _marks(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            ids = self._model(marks)
            if len(self.marks) < 10_000 and len(marks) <= 16:
                self.marks[marks] = ids
        return ids

    def _word(self, word: str, lead: str) -> bytes:
        m = _WORD.fullmatch(word)
        if not m:
            if lead and "\n" in word[1:]:
                return self._lines(word, lead)
            return self._library(lead + word)
        letters, marks = m.groups()
        ids = self.memo.get(letters) if lead and marks else None
        seen = ids is not None
        if not seen:
            ids = self._model(letters.lower() if self.lower else letters, self.lead if lead else "")
            if lead and self.room > 0 and len(letters) <= 64:
                self.memo[letters] = ids
                self.room -= 1
        if not marks:
            return ids
        ids += self._marks(marks)
        if seen and self.pair_room > 0 and len(word) <= 64:
            self.memo[word] = ids
            self.pair_room -= 1
        return ids

    def _lines(self, word: str, lead: str) -> bytes:
        """A word with single line breaks inside (texts with runs of white space do not get here)."""
        first, *rest = word.split("\n")
        if not first or "" in rest[:-1]:
            return self._library(lead + word)
        out = [self.memo.get(first) or self._word(first, lead)]
        for part in rest:
            ids = self.bare.get(part)
            if ids is None:
                ids = self._word(part, "") if part else b""
                if len(self.bare) < 50_000 and len(part) <= 64:
                    self.bare[part] = ids
            out += [self.line, ids]
        return b"".join(out)

    def word(self, word: str) -> bytes:
        """Ids of one word after a space."""
        return self.memo.get(word) or self._word(word, " ")

    def encode(self, text: str) -> bytes:
        if not self.lower and _PAIR_OF_SPACES.search(text):
            return self._library(text)  # runs of white space are tokens of their own
        first, *words = (text.replace("\n", " ") if self.lower else text).split(" ")
        memo = self.memo
        found = list(map(memo.get, words))
        if None in found:
            word_ids = self._word
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    found[i] = (memo.get(word) or word_ids(word, " ")) if word or not self.lower else b""
        return self._word(first, "") + b"".join(found) if first else b"".join(found)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    return held(("encoder", path), lambda: WordEncoder(path))


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
