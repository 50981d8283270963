"""Whole-text encoding with the tokenizers library, remembering what recurs.

Byte-pair encoders treat what their pre-tokenizer separates independently, and both kinds used here
always separate where white space begins. A text is therefore the concatenation of *units* that each
begin there. Most units are a word with punctuation behind it, two *pieces* that the pre-tokenizer
separates as well; those go straight to the library's merge model, all others through the whole
tokenizer. Special tokens hold no white space, so they never straddle two units.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata
from array import array
from functools import lru_cache

# Remembered units: two generations of this many each, no longer than this; tails of punctuation.
_REMEMBERED = 250_000
_UNIT_CHARS = 48
_TAILS = 10_000

_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])")
_RUN = re.compile(r"\s\s")
_SPACED = re.compile(r" \S+$")
_PUNCTUATION = string.punctuation.replace("'", "")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Remembered(dict):
    """Text to value in two generations: what was not asked for during a whole one is forgotten."""

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def learn(self, text: str, value):
        if len(self) >= _REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[text] = value
        return value

    def find(self, text: str):
        value = dict.get(self, text)
        if value is None and (value := self.old.get(text)) is not None:
            self.learn(text, value)
        return value


class _Units(Remembered):
    """Ids by unit: a unit that neither generation has is encoded, so whole texts are looked up without a call for each unit."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        found = self.old.get(unit)
        return self.encode(unit) if found is None else self.learn(unit, found)


class UnitEncoder:
    """Encode texts to little-endian unsigned 32-bit ids, exactly as the library encodes the whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        # With one pre-tokenizer that is byte-level, white space is kept and case matters.
        self.keeps_space = isinstance(self.tokenizer.pre_tokenizer, ByteLevel)
        self.lead = " " if self.keeps_space else ""
        # Ids of units by what follows their blank; a key that begins with a line end has no blank before it.
        self.units = _Units(self._fresh)
        self.tails: dict[str, bytes] = {}
        self.alphabet = byte_alphabet()

    @property
    def vocabulary_size(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token, straight from the merge model."""
        if not self.keeps_space:
            if not piece.isascii():
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")  # no special final form
            piece = piece.lower()
        if not piece.isascii():
            piece = "".join([self.alphabet[b] for b in piece.encode()])
        elif piece[0] in " \n":  # all else that comes here is letters or punctuation, which stand for themselves
            piece = self.alphabet[ord(piece[0])] + piece[1:]
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _fresh(self, unit: str) -> bytes:
        """Ids of a unit that is not remembered, given without its blank."""
        fresh_line = self.keeps_space and unit[:1] == "\n"
        if len(unit) > _UNIT_CHARS:
            return self._whole(unit if fresh_line else self.lead + unit)
        body = unit.rstrip(_PUNCTUATION)
        word = body[1:] if fresh_line else body
        if not word.isalpha() or "İ" in word:  # the lower case of İ is more than letters
            ids = self._whole(unit if fresh_line else self.lead + unit)
        elif len(body) < len(unit):
            tail = unit[len(body) :]
            if tail not in self.tails:
                if len(self.tails) > _TAILS:
                    self.tails.clear()
                self.tails[tail] = self._piece(tail)
            ids = self.units[body] + self.tails[tail]
        elif fresh_line:
            ids = self._piece("\n") + self._piece(word)
        else:
            ids = self._piece(self.lead + word)
        return self.units.learn(unit, ids)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        unit = self.units.__getitem__
        if not self.keeps_space:
            rest = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            return b"".join(map(unit, filter(None, rest)))
        if _RUN.search(text):  # units with longer runs of white space
            return b"".join([unit(u[1:]) if _SPACED.match(u) else self._whole(u) for u in _CUT.split(text)])
        first, *rest = text.replace("\n", " \n").split(" ")
        return b"".join([self._whole(first) if first else b"", *map(unit, rest)])


@lru_cache(maxsize=4)
def encoder(path: str) -> UnitEncoder:
    """One encoder for each Python worker and tokenizer file."""
    return UnitEncoder(path)
