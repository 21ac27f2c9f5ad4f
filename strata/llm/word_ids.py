"""Token ids of whole texts by a tokenizers file whose words never join across blanks.

The tokenizer is asked once per distinct word, or part of a word, and the ids are kept in tables of
bounded size; a text with a special token, or a control character that Python takes for a
blank, is given to the library whole.
"""

from __future__ import annotations

import struct
import unicodedata
from functools import lru_cache

import numpy as np
import regex

MODEL = "word_bpe_49k.json"
KEPT, KEPT_LENGTH = 400_000, 32  # words of a table; there are two
_NOT_BLANK = "\x1c\x1d\x1e\x1f"  # blanks to str.split, not to the tokenizer
_LATIN_END = "ɐ"
# How the tokenizer divides a word that has no apostrophe.
_parts = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall


def _byte_names() -> dict[int, int]:
    """Byte to the character that names it in a byte-level vocabulary: printable Latin-1
    characters name themselves, the others take those from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}


class _Words(dict):
    """Ids of the words between blanks, as unsigned little-endian 32-bit numbers."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.names = tokenizer, tokenizer.model, _byte_names()
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.made(word)
        if len(word) <= KEPT_LENGTH:
            self[word] = ids
        return ids

    def made(self, word: str) -> bytes:
        if len(word) > KEPT_LENGTH or "'" in word:
            return self.asked(word)
        if word.isascii():
            low = word.lower()
        elif max(word) < _LATIN_END:
            low = "".join(c.lower() for c in unicodedata.normalize("NFC", word))
        else:
            return self.asked(word)
        if not low.isalpha():
            parts = _parts(low)
            return b"".join(map(self.__getitem__, parts)) if len(parts) > 1 else self.asked(word)
        return self.of_letters(word) if low == word else self[low]

    def asked(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of_letters(self, low: str) -> bytes:
        """Lower-case letters only are one word to the tokenizer: its model is asked directly."""
        named = low if low.isascii() else low.encode().decode("latin-1").translate(self.names)
        return _packed([t.id for t in self.model.tokenize(named)])

    def bounded(self) -> None:
        """A full table stays for words that come again, in place of the one before."""
        if len(self) > KEPT:
            self.before = dict(self)
            self.clear()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.words = _Words(tokenizer)
        self.whole = [t.content for t in tokenizer.get_added_tokens_decoder().values()] + list(_NOT_BLANK)

    def __call__(self, text: str, last: int) -> np.ndarray:
        """Ids of ``text`` and then ``last``, as unsigned 32-bit numbers."""
        self.words.bounded()
        if any(x in text for x in self.whole):
            ids = self.words.asked(text)
        else:
            ids = b"".join(map(self.words.__getitem__, text.split()))
        return np.frombuffer(ids + _packed([last]), dtype="<u4")


@lru_cache(maxsize=4)
def encoder(name: str = MODEL) -> Encoder:
    import public_tokenizers

    return Encoder(public_tokenizers.path(name))
