"""Token ids of whole texts, by the tokenizers library and a bounded cache of words."""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

# A word that ends in marks, and letters that the vocabulary's bytes do not tell case by case.
_STEM = re.compile(r"(\w+)([.,!?;:*&%$#]+)")
_beyond_latin = re.compile("[^\0-\u024f]").search


def _little(ids: array) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: printable ones stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Encodes texts with a vocabulary that drops white space, word by word.

    Such a vocabulary never joins two words over a blank or a line feed, so a text's ids are its words' ids, one after
    the other.  Words repeat, hence the cache; when it holds `capacity` words it becomes the older one of two, from which words
    that come again are taken over, and the one before is dropped.  So memory is bounded and frequent words stay.
    Plain letters go straight to the vocabulary's model, anything else through the whole tokenizer.
    Special tokens keep the meaning that the tokenizer file gives them.
    """

    def __init__(self, path: str, capacity: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.capacity = capacity
        self.words: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})

    def _pack(self, ids: list[int]) -> bytes:
        return _little(array("I", ids))

    def _letters(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters only."""
        if word.isascii():
            mapped = word.lower()
        else:
            form = unicodedata.normalize("NFC", word).lower()
            if not form.isalpha() or _beyond_latin(form):
                return None
            mapped = form.encode().decode("latin-1").translate(self.letters)
        return self._pack([t.id for t in self.model.tokenize(mapped)])

    def _learn(self, word: str) -> bytes:
        if len(self.words) >= self.capacity:
            # The newer one stays the same object, as a text that is being read holds it.
            self.older = self.words.copy()
            self.words.clear()
            self.words[""] = b""
        ids = self.older.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(word) <= 64:
            self.words[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        ids = None
        if word.isalpha():
            ids = self._letters(word)
        elif (m := _STEM.fullmatch(word)) and m[1].isalpha():
            # Letters and the marks behind them are split by the tokenizer too.
            stem, marks = self.words.get(m[1]), self.words.get(m[2])
            ids = (self._learn(m[1]) if stem is None else stem) + (self._learn(m[2]) if marks is None else marks)
        return self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids) if ids is None else ids

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; a null text is an empty one."""
        if not text:
            return b""
        if "<|" not in text and not _beyond_latin(text):
            text = text.lower()
        words, out = self.words, text.replace("\n", " ").split(" ")
        try:
            return b"".join([words[w] for w in out])
        except KeyError:
            learn, known = self._learn, words.get
            return b"".join([learn(w) if (ids := known(w)) is None else ids for w in out])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each tokenizer file and Python worker."""
    return WordEncoder(path)
