"""Whole texts to ids with the tokenizers library, word by remembered word."""

from __future__ import annotations

import json
import string
import sys
from array import array
from functools import cache

#: The split of tokenizers that drop white space and never join what it separates.
SPACE_FREE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Signs that, any number of them, are one slice behind a letter.
SIGNS = "".join(x for x in string.punctuation if x != "'")
#: Latin letters, which stay one letter when normalised and lower-cased (İ does not).
LETTERS = frozenset(chr(x) for x in range(0x250) if chr(x).isalpha() and len(chr(x).lower()) == 1)
#: The sign that stands for each byte in byte-level vocabularies: itself if it can be printed, else the next free one from 256.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {x: chr(x) for x in PRINTED} | {x: chr(256 + k) for k, x in enumerate(x for x in range(256) if x not in PRINTED)}


class WordEncoder:
    """``encode(text)`` gives the ids of a whole text as little-endian unsigned 32-bit integers.

    A tokenizer that drops white space gives a text the ids of its words in turn, so each
    word is encoded by the library once and then remembered; any other tokenizer gets whole
    texts. Where a word is new, what is left without signs at its end and a capital at its
    start may still be known, and a word of Latin letters alone needs no more of the library
    than its model: it is one slice, its normal form its lower case. ``remember`` bounds the memory; words over ``longest``
    characters are not remembered. Null counts as empty. Strings of special tokens are
    ordinary text.
    """

    def __init__(self, path: str, remember: int = 180_000, longest: int = 48):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            split = (json.load(f).get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_word = split.get("pattern", {}).get("Regex") == SPACE_FREE_SPLIT and split.get("behavior") == "Removed" and bool(split.get("invert"))
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.library.encode_special_tokens = True
        self.model = self.library.model
        self.words, self.cores = Memory(self._word, remember, longest), Memory(self._core, remember, longest)

    def _ids(self, text: str) -> bytes:
        return _packed(self.library.encode(text, add_special_tokens=False).ids)

    def _core(self, core: str) -> bytes:
        if core.isalpha() and LETTERS.issuperset(core):
            core = core.lower()
            return _packed([t.id for t in self.model.tokenize(core if core.isascii() else core.encode().decode("latin-1").translate(BYTE_SIGNS))])
        return self._ids(core)

    def _word(self, word: str) -> bytes:
        core = word.rstrip(SIGNS)
        if not core or core[-1] not in LETTERS:
            return self.cores[word]
        tail = word[len(core) :]
        if "A" <= core[0] <= "Z":
            core = core[0].lower() + core[1:]
        return self.cores[core] + self.cores[tail] if tail else self.cores[core]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word:
            return self._ids(text)
        self.words.age()
        self.cores.age()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Memory(dict):
    """What ``make`` made of a key: the last ``most`` new keys, and as many of the generation before."""

    def __init__(self, make, most: int, longest: int):
        self.make, self.most, self.longest, self.old = make, most, longest, {"": b""}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self[key] = value
        return value

    def age(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
            self[""] = b""


@cache
def shared_encoder(path: str, remember: int) -> WordEncoder:
    """One encoder for all tasks of a worker, so that it keeps what it remembers."""
    return WordEncoder(path, remember)
