"""Encoding whole texts with the tokenizers library, a word at a time where that gives the same ids."""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import lru_cache

# New words after which a process starts a new store; words met again are taken over from the last one, others are forgotten.
CACHE_WORDS = 350_000


# White space as tokenizers see it: unlike Python they do not count the four separators among it.
_PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
# The same for texts without these separators.
_PLAIN_PIECE = re.compile(r"\s*\S+|\s+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _steps(part: dict | None, inner: str) -> list[dict]:
    return [] if part is None else part[inner] if part["type"] == "Sequence" else [part]


def separable(spec: dict) -> bool:
    """Whether ids of a text are the ids of its words (each with the white space before it) one after another.

    So it is where words are cut by the usual pattern before merging: no match goes from a sign that is not white space to
    one that is. The normalisers met here (composition, white space to spaces, lower case) do not look across that place
    either. Any other tokenizer gets whole texts.
    """
    before = _steps(spec.get("pre_tokenizer"), "pretokenizers")
    normal = _steps(spec.get("normalizer"), "normalizers")
    if not before or any(n["type"] not in ("NFC", "Lowercase", "Replace") for n in normal):
        return False
    if any(n["type"] == "Replace" and (n["pattern"] != {"Regex": "\\s+"} or n["content"] != " ") for n in normal):
        return False
    if len(before) == 1:
        return before[0]["type"] == "ByteLevel" and before[0]["use_regex"] and not before[0]["add_prefix_space"]
    return (len(before) == 2 and before[0]["type"] == "Split" and before[0]["invert"] and before[0]["behavior"] == "Removed"
            and "\\s" in before[0]["pattern"].get("Regex", "") and before[1]["type"] == "ByteLevel"
            and not before[1]["use_regex"] and not before[1]["add_prefix_space"])


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next one free."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()
# Letters below this sign have one upper and lower form and no parts to compose, whatever the version of Unicode.
_LATIN = "\u0250"
# ASCII signs that are neither letters, digits nor white space: a run of them after a letter is one piece.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _packed(kind: str, ids: list[int]) -> bytes:
    """Little-endian unsigned integers."""
    raw = array(kind, ids)
    if sys.byteorder == "big":
        raw.byteswap()
    return raw.tobytes()


class _Words(dict):
    """Ids of words with the white space before them, found once. A word of Latin letters is one piece of the pattern and
    goes to the merges directly, ASCII marks after it are another one; any other word goes through the whole tokenizer."""

    def __init__(self, tokenizer, lower: bool, spaced: bool, kind: str):
        super().__init__()
        self.tokenizer, self.lower, self.kind = tokenizer, lower, kind
        self.merge = tokenizer.model.tokenize
        self.marks: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}
        # what stands in front of the letters: nothing, a space that joins them, a line end that is a piece of its own
        self.fronts = {" ": (b"", _LETTERS[0x20] if spaced else ""), "\n": (self._piece(_LETTERS[0x0A]) if spaced else b"", "")}

    def _piece(self, letters: str) -> bytes:
        return _packed(self.kind, [t.id for t in self.merge(letters)])

    def age(self) -> None:
        """Begin a new store if this one is full."""
        if len(self) > CACHE_WORDS:
            self.last = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        if (ids := self.last.get(word)) is not None:
            self[word] = ids
            return ids
        core = word.rstrip(_MARKS)
        if core and core[-1].isalpha() and len(core) < len(word):
            marks = word[len(core):]
            ids = self[core] + (self.marks.get(marks) or self.marks.setdefault(marks, self._piece(marks)))
        else:
            front = self.fronts.get(word[:1])
            bare = word[1:] if front else word
            if self.lower:
                bare = bare.lower()
            if bare.isalpha() and (bare.isascii() or max(bare) < _LATIN):
                letters = bare if bare.isascii() else bare.encode().decode("latin-1").translate(_LETTERS)
                before, lead = front or (b"", "")
                ids = before + self._piece(lead + letters)
            else:
                ids = _packed(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = ids
        return ids


class TextEncoder:
    """Ids of whole texts as little-endian unsigned integers of 4 bytes, or of 2 if ``short``. No special tokens are added; where the string of an
    added token stands in a text it is that token, as the library has it, and such a text goes through the library as a whole."""

    def __init__(self, path: str, short: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = spec.get("added_tokens") or []
        # tokens that are looked for after normalising, or only as whole words, would have to be looked for likewise here
        self.by_words = separable(spec) and not any(t["normalized"] or t["single_word"] for t in added)
        self.added = [t["content"] for t in added]
        self.kind = "H" if short else "I"
        lower = any(n["type"] == "Lowercase" for n in _steps(spec.get("normalizer"), "normalizers"))
        self.words = _Words(self.tokenizer, lower, len(_steps(spec.get("pre_tokenizer"), "pretokenizers")) == 1, self.kind)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Surrogates, which UTF-8 lacks, are read as question marks."""
        self.words.age()
        return [self._one(t if t.isascii() else t.encode("utf-8", "replace").decode()) for t in texts]

    def _one(self, text: str) -> bytes:
        if self.by_words and not any(t in text for t in self.added):
            cut = _PIECE if any(c in text for c in _SEPARATORS) else _PLAIN_PIECE
            return b"".join(map(self.words.__getitem__, cut.findall(text)))
        return _packed(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids)


@lru_cache(maxsize=4)
def encoder(path: str, short: bool = False) -> TextEncoder:
    """One encoder for each file and process, so that the words it has seen serve later tasks too."""
    return TextEncoder(path, short)
