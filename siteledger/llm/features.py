"""Hashed features of words, remembered for recent words only."""

from __future__ import annotations

import re
import zlib

_RUNS = (("A-ZÀ-ÖØ-Þ", "X"), ("a-zß-öø-ÿ", "x"), ("0-9", "9"))
_SHAPE = [(re.compile(f"[{chars}]+"), to) for chars, to in _RUNS]
_MARKS = ".,;:!?\"'()[]{}<>*#$%&|~^_-+=/\\`@"


def shape(word: str) -> str:
    """The form of a word: runs of capitals, small letters and digits as one sign each; repeated marks as one."""
    for pattern, to in _SHAPE:
        word = pattern.sub(to, word)
    return re.sub(r"(.)\1+", r"\1", word)[:12]


class WordFeatures(dict):
    """Word to the hashed columns of its small-letter core and of its shape."""

    MOST = 300_000

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= self.MOST:
            self.clear()
        core = word.strip(_MARKS).lower()
        out = (zlib.crc32(("w" + core).encode("utf-8", "surrogatepass")) & self.mask, zlib.crc32(("s" + shape(word)).encode("utf-8", "surrogatepass")) & self.mask)
        if len(word) <= 64:
            self[word] = out
        return out
