"""Tokenizers of public vocabulary files, with a bounded memo of words already encoded."""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from itertools import compress, repeat
from operator import is_

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
#: Words a worker remembers, and the longest of them in characters.
MEMO_WORDS, MEMO_CHARS = 1_600_000, 48

#: The library for ranks overflows its stack on white space of some hundred thousand characters; runs of this
#: length go to the vocabulary's own library, which counts the same.
LONG_SPACE = re.compile(r"\s{1000}")

#: Byte-level vocabularies that the public folder also has as ranks.
RANKS = {BYTE_BPE: "byte_bpe_50k.tiktoken"}


def vocabulary_path(name: str) -> str:
    """A file name of the public folder, or any path."""
    return name if os.sep in name else public_tokenizers.path(name)


@functools.cache
def tokenizer_digest(name: str) -> str:
    """SHA-256 of the vocabulary file: the version under which counts are stored."""
    with open(vocabulary_path(name), "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


@functools.cache
def load(name: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(vocabulary_path(name))


class Counter:
    """Token counts of whole texts as the library of the vocabulary file gives them.

    A byte-level BPE whose ranks are at hand as well is counted by the faster library for ranks,
    which gives the same tokens; texts that hold a special token's string, or a long run of white
    space, go to the file's own.
    """

    def __init__(self, name: str = BYTE_BPE):
        self.ranks, self.special, self.pieces = None, [], None
        if name.endswith(".model"):
            self.pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name))
            return
        self.tokenizer = load(name)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if name in RANKS:
            with open(vocabulary_path(RANKS[name]), "rb") as file:
                ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
            self.ranks = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(self, text: str) -> int:
        if self.pieces is not None:
            return len(self.pieces.encode(text))
        if self.ranks is not None and not any(s in text for s in self.special) and not LONG_SPACE.search(text):
            return len(self.ranks.encode_ordinary(text))
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


class WordEncoder:
    """Token ids of whole texts, as little-endian 32-bit bytes, by a BPE that drops white space.

    Such a BPE cuts a text at ASCII white space before anything looks across it, so words are
    encoded alone; a word is remembered, as most of a text's words come again.
    """

    _TAIL = b".,;:!?"

    def __init__(self, name: str = WORD_BPE):
        self.tokenizer, self.memo = load(name), {}
        ends = [i for word, i in self.tokenizer.get_vocab().items() if word.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[ends] = True

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters only are one pretoken each, closed by a token that ends a word: they are encoded in one go."""
        plain, other, out = [], [], {}
        for word in words:
            (plain if word.decode("utf-8", "replace").lower().isalpha() else other).append(word)
        for at in range(0, len(plain), 1000):
            part = plain[at : at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                other += part
                continue
            data, begin = ids.tobytes(), 0
            for word, stop in zip(part, (4 * stops).tolist(), strict=True):
                out[word] = data[begin:stop]
                begin = stop
        if other:
            encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in other], add_special_tokens=False)
            out.update((w, np.array(e.ids, dtype="<u4").tobytes()) for w, e in zip(other, encoded, strict=True))
        return out

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """A word that ends in a letter, with plain marks behind it, is its two parts: they make pretokens of their own."""
        memo, parts, need = self.memo, [], set()
        for word in words:
            core = word.rstrip(self._TAIL)
            if core and len(core) <= MEMO_CHARS and (core[-1:].isalpha() or core.decode("utf-8", "replace").lower()[-1].isalpha()):
                low = core.lower() if core.isascii() else core
                tail = word[len(core) :]
                parts.append((word, low, tail))
                if tail and tail not in memo:
                    need.add(tail)
            else:
                low = word
                parts.append((word, word, b""))
            if low not in memo:
                need.add(low)
        fresh = self._encode(list(need))
        out = {}
        for word, low, tail in parts:
            ids = fresh[low] if low in fresh else memo[low]
            out[word] = ids + (fresh[tail] if tail in fresh else memo[tail]) if tail else ids
        for source in (fresh, out):
            memo.update((w, b) for w, b in source.items() if len(w) <= MEMO_CHARS)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; call it with a few MB of texts."""
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        split = [t.encode("utf-8", "replace").split() for t in texts]  # bytes split at ASCII white space only
        known = [list(map(memo.get, words)) for words in split]
        gaps = [None in parts for parts in known]
        missing: set[bytes] = set()
        for words, parts, gap in zip(split, known, gaps, strict=True):
            if gap:
                missing.update(compress(words, map(is_, parts, repeat(None))))
        fresh = self._learn(missing)
        return [b"".join([fresh[w] if p is None else p for w, p in zip(words, parts, strict=True)] if gap else parts) for words, parts, gap in zip(split, known, gaps, strict=True)]

    def ids(self, text: str) -> bytes:
        return self.encode([text])[0]


@functools.cache
def counter(name: str) -> Counter:
    return Counter(name)


@functools.cache
def word_encoder(name: str) -> WordEncoder:
    return WordEncoder(name)
