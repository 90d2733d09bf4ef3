"""Token ids and counts of public tokenizers.

Ids are as Python's ``tokenizers`` gives them. Counts use a memory of words: the counting vocabulary drops white
space and never joins what it parts, so a text has as many tokens as its words together. Texts with separators on
which Python and the library disagree are encoded whole.
"""

from __future__ import annotations

import base64
import os
import re
import sys
from array import array

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer


# Words whose counts one worker remembers before it starts anew; each costs more to encode than to keep.
WORD_LIMIT = 600_000
# Separators to Python that are symbols to the tokenizers.
_ODD_SEPARATOR = re.compile("[\x1c-\x1f]")


def place(name: str) -> str:
    return name if os.path.isabs(name) else public_tokenizers.path(name)


def load(name: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(place(name))


def ranked(name: str) -> tiktoken.Encoding | None:
    """The encoder of a rank file, None where there is no such file."""
    if not os.path.exists(place(name)):
        return None
    with open(place(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _sixteen(ids: list[int]) -> bytes:
    short = array("H", ids)
    if sys.byteorder == "big":
        short.byteswap()
    return short.tobytes()


class ByteIds:
    """Ids of a byte-level BPE vocabulary as little-endian unsigned 32-bit integers.

    The ids are those of the ``.json`` file. Where its rank file with the same vocabulary lies beside it, texts
    without special strings are encoded by that, which gives equal ids several times faster.
    """

    def __init__(self, name: str = "byte_bpe_50k.json"):
        self.tokenizer = load(name)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = ranked(os.path.splitext(name)[0] + ".tiktoken")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.ranked is None:
            return [self._whole(text) for text in texts]
        plain = self.ranked.encode_ordinary
        return [
            self._whole(text) if any(s in text for s in self.special) else np.array(plain(text), "<u4").tobytes()
            for text in texts
        ]

    def short(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 16-bit integers; a larger one raises."""
        if self.ranked is None:
            return [_sixteen(self.tokenizer.encode(text, add_special_tokens=False).ids) for text in texts]
        plain = self.ranked.encode_ordinary
        return [
            _sixteen(self.tokenizer.encode(text, add_special_tokens=False).ids if any(s in text for s in self.special) else plain(text))
            for text in texts
        ]

    def lengths(self, texts: list[str]) -> list[int]:
        """How many ids each text has, without making them arrays."""
        if self.ranked is None:
            return [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        plain = self.ranked.encode_ordinary
        return [len(self._whole(text)) // 4 if any(s in text for s in self.special) else len(plain(text)) for text in texts]


class WordCounts:
    """Token counts of a BPE vocabulary that drops white space."""

    def __init__(self, name: str = "word_bpe_49k.json"):
        self.tokenizer = load(name)
        self.known: dict[str, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > WORD_LIMIT:
            self.known = {}
        split = [[text] if _ODD_SEPARATOR.search(text) else text.split() for text in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        words = list(new - self.known.keys())
        self.known.update(zip(words, self.lengths(words)))
        known = self.known.__getitem__
        return [sum(map(known, own)) for own in split]


_loaded: dict[tuple[type, str], object] = {}


def shared(kind: type, name: str):
    """One encoder of a kind and vocabulary for each worker."""
    return _loaded.get((kind, name)) or _loaded.setdefault((kind, name), kind(name))
