"""Token ids of whole texts, with the ids of repeated pieces remembered.

A text is cut where the tokenizer is certain to cut as well: before a single space (or line feed) that a
non-space follows. Pieces are encoded once and then looked up, because text repeats its words
and a tokenizer needs over a microsecond a byte. What cannot be cut so simply
(runs of white space) is cut more carefully or encoded whole; ids are the same either way.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Callable

import numpy as np

CACHED_PIECES = 1_200_000
"""Pieces that a Python worker remembers; when there are more it starts afresh."""

_SPACES = frozenset(chr(c) for c in range(0x3001) if chr(c).isspace())
_MARKS = frozenset(".,;:!?")
_DOTTED = "\u0130"  # its lower case ends with a combining dot
JOINED_PIECES = 100
"""New pieces that the tokenizer is given as one text, if it drops spaces; a call has its price, however short the text is."""
_BETWEEN = "~"  # stands between them, with an id of its own; pieces that hold it are encoded by themselves
_CAREFUL = re.compile(r"(?<!^)(?= \S)")


class Encoder:
    """`encode` gives the ids of texts as little-endian unsigned 32-bit numbers.

    `whole` encodes a list of texts; `drops_spaces` is for tokenizers that lower-case and ignore white
    space other than as a separator. The others must be byte-level with the usual pattern, in which one space
    belongs to the word that follows.
    """

    def __init__(self, whole: Callable[[list[str]], list[bytes]], drops_spaces: bool) -> None:
        self.whole = whole
        self.drops_spaces = drops_spaces
        self.cache: dict[str, bytes | None] = {}
        self.marks: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        cache = self.cache
        new = pieces.difference(cache)
        if not self.drops_spaces:
            odd = [p for p in new if not p or p[0] in _SPACES and (p[0] != "\n" or p == "\n" or p[1] in _SPACES)]
            cache.update(dict.fromkeys(odd))
            new.difference_update(odd)
        # capitals of ASCII pieces do not matter where the tokenizer lower-cases anyway
        lowered = [p for p in new if p.isascii() and not p.islower() and p != p.lower()] if self.drops_spaces else []
        new.difference_update(lowered)
        new.update({p.lower() for p in lowered}.difference(cache))
        # a mark after a Latin letter or digit is a pre-token of its own, so the word before it is what must be known
        marked = [p for p in new if p[-1:] in _MARKS and p[-2:-1].isalnum() and p[-2] < "\u0180" and p[-2] != _DOTTED]
        new.difference_update(marked)
        new.update({p[:-1] for p in marked}.difference(cache))
        known = list(new)
        cache.update(zip(known, self.whole(known if self.drops_spaces else [p if p[0] == "\n" else " " + p for p in known])))
        for mark in {p[-1] for p in marked}.difference(self.marks):
            self.marks[mark] = self.whole([mark])[0]
        cache.update([(p, cache[p[:-1]] + self.marks[p[-1]]) for p in marked])
        cache.update([(p, cache[p.lower()]) for p in lowered])

    def _careful(self, text: str) -> bytes:
        first, *rest = _CAREFUL.split(text)
        keys = [p[1:] for p in rest]
        self._learn(set(keys))
        parts = [self.cache[k] for k in keys]
        if None in parts:
            return self.whole([text])[0]
        return b"".join([*self.whole([first]), *parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHED_PIECES:
            self.cache.clear()
        if self.drops_spaces:
            cut = [t.replace("\n", " ").split(" ") for t in texts]
        else:
            cut = [("\n" + t).replace("\n", " \n").split(" ")[1:] if t else [] for t in texts]
        self._learn(set().union(*cut))
        found = []
        for text, pieces in zip(texts, cut):
            try:
                data = b"".join(map(self.cache.__getitem__, pieces))
                found.append(data if self.drops_spaces else data[4:])  # without the leading line feed
            except TypeError:
                found.append(self._careful(text))
        return found


@functools.lru_cache(maxsize=2)
def encoder(path: str, drops_spaces: bool) -> Encoder:
    """One encoder by the tokenizers library per Python worker, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def single(texts: list[str]) -> list[bytes]:
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(itertools.chain.from_iterable(found), "<u4").tobytes()
        ends = np.cumsum([4 * len(x) for x in found]).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    mark = tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
    if not drops_spaces or len(mark) != 1:
        return Encoder(single, drops_spaces)

    def whole(texts: list[str]) -> list[bytes]:
        plain = [t for t in texts if _BETWEEN not in t]
        chunks = [plain[a : a + JOINED_PIECES] for a in range(0, len(plain), JOINED_PIECES)]
        joined = tokenizer.encode_batch_fast([f" {_BETWEEN} ".join([*c, ""]) for c in chunks], add_special_tokens=False)
        found: list[bytes] = []
        for chunk, e in zip(chunks, joined):
            ids = np.array(e.ids, "<u4")
            ends = (4 * np.nonzero(ids == mark[0])[0]).tolist()
            data = ids.tobytes()
            cut = [data[a:b] for a, b in zip([0, *(x + 4 for x in ends)], ends)]
            found += cut if len(cut) == len(chunk) else single(chunk)
        if len(plain) == len(texts):
            return found
        rest = iter(single([t for t in texts if _BETWEEN in t]))
        each = iter(found)
        return [next(rest if _BETWEEN in t else each) for t in texts]

    return Encoder(whole, drops_spaces)
