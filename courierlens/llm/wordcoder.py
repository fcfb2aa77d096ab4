"""Ids of whole texts put together from the ids of their parts.

The public byte-level tokenizers cut a text by a pattern and encode each match
separately. No match that holds a visible character goes on past it into white
space, so a text may be cut before any blank that follows a visible character
without changing a match. The parts between blanks repeat a lot, so their ids
are made once, for all new parts of a batch of texts together, and kept.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Callable, Iterable


def to_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()

MARKS = frozenset(".,;:!?")


class WordCoder:
    """``encode_words`` gives the ids of many strings; ``most`` bounds the parts kept in memory."""

    def __init__(self, encode_words: Callable[[list[str]], list[bytes]], most: int = 400_000):
        self.encode_words, self.most = encode_words, most
        self.known: dict[str, bytes] = {}

    def _open(self, part: str) -> bool:
        """Whether the blank after the part may belong to white space that began within it."""
        return not part or part[-1].isspace()

    def parts(self, text: str) -> list[str]:
        """The text cut before blanks that follow a visible character."""
        cut = text.split(" ")
        if not any(map(self._open, cut)):
            return [cut[0], *[" " + p for p in cut[1:]]]
        parts = [cut[0]]
        for previous, part in zip(cut, cut[1:], strict=False):
            if self._open(previous):
                parts[-1] += " " + part
            else:
                parts.append(" " + part)
        return parts

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as bytes; a missing text counts as empty."""
        cut = [self.parts(t) if t else [] for t in texts]
        new = list(set().union(*cut) - self.known.keys())
        if len(self.known) + len(new) > self.most:
            self.known = {}
            new = list(set().union(*cut))
        # one mark after a letter is a match of its own, so "word," needs no ids beyond those of "word" and ","
        stems = {p: p[:-1] for p in new if p[-1] in MARKS and p[-2:-1].isalpha()}
        plain = list({*(stems.get(p, p) for p in new), *{p[-1] for p in stems}} - self.known.keys())
        for start in range(0, len(plain), 50_000):
            some = plain[start : start + 50_000]
            self.known.update(zip(some, self.encode_words(some), strict=True))
        self.known.update({p: self.known[stem] + self.known[p[-1]] for p, stem in stems.items()})
        return [b"".join(map(self.known.__getitem__, parts)) for parts in cut]
