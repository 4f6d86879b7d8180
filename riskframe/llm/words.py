"""Cutting texts at blanks where no byte-level BPE piece can run across, and ids of the cut parts kept by task worker.

The public byte-level pattern never matches across a blank that stands between two characters that aren't white space:
a piece holds a blank only as its first character or within a run of white space. So a text can be cut before every such
blank and its parts encoded one by one; equal parts have equal ids. Parts repeat far more often than texts, and each
Python worker keeps the ids of those that it has met, up to a fixed number (then it starts afresh).
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable

import regex

BLANK = re.compile(r"(?<=\S) (?=\S)")

#: Parts and pieces kept by one worker.
PARTS, PIECES = 600_000, 500_000
_PLAIN_END = frozenset(",.;:!?")


class PartCoder:
    """Ids of texts as little-endian unsigned 32-bit integers. ``encode`` maps a list of pieces (str) to their ids."""

    def __init__(self, pattern: str, encode: Callable[[list[str]], list[bytes]], parts: int = PARTS, pieces: int = PIECES):
        self.find = regex.compile(pattern).findall
        self.encode, self.max_parts, self.max_pieces = encode, parts, pieces
        self.pieces: dict[str, bytes] = {}
        self.first: dict[str, bytes | None] = {}
        self.later: dict[str, bytes | None] = {}

    def forget(self) -> None:
        """Drops what is kept, so that a worker holds nothing of a task that has ended."""
        self.pieces, self.first, self.later = {}, {}, {}

    def learn(self, first: set[str], later: set[str]) -> None:
        """Ids of parts not met before; None for a part that starts or ends in white space (the cut isn't safe there)."""
        if len(self.first) + len(self.later) > self.max_parts:
            self.first, self.later = {}, {}
        for known, parts, lead in ((self.first, first, ""), (self.later, later, " ")):
            letters, stopped, others, new = [], [], [], set(_PLAIN_END)
            for p in parts:
                if p in known:
                    continue
                if p.isalpha():
                    letters.append(p)
                    new.add(lead + p)
                elif p[-1:] in _PLAIN_END and p[:-1].isalpha():
                    stopped.append(p)
                    new.add(lead + p[:-1])
                elif (not p and lead) or p[:1].isspace() or p[-1:].isspace():
                    known[p] = None
                else:
                    others.append((p, self.find(lead + p)))
                    new.update(others[-1][1])
            kept = self.ids_of(new)
            known.update([(p, kept[lead + p]) for p in letters])
            known.update([(p, kept[lead + p[:-1]] + kept[p[-1]]) for p in stopped])
            known.update([(p, b"".join([kept[x] for x in got])) for p, got in others])

    def ids_of(self, new: set[str]) -> dict[str, bytes]:
        """The ids of these pieces, and of others."""
        if len(self.pieces) + len(new) > self.max_pieces:
            self.pieces = {}
        todo = [p for p in new if p not in self.pieces]
        self.pieces.update(zip(todo, self.encode(todo)))
        return self.pieces

    def __call__(self, texts: list[str]) -> list[bytes]:
        gc.disable()  # half a million small objects, none in a cycle
        try:
            return self.coded(texts)
        finally:
            gc.enable()

    def coded(self, texts: list[str]) -> list[bytes]:
        split = [t.split(" ") for t in texts]
        later: set[str] = set()
        for s in split:
            later.update(s[1:])
        self.learn({s[0] for s in split}, later)
        out: list[bytes | None] = []
        odd: list[int] = []
        for i, s in enumerate(split):
            try:
                out.append(self.first[s[0]] + b"".join(map(self.later.__getitem__, s[1:])))
            except TypeError:  # None: white space beside a blank
                out.append(None)
                odd.append(i)
        for i in odd:  # cut where it is safe only; the parts are a few, longer ones
            parts = BLANK.split(texts[i])
            got = [x for n, p in enumerate(parts) for x in self.find(" " + p if n else p)]
            kept = self.ids_of(set(got))
            out[i] = b"".join([kept[x] for x in got])
        return out  # type: ignore[return-value]


def slices(texts: list[str], chars: int = 4_000_000):
    """(start, end) of runs of texts of about ``chars`` characters at most; a longer text is a run of its own."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)
