"""Many texts as one byte array, cut into words with numpy."""

from __future__ import annotations

import numpy as np

# Byte classes: what a word is made of does not depend on the caller.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MULT = 0x9E3779B97F4A7C15 | 1
_powers: dict = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        _powers["up"] = np.multiply.accumulate(np.full(size, _MULT, np.uint64))
        _powers["down"] = np.multiply.accumulate(np.full(size, pow(_MULT, -1, 1 << 64), np.uint64))
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (finaliser of a well-known integer hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Block:
    """The words of some texts.

    ``data``: all bytes, ``doc``: text of each word, ``start``/``end``: its
    bytes, ``nth``: its place in its text, ``n_words``: words per text.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray = SPACE):
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.ends = np.cumsum(sizes)            # each text is followed by one space
        self.begins = self.ends - sizes
        self.data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        self.n_docs = len(texts)
        out = separators[self.data]
        out = out.copy()
        out[self.ends - 1] = True
        solid = ~out
        first = solid.copy()
        first[1:] &= out[:-1]
        self.start = np.flatnonzero(first)
        last = solid.copy()
        last[:-1] &= out[1:]
        self.end = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(self.ends, self.start, side="right")
        self.n_words = np.bincount(self.doc, minlength=self.n_docs)
        before = np.cumsum(self.n_words) - self.n_words
        self.nth = np.arange(len(self.start)) - before[self.doc]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word (equal words, equal hashes)."""
        n = len(self.data)
        up, down = _pow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        h = sums[self.end] - sums[self.start]
        return mix(h * down[self.start] + (self.end - self.start).astype(np.uint64))


def grouped(items, size, most: int):
    """Runs of items whose sizes add up to about ``most`` (one item at least)."""
    run, total = [], 0
    for x in items:
        n = size(x)
        if run and total + n > most:
            yield run
            run, total = [], 0
        run.append(x)
        total += n
    if run:
        yield run


def _next(breaks: np.ndarray, at: int) -> int:
    """The first separator from ``at`` on, else the end."""
    return at + int(breaks[at:].argmax()) if breaks[at:].any() else len(breaks)


def located_words(texts: list[bytes], piece: int = 1 << 20, separators: np.ndarray = SPACE):
    """(start, end, hash, words per text) of texts laid out with one space after
    each, whatever their length: a long text is hashed in pieces of about
    ``piece`` bytes, so that only the three word arrays grow with it."""
    if len(texts) != 1 or len(texts[0]) <= piece:
        b = Block(texts, separators)
        return b.start, b.end, b.hashes(), b.n_words
    parts, at, text = [], 0, texts[0]
    breaks = separators[np.frombuffer(text, np.uint8)]
    while at < len(text):
        # a piece ends before a separator, or with the text
        near = breaks[at + piece:at + 2 * piece]
        end = at + piece + int(near.argmax()) if near.any() else _next(breaks, at + 2 * piece)
        b = Block([text[at:end]], separators)
        parts.append((b.start + at, b.end + at, b.hashes()))
        at = end
    start, end, h = (np.concatenate(c) for c in zip(*parts))
    return start, end, h, np.array([len(h)])
