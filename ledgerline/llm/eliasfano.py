"""Elias-Fano coded sequences and the two-level trie built from them.

A sequence of n ascending numbers below u is kept as the low bytes of each
number and a bitmap that counts, in unary, how many numbers share each high
part: about 2 + log2(u / n) bits a number (low parts are whole bytes here).
Everything is read in place from one buffer, a memory map of a file or the
binary value of a row alike; ``successor`` looks only at the numbers that
share the high part of what is sought.
"""

from __future__ import annotations

import numpy as np

HEAD = 4  # 64-bit numbers before the parts


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def encode(values: np.ndarray) -> bytes:
    """Ascending uint64 numbers (repeats allowed)."""
    values = values.astype(np.uint64, copy=False)
    n = len(values)
    spare = int(values[-1]).bit_length() - n.bit_length() if n else 0
    k = min(7, max(0, (spare + 4) // 8))
    low = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :k])
    high = (values >> np.uint64(8 * k)).astype(np.int64)
    bits = np.zeros(int(high[-1]) + n + 1 if n else 0, np.uint8)
    bits[high + np.arange(n)] = 1
    unary = _padded(np.packbits(bits, bitorder="little").tobytes())
    head = np.array([n, k, len(unary), int(high[-1]) + 1 if n else 0], "<i8").tobytes()
    return head + unary + _padded(low.tobytes())


class Sequence:
    """An encoded sequence, read in place from ``buffer`` at ``at``; ``end`` is where the next part starts."""

    def __init__(self, buffer, at: int = 0):
        n, k, unary, highs = np.frombuffer(buffer, "<i8", HEAD, at).tolist()
        self.n, self.k, self.highs = n, k, highs
        at += 8 * HEAD
        self.unary = np.frombuffer(buffer, np.uint8, unary, at)
        at += unary
        self.low = np.frombuffer(buffer, np.uint8, n * k, at).reshape(n, k)
        self.end = at + n * k + -(n * k) % 8
        self._starts: np.ndarray | None = None

    def _high(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.unary, bitorder="little")) - np.arange(self.n)

    def _lows(self, at: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(at), 8), np.uint8)
        wide[:, :self.k] = self.low[at]
        return wide.view("<u8").ravel()

    def all(self) -> np.ndarray:
        """The numbers, decoded."""
        return (self._high().astype(np.uint64) << np.uint64(8 * self.k)) + self._lows(np.arange(self.n))

    @property
    def starts(self) -> np.ndarray:
        """Directory of the unary part: how many numbers have a smaller high part."""
        if self._starts is None:
            self._starts = np.concatenate([[0], np.cumsum(np.bincount(self._high(), minlength=self.highs))]).astype(np.int64)
        return self._starts

    def get(self, at: np.ndarray) -> np.ndarray:
        high = np.searchsorted(self.starts, at, "right") - 1
        return (high.astype(np.uint64) << np.uint64(8 * self.k)) + self._lows(at)

    def successor(self, wanted: np.ndarray, low: np.ndarray | int = 0, high: np.ndarray | int | None = None) -> np.ndarray:
        """Place of the first number >= each of ``wanted`` among places low to high (high if there is none)."""
        wanted = wanted.astype(np.uint64, copy=False)
        part = wanted >> np.uint64(8 * self.k)
        beyond = part >= np.uint64(self.highs)
        part = np.minimum(part, np.uint64(max(0, self.highs - 1))).astype(np.int64)
        stop = np.full(len(wanted), self.n) if high is None else np.broadcast_to(high, len(wanted)).copy()
        if not self.n:
            return stop
        at = np.maximum(np.where(beyond, self.n, self.starts[part]), low)
        end = np.minimum(np.where(beyond, self.n, self.starts[part + 1]), stop)
        sought = wanted & np.uint64((1 << 8 * self.k) - 1)
        at, end = np.minimum(at, stop), np.maximum(end, at)
        last = end.copy()
        left = np.flatnonzero(at < last)
        while len(left):
            mid = (at[left] + last[left]) >> 1
            less = self._lows(mid) < sought[left]
            at[left[less]] = mid[less] + 1
            last[left[~less]] = mid[~less]
            left = left[at[left] < last[left]]
        return np.minimum(at, stop)

    def find(self, wanted: np.ndarray, low: np.ndarray | int = 0, high: np.ndarray | int | None = None) -> np.ndarray:
        """Place of each of ``wanted`` among places low to high, -1 if it is not there."""
        at = self.successor(wanted, low, high)
        stop = np.full(len(wanted), self.n) if high is None else high
        ok = at < stop
        out = np.full(len(wanted), -1)
        out[ok] = np.where(self.get(at[ok]) == wanted[ok], at[ok], -1)
        return out


def build_trie(words: np.ndarray, counts: np.ndarray, word_of: np.ndarray, context: np.ndarray, code: np.ndarray) -> bytes:
    """A trie as one buffer.

    ``words``: ascending numbers, ``counts`` one for each.  Under a word are
    its contexts: ``word_of`` (place of the word, ascending), ``context``
    (ascending within a word) and the quantised value ``code`` of each.  A
    level holds each context relative to its word -- the word's place before
    the context's bits -- so the whole level ascends, and pointers tell where
    the contexts of each word begin.
    """
    pointers = np.searchsorted(word_of, np.arange(len(words) + 1))
    shift = context_bits(len(words))
    relative = (word_of.astype(np.uint64) << np.uint64(shift)) + (context >> np.uint64(64 - shift))
    return b"".join([encode(words), encode(pointers.astype(np.uint64)), encode(relative),
                     counts.astype("<i8").tobytes(), _padded(code.astype("<u2").tobytes())])


def context_bits(n_words: int) -> int:
    return 64 - max(1, n_words.bit_length())


class Trie:
    """A trie read in place from a buffer."""

    def __init__(self, buffer):
        self.words = Sequence(buffer)
        self.pointers = Sequence(buffer, self.words.end)
        self.contexts = Sequence(buffer, self.pointers.end)
        at = self.contexts.end
        self.counts = np.frombuffer(buffer, "<i8", self.words.n, at)
        self.codes = np.frombuffer(buffer, "<u2", self.contexts.n, at + 8 * self.words.n)
        self.shift = context_bits(self.words.n)

    def word(self, words: np.ndarray) -> np.ndarray:
        """The place of each word, -1 if it is not known."""
        return self.words.find(words)

    def code(self, place: np.ndarray, context: np.ndarray) -> np.ndarray:
        """The code of each context under the word at ``place``, -1 if there is none."""
        out = np.full(len(place), -1)
        known = np.flatnonzero(place >= 0)
        at = place[known]
        begin, end = (self.pointers.get(at + d).astype(np.int64) for d in (0, 1))
        relative = (at.astype(np.uint64) << np.uint64(self.shift)) + (context[known] >> np.uint64(64 - self.shift))
        found = self.contexts.find(relative, begin, end)
        out[known[found >= 0]] = self.codes[found[found >= 0]]
        return out
