"""All ways to cut words into pieces of a vocabulary, for many words at once in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
TINY, LOG_TINY = 1e-200, np.log(1e-200)


class Lattice:
    """Finds every piece at every place. ``pieces`` maps strings to numbers."""

    def __init__(self, pieces: dict[str, int], unknown: int | None = None):
        """``unknown``: number given to a character that is no piece by itself."""
        self.longest = max(map(len, pieces), default=1)
        self.unknown = unknown
        names = list(pieces)
        codes, sizes, _ = self._codes(names)
        keys = np.zeros(len(names), np.uint64)
        for j in range(self.longest):
            on = sizes > j
            at = (np.cumsum(sizes) - sizes)[on] + j
            keys[on] = keys[on] * BASE + self._mix(codes[at])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.numbers = np.array([pieces[n] for n in names], np.int64)[order]
        self.sizes = sizes[order]
        self.known = np.zeros(1 << 20, bool)
        self.known[self.keys >> np.uint64(44)] = True

    @staticmethod
    def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        return codes, sizes, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)

    @staticmethod
    def _mix(codes: np.ndarray) -> np.ndarray:
        v = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return v ^ (v >> np.uint64(31))

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(size of each word; word, end, length, number of each piece found), sorted by end, then
        length, then word."""
        codes, sizes, inside = self._codes(words)
        own = np.repeat(np.arange(len(words)), sizes)
        mixed = self._mix(codes)
        found = []
        at, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        for length in range(1, self.longest + 1):
            # h: hash of the ``length`` characters that end at ``at``.
            on = inside[at] >= length - 1
            at = at[on]
            if not len(at):
                break
            if length == 1:
                h = mixed
            else:
                h = mixed[at - length + 1] * np.uint64(pow(int(BASE), length - 1, 1 << 64)) + h[on]
            maybe = np.flatnonzero(self.known[h >> np.uint64(44)])
            k = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
            hit = (self.keys[k] == h[maybe]) & (self.sizes[k] == length)
            number = self.numbers[k[hit]]
            place = at[maybe[hit]]
            if length == 1 and self.unknown is not None:
                bare = np.ones(len(at), bool)
                bare[place] = False
                bare = np.flatnonzero(bare)
                number = np.append(number, np.full(len(bare), self.unknown))
                place = np.append(place, bare)
            found.append((own[place], inside[place] + 1, np.full(len(place), length), number))
        word, end, length, number = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
        order = np.lexsort((word, length, end))
        return sizes, word[order], end[order], length[order], number[order]


def steps(end: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, int, slice]]:
    """Runs of edges with the same end and length: each word appears in a run once at most."""
    if len(end):
        cut = np.flatnonzero(np.append(True, (end[1:] != end[:-1]) | (length[1:] != length[:-1])))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(end)]):
            yield int(end[a]), int(length[a]), slice(a, b)


def forward(edges, weight: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all ways to cut the first i characters, for each word and column of ``weight``
    (one row for each piece), as (scaled sums, logarithm of each word's final sum). When the sums
    of a word become tiny its last columns are scaled up; the logarithm takes that back."""
    sizes, word, end, length, number = edges
    n, width = len(sizes), weight.shape[1]
    sums = np.zeros((n, int(sizes.max(initial=0)) + 1, width))
    sums[:, 0] = 1
    shift = np.zeros((n, width))
    at = 0
    for i, size, run in steps(end, length):
        if i != at:
            if at > 16:
                _rescale(sums, shift, at, longest)
            at = i
        u = word[run]
        sums[u, i] += sums[u, i - size] * weight[number[run]]
    return sums, np.log(np.maximum(sums[np.arange(n), sizes], 1e-300)) + shift


def _rescale(sums: np.ndarray, shift: np.ndarray, at: int, longest: int) -> None:
    u, k = np.nonzero((sums[:, at] < TINY) & (sums[:, at] > 0))
    if len(u):
        for j in range(max(0, at - longest), at + 1):
            sums[u, j, k] /= TINY
        shift[u, k] += LOG_TINY


def expected(edges, weight: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece, given words and how often they occur.

    Each place of a word keeps its sum as 1 and a logarithm of its own, so that words of any length
    count in full; going back the same logarithms are taken out again."""
    sizes, word, end, length, number = edges
    n, last = len(sizes), int(sizes.max(initial=0))
    ahead, logs = np.zeros((n, last + 1)), np.zeros((n, last + 1))
    ahead[:, 0] = 1
    runs = list(steps(end, length))

    def settle(upto: int, at: int) -> int:
        while at < upto:
            on = ahead[:, at] > 0
            logs[on, at] += np.log(ahead[on, at])
            ahead[on, at] = 1
            at += 1
            logs[:, at] = logs[:, at - 1]
        return at

    at = 0
    for i, size, run in runs:
        at = settle(i, at)
        u = word[run]
        ahead[u, i] += ahead[u, i - size] * weight[number[run]] * np.exp(logs[u, i - size] - logs[u, i])
    at = settle(last, at)
    on = ahead[:, last] > 0
    logs[on, last] += np.log(ahead[on, last])
    ahead[on, last] = 1
    # ``back`` is the share of all ways that pass a place.
    back = np.zeros_like(ahead)
    back[np.arange(n), sizes] = ahead[np.arange(n), sizes]
    out = np.zeros(len(weight))
    for i, size, run in reversed(runs):
        u, p = word[run], number[run]
        share = back[u, i] * weight[p] * np.exp(logs[u, i - size] - logs[u, i])
        out += np.bincount(p, count[u] * ahead[u, i - size] * share, len(weight))
        back[u, i - size] += share
    return out


def by_size(words: list[str], most: int = 400_000) -> Iterator[np.ndarray]:
    """Indices of words of like size, so that a block of sums stays small."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi - lo + 1) * (sizes[order[hi]] + 1) <= most:
            hi += 1
        yield order[lo:hi]
        lo = hi
