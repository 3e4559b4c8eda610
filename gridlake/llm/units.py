"""A bounded cache of encoded text units (words with their leading space, say).

A tokenizer whose merges never cross the start of a unit gives a unit the same ids wherever it
stands. So each distinct unit is encoded once per worker and texts are put together from rows of
a table, in numpy.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa


_KEPT: dict = {}


def kept(key, make: Callable):
    """What ``make`` builds, once in a worker process for as long as tasks ask for the same ``key``:
    a tokenizer with its table of units outlives the task that filled it."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Lets go of what an operator before kept in this worker process. A tokenizer and its table of
    units refer to each other, so they are collected here; else they stay until Python happens to."""
    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


class UnitCache:
    """``encode`` maps a list of units to (the units in any order, ids of all of them in a row,
    number of ids of each, a small number to keep with each).

    Before it would hold over ``limit`` units the table drops those looked up least, which bounds
    the memory of a worker and changes no result."""

    def __init__(self, encode: Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray, np.ndarray]], limit: int = 400_000, kind=np.int32):
        self.encode, self.limit, self.kind = encode, limit, kind
        self.row: dict[str, int] = {}
        self.sizes, self.hits, self.marks = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8)
        self.ids, self.starts = np.zeros(0, kind), np.zeros(0, np.int64)

    def _shrink(self) -> None:
        keep = np.sort(np.argsort(-self.hits, kind="stable")[: self.limit // 2])
        names = list(self.row)
        self.row = {names[k]: i for i, k in enumerate(keep.tolist())}
        self.ids, self.sizes = self.flat(keep)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.hits, self.marks = self.hits[keep], self.marks[keep]

    def rows(self, units: list[str], times: np.ndarray | None = None) -> np.ndarray:
        """Row of the table for each unit; the rows stay valid until the next call. ``times``: how often
        each unit stands in the texts, once if not given."""
        out = self._look(units)
        absent = np.flatnonzero(out < 0)
        if len(absent):
            fresh = {units[i] for i in absent.tolist()}
            if self.row and len(self.row) + len(fresh) > self.limit:
                self._shrink()
                out = self._look(units)
                absent = np.flatnonzero(out < 0)
                fresh = {units[i] for i in absent.tolist()}
            new, ids, sizes, marks = self.encode(list(fresh))
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
            self.ids = np.append(self.ids, ids.astype(self.kind))
            self.sizes = np.append(self.sizes, sizes)
            self.hits = np.append(self.hits, np.zeros(len(new), np.int64))
            self.marks = np.append(self.marks, marks.astype(np.int8))
            out[absent] = self._look([units[i] for i in absent.tolist()])
        self.hits += np.bincount(out, times, len(self.hits)).astype(np.int64)
        return out

    def _look(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.row.get, units, repeat(-1)), np.int64, len(units))

    def flat(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows one after the other, and the number of ids of each row."""
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[rows] - (ends - sizes), sizes)
        return self.ids[at], sizes
