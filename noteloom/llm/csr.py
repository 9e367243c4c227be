"""Sparse matrices in compressed rows, and their product row by row."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Csr:
    """Row i has the columns ``columns[starts[i]:starts[i+1]]`` with the same places of ``values``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.sizes())

    def transposed(self) -> "Csr":
        order = np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        return Csr(_starts(counts), self.row_of_entry()[order], self.values[order], self.rows)

    def dense(self) -> np.ndarray:
        found = np.zeros((self.rows, self.width), dtype=np.int64)
        np.add.at(found, (self.row_of_entry(), self.columns), self.values)
        return found


def _starts(sizes: np.ndarray) -> np.ndarray:
    starts = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=starts[1:])
    return starts


def incidence(low: np.ndarray, high: np.ndarray, width: int) -> Csr:
    """Row i has a one in each of the columns from low[i] up to, but without, high[i]."""
    sizes = np.maximum(high - low, 0)
    starts = _starts(sizes)
    columns = np.arange(starts[-1]) - np.repeat(starts[:-1] - low, sizes)
    return Csr(starts, columns, np.ones(len(columns), dtype=np.int64), width)


def memberships(group: np.ndarray, groups: int) -> Csr:
    """Row i has a one in column group[i]."""
    n = len(group)
    return Csr(np.arange(n + 1), group.astype(np.int64), np.ones(n, dtype=np.int64), groups)


def product(left: Csr, right: Csr) -> Csr:
    """left times right by Gustavson's rule: a row of the result is the sum of the rows of ``right``
    that the row's entries in ``left`` name, each times the entry's value.

    All rows go through together: the named rows are laid end to end, and what falls on the same
    column of the same row is summed up.
    """
    taken = right.sizes()[left.columns]
    starts = _starts(taken)
    place = np.arange(starts[-1]) - np.repeat(starts[:-1] - right.starts[left.columns], taken)
    row = np.repeat(left.row_of_entry(), taken)
    key = row * max(right.width, 1) + right.columns[place]
    value = np.repeat(left.values, taken) * right.values[place]
    if len(key) and (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    summed = np.add.reduceat(value, first) if len(first) else value[:0]
    key = key[first]
    sizes = np.bincount(key // max(right.width, 1), minlength=left.rows) if len(key) else np.zeros(left.rows, dtype=np.int64)
    return Csr(_starts(sizes), key % max(right.width, 1), summed, right.width)
