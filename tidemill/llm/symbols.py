"""Texts as runs of 64 symbols, and their n-gram codes, inside Arrow functions."""

from __future__ import annotations

import numpy as np

SYMBOLS = 64
ORDER = 4


def _fold() -> np.ndarray:
    """Symbol of each byte that ends a character: letters a-z by themselves, A-Z as one, digits as one, white space and
    controls as one, ``.``, ``,`` and all other ASCII marks; characters beyond ASCII by the low five bits of their code."""
    table = np.full(256, 31, dtype=np.int32)
    table[:33] = 0
    table[127] = 0
    table[97:123] = np.arange(1, 27)
    table[65:91] = 27
    table[48:58] = 28
    table[46], table[44] = 29, 30
    table[128:] = 32 + (np.arange(128, 256) & 31)
    return table


_FOLD = _fold()


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all characters, and each row's first (one more at the end)."""
    ends = np.ones(len(data), dtype=bool)
    ends[:-1] = (data[1:] & 0xC0) != 0x80
    places = np.flatnonzero(ends)
    return _FOLD[data[places]], np.searchsorted(places, offsets)


def codes(found: np.ndarray, firsts: np.ndarray, order: int = ORDER, base: int = SYMBOLS) -> np.ndarray:
    """The code of the ``order`` symbols that end at each place; before a text stand symbols 0."""
    out = found.astype(np.int32)
    for k in range(1, order):
        before = np.zeros(len(found), dtype=np.int32)
        before[k:] = found[:-k] if k < len(found) else 0
        for j in range(k):
            heads = firsts[:-1] + j
            before[heads[heads < firsts[1:]]] = 0
        out += before * base**k
    return out


def row_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of the values of each row."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[firsts[1:]] - sums[firsts[:-1]]
