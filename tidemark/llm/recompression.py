"""Locally consistent parsing of word sequences by recompression.

Rounds alternate between naming maximal runs of one symbol and naming pairs:
in a pair round every symbol falls left or right by a bit of its name, and
each left symbol followed by a right one becomes a pair.  Names are
fingerprints of what they stand for (run: symbol and length; pair: both
symbols), so the whole corpus agrees on them without a shared dictionary, and
equal word sequences are parsed alike except near their ends.

How near is tracked exactly: every symbol carries the range of words that its
existence *depends* on.  If that range lies within a stretch of words that
also occurs elsewhere, the same symbol occurs there too, at the same offset.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.llm.words import U64, mix

ROUNDS = 6
FINE_ROUNDS = 3
RUN_ROUNDS = (0, 4)
#: no pair stands for more words than this; runs that do share one name
MAX_WEIGHT = 24


@dataclass
class Parse:
    """Symbols of a run of texts: name, words [a, b), dependence range [dl, dr); ``first`` delimits the texts."""

    name: np.ndarray
    a: np.ndarray
    b: np.ndarray
    dl: np.ndarray
    dr: np.ndarray
    first: np.ndarray


def parse(h: np.ndarray, first: np.ndarray, rounds: int = ROUNDS, fine: int = FINE_ROUNDS) -> tuple[Parse, Parse]:
    """The parses after ``rounds`` and after ``fine`` rounds of words with fingerprints ``h``.

    Text ends count as lying outside every stretch.
    """
    n = len(h)
    a = np.arange(n)
    p = early = Parse(h.copy(), a, a + 1, a.copy(), a + 1, np.asarray(first))
    for r in range(rounds):
        if r in RUN_ROUNDS:
            p = _runs(p, r, MAX_WEIGHT)
        p = _pairs(p, r, MAX_WEIGHT)
        if r + 1 == fine:
            early = p
    return p, early


def _neighbours(p: Parse):
    """(text of each symbol, is first of its text, is last, left dependence of the one before, right of the one after)."""
    n = len(p.name)
    is_first, is_last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    is_first[p.first[:-1]] = True
    is_last[p.first[1:] - 1] = True
    is_first, is_last = is_first[:n], is_last[:n]
    before, after = np.empty(n, np.int64), np.empty(n, np.int64)
    before[1:] = p.dl[:-1]
    after[:-1] = p.dr[1:]
    before[is_first] = p.a[is_first] - 1
    after[is_last] = p.b[is_last] + 1
    return is_first, is_last, before, after


def _keep(p: Parse, start: np.ndarray) -> np.ndarray:
    """New text limits when only the symbols marked in ``start`` remain."""
    c = np.zeros(len(start) + 1, np.int64)
    np.cumsum(start, out=c[1:])
    return c[p.first]


def _runs(p: Parse, r: int, max_weight: int) -> Parse:
    n = len(p.name)
    if not n:
        return p
    is_first, _, before, after = _neighbours(p)
    start = np.ones(n, bool)
    start[1:] = p.name[1:] != p.name[:-1]
    start |= is_first
    s = np.flatnonzero(start)
    e = np.append(s[1:], n) - 1
    k = e - s + 1
    weight = p.b[e] - p.a[s]
    count = np.where(weight > max_weight, 0, k).astype(U64)
    run = mix(p.name[s] + U64(0x632BE59BD9B4E019) * (count + U64(2 * r + 1)))
    return Parse(np.where(k > 1, run, p.name[s]), p.a[s], p.b[e], before[s], after[e], _keep(p, start))


def _pairs(p: Parse, r: int, max_weight: int) -> Parse:
    n = len(p.name)
    if not n:
        return p
    is_first, is_last, before, after = _neighbours(p)
    right = (mix(p.name ^ U64(0x9E3779B97F4A7C15 * (r + 1) & (2**64 - 1))) >> U64(63)).astype(bool)
    merge = np.zeros(n, bool)
    merge[:-1] = ~right[:-1] & right[1:] & ~is_last[:-1] & (p.b[1:] - p.a[:-1] <= max_weight)
    second = np.zeros(n, bool)
    second[1:] = merge[:-1]
    dl = np.where(right, before, p.dl)
    dr = np.where(right, p.dr, after)
    name, b = p.name.copy(), p.b.copy()
    m = np.flatnonzero(merge)
    name[m] = mix(p.name[m] * U64(0x2545F4914F6CDD1D) + p.name[m + 1] + U64(r + 1))
    b[m] = p.b[m + 1]
    dl[m] = p.dl[m]
    dr[m] = p.dr[m + 1]
    keep = ~second
    return Parse(name[keep], p.a[keep], b[keep], dl[keep], dr[keep], _keep(p, keep))


def interior(p: Parse, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols [i, j) that depend on nothing outside the ``window`` words from each start."""
    dl, dr = np.maximum.accumulate(p.dl), np.maximum.accumulate(p.dr)
    i = np.searchsorted(dl, starts, side="left")
    j = np.searchsorted(dr, starts + window, side="right")
    return i, np.maximum(i, j)
