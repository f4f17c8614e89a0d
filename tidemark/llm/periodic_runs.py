"""Runs of periodically repeated words in a document, by seeds on diagonals.

A *run* is a stretch of consecutive words with smallest period ``q`` and at
least ``max(MIN_WORDS, MIN_EXPONENT * q)`` words that neither neighbour extends.
Its words match the words ``q`` further on along one diagonal (lag ``q``), over
at least ``max(24 - q, 2q)`` positions: the guaranteed overlap.  Lags are taken
in octaves, ``q < 16`` and then ``[k/2, k)`` for k = 32, 64, ...; within an octave
the overlap is at least ``k`` (16 for the first), so every run contains ``k``-grams
that occur again at its lag.

1. The ``k``-grams of a document are indexed (sorted by fingerprint and place).
2. *Seeds* are occurrence pairs.  The next occurrence of a ``k``-gram is enough:
   if a gram inside a run of period ``q < k`` came again at ``d < q``, it would
   have the periods ``min(d, q - d)`` and ``max(d, q - d)``, whose sum ``q`` is
   less than ``k``; by Fine and Wilf their divisor were a period of the run.
   So an index of ``n`` grams gives at most ``n`` seeds, never all pairs.
3. Seeds are taken by lag and place.  A table of the furthest covered place per
   document and lag skips those on a diagonal that is extended already; seeds
   that follow one another on a diagonal are skipped in bulk.
4. What is left is extended to both sides, word by word in doubling steps.
   A stretch found at the lag of a next occurrence has no smaller period.

Octaves end at a third of the document's words, so the work is
``O(n log n)`` words and linear memory for a text of any length; texts are
handled in segments of about 2 MB, a longer text alone.  Words are compared by
64-bit fingerprints.  Null text: no words, no runs; null ids, repeated rows and
extra columns are kept as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.words import ngram_hashes, segments, span_hashes, within, word_spans

MIN_WORDS = 24
MIN_EXPONENT = 3
FIRST_GRAM = 16
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _seeds(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the next occurrence of every ``k``-gram within its text, for lags of the octave of ``k``."""
    grams = ngram_hashes(h, k)
    at = np.flatnonzero(within(first, k))
    if len(at) < 2:
        return at[:0], at[:0]
    order = at[np.argsort(grams[at], kind="stable")]
    lag = order[1:] - order[:-1]
    same = (grams[order[1:]] == grams[order[:-1]]) & (lag < k) & (lag >= (1 if k == FIRST_GRAM else k // 2))
    place, lag = order[:-1][same], lag[same]
    # lags below k keep both grams in reach; a pair must lie in one text
    text = np.searchsorted(first, place, side="right")
    same = place + lag < first[text]
    return place[same], lag[same]


def _extent(h: np.ndarray, place: int, lag: int, lo: int, hi: int) -> tuple[int, int]:
    """First and end place of the matches ``h[i] == h[i + lag]`` around ``place``, within the text ``[lo, hi)``."""
    step, right = 32, place
    while right < hi - lag:
        end = min(right + step, hi - lag)
        miss = np.flatnonzero(h[right:end] != h[right + lag:end + lag])
        if len(miss):
            right += int(miss[0])
            break
        right, step = end, 2 * step
    step, left = 32, place
    while left > lo:
        begin = max(left - step, lo)
        miss = np.flatnonzero(h[begin:left] != h[begin + lag:left + lag])
        if len(miss):
            left = begin + int(miss[-1]) + 1
            break
        left, step = begin, 2 * step
    return left, right


def find_runs(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs; ``h`` holds the words of texts that ``first`` delimits.

    Ordered by text, start and period; starts count from the text's first word.
    """
    found, k = [], FIRST_GRAM
    sizes = np.diff(first)
    least = MIN_WORDS  # words of a text that can hold a run of this octave
    while len(sizes) and sizes.max() >= least:
        keep = sizes >= least
        if keep.all():
            words, bounds, where = h, first, None
        else:  # only the texts that are long enough
            where = np.flatnonzero(np.repeat(keep, sizes))
            words, bounds = h[where], np.concatenate([[0], np.cumsum(np.where(keep, sizes, 0))])
        place, lag = _seeds(words, bounds, k)
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (place[1:] != place[:-1] + 1) | (lag[1:] != lag[:-1])
        furthest: dict[tuple[int, int], int] = {}
        for i, q in zip(place[fresh].tolist(), lag[fresh].tolist()):
            text = int(np.searchsorted(bounds, i, side="right")) - 1
            if i < furthest.get((text, q), -1):
                continue
            left, right = _extent(words, i, q, int(bounds[text]), int(bounds[text + 1]))
            furthest[text, q] = right
            length = right - left + q
            if length >= max(MIN_WORDS, MIN_EXPONENT * q):
                found.append((text, left - int(bounds[text]), length, q))
        k *= 2
        least = MIN_EXPONENT * (k // 2)
    return np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)


def covered_words(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True for words that some run contains after its first period."""
    d = np.zeros(int(first[-1]) + 1, np.int64)
    at = first[runs[:, 0]] + runs[:, 1]
    np.add.at(d, at + runs[:, 3], 1)
    np.add.at(d, at + runs[:, 2], -1)
    return np.cumsum(d)[:-1] > 0


def planted_repeats(ids: list, first: np.ndarray) -> np.ndarray | None:
    """For every word the place it is taken from: rows whose id's checksum ends in 0 get a periodic tail (None: no such row).

    With h = crc32(decimal id) and g = h // 10, if h % 10 = 0 the words from a = g % n on repeat
    the p = 1 + (n - a) // (3 + g % 8) words from a.
    """
    take = None
    for row, key in enumerate(ids):
        n = int(first[row + 1] - first[row])
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        if h % 10 or not n:
            continue
        if take is None:
            take = np.arange(int(first[-1]))
        g, lo = h // 10, int(first[row])
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        take[lo + a:lo + n] = lo + a + np.arange(n - a) % p
    return take


def _join(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, block: int = 1 << 17) -> pa.Array:
    """Texts of the given words, joined by one space; ``first`` delimits the words of each text."""
    raw = bytearray()
    for i in range(0, len(starts), block):
        s, size = starts[i:i + block], ends[i:i + block] - starts[i:i + block] + 1
        end = np.cumsum(size)
        # byte j of the block comes from starts[word] + (j - first byte of the word); a word's last byte is the space
        src = np.arange(int(end[-1])) + np.repeat(s - (end - size), size)
        src[end - 1] = 0
        part = data[src]
        part[end - 1] = 0x20
        raw += part.tobytes()
    place = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts + 1, out=place[1:])
    lo = place[first[:-1]]
    hi = np.maximum(place[first[1:]] - 1, lo)  # without the last space
    return pa.array([raw[p:q].decode("utf-8") for p, q in zip(lo.tolist(), hi.tolist())], pa.string())


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` is the text without the words that a run repeats: its words
    after the run's first period, joined by one space.  ``plant`` rewrites rows
    by :func:`planted_repeats` first.  No shuffle.
    """
    src = docs.select(docs[id_col], docs[text_col])
    id_type = src.schema[id_col].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for a, b, data, off in segments(batch.column(1)):
                starts, ends, first = word_spans(data, off)
                ids = batch.column(0).slice(a, b - a)
                take = planted_repeats(ids.to_pylist(), first) if plant else None
                h = span_hashes(data, starts, ends)
                if take is not None:
                    starts, ends, h = starts[take], ends[take], h[take]
                runs = find_runs(h, first)
                keep = ~covered_words(runs, first)
                kept_first = np.zeros(len(keep) + 1, np.int64)
                np.cumsum(keep, out=kept_first[1:])
                per_row = np.searchsorted(runs[:, 0], np.arange(b - a + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(per_row), pa.StructArray.from_arrays(
                    [pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(run_type)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(first).astype(np.int64)), lists, _join(data, starts[keep], ends[keep], kept_first[first])],
                    names=[id_col, "n_words", "runs", "collapsed"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, n_words long, runs array<{RUN}>, collapsed string")
