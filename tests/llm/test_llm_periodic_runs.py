"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic_runs as PR
from tidemark.llm import queries as LQ

from llm_fixtures import make_docs, shipped  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    """(start, length, period) of every run, from all periods and all places."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def rewritten(key, w):
    h, n = zlib.crc32(str(key).encode()), len(w)
    if h % 10 or not n:
        return list(w)
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]


def expected_row(key, text, plant=True):
    w = WORD.findall(text or "")
    w = rewritten(key, w) if plant and key is not None else w
    runs = brute_runs(w)
    lost = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in lost)))


def generated(rng):
    """Words with runs of many periods, powers of powers, near runs and noise."""
    w, size = [], rng.randrange(1, 500)
    while len(w) < size:
        if rng.random() < 0.5:
            w += [f"w{rng.randrange(rng.choice([2, 3, 40]))}" for _ in range(rng.randrange(1, 30))]
        else:
            p = [f"w{rng.randrange(rng.choice([1, 2, 4]))}" for _ in range(rng.randrange(1, 70))]
            if rng.random() < 0.3:
                p = p + p[:len(p) // 2] + p
            w += (p * 9)[:rng.randrange(1, 6 * len(p) + 1)]
    return w


@pytest.mark.parametrize("seed", range(12))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    texts = [generated(rng) for _ in range(6)] + [[]]
    h = np.array([int(x[1:]) + 1 for t in texts for x in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = [tuple(r) for r in PR.find_runs(h, first).tolist()]
    assert got == [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t)]


def test_seeds_are_linear_in_the_words():
    h = np.ones(200_000, np.uint64)
    first = np.array([0, len(h)])
    for k in (16, 1024, 65536):
        assert len(PR._seeds(h, first, k)[0]) <= len(h)
    assert PR.find_runs(h, first).tolist() == [[0, 0, 200_000, 1]]


def test_runs_end_at_the_text():
    """A run is never joined across two texts."""
    h = np.tile(np.arange(1, 5, dtype=np.uint64), 10)
    assert PR.find_runs(h, np.array([0, 20, 40])).tolist() == []  # 20 words each: too short
    assert [r[1:] for r in PR.find_runs(h, np.array([0, 16, 40])).tolist()] == [[0, 24, 4]]


def test_query_matches_brute_force(spark, make_docs, monkeypatch):  # noqa: F811
    rng = random.Random(9)
    rows = [(i, "  ".join(generated(rng)) + rng.choice(["", "\n", "\t "])) for i in range(60)]
    rows += [(None, "a " * 30), (None, None), (100, None), (101, ""), (102, " \n\t"), (103, "x"), (104, "é　b " * 40),
             (3, rows[3][1]), (3, rows[3][1]), (105, "a b " * 20_000)]
    monkeypatch.setattr(LQ, "read_table", lambda *a: make_docs(rows))
    got = [tuple(r) for r in LQ.QUERIES["op12_periodic_runs"](spark, "").collect()]
    want = [expected_row(k, t) for k, t in rows if k != 105]
    long = [r for r in got if r[0] == 105]
    assert sorted(map(str, (r for r in got if r[0] != 105))) == sorted(map(str, want))
    assert long == [(105, 1, 0, 40_000, 2, 20_000_000, hashlib.sha256(b"0,40000,2\n").hexdigest(), hashlib.sha256(b"a b").hexdigest())] \
        or zlib.crc32(b"105") % 10 == 0


def test_operator_returns_texts_and_runs(spark, make_docs):  # noqa: F811
    body = "one two three four five six seven eight"
    rows = [(1, f"start {body} {body} {body} end"), (2, body), (3, None)]
    got = {r.doc_id: r for r in PR.collapse_runs(make_docs(rows)).collect()}
    assert got[1].collapsed == f"start {body} end" and [tuple(x) for x in got[1].runs] == [(1, 24, 8)]
    assert got[2].collapsed == body and got[2].runs == [] and got[3].collapsed == "" and got[3].n_words == 0


def test_empty_table(spark, make_docs):  # noqa: F811
    assert PR.collapse_runs(make_docs([])).count() == 0
    assert PR.collapse_runs(make_docs([]).filter(F.lit(False))).columns == ["doc_id", "n_words", "runs", "collapsed"]
