"""Toxicity: features against plain Python, what may be learned, held-out accuracy."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import queries as LQ
from tidemark.llm import toxicity as TX
from tidemark.llm import words as W
from tidemark.sources.tables import read_table

from llm_fixtures import make_docs, shipped  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean())


def plain_features(text, weight_of):
    """The same features, word by word."""
    text = text or ""
    raw = WORD.findall(text)
    low = []
    for w in WORD.findall(text.lower()):
        for _ in range(3):
            if len(w) > 1 and w[0] in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
                w = w[1:]
        low.append(w.translate(str.maketrans("@$01345", "asoieas")))
    weights = [max([weight_of(("w", w))] + [weight_of((k, w[:k])) for k in TX.PREFIXES if len(w) >= k]) for w in low]
    you = [w in TX.SECOND_PERSON for w in low]
    n, hits = max(len(raw), 1), [w >= TX.TIERS[1] for w in weights]
    near = [h and any(you[j] for j in range(max(0, i - TX.REACH), min(len(you), i + TX.REACH + 1)) if j != i) for i, h in enumerate(hits)]
    top = (sorted(weights, reverse=True) + [0, 0, 0])[:3]
    data = text.encode()
    up, lo = (lambda b: 65 <= b <= 90), (lambda b: 97 <= b <= 122 or b >= 128)
    letters = lambda w: sum(up(b) or lo(b) for b in w.encode())
    punct = set(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    return [*(100 * sum(w >= t for w in weights) / n for t in TX.TIERS), top[0], sum(top) / 3, math.log1p(sum(hits)), sum(near) / max(sum(hits), 1),
            100 * sum(you) / n, sum(map(up, data)) / max(sum(up(b) or lo(b) for b in data), 1),
            sum(sum(map(up, w.encode())) >= 2 and not any(map(lo, w.encode())) for w in raw) / n, sum(b in b"!?" for b in data) / n,
            sum(b in punct for b in data) / max(len(data), 1), 100 * sum(any(c in "@#$%&*^~" for c in w) and letters(w) > 1 for w in raw) / n,
            100 * sum(any(c.isascii() and c.isdigit() for c in w) and letters(w) > 1 for w in raw) / n,
            100 * sum(bool(re.search(r"([A-Za-z])\1\1", w)) for w in raw) / n, 100 * sum(len(w.encode()) == 1 and letters(w) == 1 for w in raw) / n, math.log1p(len(raw))]


def test_features_match_plain_python(monkeypatch):
    rng = random.Random(2)
    vocab = ["you", "Your", "idiot", "1d10t", "moron!!", "(scum)", "clean", "Éclair", "soooo", "B", "i", "TRASH", "tr@sh###", "ab3", "日本語です", "!!", "Du,", "du", "a.b", "x"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 40))) for _ in range(80)] + [None, "", "  \n", "aaa", "É", "you", '"""idiot']
    entries = {("w", "idiot"): (9, 0), (4, "moro"): (5, 1), ("w", "trash###"): (4, 0), (3, "écl"): (6, 0), (5, "日本語です"): (3, 0), ("w", "scum)"): (3, 5), (3, "cle"): (3, 90)}

    def fingerprint(entry):
        kind, w = entry
        data = np.frombuffer(w.encode(), np.uint8)
        h = W.span_hashes(data, np.array([0]), np.array([len(data)]))
        return int(W.mix(h + np.uint64(1))[0] if kind == "w" else h[0])

    table = sorted((fingerprint(e), *c) for e, c in entries.items())
    lexicon = TX.Lexicon(np.array([t[0] for t in table], np.uint64), np.array([t[1] for t in table]), np.array([t[2] for t in table]), 30, 200)
    for own in (None, 0, 1):
        def weight_of(e):
            if e not in entries:
                return 0.0
            p, n = entries[e][0] - (own == 1), max(entries[e][1] - (own == 0), 0)
            if p < 3:
                return 0.0
            return max(0.0, math.log((p + .5) / (31 - (own == 1))) - math.log((n + .5) / (201 - (own == 0))) - math.sqrt(1 / (p + .5) + 1 / (n + .5)))

        label = None if own is None else np.full(len(texts), own)
        for size in (1 << 30, 64):  # at once, and in small segments
            monkeypatch.setattr(TX, "segments", lambda col, n=size: W.segments(col, n))
            got = TX.measure(pa.array(texts, pa.string()), lexicon, label)
            want = np.array([plain_features(t, weight_of) for t in texts])
            assert got.shape == (len(texts), len(TX.FEATURES))
            for j, name in enumerate(TX.FEATURES):
                assert np.allclose(got[:, j], want[:, j]), (name, own)


@pytest.fixture(scope="module")
def corpus(spark):
    """Rows with planted insults; stems that only toxic documents use."""
    rng = random.Random(5)
    plain = [f"{a}{b}{c}" for a in ("be", "lo", "ta", "su") for b in ("ra", "ni", "mo") for c in ("n", "s", "t")]
    stems = ["zork", "blatz"]
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(plain) for _ in range(rng.randrange(20, 90))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(stems) + rng.choice(plain))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def labels_df(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int")


def scores(spark, make_docs, rows, labels):  # noqa: F811
    model = TX.train_toxicity(make_docs(rows), labels_df(spark, labels), rounds=6)
    return {r.doc_id: r for r in TX.toxicity(make_docs(rows), model).collect()}


def test_learns_and_leaves_held_out_rows_alone(spark, make_docs, corpus):  # noqa: F811
    rows, labels = corpus
    first = scores(spark, make_docs, rows, labels)
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in first.items() if r.held_out} == set(held)
    y, s = np.array([labels[i][1] for i in held]), np.array([first[i].score for i in held])
    assert auc(y, s) > 0.98 and (s >= 0).all() and (s <= 1).all()
    assert all(r.predicted == (r.score >= 0.3) for r in first.values())
    # labels of held-out rows change nothing
    flipped = [(i, 1 - t if i in set(held) else t) for i, t in labels]
    again = scores(spark, make_docs, rows, flipped)
    assert {i: r.score for i, r in again.items()} == {i: r.score for i, r in first.items()}


def test_sample_bound_and_repeated_labels(spark, make_docs, corpus):  # noqa: F811
    rows, labels = corpus
    noisy = labels + [(labels[0][0], 0), (None, 1), (3, None), (4, 7), (5_000_000, 1)]
    train = TX.training_rows(make_docs(rows), labels_df(spark, noisy), max_rows=200)
    assert 120 < train.count() < 280
    whole = TX.training_rows(make_docs(rows), labels_df(spark, noisy))
    want = [t for i, t in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    assert whole.count() == len(want) and whole.filter("y = 1").count() == sum(want)


def test_edge_rows(spark, make_docs, corpus):  # noqa: F811
    rows, labels = corpus
    odd = [(None, rows[0][1]), (7, None), (8, ""), (9, " \n\t"), (10, "zorkben " * 60_000), (11, rows[0][1]), (11, rows[0][1]), (12, "é" * 50)]
    model = TX.train_toxicity(make_docs(rows), labels_df(spark, labels), rounds=4)
    got = TX.toxicity(make_docs(odd), model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "features"]
    by = got.collect()
    assert len(by) == len(odd) and all(0 <= r.score <= 1 for r in by)
    same = {r.score for r in by if r.doc_id in (None, 11)}
    assert len(same) == 1 and not [r for r in by if r.doc_id is None][0].held_out
    assert len({r.score for r in by if r.doc_id in (7, 8, 9)}) == 1
    assert TX.toxicity(make_docs([]), model).count() == 0


def test_one_class_or_no_labels(spark, make_docs):  # noqa: F811
    rows = [(i, f"word{i} text") for i in range(30)]
    for labels, want in (([], 0.0), ([(i, 1) for i in range(30)], 1.0), ([(i, 0) for i in range(30)], 0.0)):
        model = TX.train_toxicity(make_docs(rows), labels_df(spark, labels))
        assert {r.score for r in TX.toxicity(make_docs(rows), model).collect()} == {want}
    assert TX.train_toxicity(make_docs([]), labels_df(spark, [(1, 1)])).prior == 0.0


def test_held_out_accuracy_on_given_tables(spark):
    d = "/root/testdata/sf0.1"
    rows = LQ.QUERIES["op13_toxicity"](spark, d)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in rows.collect()}
    held = [(r.toxic, rows[r.doc_id]) for r in read_table(spark, d, "labels").collect() if rows[r.doc_id].held_out]
    y, s = np.array([t for t, _ in held]), np.array([r.score for _, r in held])
    p = np.array([r.predicted for _, r in held])
    assert auc(y, s) > 0.98 and p[y == 1].mean() > 0.9 and p[y == 0].mean() < 0.02
    assert ((s - y) ** 2).mean() < 0.02  # calibrated: 0.098 for the share alone
