"""Quality rules with line labels from a linear-chain conditional random field.

Every line of a text is an element of a chain with two states, content and
boilerplate.  State scores are linear in features of the line, neighbours are
tied by transition scores, and Viterbi decoding picks the best sequence.  A
document stays if its content lines hold at least ``min_share`` of its words
and no base rule fails.

The field is fitted here by gradient ascent on the conditional likelihood
(forward-backward over the chains).  Labels exist per document only, so the
lines of a labelled document take its quality as their state.  The fit uses at
most ``max_docs`` labelled ids of each quality (one row of each) and at most
``max_lines`` consecutive lines of each, a block that a hash of the id places
anywhere in the text; without labels of both kinds a field that calls every
line content is used, and the base rules alone decide.

Null text counts as empty: no words, base rules fail, not kept.  Repeated rows
and null ids are returned as they come; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import U64, counts_in, mix, ngram_hashes, segments, span_hashes, within, word_spans

N_FEATURES = 12
REPEAT_WINDOW = 8


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)))
_DIGIT = _table(bytes(range(48, 58)))
_LOUD = _table(b"!?")
_STOP = _table(b".!?:;")


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(equal to an earlier one, equal to any other one) for each key."""
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later = np.zeros(len(key), bool)
    later[order[1:]] = same
    any_ = later.copy()
    any_[order[:-1]] |= same
    return later, any_


def _per(index: np.ndarray) -> np.ndarray:
    return mix(index.astype(U64) + U64(1))


@dataclass
class Lines:
    """Base counts per text and features per line of a run of texts."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    first_line: np.ndarray  #: first line (with a word) of each text, and the total
    words_in_line: np.ndarray
    features: np.ndarray


def measure(data: np.ndarray, off: np.ndarray) -> Lines:
    n_docs = len(off) - 1
    starts, ends, first = word_spans(data, off)
    n_words = np.diff(first)
    h = span_hashes(data, starts, ends)
    doc_of = np.repeat(np.arange(n_docs), n_words)
    in_word = np.zeros(len(data) + 1, np.int8)
    np.add.at(in_word, starts, 1)
    np.add.at(in_word, ends, -1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    word_chars = counts_in(off, in_word & ((data & 0xC0) != 0x80))
    symbol = _SYMBOL[data]

    # words in windows that occur twice or more in their text
    g = ngram_hashes(h, REPEAT_WINDOW)
    at = np.flatnonzero(within(first, REPEAT_WINDOW))
    _, twice = _repeated(mix(g[at] ^ _per(doc_of[at])))
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + REPEAT_WINDOW, -1)
    n_repeat = counts_in(first, np.cumsum(cover[:-1]) > 0)

    # lines with a word
    feed = np.flatnonzero(data == 0x0A)
    line_starts = np.union1d(off[:-1], feed + 1)
    line_starts = line_starts[line_starts < len(data)]
    feed = np.append(feed, len(data))
    line_ends = np.minimum(feed[np.searchsorted(feed, line_starts)], off[np.searchsorted(off, line_starts, side="right")])
    a, b = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    keep = b > a
    ls, le, a, b = line_starts[keep], line_ends[keep], a[keep], b[keep]
    line_doc = np.searchsorted(off, ls, side="right") - 1
    first_line = np.searchsorted(line_doc, np.arange(n_docs + 1))
    later, _ = _repeated(mix(span_hashes(data, ls, le) ^ _per(line_doc)))
    n_dup = counts_in(first_line, later)

    # features
    nw = (b - a).astype(np.float64)
    size = np.maximum(le - ls, 1)

    def share(table):
        c = np.zeros(len(data) + 1, np.int32)
        np.cumsum(table[data], out=c[1:])
        return c[le] - c[ls]

    upper, lower = share(_UPPER), share(_LOWER)
    line_of = np.repeat(np.arange(len(ls)), b - a)
    again, _ = _repeated(mix(h ^ _per(line_of)))
    c = np.zeros(len(again) + 1, np.int64)
    np.cumsum(again, out=c[1:])
    x = np.empty((len(ls), N_FEATURES), np.float32)
    x[:, 0] = 1.0
    x[:, 1] = np.log1p(nw) / 4
    x[:, 2] = upper / np.maximum(upper + lower, 1)
    x[:, 3] = np.minimum(share(_SYMBOL) / nw, 2)
    x[:, 4] = np.minimum(share(_LOUD) / nw, 3)
    x[:, 5] = share(_DIGIT) / size
    x[:, 6] = np.minimum(size / nw / 10, 4)
    x[:, 7] = _STOP[data[np.maximum(ends[b - 1] - 1, 0)]] if len(ls) else 0
    x[:, 8] = later
    x[:, 9] = (c[b] - c[a]) / nw
    x[:, 10] = nw < 4
    x[:, 11] = (share(_STOP)) / nw
    return Lines(n_words, word_chars, counts_in(off, symbol), n_dup, n_repeat, first_line, (b - a), x)


@dataclass
class Field:
    """Linear-chain CRF with states 0 (boilerplate) and 1 (content)."""

    weights: np.ndarray = field(default_factory=lambda: np.eye(1, N_FEATURES)[0] * 8.0)
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def viterbi(self, x: np.ndarray, first_line: np.ndarray) -> np.ndarray:
        """Best state of every line; chains are delimited by ``first_line``."""
        score = (x @ self.weights).tolist()
        (t00, t01), (t10, t11) = self.trans.tolist()
        out = np.zeros(len(score), np.int8)
        for a, b in zip(first_line[:-1].tolist(), first_line[1:].tolist()):
            if a == b:
                continue
            v0, v1 = 0.0, score[a]
            back = []
            for i in range(a + 1, b):
                p0, p1 = v0 + t00 >= v1 + t10, v0 + t01 >= v1 + t11
                back.append((p0, p1))
                v0, v1 = (v0 + t00 if p0 else v1 + t10), (v0 + t01 if p1 else v1 + t11) + score[i]
            s = int(v1 >= v0)
            out[b - 1] = s
            for i in range(b - 2, a - 1, -1):
                s = 1 - int(back[i - a][s])
                out[i] = s
        return out


def fit_field(x: np.ndarray, length: np.ndarray, state: np.ndarray, rounds: int = 150, rate: float = 0.15, l2: float = 1e-3) -> Field:
    """Maximum conditional likelihood (Adam, both states weighted alike).

    ``x``: chains x lines x features, padded; ``length``: lines of each chain;
    ``state``: the state of a chain's lines.
    """
    d, m, f = x.shape
    on = np.arange(m)[None, :] < length[:, None]
    chain_w = np.where(state == 1, 0.5 / max((state == 1).sum(), 1), 0.5 / max((state == 0).sum(), 1))
    w, t = np.zeros(f), np.zeros((2, 2))
    mom = [np.zeros(f), np.zeros(f), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, rounds + 1):
        u = np.stack([np.zeros((d, m)), x @ w], -1)
        alpha, beta = np.zeros((m, d, 2)), np.zeros((m, d, 2))
        alpha[0] = u[:, 0]
        for i in range(1, m):
            nxt = np.logaddexp(alpha[i - 1][:, 0, None] + t[0], alpha[i - 1][:, 1, None] + t[1]) + u[:, i]
            alpha[i] = np.where(on[:, i, None], nxt, alpha[i - 1])
        z = np.logaddexp(alpha[-1][:, 0], alpha[-1][:, 1])
        for i in range(m - 2, -1, -1):
            r = u[:, i + 1] + beta[i + 1]
            nxt = np.logaddexp(t[:, 0] + r[:, 0, None], t[:, 1] + r[:, 1, None])
            beta[i] = np.where(on[:, i + 1, None], nxt, 0.0)
        gw, gt = np.zeros(f), np.zeros((2, 2))
        scale = chain_w / np.maximum(length, 1)
        for i in range(m):
            p1 = np.exp(alpha[i][:, 1] + beta[i][:, 1] - z)
            gw += ((state - p1) * on[:, i] * scale) @ x[:, i]
            if i + 1 < m:
                both = on[:, i + 1] * scale
                for a in (0, 1):
                    for b in (0, 1):
                        p = np.exp(alpha[i][:, a] + t[a, b] + u[:, i + 1, b] + beta[i + 1][:, b] - z)
                        gt[a, b] += (((state == a) & (state == b)) * both - p * both).sum()
        gw -= l2 * w
        gt -= l2 * t
        for k, (g, v) in enumerate(((gw, w), (gt, t))):
            mom[2 * k] = 0.9 * mom[2 * k] + 0.1 * g
            mom[2 * k + 1] = 0.99 * mom[2 * k + 1] + 0.01 * g * g
            v += rate * (mom[2 * k] / (1 - 0.9 ** step)) / (np.sqrt(mom[2 * k + 1] / (1 - 0.99 ** step)) + 1e-9)
    return Field(w, t)


def line_block(n_lines: int, max_lines: int, draw: int) -> tuple[int, int]:
    """First and end line of the block that a text of ``n_lines`` is learned from: all of them, or ``max_lines`` placed by the draw."""
    first = draw % (n_lines - max_lines + 1) if n_lines > max_lines else 0
    return first, min(n_lines, first + max_lines)


def train_field(docs: DataFrame, labels: DataFrame, max_docs: int = 1200, max_lines: int = 48, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", seed: int = 7) -> Field:
    """Fit on at most ``max_docs`` labelled ids of each quality (picked by a hash of the id; the highest label of an id
    that has several) and ``max_lines`` consecutive lines of each."""
    lab = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_y")).filter("_id is not null and _y in (0, 1)")
    lab = lab.groupBy("_id").agg(F.max("_y").alias("_y")).withColumn("_draw", F.xxhash64(F.lit(seed), F.col("_id")))
    picked = lab.filter("_y = 0").orderBy("_draw", "_id").limit(max_docs).unionAll(lab.filter("_y = 1").orderBy("_draw", "_id").limit(max_docs))
    text = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    # at most 2 * max_docs ids; of rows that repeat one, the text with the smallest hash
    rows = text.join(F.broadcast(picked), "_id").select("_y", "_draw", "_id", "_text", F.xxhash64("_text").alias("_hash"))
    rows = rows.groupBy("_id").agg(F.min_by(F.struct("_y", "_draw", "_text"), F.col("_hash")).alias("r")).select("r.*")

    def chains(batches):
        for batch in batches:
            y, draw = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, _, data, off in segments(batch.column(2)):
                m = measure(data, off)
                for i, (p, q) in enumerate(zip(m.first_line[:-1], m.first_line[1:])):
                    if q > p:
                        lo, hi = line_block(int(q - p), max_lines, draw[a + i] & 0x7FFFFFFFFFFFFFFF)
                        x = np.ascontiguousarray(m.features[p + lo:p + hi], np.float32)
                        yield pa.RecordBatch.from_arrays([pa.array([y[a + i]], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["y", "x"])

    found = sorted((r["y"], bytes(r["x"])) for r in rows.mapInArrow(chains, "y int, x binary").collect())  # 2 * max_docs blocks
    state = np.array([y for y, _ in found], np.int64)
    if len(set(state.tolist())) < 2:
        return Field()
    each = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for _, b in found]
    length = np.array([len(e) for e in each])
    x = np.zeros((len(each), int(length.max()), N_FEATURES), np.float32)
    for i, e in enumerate(each):
        x[i, :len(e)] = e
    return fit_field(x, length, state)


def _verdict(m: Lines, content: np.ndarray, min_words: int, max_repeat_pct: int, min_share: float) -> tuple[np.ndarray, np.ndarray]:
    """(base rules fail, document stays)."""
    failed = (m.n_words < min_words) | (100 * m.n_repeat_words > max_repeat_pct * m.n_words)
    return failed, ~failed & (content >= min_share * m.n_words)


def quality(docs: DataFrame, crf: Field, min_words: int = 20, max_repeat_pct: int = 30, min_share: float = 0.5,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base counts, ``base_failed``, ``kept``, ``content_words``, ``line_labels``.

    ``line_labels`` has a letter for each line with a word: C content, B boilerplate.
    """
    src = docs.select(docs[id_col], docs[text_col])
    id_type = src.schema[id_col].dataType.simpleString()
    letters = np.frombuffer(b"BC", np.uint8)

    def run(batches):
        for batch in batches:
            for a, b, data, off in segments(batch.column(1)):
                m = measure(data, off)
                state = crf.viterbi(m.features, m.first_line)
                content = counts_in(m.first_line, state * m.words_in_line)
                text = letters[state].tobytes().decode()
                labels = [text[p:q] for p, q in zip(m.first_line[:-1], m.first_line[1:])]
                failed, kept = _verdict(m, content, min_words, max_repeat_pct, min_share)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(np.asarray(v, np.int64)) for v in (
                        m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words)),
                     pa.array(failed), pa.array(kept), pa.array(content.astype(np.int64)), pa.array(labels, pa.string())],
                    names=[id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                           "content_words", "line_labels"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                               "n_repeat_words long, base_failed boolean, kept boolean, content_words long, line_labels string")


def keep_quality(docs: DataFrame, crf: Field, min_words: int = 20, max_repeat_pct: int = 30, min_share: float = 0.5,
                 text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns; no shuffle."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for a, b, data, off in segments(batch.column(at)):
                m = measure(data, off)
                content = counts_in(m.first_line, crf.viterbi(m.features, m.first_line) * m.words_in_line)
                yield batch.slice(a, b - a).filter(pa.array(_verdict(m, content, min_words, max_repeat_pct, min_share)[1]))

    return docs.mapInArrow(run, docs.schema)
