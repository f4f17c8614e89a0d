"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

1. *Lexicon.*  Words count by their beginnings (``PREFIXES`` code points, and whole
   words), lower-cased, common letter substitutes undone.  A beginning's weight is
   the lower bound (one standard error) of its log odds ratio between toxic and
   clean training documents; beginnings in fewer than ``min_docs`` toxic documents
   have none.  Counts are aggregated in Spark; the ``max_entries`` entries with the
   largest weighted support are kept, known by 64-bit fingerprints.
2. *Features* (``FEATURES``): densities of lexicon words in three tiers, largest
   weights, second-person words and their distance to lexicon words, capitals,
   punctuation, and obfuscation (symbols or digits inside words, stretched
   letters, spaced-out letters).  Training rows are measured against a lexicon
   without their own document, so its counts do not leak into their features.
3. *Trees*: MLlib boosting on two thirds of the training rows.
4. *Calibration*: isotonic regression on the other third.  A fiftieth of the
   score is the trees' own probability, which orders texts on one step.

Rows whose ``crc32(id) % 4`` is 2 are never learned from; the fit uses at most
about ``max_rows`` of the other labelled rows, picked by a hash of the id.  Scores
depend on the text alone.  Null or empty texts have features of zero and a score
like others; rows with a null id are scored, never learned from.  An id that is
labelled more than once counts as toxic if one label says so; labels other
than 0 and 1 are ignored.  Where the training rows hold one class or none, every
score is the share of toxic ones (0 if there are none).  Repeated rows and extra
columns are kept apart; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import U64, counts_in, mix, segments, span_hashes, text_buffer, word_spans
from tidemark.operators.materialize import materialize

PREFIXES = tuple(range(3, 11))
WHOLE = 0
TIERS = (1.0, 2.5, 4.0)
#: how many words lie between a lexicon word and a second-person word at most
REACH = 3
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta",
                 "tes", "vous", "votre", "vos", "ti", "tus", "usted", "ustedes", "vosotros", "os")
FEATURES = ("density_1", "density_2", "density_3", "top_weight", "mean_top_3", "log_hits", "near_second_person", "second_person", "capitals",
            "capital_words", "exclaims", "punctuation", "symbol_words", "digit_words", "stretched", "spaced_out", "log_words")

#: letter substitutes undone before words are looked up
_PLAIN = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"@$01345", b"asoieas"):
    _PLAIN[_a] = _b
_IS = np.zeros((6, 256), bool)
_UPPER, _LOWER, _DIGIT, _SYMBOL, _EXCLAIM, _PUNCT = _IS
_UPPER[65:91] = True
_LOWER[97:123] = True
_LOWER[128:] = True
_DIGIT[48:58] = True
_SYMBOL[list(b"@#$%&*^~")] = True
_EXCLAIM[list(b"!?")] = True
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True


def _hashes_of(words) -> np.ndarray:
    data, off = text_buffer(pa.array(list(words), pa.string()))
    return np.sort(span_hashes(data, off[:-1], off[1:]))


def _among(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Position of each value in the sorted table, -1 where it is missing."""
    if not len(table):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[at] == h, at, -1)


def _lookup_words(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first word of each text) of a column's words, lower-cased and with substitutes undone."""
    low, off = text_buffer(pc.utf8_lower(col))
    starts, ends, first = word_spans(low, off)
    starts = starts.copy()
    for _ in range(3):  # opening quotes and brackets
        starts += _PUNCT[low[starts]] & (starts + 1 < ends)
    return _PLAIN[low], starts, ends, first


def _beginnings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(kind, words, fingerprints) for whole words and for every length of beginnings."""
    yield WHOLE, np.arange(len(starts)), mix(span_hashes(data, starts, ends) + U64(1))
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), np.full(max(PREFIXES) + 1, len(data)))
    at = np.searchsorted(lead, starts)
    for k in PREFIXES:
        stop = lead[at + k]
        words = np.flatnonzero(stop <= ends)
        if len(words):
            yield k, words, span_hashes(data, starts[words], stop[words])


def odds_weight(pos, neg, n_pos, n_neg, min_docs):
    """Lower bound of the log odds ratio; 0 below ``min_docs`` toxic documents."""
    pos, neg = np.maximum(pos, 0), np.maximum(neg, 0)
    w = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1)) - np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    return np.where(pos >= min_docs, np.maximum(w, 0.0), 0.0)


@dataclass
class Lexicon:
    """Entries as sorted (fingerprint, documents per class); weights without a document of either class for training."""
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    pos: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    neg: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_pos: int = 0
    n_neg: int = 0
    min_docs: int = 3

    def weights(self, own: int | None = None) -> np.ndarray:
        p, n = int(own == 1), int(own == 0)
        return odds_weight(self.pos - p, self.neg - n, self.n_pos - p, self.n_neg - n, self.min_docs)


def measure(col: pa.Array, lexicon: Lexicon, own: np.ndarray | None = None) -> np.ndarray:
    """Rows of ``FEATURES`` for the texts of a column; ``own`` gives the label of training rows."""
    second = _hashes_of(SECOND_PERSON)
    tables = [lexicon.weights(x) for x in (None, 0, 1)]
    out = []
    for a, b, data, off in segments(col):
        words, starts, ends, first = _lookup_words(col.slice(a, b - a))
        n_rows, n_words = b - a, np.diff(first)
        row = np.repeat(np.arange(n_rows), n_words)
        label = None if own is None else own[a:b][row]
        weight = np.zeros(len(starts))
        for _, who, h in _beginnings(words, starts, ends):
            at = _among(h, lexicon.hashes)
            hit = np.flatnonzero(at >= 0)
            if len(hit):
                w = tables[0][at[hit]] if label is None else np.choose(label[who[hit]], [tables[1][at[hit]], tables[2][at[hit]]])
                np.maximum.at(weight, who[hit], w)
        you = _among(span_hashes(words, starts, ends), second) >= 0
        near = np.zeros(len(starts), bool)
        for d in range(1, REACH + 1):
            same = row[d:] == row[:-d] if len(row) > d else np.zeros(0, bool)
            near[d:] |= you[:len(same)] & same if len(same) else near[d:]
            near[:len(same)] |= you[d:] & same if len(same) else near[:0]
        per_word = 1.0 / np.maximum(n_words, 1)
        tiers = [counts_in(first, weight >= t) for t in TIERS]
        order = np.lexsort((-weight, row))
        top = np.zeros((n_rows, 3))
        for i in range(3):
            has = n_words > i
            top[has, i] = weight[order[first[:-1][has] + i]]
        # surface features come from the text as written
        starts, ends, first = word_spans(data, off)
        n = np.maximum(np.diff(off), 1)

        def per_text(flags):
            return counts_in(off, flags)

        def in_words(flags):
            return counts_in(np.append(starts, len(data)), flags) if len(starts) else np.zeros(0, np.int64)

        upper, lower = in_words(_UPPER[data]), in_words(_LOWER[data])
        letters = upper + lower
        symbols, digits, size = in_words(_SYMBOL[data]), in_words(_DIGIT[data]), ends - starts
        triple = np.zeros(len(data), bool)
        if len(data) > 2:
            triple[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & (data[2:] < 128) & (_UPPER | _LOWER)[data[2:]]
        spaced = (size == 1) & (letters == 1)
        features = [*(100 * t * per_word for t in tiers), top[:, 0], top.mean(1), np.log1p(tiers[1]),
                    counts_in(np.concatenate([[0], np.cumsum(n_words)]), near & (weight >= TIERS[1])) / np.maximum(tiers[1], 1),
                    100 * counts_in(np.concatenate([[0], np.cumsum(n_words)]), you) * per_word,
                    per_text(_UPPER[data]) / np.maximum(per_text((_UPPER | _LOWER)[data]), 1),
                    counts_in(first, (upper >= 2) & (lower == 0)) * per_word, per_text(_EXCLAIM[data]) * per_word, per_text(_PUNCT[data]) / n,
                    100 * counts_in(first, (symbols > 0) & (letters > 1)) * per_word, 100 * counts_in(first, (digits > 0) & (letters > 1)) * per_word,
                    100 * counts_in(first, in_words(triple) > 0) * per_word, 100 * counts_in(first, spaced) * per_word, np.log1p(n_words)]
        out.append(np.stack(features, 1).astype(np.float64))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def held_out(id_col: Column) -> Column:
    """Rows that no model may learn from; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = 8000, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", seed: int = 11) -> DataFrame:
    """(y, calibrate, text) of about ``max_rows`` labelled rows that are not held out, written once.

    The ids are drawn by a hash with the probability ``max_rows`` / labelled rows (1 if there are fewer).
    """
    lab = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_y")).filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
    lab = materialize(lab.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("y")), "labels")
    share = min(1.0, max_rows / max(lab.count(), 1))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("_id")), 11) / F.lit(float(1 << 53))
    picked = lab.filter(draw < F.lit(share)).withColumn("calibrate", F.crc32(F.col("_id").cast("string")) % 4 == 3)
    text = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("text"))
    return materialize(text.join(F.broadcast(picked), "_id").select("y", "calibrate", "text"), "training")  # about max_rows ids


def learn_lexicon(train: DataFrame, min_docs: int = 3, max_entries: int = 4096) -> Lexicon:
    """Weighted beginnings from all training rows."""
    sizes = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)

    def count(batches):
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            col = batch.column(1)
            for a, b, _, _ in segments(col):
                words, starts, ends, first = _lookup_words(col.slice(a, b - a))
                row = np.repeat(np.arange(b - a), np.diff(first))
                for _, who, h in _beginnings(words, starts, ends):
                    order = np.lexsort((row[who], h))
                    h, r = h[order], row[who][order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])  # a document counts once
                    h, r = h[new], r[new]
                    keys, at = np.unique(h, return_inverse=True)
                    pos = np.bincount(at, weights=y[a:b][r], minlength=len(keys)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(pos), pa.array(np.bincount(at, minlength=len(keys)) - pos)],
                                                     names=["h", "pos", "neg"])

    counts = train.select("y", "text").mapInArrow(count, "h long, pos long, neg long").groupBy("h").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    half, neg = F.lit(0.5), F.greatest(F.col("neg") - 1, F.lit(0))  # as seen by a clean training document
    odds = (F.log((F.col("pos") + half) / (n_pos + 1)) - F.log((neg + half) / (n_neg + 1)) - F.sqrt(1 / (F.col("pos") + half) + 1 / (neg + half)))
    best = counts.filter(F.col("pos") >= min_docs).withColumn("w", odds).filter(F.col("w") >= TIERS[0])
    rows = best.orderBy((F.col("w") * F.col("pos")).desc(), "h").limit(max_entries).collect()  # max_entries rows
    rows.sort(key=lambda r: r["h"] & 0xFFFFFFFFFFFFFFFF)
    return Lexicon(np.array([r["h"] for r in rows], np.int64).view(U64), np.array([r["pos"] for r in rows], np.int64),
                   np.array([r["neg"] for r in rows], np.int64), n_pos, n_neg, min_docs)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    prior: float
    trees: GBTClassificationModel | None = None
    steps: IsotonicRegressionModel | None = None


def _raw_score(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    """``rows`` (with ``x``, an array of features) with ``p``, the trees' probability."""
    scored = trees.transform(rows.withColumn("features", array_to_vector("x")))
    return scored.withColumn("p", F.get(vector_to_array("probability"), F.lit(1))).drop("features", "rawPrediction", "probability", "prediction")


def train_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 8000, min_docs: int = 3, max_entries: int = 4096, rounds: int = 20, depth: int = 3,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", seed: int = 11) -> ToxicityModel:
    """Lexicon, trees and calibration from the labelled rows that are not held out."""
    train = training_rows(docs, labels, max_rows, id_col, text_col, label_col, seed)
    lexicon = learn_lexicon(train, min_docs, max_entries)
    n = lexicon.n_pos + lexicon.n_neg
    model = ToxicityModel(lexicon, lexicon.n_pos / n if n else 0.0)
    if not lexicon.n_pos or not lexicon.n_neg:
        return model

    def features(batches):
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = measure(batch.column(2), lexicon, y)
            yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.float64)), batch.column(1), _lists(x)], names=["label", "calibrate", "x"])

    rows = materialize(train.mapInArrow(features, "label double, calibrate boolean, x array<double>"), "features").coalesce(8)
    for fit, rest in ((rows.filter("not calibrate"), rows.filter("calibrate")), (rows, rows.limit(0))):
        if fit.select("label").distinct().count() == 2:  # else too few rows to set some aside
            break
    gbt = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, maxBins=64, minInstancesPerNode=4, seed=seed, labelCol="label")
    model.trees = gbt.fit(fit.withColumn("features", array_to_vector("x")).select("features", "label"))
    rest = materialize(_raw_score(rest, model.trees).select("p", "label"), "calibration")
    if rest.select("label").distinct().count() == 2:
        model.steps = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="step").fit(rest)
    return model


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` (0 to 1), ``predicted``, ``features`` (by ``FEATURES``).  No shuffle."""
    src = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    id_type, lexicon = src.schema["_id"].dataType.simpleString(), model.lexicon

    def features(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(measure(batch.column(1), lexicon))], names=["_id", "x"])

    rows = src.mapInArrow(features, f"_id {id_type}, x array<double>")
    score = F.lit(model.prior)
    if model.trees is not None:
        rows, score = _raw_score(rows, model.trees), F.col("p")
        if model.steps is not None:
            rows, score = model.steps.transform(rows), 0.98 * F.col("step") + 0.02 * F.col("p")
    rows = rows.withColumn("score", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))
    return rows.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"), F.col("x").alias("features"))
