"""Language-model scores by stupid backoff, computed as joins.

Count tables of all n-grams up to ``order`` are partitioned by hash and joined
to the n-grams of the documents; scores are summed per document.  A row per
n-gram would move the corpus many times over, so both sides travel in blocks:

1. Texts are read once into *batches* of about ``batch_bytes``: ids, number of
   words and the words as indexes into the batch's table of 64-bit word
   fingerprints.  Batches are a written table, so all later steps see the same.
2. A batch lists its different n-grams with their counts, sorted, a row for
   each range of the hash space (a block of the exploded n-grams); keys travel
   as compressed differences.
3. Rows of one range meet in one task, which adds up the counts - that range of
   the count table - and answers every row with the totals of its n-grams.
   The number of ranges grows with the number of n-grams.
4. Answers are joined to their batch, and every word gets
   ``S(w | h) = c(h w) / c(h)`` for the longest history h with
   ``c(h w) >= min_count``, times ``backoff`` for every word that was dropped
   from the history; without history ``c(w) / N``.

n-grams do not cross documents.  Keys are fingerprints whose bits grow with the
number of n-grams (``key_bits``).  Null or empty text: no words, score 0, mean null.  Repeated
rows and null ids count and are scored like others.  An empty table gives an
empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import U64, mix, ngram_hashes, segments, span_hashes, within, word_spans
from tidemark.session import scratch_path

ORDER = 3
BATCH_BYTES = 16 << 20
RANGE_GRAMS = 3_000_000


_BYTES = 8


def pack(x: np.ndarray) -> bytes:
    """Unsigned values, byte plane by byte plane, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, _BYTES).T).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    out = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(_BYTES, -1)
    return np.ascontiguousarray(out.T).view("<u8").ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """Sorted values by their differences."""
    return pack(np.diff(x, prepend=U64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=U64)


def key_bits(n_grams: int) -> int:
    """Bits of a key: about one n-gram in eight million shares its key with another; at least 52, at most 64."""
    return max(52, min(64, int(n_grams).bit_length() + 23))


def gram_keys(words: np.ndarray, first: np.ndarray, order: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 .. order: (first word of every n-gram, its key of ``bits`` bits)."""
    for n in range(1, order + 1):
        at = np.flatnonzero(within(first, n))
        yield at, mix(ngram_hashes(words, n)[at] + U64(n)) >> U64(64 - bits)


def distinct_grams(words: np.ndarray, first: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, counts) of the different n-grams of all orders."""
    each = [np.unique(keys, return_counts=True) for _, keys in gram_keys(words, first, order, bits)]
    keys = np.concatenate([k for k, _ in each])
    by = np.argsort(keys, kind="stable")
    return keys[by], np.concatenate([c for _, c in each])[by]


def _sequence(vocab: bytes, seq: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(vocab, U64)[unpack(seq).astype(np.int64)], np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def word_batches(docs: DataFrame, batch_bytes: int) -> DataFrame:
    """(batch, ids, sizes, n_words, vocab, seq): the words of whole texts in batches."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, data, off in segments(batch.column(1), batch_bytes):
                starts, ends, first = word_spans(data, off)
                vocab, seq, count = np.unique(span_hashes(data, starts, ends), return_inverse=True, return_counts=True)
                by = np.argsort(-count, kind="stable")  # common words get small numbers
                rank = np.empty_like(by)
                rank[by] = np.arange(len(by))
                ids = batch.column(0).slice(a, b - a)
                one = np.array([0, b - a], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, pa.array(np.diff(first))),
                     pa.array([len(seq)], pa.int64()), pa.array([vocab[by].tobytes()], pa.binary()), pa.array([pack(rank[seq])], pa.binary())],
                    names=["batch", "ids", "sizes", "n_words", "vocab", "seq"])

    return docs.select("id", "text").mapInArrow(run, f"batch string, ids array<{id_type}>, sizes array<long>, n_words long, vocab binary, seq binary")


def _limits(n_ranges: int, bits: int) -> np.ndarray:
    """First key of every range but the first."""
    return np.array([(i << bits) // n_ranges for i in range(1, n_ranges)], U64)


def requests(batches: DataFrame, order: int, n_ranges: int, bits: int) -> DataFrame:
    """(part, batch, keys, counts): the different n-grams of every batch by range."""

    def run(it):
        limits = _limits(n_ranges, bits)
        for rb in it:
            for r in rb.to_pylist():
                words, first = _sequence(r["vocab"], r["seq"], np.array(r["sizes"]))
                keys, counts = distinct_grams(words, first, order, bits)
                cut = np.concatenate(([0], np.searchsorted(keys, limits), [len(keys)]))
                for part in np.flatnonzero(np.diff(cut)).tolist():
                    a, b = cut[part], cut[part + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([r["batch"]]), pa.array([pack_sorted(keys[a:b])], pa.binary()),
                         pa.array([pack(counts[a:b])], pa.binary())], names=["part", "batch", "keys", "counts"])

    return batches.select("batch", "sizes", "vocab", "seq").mapInArrow(run, "part int, batch string, keys binary, counts binary")


def _answer(table: pa.Table) -> pa.Table:
    """Totals of a range of the count table, for every row that asked."""
    keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([unpack(c) for c in table.column("counts").to_pylist()])
    size = np.cumsum([0] + [len(k) for k in keys])
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    ks = keys[order]
    new = np.concatenate(([True], ks[1:] != ks[:-1]))
    total = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(new))
    answer = np.empty(len(keys), np.int64)
    answer[order] = total[np.cumsum(new) - 1]
    return pa.table({"batch": table.column("batch"), "part": table.column("part"),
                     "totals": pa.array([pack(answer[a:b]) for a, b in zip(size[:-1], size[1:])], pa.binary())})


def backoff_scores(words: np.ndarray, first: np.ndarray, lookup, order: int, bits: int, total: int, min_count: int, backoff: float):
    """(log score, words of the history used) of every word; ``lookup`` gives the counts of keys."""
    n = len(words)
    counts = []
    for at, keys in gram_keys(words, first, order, bits):
        c = np.zeros(n, np.int64)
        c[at] = lookup(keys)
        counts.append(c)  # by the n-gram's first word
    place = np.arange(n) - np.repeat(first[:-1], np.diff(first))
    score = np.log(counts[0] / max(total, 1)) + np.minimum(place, order - 1) * np.log(backoff) if n else np.zeros(0)
    used = np.zeros(n, np.int64)
    for k in range(1, order):  # histories of k words
        i = np.flatnonzero(place >= k)
        c = counts[k][i - k]
        ok = c >= min_count
        i = i[ok]
        score[i] = np.log(c[ok] / counts[k - 1][i - k]) + (np.minimum(place[i], order - 1) - k) * np.log(backoff)
        used[i] = k
    return score, used


def lm_scores(docs: DataFrame, order: int = ORDER, min_count: int = 2, backoff: float = 0.4, batch_bytes: int = BATCH_BYTES,
              range_grams: int = RANGE_GRAMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``log_score``, ``mean_log`` and ``n_by_order`` (words scored with n-grams of each order)."""
    spark = docs.sparkSession
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    path = scratch_path(spark, "word-batches")
    word_batches(src, batch_bytes).write.option("compression", "zstd").parquet(path)
    batches = spark.read.parquet(path)
    total = batches.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    n_ranges = max(1, -(-total * order // range_grams))
    bits = key_bits(total * order)
    answers = requests(batches, order, n_ranges, bits).groupBy("part").applyInArrow(_answer, "batch string, part int, totals binary")
    id_type = src.schema["id"].dataType.simpleString()

    def score(own: pa.Table, got: pa.Table) -> pa.Table:
        out = []
        parts = sorted(zip(got.column("part").to_pylist(), got.column("totals").to_pylist()))
        totals = np.concatenate([unpack(t) for _, t in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        for r in range(own.num_rows):
            sizes = np.array(own.column("sizes")[r].as_py(), np.int64)
            words, first = _sequence(own.column("vocab")[r].as_py(), own.column("seq")[r].as_py(), sizes)
            keys = distinct_grams(words, first, order, bits)[0]
            s, used = backoff_scores(words, first, lambda k: totals[np.searchsorted(keys, k)], order, bits, total, min_count, backoff)
            full = np.flatnonzero(sizes > 0)
            log_score = np.zeros(len(sizes))
            by_order = np.zeros((len(sizes), order), np.int64)
            if len(full):
                log_score[full] = np.add.reduceat(s, first[full])
                for k in range(order):
                    by_order[full, k] = np.add.reduceat((used == k).astype(np.int64), first[full])
            mean = np.divide(log_score, sizes, out=np.full(len(sizes), np.nan), where=sizes > 0)
            out.append(pa.table({"id": own.column("ids")[r].values, "n_words": pa.array(sizes), "log_score": pa.array(log_score),
                                 "mean_log": pa.array(mean, mask=sizes == 0),
                                 "n_by_order": pa.ListArray.from_arrays(np.arange(0, (len(sizes) + 1) * order, order, dtype=np.int32), pa.array(by_order.ravel()))}))
        return pa.concat_tables(out)

    schema = f"id {id_type}, n_words long, log_score double, mean_log double, n_by_order array<long>"
    return batches.drop("n_words").groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, schema)
