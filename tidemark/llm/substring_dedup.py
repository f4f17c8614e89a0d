"""Substring dedup: repeated runs of words, found by recompression.

A word goes if a window of ``window`` consecutive words covers it whose word
sequence also starts in a document with a smaller id.  Windows are judged on
the input.

1. One pass parses every text (``recompression``) and keeps the names of the
   symbols that some window fully determines, a digest of the word sequence
   and the hash of the text as it stands.
2. Documents with equal word sequences form a class; only its smallest id goes
   on, the others lose everything (if they hold a window at all).
3. Names are aggregated to their smallest and largest document and joined back:
   a symbol is flagged if a smaller / a larger document has it.
4. Equal windows have equal interior symbols, so a window can repeat only if
   *all* of its interior symbols (those of enough words to be rare) are flagged
   alike.  Windows without such symbols are judged by an earlier parse.  Only
   windows that pass - and those without symbols even there, as in runs of one
   word - are verified: by a
   96-bit fingerprint of the window, grouped to its smallest document.
5. Windows that a smaller document has are sent back to their documents.

Names and windows are aggregated with map-side combination, so a passage that
a third of all documents share costs a row per task, and the joins back run
between written tables that the adaptive planner can split.

Null or empty texts have no words.  Rows with a null id keep everything and
take nothing from others.  Rows that repeat an id are judged each by its own
text, against smaller ids only.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.recompression import Parse, interior, parse
from tidemark.llm.words import U64, mix, ngram_hashes, segments, span_hashes, within, word_spans
from tidemark.operators.materialize import materialize

WINDOW = 50
#: words that a symbol of the last / the early parse must stand for to count as evidence
COARSE_WORDS, FINE_WORDS = 5, 2


def _digest(h: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(hashlib.blake2b(h.tobytes(), digest_size=16).digest(), np.int64)
    return int(d[0]), int(d[1])


def _heavy(p: Parse, least: int) -> np.ndarray:
    """Symbols that stand for at least ``least`` words: light ones repeat everywhere by chance and tell nothing."""
    return (p.b - p.a) >= least


def _running(x: np.ndarray) -> np.ndarray:
    c = np.zeros(len(x) + 1, np.int64)
    np.cumsum(x, out=c[1:])
    return c


def _marked(p: Parse, starts: np.ndarray, window: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows whose interior has no heavy symbol, heavy symbols that lie in any interior)."""
    i, j = interior(p, starts, window)
    heavy = _heavy(p, least)
    c = _running(heavy)
    d = np.zeros(len(p.name) + 1, np.int64)
    full = j > i
    np.add.at(d, i[full], 1)
    np.add.at(d, j[full], -1)
    return c[j] == c[i], heavy & (np.cumsum(d[:-1]) > 0)


def _lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(values, kind))


def _windows(data: np.ndarray, off: np.ndarray, window: int):
    """Words, parses and window starts of a run of texts."""
    starts, ends, first = word_spans(data, off)
    h = span_hashes(data, starts, ends)
    at = np.flatnonzero(within(first, window))
    return starts, ends, first, h, at


def profile(docs: DataFrame, window: int) -> DataFrame:
    """(id, n_words, d1, d2, text_sha256, names, loose) per row; ``loose``: a window without interior symbols exists."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, data, off in segments(batch.column(1)):
                _, _, first, h, at = _windows(data, off, window)
                coarse, fine = parse(h, first)
                empty, use = _marked(coarse, at, window, COARSE_WORDS)
                bare = at[empty]
                empty, fine_use = _marked(fine, bare, window, FINE_WORDS)
                loose_at = bare[empty]
                loose = np.zeros(b - a, bool)
                loose[np.searchsorted(first, loose_at, side="right") - 1] = True
                names, counts = [], []
                for k in range(b - a):
                    c, f = slice(*coarse.first[k:k + 2]), slice(*fine.first[k:k + 2])
                    u = np.unique(np.concatenate((coarse.name[c][use[c]], fine.name[f][fine_use[f]])))
                    names.append(u)
                    counts.append(len(u))
                raw = data.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[x:y].split())).hexdigest() for x, y in zip(off[:-1], off[1:])]
                digests = [_digest(h[x:y]) for x, y in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(first).astype(np.int64)), pa.array([x for x, _ in digests], pa.int64()),
                     pa.array([y for _, y in digests], pa.int64()), pa.array(sha),
                     _lists(np.concatenate(names).view(np.int64), np.cumsum(counts), pa.int64()), pa.array(loose)],
                    names=["id", "n_words", "d1", "d2", "text_sha256", "names", "loose"])

    return docs.select("id", "text").mapInArrow(
        run, f"id {id_type}, n_words long, d1 long, d2 long, text_sha256 string, names array<long>, loose boolean")


def _all_flagged(p: Parse, starts: np.ndarray, window: int, least: int, key: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows without a heavy interior symbol, windows whose heavy interior symbols are all flagged alike).

    ``key`` holds the flagged symbols of each text, sorted.
    """
    i, j = interior(p, starts, window)
    heavy = _heavy(p, least)
    own = mix(p.name ^ _text_of(p.first))
    k = np.minimum(np.searchsorted(key, own), max(len(key) - 1, 0))
    has = np.where(key[k] == own, flag[k], 0) if len(key) else np.zeros(len(own), np.int64)
    c = _running(heavy)
    ok = np.zeros(len(starts), bool)
    for bit in (1, 2):
        miss = _running(heavy & ((has & bit) == 0))
        ok |= miss[j] == miss[i]
    return c[j] == c[i], ok


def _text_of(first: np.ndarray) -> np.ndarray:
    """A key per element that tells the texts of a run apart."""
    return np.repeat(mix(np.arange(1, len(first), dtype=U64)), np.diff(first))


def verified_windows(todo: DataFrame, window: int) -> DataFrame:
    """(id, h, c): fingerprints of the windows of each text whose interior symbols are all flagged alike."""
    id_type = todo.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            want = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2)])
            names, flags = batch.column(4), batch.column(5)
            for a, b, data, off in segments(batch.column(3)):
                _, _, first, h, at = _windows(data, off, window)
                same = np.array([_digest(h[x:y]) for x, y in zip(first[:-1], first[1:])]) == want[a:b]
                text = np.searchsorted(first, at, side="right") - 1
                at, text = at[same.all(1)[text]], text[same.all(1)[text]]
                part, bits = names.slice(a, b - a), flags.slice(a, b - a)
                n = np.array([0, *np.cumsum(part.value_lengths().fill_null(0).to_numpy())])
                key = mix(part.flatten().to_numpy().view(U64) ^ _text_of(n))
                order = np.argsort(key)
                key, bit = key[order], bits.flatten().to_numpy()[order].astype(np.int64)
                coarse, fine = parse(h, first)
                bare, ok = _all_flagged(coarse, at, window, COARSE_WORDS, key, bit)
                ok[bare] = _all_flagged(fine, at[bare], window, FINE_WORDS, key, bit)[1]
                at, text = at[ok], text[ok]
                g = ngram_hashes(h, window)[at]
                check = ngram_hashes(mix(h ^ U64(0x5851F42D4C957F2D)), window)[at] >> U64(33)
                one = np.sort(np.unique(mix(g ^ mix(text.astype(U64))), return_index=True)[1])  # a window once per text
                n = np.cumsum(np.bincount(text[one], minlength=b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), _lists(g[one].view(np.int64), n, pa.int64()), _lists(check[one].astype(np.int32), n, pa.int32())],
                    names=["id", "h", "c"])

    return todo.select("id", "d1", "d2", "text", "names", "flags").mapInArrow(run, f"id {id_type}, h array<long>, c array<int>")


def cut(todo: DataFrame, removal: DataFrame, window: int) -> DataFrame:
    """(id, d1, d2, removed, n_removed, kept_sha256) of the texts that lose words; ``removed`` are word ranges."""
    rows = todo.select("id", "d1", "d2", "text").join(removal, "id")
    id_type = todo.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            gone = batch.column(4)
            for a, b, data, off in segments(batch.column(3), 0):
                starts, ends, first, h, at = _windows(data, off, window)
                hit = at[np.isin(ngram_hashes(h, window)[at].view(np.int64), gone[a].values.to_numpy())]
                d = np.zeros(len(h) + 1, np.int64)
                np.add.at(d, hit, 1)
                np.add.at(d, hit + window, -1)
                lost = np.cumsum(d[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([False], lost, [False])).astype(np.int8)))
                raw = data.tobytes()
                kept = b" ".join(raw[x:y] for x, y in zip(starts[~lost].tolist(), ends[~lost].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, 1) for k in range(3)]
                    + [pa.array([[{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])]], span),
                       pa.array([int(lost.sum())], pa.int64()), pa.array([hashlib.sha256(kept).hexdigest()])],
                    names=["id", "d1", "d2", "removed", "n_removed", "kept_sha256"])

    schema = f"id {id_type}, d1 long, d2 long, removed array<struct<start:long,end:long>>, n_removed long, kept_sha256 string"
    return rows.mapInArrow(run, schema)


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_words``, ``n_removed``, ``removed`` (word ranges), ``kept_sha256``."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    prof = materialize(profile(src, window), "parsed")
    classes = materialize(prof.filter((F.col("n_words") >= window) & F.col("id").isNotNull()).groupBy("d1", "d2")
                          .agg(F.min("id").alias("rep"), F.first("names").alias("names"), F.first("loose").alias("loose")), "sequences")
    named = classes.select(F.explode("names").alias("name"), "rep")
    shared = materialize(named.groupBy("name").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi"), "shared-names")
    flag = (F.col("lo") < F.col("rep")).cast("int") + F.lit(2) * (F.col("hi") > F.col("rep")).cast("int")
    flags = named.join(shared, "name").groupBy("rep").agg(F.collect_list(F.struct("name", flag.alias("flag"))).alias("f"))
    flags = flags.select("rep", F.col("f.name").alias("names"), F.col("f.flag").alias("flags"))
    wanted = classes.select("rep", "d1", "d2", "loose").join(flags, "rep", "left").filter("loose or flags is not null")
    todo = materialize(src.join(wanted.withColumnRenamed("rep", "id").drop("loose"), "id"), "to-verify")

    seen = materialize(verified_windows(todo, window), "windows")
    rows = seen.select("id", F.explode(F.arrays_zip("h", "c")).alias("w")).select("id", "w.h", "w.c")
    first = materialize(rows.groupBy("h", "c").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").drop("hi"), "first-windows")
    removal = materialize(rows.join(first, ["h", "c"]).filter("id > lo").groupBy("id").agg(F.collect_set("h").alias("gone")), "removal")
    lost = materialize(cut(todo, removal, window).dropDuplicates(["id", "d1", "d2"]), "cut")

    out = prof.select("id", "n_words", "d1", "d2", "text_sha256").join(classes.select("d1", "d2", "rep"), ["d1", "d2"], "left")
    out = out.join(lost, ["id", "d1", "d2"], "left")
    copy = F.coalesce(F.col("id") > F.col("rep"), F.lit(False))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    return out.select(
        "id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, whole).otherwise(F.coalesce("removed", F.array().cast("array<struct<start:long,end:long>>"))).alias("removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "text_sha256")).alias("kept_sha256"))
