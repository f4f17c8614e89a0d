"""Near-duplicate documents: min-max hashing, banding, links confirmed on full sets.

A document's set holds its distinct ``n``-word shingles (A-Z lower-cased;
64-bit fingerprints); a shorter text is one shingle.  Documents are linked
when the Jaccard similarity of their sets reaches ``percent``.

1. One pass over the texts gives, per row, the size of the set, a 128-bit
   digest of it and a min-max signature: under every permutation both the
   smallest and the largest value are kept, so ``bands * rows`` values cost
   half as many hash evaluations.
2. Rows with equal sets form a class with its smallest id as representative
   (a partial aggregate: thousands of copies cost one row per task).
3. Representatives that agree in a band share a bucket.  Every member of a
   bucket is compared with the bucket's smallest member; comparisons that
   repeat over bands are made once.
4. Buckets whose other members still lie in different components are compared
   within: in blocks of ``block`` members, block against block, skipping what
   is already connected.  A block pair returns the links that join
   components, at most one per member, never all pairs.
5. Components of the confirmed links give the answer.

With 24 bands of 5 values a pair at similarity 0.85 misses all bands with a
probability below 1e-6; with ``STAGE_BANDS`` x ``STAGE_ROWS`` (31 bands of 4, the
pipeline stage) so does a pair at 0.80: 8e-8 for large sets, 9.8e-7 for sets that
share 4 of 5 shingles, the smallest that reach it.  Null or wordless texts have an empty set and are
linked with nothing; so are rows with a null id (``component_id`` null, kept; the
pipeline stage drops copies among them).  Rows that repeat an id stand for one node.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.words import LOWER, U64, mix, ngram_hashes, segments, span_hashes, word_spans
from tidemark.operators.materialize import materialize

SHINGLE = 5
BANDS, ROWS = 24, 5
#: the pipeline stage links from this similarity on
STAGE_PERCENT, STAGE_BANDS, STAGE_ROWS = 80, 31, 4
BLOCK = 256


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of every text."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, off)
    h = span_hashes(data, starts, ends)
    g = ngram_hashes(h, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(g[a:b - n + 1]))
        elif b > a:
            out.append(mix(ngram_hashes(h[a:b], b - a) ^ U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def set_digest(s: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
    return int(d[0]), int(d[1])


def min_max_bands(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS, seed: int = 11) -> np.ndarray:
    """Band keys (texts x bands) of non-empty sets, from the minima and maxima of ``bands * rows / 2`` permutations."""
    n_perm = (bands * rows + 1) // 2
    rng = np.random.default_rng(seed)
    mul = rng.integers(1, 1 << 63, n_perm, dtype=np.int64).astype(U64) * U64(2) + U64(1)
    add = rng.integers(0, 1 << 63, n_perm, dtype=np.int64).astype(U64)
    x = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    sig = np.empty((2 * n_perm, len(sets)), U64)
    for p in range(n_perm):
        y = x * mul[p]
        y += add[p]
        sig[2 * p] = np.minimum.reduceat(y, at)
        sig[2 * p + 1] = np.maximum.reduceat(y, at)
    keys = np.empty((len(sets), bands), U64)
    for b in range(bands):
        k = np.full(len(sets), b + 1, U64)
        for r in range(rows):
            k = mix(k + sig[b * rows + r])
        keys[:, b] = k
    return keys


def profiles(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, d1, d2, bands) per row; digest and bands are null for an empty set."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, data, off in segments(batch.column(1)):
                sets = shingle_sets(data, off, shingle)
                size = np.array([len(s) for s in sets], np.int64)
                full = size > 0
                digests = [set_digest(s) if len(s) else (None, None) for s in sets]
                keys = min_max_bands([s for s in sets if len(s)], bands, rows) if full.any() else np.zeros((0, bands), U64)
                ends = np.concatenate(([0], np.cumsum(full * bands))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(size), pa.array([x for x, _ in digests], pa.int64()),
                     pa.array([y for _, y in digests], pa.int64()), lists], names=["id", "n_shingles", "d1", "d2", "bands"])

    return docs.select("id", "text").mapInArrow(run, f"id {id_type}, n_shingles long, d1 long, d2 long, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(id, set) of the wanted (id, d1, d2): texts are read again, only those in a shared bucket are kept."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, data, off in segments(batch.column(1)):
                sets = shingle_sets(data, off, shingle)
                digests = [set_digest(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([x for x, _ in digests], pa.int64()),
                     pa.array([y for _, y in digests], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "d1", "d2", "set"])

    kept = docs.select("id", "text").join(wanted.select("id").distinct(), "id", "left_semi")
    sets = kept.mapInArrow(run, f"id {id_type}, d1 long, d2 long, set binary")
    return sets.join(wanted, ["id", "d1", "d2"], "left_semi").dropDuplicates(["id", "d1", "d2"]).select("id", "set")


def _as_set(b: bytes) -> np.ndarray:
    return np.frombuffer(b, U64)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * common >= percent * (len(x) + len(y) - common)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    schema = rows.select("a", "b").schema

    def run(batches):
        for batch in batches:
            ok = [similar(_as_set(x), _as_set(y), percent) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return rows.mapInArrow(run, schema)


def joining_links(ids, comps, sides, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links that join components of the members, comparing only what is not yet connected.

    ``sides`` is 0 / 1 for a pair of blocks (only pairs across are compared) or all 0 for one block.
    """
    n = len(ids)
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    size = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    marked = np.zeros(int(code.max()) + 1, np.int32)
    two = len(set(sides)) > 1
    side = np.array(sides)
    links = []
    for i in range(n):
        if two and side[i]:
            continue
        mine = find(comps[i])
        todo = np.array([find(c) != mine for c in comps])
        todo &= (side == 1) if two else (np.arange(n) > i)
        todo &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
        if not todo.any():
            continue
        part = code[at[i]:at[i] + size[i]]
        marked[part] = 1
        common = np.add.reduceat(marked[code], at)
        marked[part] = 0
        for j in np.flatnonzero(todo & (100 * common >= percent * (size + size[i] - common))):
            if find(comps[i]) != find(comps[j]):
                root[find(comps[i])] = find(comps[j])
                links.append((ids[i], ids[j]))
    return links


def compare_blocks(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links within buckets: ``members`` (key, n, id, comp); block pairs of at most about ``2 * block`` members."""
    n_blocks = F.ceil(F.col("n") / F.lit(float(block))).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")
    rows = (members.withColumn("nb", n_blocks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "comp", "own"))
    rows = rows.join(sets, "id")
    schema = rows.select(F.col("id").alias("a"), F.col("id").alias("b")).schema
    id_type = pa.int64() if schema["a"].dataType.simpleString() == "bigint" else None

    def run(table: pa.Table) -> pa.Table:
        t = table.to_pydict()
        two = t["i"][0] != t["j"][0]
        found = joining_links(t["id"], t["comp"], [int(two and o == t["j"][0]) for o in t["own"]], [_as_set(s) for s in t["set"]], percent)
        return pa.table({"a": pa.array([a for a, _ in found], id_type), "b": pa.array([b for _, b in found], id_type)})

    return rows.groupBy("key", "i", "j").applyInArrow(run, schema)


def _row_components(src: DataFrame, percent: int, shingle: int, bands: int, rows: int, block: int) -> DataFrame:
    """(id, n_shingles, d1, d2, rep, component_id, kept) for every row of ``src`` (id, text); rep is null for an empty set or a set of null ids only."""
    prof = materialize(profiles(src, shingle, bands, rows), "minmax")
    known = prof.filter("id is not null and d1 is not null")
    classes = materialize(known.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
                                                        F.first("bands").alias("bands")), "classes")
    in_band = classes.select("rep", "n_shingles", F.explode("bands").alias("key"))
    shared = in_band.groupBy("key").agg(F.min(F.struct("rep", "n_shingles")).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialize(in_band.join(shared, "key").select("key", "n", F.col("lead.rep").alias("lead"), F.col("lead.n_shingles").alias("lead_n"),
                                                             "rep", "n_shingles"), "buckets")
    wanted = members.select(F.col("rep").alias("id")).distinct().join(classes.select(F.col("rep").alias("id"), "d1", "d2"), "id")
    sets = materialize(full_sets(src, wanted, shingle), "sets")
    small, large = F.least("lead_n", "n_shingles"), F.greatest("lead_n", "n_shingles")
    pairs = members.filter((F.col("lead") != F.col("rep")) & (100 * small >= percent * large)).select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    links = materialize(confirm(pairs, sets, percent), "links")
    comp = connected_components(links)

    # buckets whose other members are still apart
    placed = materialize(members.filter("lead <> rep and n > 2").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                         .select("key", "n", F.col("rep").alias("id"), F.coalesce("component", "rep").alias("comp")), "placed")
    apart = placed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("m"),
                                      F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who")).filter("c0 <> c1")
    apart = apart.groupBy("m", "who").agg(F.min("key").alias("key")).select("key")  # equal buckets of several bands once
    left = placed.join(apart, "key")
    more = materialize(compare_blocks(left, sets, percent, block), "more-links")

    # an id that repeats with different texts stands for one node
    of_row = known.select("id", "d1", "d2").join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).select("id", "rep")
    several = of_row.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z")
    same_id = of_row.join(several, "id").filter("rep <> a").select("a", F.col("rep").alias("b"))
    links = links.unionAll(more).unionAll(same_id)
    comp = connected_components(links)

    out = prof.select("id", "n_shingles", "d1", "d2").join(classes.select("d1", "d2", "rep"), ["d1", "d2"], "left")
    out = out.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("component", "rep", "id"))
    return out.select("id", "n_shingles", "d1", "d2", "rep", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
                    block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept``."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return _row_components(src, percent, shingle, bands, rows, block).select("id", "n_shingles", "component_id", "kept")


def _with_digests(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(row, d1, d2): the rows of ``docs`` as a struct, with the digest of their set (null for an empty set)."""
    src = docs.select(docs[text_col].alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))

    def run(batches):
        for batch in batches:
            for a, b, data, off in segments(batch.column(0)):
                digests = [set_digest(s) if len(s) else (None, None) for s in shingle_sets(data, off, shingle)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array([x for x, _ in digests], pa.int64()),
                                                  pa.array([y for _, y in digests], pa.int64())], names=["row", "d1", "d2"])

    return src.mapInArrow(run, src.select("row").schema.add("d1", "long").add("d2", "long"))


def drop_near_duplicates(docs: DataFrame, percent: int = STAGE_PERCENT, bands: int = STAGE_BANDS, rows: int = STAGE_ROWS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their group, with all columns.

    Of rows that repeat an id and a set one stays.  Rows with a null id go if
    their set is that of a row with an id; of those with equal sets one stays.
    Rows without words stay.
    """
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    found = materialize(_row_components(src, percent, SHINGLE, bands, rows, BLOCK).select("id", "d1", "d2", "rep", "kept"), "groups")
    gone = found.filter(~F.col("kept")).select(F.col("id").alias("_gone")).distinct()
    left = docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    # rows that need a look at their own set: a repeated id, or none
    again = materialize(found.filter("kept and id is not null and d1 is not null").groupBy("id", "d1", "d2").agg(F.count(F.lit(1)).alias("n"))
                        .filter("n > 1").select(F.col("id").alias("_again")).distinct(), "repeated")
    if again.isEmpty() and found.filter("id is null").isEmpty():
        return left
    odd = left.join(again, left[id_col] == again["_again"], "left_semi").unionByName(left.filter(left[id_col].isNull()))
    plain = left.filter(left[id_col].isNotNull()).join(again, left[id_col] == again["_again"], "left_anti")
    sets = _with_digests(odd, text_col, SHINGLE).withColumn("id", F.col(f"row.`{id_col}`"))
    known = found.filter("rep is not null").select("d1", "d2").distinct()
    unnamed = sets.filter("id is null").join(known, ["d1", "d2"], "left_anti").select("row", "d1", "d2", "id")
    sets = sets.filter("id is not null").select("row", "d1", "d2", "id").unionByName(unnamed)
    one = sets.filter("d1 is not null").groupBy("id", "d1", "d2").agg(F.first("row").alias("row"))
    return plain.unionByName(one.select("row").unionByName(sets.filter("d1 is null").select("row")).select("row.*"))
