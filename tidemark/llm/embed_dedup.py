"""Near-duplicate vectors: product quantisation with coarse inverted lists.

Vectors are compared only within equal, non-null labels.  Unit vectors are
assigned to the nearest of ``K`` coarse centroids (an inverted list each); the
residual is coded by ``subspaces`` small codebooks.  A search computes
distances from lookup tables (query residual against every codeword, summed
over the codes of a list: asymmetric distances) and checks what remains with
the exact cosine in double precision.

Nothing is lost on the way, so recall is 1 up to rounding:

* *probes*: with r the distance of unit vectors at the least cosine, a
  neighbour of y can lie in the cell of centroid c only if y is within r of
  the bisector of c and y's own centroid; exactly these lists are probed;
* *codes*: every code carries its quantisation error e; a table distance above
  r + e cannot belong to a neighbour.

The quantisers are fitted on a sample of at most ``max_sample`` vectors
(picked by hash); every vector is indexed.  Equal vectors of a label form a
class that is searched once and counts with its size.  Lists of a label are
dealt to blocks of about ``block`` vectors (longer lists are split), queries
of a block to chunks; a task returns counts per query and, instead of linked
pairs, the links to one root per connected set.

Vectors that are null, zero, or hold null or non-finite components, and rows
with a null id or label, are linked with nothing.  Vectors of different
lengths are not compared.  Rows that repeat an id stand for one node.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.operators.materialize import materialize

MAX_SAMPLE = 16384
MAX_LISTS = 1024
VECTORS_PER_LIST = 512
SLACK = 1e-4


def _kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, c)
        n = np.bincount(own, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, own, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = 0.5 * (c * c).sum(1)
    for i in range(0, len(x), 4096):
        out[i:i + 4096] = np.argmax(x[i:i + 4096] @ c.T - half, axis=1)
    return out


@dataclass
class Quantiser:
    """Coarse centroids (K x D) and residual codebooks (one per subspace)."""

    centroids: np.ndarray
    cuts: np.ndarray
    books: list[np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, n_lists: int, subspaces: int = 16, codewords: int = 256, seed: int = 5) -> Quantiser:
        rng = np.random.default_rng(seed)
        c = _kmeans(x, max(1, min(n_lists, len(x))), 8, rng)
        rest = x - c[_nearest(x, c)]
        cuts = np.linspace(0, x.shape[1], min(subspaces, x.shape[1]) + 1).astype(int)
        books = [_kmeans(rest[:, a:b], min(codewords, len(x)), 5, rng) for a, b in zip(cuts[:-1], cuts[1:])]
        return cls(c, cuts, books)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, quantisation error) of unit vectors."""
        own = _nearest(x, self.centroids)
        rest = x - self.centroids[own]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        err = np.zeros(len(x))
        for m, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            codes[:, m] = _nearest(rest[:, a:b], self.books[m])
            err += ((rest[:, a:b] - self.books[m][codes[:, m]]) ** 2).sum(1)
        return own, codes, np.sqrt(err)

    def probes(self, x: np.ndarray, radius: float) -> np.ndarray:
        """Lists (rows x K, boolean) that can hold a vector within ``radius``."""
        c = self.centroids
        d = -2 * x @ c.T + (c * c).sum(1)
        own = d.argmin(1)
        near = d[np.arange(len(x)), own][:, None]
        gap = np.sqrt(np.maximum((c * c).sum(1)[:, None] - 2 * c @ c.T + (c * c).sum(1), 0))
        hit = d - near <= 2 * (radius + SLACK) * gap[own] + SLACK
        hit[np.arange(len(x)), own] = True
        return hit

    def distances(self, y: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances (queries x members) of unit vectors to coded members of one list."""
        rest = y - self.centroids[which]
        d2 = np.zeros((len(y), len(codes)), np.float32)
        for m, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            q, book = rest[:, a:b], self.books[m]
            table = ((q * q).sum(1)[:, None] - 2 * q @ book.T + (book * book).sum(1)).astype(np.float32)
            d2 += table[:, codes[:, m]]
        return np.sqrt(np.maximum(d2, 0))


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.linalg.norm(x, axis=1)[:, None]
    return np.pad(x, ((0, 0), (0, dim - x.shape[1]))) if x.shape[1] < dim else x


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable over links (i, j) among ``n`` nodes."""
    lab = np.arange(n)
    while True:
        new = lab.copy()
        np.minimum.at(new, i, lab[j])
        np.minimum.at(new, j, lab[i])
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def _search(t: dict, quant: Quantiser, least: float, radius: float) -> tuple[list, list, list]:
    """(ids, links found, root id) of a block: its members against the queries sent to it."""
    dim = quant.centroids.shape[1]
    role = np.array(t["role"])
    ids = np.array(t["rep"], object)
    size = np.array(t["n"], np.int64)
    member, query = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    none = ([], [], [])
    if not len(member) or not len(query):
        return none
    x = np.frombuffer(b"".join(t["vec"]), np.float64).reshape(len(role), -1)
    norm = np.linalg.norm(x, axis=1)
    unit = np.pad(x / norm[:, None], ((0, 0), (0, dim - x.shape[1])))
    lists = np.array([t["list"][k] for k in member])
    codes = np.frombuffer(b"".join(t["code"][k] for k in member), np.uint8).reshape(len(member), -1)
    err = np.array([t["err"][k] for k in member])
    probed = quant.probes(unit[query], radius)
    qs, ms = [], []
    for which in np.unique(lists):
        mine = np.flatnonzero(lists == which)
        todo = np.flatnonzero(probed[:, which])
        for p in range(0, len(todo), 1024):
            part = todo[p:p + 1024]
            d = quant.distances(unit[query[part]], int(which), codes[mine])
            a, b = np.nonzero(d <= radius + err[mine] + 10 * SLACK)
            qi, mi = query[part[a]], member[mine[b]]
            cos = np.empty(len(qi))
            for k in range(0, len(qi), 65536):
                u, v = qi[k:k + 65536], mi[k:k + 65536]
                cos[k:k + 65536] = np.einsum("ij,ij->i", x[u], x[v]) / (norm[u] * norm[v])
            ok = (cos >= least) & (ids[qi] != ids[mi]).astype(bool)
            qs.append(qi[ok])
            ms.append(mi[ok])
    qi, mi = np.concatenate(qs), np.concatenate(ms)
    if not len(qi):
        return none
    found = np.zeros(len(role), np.int64)
    np.add.at(found, qi, size[mi])
    root = _roots(len(role), qi, mi)
    used = np.union1d(qi, mi)
    return ids[used].tolist(), found[used].tolist(), ids[root[used]].tolist()


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.98, subspaces: int = 16, max_sample: int = MAX_SAMPLE,
                           block: int = 2048, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: ``id``, ``n_links``, ``component_id`` (smallest id reachable), ``kept``."""
    radius = float(np.sqrt(2 - 2 * least))
    src = vectors.select(vectors[id_col].alias("id"), vectors[label_col].alias("label"), vectors[vec_col].cast("array<double>").alias("vec"))
    id_t, label_t = (src.schema[c].dataType.simpleString() for c in ("id", "label"))

    def prepare(batches):
        for batch in batches:
            keys, raws, dims = [], [], []
            for v, i, lab in zip(batch.column(2).to_pylist(), batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.array(v, np.float64) + 0.0 if v and None not in v else np.zeros(1)
                if i is None or lab is None or not np.isfinite(x).all() or not np.any(x):
                    keys.append((None, None)), raws.append(None), dims.append(None)
                    continue
                raw = x.tobytes()
                d = np.frombuffer(hashlib.blake2b(raw, digest_size=16).digest(), np.int64)
                keys.append((int(d[0]), int(d[1]))), raws.append(raw), dims.append(len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()),
                 pa.array(dims, pa.int32()), pa.array(raws, pa.binary())], names=["id", "label", "k1", "k2", "dim", "vec"])

    rows = materialize(src.mapInArrow(prepare, f"id {id_t}, label {label_t}, k1 long, k2 long, dim int, vec binary"), "vectors")
    classes = materialize(rows.filter("vec is not null").groupBy("label", "dim", "k1", "k2")
                          .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec")), "vector-classes")
    total = classes.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("d")).first()
    if not total["n"]:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    dim = total["d"]
    sample = classes.orderBy(F.xxhash64("k1"), "k2").limit(max_sample).select("vec").collect()  # bounded by max_sample
    x = np.concatenate([_unit([bytes(r["vec"])], dim) for r in sample])
    quant = Quantiser.fit(x, min(MAX_LISTS, max(1, total["n"] // VECTORS_PER_LIST), max(1, len(x) // 16)), subspaces)

    def index(batches):
        for batch in batches:
            raws = batch.column(3).to_pylist()
            u = np.concatenate([_unit([r], dim) for r in raws]) if raws else np.zeros((0, dim))
            own, codes, err = quant.encode(u)
            probes = quant.probes(u, radius) if raws else np.zeros((0, 1), bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(err),
                 pa.array([np.flatnonzero(p).astype(np.int32) for p in probes], pa.list_(pa.int32()))],
                names=["label", "dim", "rep", "vec", "n", "list", "code", "err", "probes"])

    coded = materialize(classes.select("label", "dim", "rep", "vec", "n").mapInArrow(
        index, f"label {label_t}, dim int, rep {id_t}, vec binary, n long, list int, code binary, err double, probes array<int>"), "coded")

    # lists -> blocks (a list longer than a block is split), queries of a block -> chunks
    sizes = coded.groupBy("label", "dim", "list").agg(F.count(F.lit(1)).alias("m"))
    # a row per label: number of blocks, and the parts of lists that are split (at most MAX_LISTS entries)
    plan = materialize(sizes.groupBy("label", "dim").agg(
        F.ceil(F.sum("m") / block).cast("int").alias("blocks"),
        F.map_from_entries(F.collect_list(F.when(F.col("m") > block, F.struct("list", F.ceil(F.col("m") / block).cast("int"))))).alias("parts")), "blocks")

    def parts_of(which):
        return F.coalesce(F.try_element_at("parts", which), F.lit(1))

    def block_of(which, part):
        return F.pmod(F.xxhash64(which, part), F.col("blocks")).cast("int")

    placed = coded.join(plan, ["label", "dim"])
    members = (placed.withColumn("part", F.pmod(F.xxhash64("rep"), parts_of(F.col("list"))).cast("int"))
               .select("label", "dim", block_of(F.col("list"), F.col("part")).alias("block"), F.lit(0).alias("role"), "rep", "n", "vec", "list", "code", "err"))
    blocks = F.array_distinct(F.flatten(F.transform("probes", lambda p: F.transform(
        F.sequence(F.lit(0), parts_of(p) - 1), lambda k: block_of(p, k)))))
    asked = materialize(placed.select("label", "dim", "rep", F.explode(blocks).alias("block")), "asked")
    load = materialize(asked.groupBy("label", "dim", "block").agg(F.ceil(F.count(F.lit(1)) / (2 * block)).cast("int").alias("chunks")), "load")
    on = ["label", "dim", "block"]
    queries = (asked.join(load, on).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")).drop("chunks")
               .join(coded.select("label", "dim", "rep", "n", "vec"), ["label", "dim", "rep"])
               .select(*on, "chunk", F.lit(1).alias("role"), "rep", "n", "vec", F.lit(None).cast("int").alias("list"),
                       F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("err")))
    members = members.join(load, on).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(*queries.columns)
    work = members.unionAll(queries)

    def search(table: pa.Table) -> pa.Table:
        ids, n, root = _search(table.to_pydict(), quant, least, radius)
        kind = table.schema.field("rep").type
        return pa.table({"rep": pa.array(ids, kind), "n": pa.array(n, pa.int64()), "root": pa.array(root, kind)})

    found = materialize(work.groupBy(*on, "chunk").applyInArrow(search, f"rep {id_t}, n long, root {id_t}"), "found")
    linked = found.groupBy("rep").agg(F.sum("n").alias("others"))
    comp = connected_components(found.select("rep", "root"))
    per_class = classes.select("label", "dim", "k1", "k2", "rep", "n").join(linked, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    per_class = materialize(per_class.select("label", "dim", "k1", "k2", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                                             F.coalesce("component", "rep").alias("component")), "answers")
    out = rows.drop("vec").join(per_class, ["label", "dim", "k1", "k2"], "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
