"""SentencePiece encoding by sampling from the piece lattice, and decoding.

All segmentations of a text into pieces form a lattice: a node per character
boundary, an edge per piece that matches.  Forward filtering sums the weights
of all paths to every node; backward sampling then walks from the end, picking
the edge into each node with its share of that sum.  The draws come from a
counter-based generator keyed by seed, row key, position and step, so a row's
segmentation is the same in any partitioning and after any retry.

Pieces hold the blank mark only at their start, so the lattice falls apart at
the start of every word; equal words of a batch share one lattice, and the
walks of all words of a batch advance together in numpy.

Weights: a unigram model's scores are log probabilities; a BPE model's are
ranks, and rank k weighs 1 / (k + 2).  ``temperature`` flattens (above 1) or
sharpens them.  Characters without a piece of their own are spelt in byte
pieces, as is a literal U+2581, which the model uses as its blank mark; so
decoding gives back every text exactly.

Null or empty text: no pieces.  Repeated rows get equal pieces (the key is the
id); null ids share one key.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.words import U64, mix, segments

BLANK = 0x2581
LITERAL = 0x110000  #: stands for a literal U+2581, which no piece matches
CHUNK_CHARS = 1 << 20
UNIT = 28  #: bits of a draw


class Model:
    """Pieces of a SentencePiece model as a trie in arrays, with log weights."""

    def __init__(self, path: str, temperature: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.byte_id = np.full(256, -1, np.int64)
        pieces = {}
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
            elif not special[i]:
                pieces[i] = p
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces: decoding would not be lossless")
        scores = {i: sp.get_score(i) for i in pieces}
        ranked = all(s == int(s) for s in scores.values())
        least = min(pieces, default=0)
        self.weight = np.zeros(n)
        for i in pieces:
            self.weight[i] = (-np.log(i - least + 2.0) if ranked else scores[i]) / temperature
        #: bytes of every piece, for decoding
        text = [b""] * n
        for i, p in pieces.items():
            text[i] = p.replace("▁", " ").encode()
        for b, i in enumerate(self.byte_id):
            text[i] = bytes([b])
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.at = np.concatenate(([0], np.cumsum([len(t) for t in text])))
        # trie: (node, character) -> child, piece that ends at a node
        child: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i, p in pieces.items():
            node = 0
            for ch in map(ord, p):
                nxt = child.get((node, ch))
                if nxt is None:
                    nxt = child[(node, ch)] = len(ends)
                    ends.append(-1)
                node = nxt
            ends[node] = i
        keys = np.array([(a << 21) | c for a, c in child], np.int64)
        order = np.argsort(keys)
        self.keys, self.child, self.ends = keys[order], np.array(list(child.values()), np.int64)[order], np.array(ends, np.int64)
        self.roots = np.full(LITERAL + 1, -1, np.int32)  # the first step needs no search
        at_root = self.keys >> 21 == 0
        self.roots[self.keys[at_root] & ((1 << 21) - 1)] = self.child[at_root]
        inside = any("▁" in p.lstrip("▁") for p in pieces.values())
        feed = any("\n" in p for p in pieces.values())
        self.unit = re.compile(r".+" if inside else r" *[^ ]+| +" if feed else r" *[^ \n]+| +|\n", re.S)

    def step(self, node: np.ndarray, ch: np.ndarray) -> np.ndarray:
        """Children (or -1) of trie nodes by characters."""
        k = (node << 21) | ch
        i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[i] == k, self.child[i], -1)


class Lattices:
    """The lattices of a list of different words, filtered forward; edges are sorted by the node they lead to."""

    def __init__(self, model: Model, words: list[str]):
        size = np.array([len(w) for w in words], np.int64)
        ch = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        original = ch
        ch = np.where(ch == BLANK, LITERAL, np.where(ch == 32, BLANK, ch))
        n = len(ch)
        word = np.repeat(np.arange(len(words)), size)
        end = np.cumsum(size)
        limit = end[word] if n else end
        src, dst, piece = [], [], []
        pos, node, k = np.arange(n), np.zeros(n, np.int64), 0
        own = np.zeros(n, bool)
        while len(pos):
            ok = pos + k < limit[pos]
            pos, node = pos[ok], node[ok]
            node = model.step(node, ch[pos + k]) if k else model.roots[ch[pos]].astype(np.int64)
            pos, node = pos[node >= 0], node[node >= 0]
            k += 1
            hit = model.ends[node] >= 0
            src.append(pos[hit]), dst.append(pos[hit] + k), piece.append(model.ends[node[hit]])
            if k == 1:
                own[pos[hit]] = True
        spelt = np.flatnonzero(~own)  # characters without a piece: an edge that is spelt in bytes
        src.append(spelt), dst.append(spelt + 1), piece.append(-1 - spelt)
        src, dst, piece = map(np.concatenate, (src, dst, piece))
        # node numbers: a word of m characters has m + 1 nodes
        self.end_node = end + np.arange(len(words))
        self.start_node = np.concatenate(([0], self.end_node[:-1] + 1))
        to = dst + word[src]
        frm = src + word[src]
        order = np.argsort(to, kind="stable")
        self.src, to, piece = frm[order], to[order], piece[order]
        w = np.where(piece >= 0, model.weight[np.maximum(piece, 0)], 0.0)
        n_nodes = n + len(words)
        first = np.flatnonzero(np.diff(to, prepend=-1))  # first edge into each reached node
        node_of = to[first]
        count = np.diff(np.append(first, len(to)))
        # forward filtering, all words at once, by distance from the word's start
        total = np.zeros(n_nodes)
        if n:
            depth = (dst - (end - size)[word[src]])[order][first]
            by = np.argsort(depth, kind="stable")
            cuts = np.searchsorted(depth[by], np.arange(1, depth.max() + 2))
            for a, b in zip(cuts[:-1], cuts[1:]):
                nodes = by[a:b]
                c = count[nodes]
                e = np.repeat(first[nodes] - np.concatenate(([0], np.cumsum(c)[:-1])), c) + np.arange(c.sum())
                v = total[self.src[e]] + w[e]
                at = np.concatenate(([0], np.cumsum(c)[:-1]))
                top = np.maximum.reduceat(v, at)
                total[node_of[nodes]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, c)), at))
        # cumulative shares per node, in units of 2**-28 behind the node's rank: exact,
        # so that a draw picks the same edge wherever the word stands in a batch
        share = np.exp(total[self.src] + w - total[to])
        for k in range(1, int(count.max(initial=0))):
            e = first[count > k] + k
            share[e] += share[e - 1]
        rank = np.repeat(np.arange(len(first)), count)
        self.cdf = (rank << UNIT) + np.minimum((share * (1 << UNIT)).astype(np.int64), 1 << UNIT)
        self.rank = np.full(n_nodes, -1, np.int64)
        self.rank[node_of] = np.arange(len(first))
        self.last = first + count - 1
        # ids of every edge: one piece, or the bytes of a character
        spelt = piece < 0
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in original[-1 - piece[spelt]].tolist()]
        self.n_ids = np.ones(len(piece), np.int64)
        self.n_ids[spelt] = [len(r) for r in raw]
        self.id_at = np.concatenate(([0], np.cumsum(self.n_ids)[:-1])) if len(piece) else self.n_ids
        self.ids = np.empty(int(self.n_ids.sum()), np.int32)
        self.ids[self.id_at[~spelt]] = piece[~spelt]
        if raw:
            b = np.repeat(self.id_at[spelt] - np.concatenate(([0], np.cumsum(self.n_ids[spelt])[:-1])), self.n_ids[spelt]) + np.arange(self.n_ids[spelt].sum())
            self.ids[b] = model.byte_id[np.frombuffer(b"".join(raw), np.uint8)]

    def sample(self, word: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids of all occurrences in order, number of ids of each): ``word`` and a random key per occurrence."""
        n = len(word)
        cur, stop = self.end_node[word], self.start_node[word]
        live = np.arange(n)
        steps = []
        k = 0
        while len(live):
            u = (mix(key[live] + U64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1))) >> U64(64 - UNIT)).astype(np.int64)
            r = self.rank[cur[live]]
            e = np.minimum(np.searchsorted(self.cdf, (r << UNIT) + u, side="right"), self.last[r])
            steps.append((live, e))
            cur[live] = self.src[e]
            live = live[cur[live] != stop[live]]
            k += 1
        edges = np.zeros(n, np.int64)
        for live, _ in steps:
            edges[live] += 1
        ends = np.cumsum(edges)
        seq = np.empty(int(edges.sum()), np.int64)
        for k, (live, e) in enumerate(steps):
            seq[ends[live] - 1 - k] = e
        m = self.n_ids[seq]
        at = np.concatenate(([0], np.cumsum(m)[:-1])) if len(m) else m
        ids = self.ids[np.repeat(self.id_at[seq] - at, m) + np.arange(int(m.sum()))]
        return ids, np.add.reduceat(m, ends - edges) if n else edges


def row_key(value, seed: int) -> int:
    """64-bit key of a row; ints count as they are, anything else by its text."""
    if isinstance(value, int):
        x = value & (2**64 - 1)
    else:
        x = int.from_bytes(hashlib.blake2b(repr(value).encode(), digest_size=8).digest(), "little")
    return int(mix(np.array([x ^ (seed * 0xD6E8FEB86659FD93 & (2**64 - 1))], U64))[0])


def _chunks(text: str, size: int = CHUNK_CHARS):
    """A text in pieces that begin at a word, so that long ones are walked with bounded memory."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut > 0 and text[cut - 1] == " ":
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def encode_texts(model: Model, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in order, number of ids of each)."""
    counts = np.zeros(len(texts), np.int64)
    parts: list[np.ndarray] = []
    pending, owner, base, size = [], [], [], 0
    units_of = [0] * len(texts)

    def flush():
        nonlocal pending, owner, base, size
        flat = list(itertools.chain.from_iterable(pending))
        if flat:
            words = list(dict.fromkeys(flat))
            index = dict(zip(words, range(len(words))))
            word = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
            n = np.array([len(u) for u in pending])
            of = np.repeat(owner, n)
            pos = np.repeat(np.array(base) - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(len(flat))
            key = mix(np.array(keys, U64)[of] + pos.astype(U64) * U64(0xD1B54A32D192ED03))
            ids, m = Lattices(model, words).sample(word, key)
            parts.append(ids)
            np.add.at(counts, of, m)
        pending, owner, base, size = [], [], [], 0

    for t, text in enumerate(texts):
        if not text:
            continue
        for chunk in _chunks(" " + text):
            units = model.unit.findall(chunk)
            pending.append(units), owner.append(t), base.append(units_of[t])
            units_of[t] += len(units)
            size += len(chunk)
            if size >= CHUNK_CHARS:
                flush()
    flush()
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), counts


def decode_ids(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Texts (UTF-8) of piece ids; the blank that encoding put in front goes."""
    n = model.at[ids + 1] - model.at[ids]
    at = np.concatenate(([0], np.cumsum(n)))
    raw = model.bytes[np.repeat(model.at[ids] - at[:-1], n) + np.arange(int(at[-1]))].tobytes()
    cut = at[np.concatenate(([0], np.cumsum(counts)))]
    return [raw[a:b].removeprefix(b" ") for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


_models: dict[tuple, Model] = {}


def model_for(path: str, temperature: float) -> Model:
    """The worker's model; tasks that reuse the worker share it."""
    key = (path, temperature)
    if key not in _models:
        _models.clear()
        _models[key] = Model(path, temperature)
    return _models[key]


def sample_pieces(docs: DataFrame, model_path: str, seed: int = 42, temperature: float = 1.0, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_pieces``, ``piece_ids``, ``lossless`` (decoding gives the text back)."""
    src = docs.select(docs[id_col], docs[text_col])
    id_type = src.schema[id_col].dataType.simpleString()

    def run(batches):
        model = model_for(model_path, temperature)
        for batch in batches:
            for a, b, data, off in segments(batch.column(1), CHUNK_CHARS):
                raw = data.tobytes()
                ids = batch.column(0).slice(a, b - a)
                texts = [raw[x:y] for x, y in zip(off[:-1], off[1:])]
                pieces, counts = encode_texts(model, [t.decode("utf-8", "replace") for t in texts], [row_key(i, seed) for i in ids.to_pylist()])
                lossless = [x == y for x, y in zip(decode_ids(model, pieces, counts), texts)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(pieces, pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(counts), lists, pa.array(lossless, pa.bool_())],
                                                 names=[id_col, "n_pieces", "piece_ids", "lossless"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, n_pieces long, piece_ids array<int>, lossless boolean")


def decode_pieces(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "piece_ids") -> DataFrame:
    """(id, text) of rows of piece ids; null or no ids: empty text."""
    src = encoded.select(encoded[id_col], encoded[ids_col])
    id_type = src.schema[id_col].dataType.simpleString()

    def run(batches):
        model = model_for(model_path, 1.0)
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                x = np.array(ids.as_py() or [], np.int64)
                texts.append(decode_ids(model, x, np.array([len(x)]))[0].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, text string")
