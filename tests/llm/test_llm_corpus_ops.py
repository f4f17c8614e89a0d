"""Dedup, mixing, language model, archives, vectors and the pipeline against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline as CP
from tidemark.llm import embed_dedup as ED
from tidemark.llm import lm_score as LM
from tidemark.llm import minhash_dedup as MH
from tidemark.llm import mixing as MX
from tidemark.llm import queries as LQ
from tidemark.llm import recompression as RC
from tidemark.llm import substring_dedup as SD
from tidemark.llm import warc_zstd as WZ
from tidemark.llm import words as W
from tidemark.llm.components import connected_components
from tidemark.sources.tables import read_table

from llm_fixtures import SF_SMALL, make_docs, shipped  # noqa: F401
from check_oracle import compare, duck  # noqa: E402  (its folder is put on the path by the fixtures)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(LQ.ORACLE))
def test_llm_query_matches_oracle(spark, name):
    info = compare(spark, duck(SF_SMALL), name, LQ.QUERIES[name], LQ.ORACLE[name], SF_SMALL)
    assert info["ok"], info


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(120)]
    links += [(5, 5), (None, 3), (139, 101)]
    df = spark.createDataFrame(links, "x long, y long")
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = groups({x for e in real for x in e}, real)
    assert {r.node: r.component for r in connected_components(df).collect()} == want
    assert connected_components(df.limit(0)).collect() == []


# substring dedup

def plain_removed(texts, window):
    ws = [(i, WORD.findall(t or "")) for i, t in texts]
    first = {}
    for i, w in ws:
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k:k + window])
                first[g] = min(i, first.get(g, i))
    out = []
    for i, w in ws:
        gone = {j for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k:k + window])] < i for j in range(k, k + window)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return Counter(out)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("ab"), min_size=30, max_size=60), st.lists(st.sampled_from("abc"), max_size=20), st.lists(st.sampled_from("abc"), max_size=20),
       st.lists(st.sampled_from("abc"), max_size=20))
def test_equal_stretches_have_equal_interiors(mid, left, right, other):
    """Symbols that depend on a stretch only occur wherever the stretch does."""
    def symbols(words, at):
        h = W.mix(np.array([ord(c) for c in words], np.uint64))
        out = []
        for p in RC.parse(h, np.array([0, len(h)])):
            ok = (p.dl >= at) & (p.dr <= at + len(mid))
            out.append(list(zip(p.name[ok].tolist(), (p.a[ok] - at).tolist(), (p.b[ok] - at).tolist())))
        return out

    assert symbols(left + mid + right, len(left)) == symbols(other + mid + left, len(other)) or not (left and right and other)


def test_substring_dedup_equals_brute_force(spark, make_docs):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)] + ["x"] * 20
    passage = [rng.choice(vocab) for _ in range(30)]
    texts = []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        kind = rng.randrange(6)
        if kind == 0:
            w[rng.randrange(len(w) + 1):0] = passage[rng.randrange(8):rng.randrange(20, 30)]
        elif kind == 1 and texts:
            w = WORD.findall(rng.choice(texts)[1] or "")
        elif kind == 2:
            w = ["r"] * rng.randrange(5, 60)
        elif kind == 3:
            w += ["p", "q"] * rng.randrange(3, 20)
        texts.append((i, " \n".join(w)))
    texts += [(3, texts[3][1]), (None, texts[4][1]), (70, None), (71, ""), (72, "x " * 3000), (73, "x " * 3000), (-1, " ".join(passage))]
    for window in (6, 12):
        got = Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in SD.substring_dedup(make_docs(texts), window).collect())
        assert got == plain_removed(texts, window)
    spans = SD.substring_dedup(make_docs(texts), 6).collect()
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in spans)
    assert SD.substring_dedup(make_docs([])).collect() == []


# mixing

def test_targets_are_filled_by_weight(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 50), ("é", 3), (None, 400), ("z", 0)]
    df = spark.createDataFrame(sizes, "source string, size long")
    ranked = MX.ranked_sources(df, (1, 2, 3))
    assert {r.source: r.weight for r in ranked.collect()} == {"a": 1, "b": 2, "c": 3, "z": 1, "é": 2, None: 3}
    total = sum(n for _, n in sizes)
    got = {r.source: r.target for r in MX.source_targets(ranked, total, 3).collect()}
    want, left, open_ = {}, float(total), {s: w for s, w in (("a", 1), ("b", 2), ("c", 3), ("z", 1), ("é", 2), (None, 3))}
    size = dict(sizes)
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * level >= 3 * size[s]]
        if not full:
            want.update({s: w * level for s, w in open_.items()})
            break
        for s in full:
            want[s] = 3.0 * size[s]
            left -= want[s]
            del open_[s]
    assert got == pytest.approx(want)


def brute_mix(rows):
    """Copies of every row, by serving each source's documents in turn until less than half of the next is due."""
    sizes = [(i, len(WORD.findall(t or "")), s) for i, t, s in rows]
    per = defaultdict(int)
    for _, n, s in sizes:
        per[s] += n
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    left, open_, target = float(sum(per.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 3 * per[s]}
        if not full:
            target.update({s: weight[s] * level for s in open_})
            break
        for s in full:
            target[s] = 3.0 * per[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    out = []
    for s in names:
        draw = lambda i: int(hashlib.md5(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        queue = sorted(((draw(i), (i is not None, i or 0), n, i) for i, n, x in sizes if x == s))
        copies, served = [0] * len(queue), 0
        for _ in range(3):
            for k, (_, _, n, _) in enumerate(queue):
                if n and served + n / 2 <= target[s]:
                    copies[k] += 1
                served += n
        out += [(i, s, n, c) for (_, _, n, i), c in zip(queue, copies)]
    return sorted(out, key=repr), target


def mix_rows():
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(0, 30), rng.choice(["a"] * 6 + ["b", "c", None])) for i in range(900)]
    return rows + [(None, "x y", "b"), (None, "x y", "b"), (5, "q", "a"), (5, None, "a"), (7, "w " * 9, "b"), (7, "w " * 9, "b"), (7, "w " * 9, "b"), (2000, "v " * 4000, "c")]


def test_mix_equals_serving_in_turn(spark, make_docs):
    rows = mix_rows()
    want, target = brute_mix(rows)
    for partitions in (2, 5):
        got = MX.mix_sources(make_docs(rows, partitions)).collect()
        assert sorted(((r.id, r.source, r.size, r.copies) for r in got), key=repr) == want
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.taken == r.copies * r.size <= 3 * r.size and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in target)
    assert MX.mix_sources(make_docs([])).collect() == []


def test_mix_of_one_long_and_one_short_text(spark, make_docs):
    got = {r.source: r for r in MX.mix_sources(make_docs([(1, "w " * 1000, "a"), (2, "w " * 10, "b")])).collect()}
    assert got["a"].taken == 1000 and got["b"].taken == 30  # targets 980 and 30


def test_given_sources_are_near_their_targets(spark):
    rows = LQ.QUERIES["op5_mixing"](spark, "/root/testdata/sf0.01").collect()
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        taken[r.source, r.target] += r.taken
        largest[r.source, r.target] = max(largest[r.source, r.target], r.size)
    assert all(abs(n - target) <= largest[s, target] / 2 for (s, target), n in taken.items())


def test_mixed_documents_repeat_rows_as_scheduled(spark, make_docs):
    rows = mix_rows()
    docs = make_docs(rows).withColumn("_copies", F.lit(1)).withColumn("row", F.lit("r")).withColumn("finish", F.lit(0.5)).withColumn("text_hash", F.lit(1))
    out = MX.mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    words = {}
    for i, t, s in rows:
        words[i, len(WORD.findall(t or "")), s] = t
    want = Counter()
    for i, s, n, c in brute_mix(rows)[0]:
        want[i, words[i, n, s], s] += c
    assert got == +want
    assert MX.mixed_documents(make_docs([])).collect() == []


# near duplicates

def shingles(text):
    w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def near_rows(seed, n=240):
    rng = random.Random(seed)
    rows = []
    base = [[f"t{rng.randrange(400)}" for _ in range(rng.choice((4, 30, 80, 200)))] for _ in range(12)]
    for i in range(n):
        w = list(rng.choice(base[:2] * 6 + base))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
            w[rng.randrange(len(w))] = f"u{rng.randrange(10 ** 6)}"
        rows.append((i, (" " if rng.random() < 0.5 else "\n").join(x.upper() if rng.random() < 0.2 else x for x in w)))
    return rows


@pytest.mark.parametrize("block", [8, 256])
def test_near_duplicates_equal_brute_force(spark, make_docs, block):
    rows = near_rows(block) + [(900, None), (901, " "), (902, "one two"), (903, "One  two"), (904, "One tWo three"), (10, "one two")]
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 100 * len(x & y) >= 85 * len(x | y)]
    want = groups({i for i, _ in rows}, [e for e in links if e[0] != e[1]])
    got = MH.near_duplicates(make_docs([*rows, (None, rows[0][1])]), block=block).collect()
    assert Counter((r.id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(
        [(i, len(s), want[i], want[i] == i) for i, s in sets] + [(None, len(sets[0][1]), None, True)])
    assert MH.near_duplicates(make_docs([])).collect() == []


def test_blocks_join_whole_groups():
    sets = [np.sort(W.mix(np.array([*range(20), 100 + i], np.uint64))) for i in range(10)]
    assert len(MH.joining_links(list(range(10)), list(range(10)), [0] * 10, sets, 85)) == 9
    assert len(MH.joining_links(list(range(10)), [0] * 10, [0] * 10, sets, 85)) == 0
    across = MH.joining_links(list(range(10)), list(range(10)), [0] * 5 + [1] * 5, sets, 85)
    assert len(across) == 9 and all(a < 5 <= b for a, b in across)


@pytest.mark.parametrize("partitions", [1, 5])
def test_pipeline_stage_links_from_80_percent(spark, make_docs, partitions):
    rng = random.Random(partitions)
    rows = near_rows(80)
    for k in range(60):  # 100 shingles, n of them replaced at the end: similarity (100 - n) / (100 + n)
        w = [f"w{k}x{i}" for i in range(104)]
        rows += [(2000 + 2 * k, " ".join(w)), (2001 + 2 * k, " ".join(w[:104 - (n := rng.choice((8, 9, 10, 11, 11, 12)))] + [f"v{k}x{i}" for i in range(n)]))]
    sets = {i: shingles(t) for i, t in rows}
    near = [(a, b, 100 * len(sets[a] & sets[b]) / len(sets[a] | sets[b])) for a in sets for b in sets if a < b and sets[a] & sets[b]]
    comp = groups(sets, [(a, b) for a, b, s in near if s >= 80])
    assert comp != groups(sets, [(a, b) for a, b, s in near if s >= 85])
    kept = CP.near_duplicates(spark, make_docs(rows, partitions), SF_SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in sets if comp[i] == i)


def test_stage_bands_miss_less_than_one_in_a_million():
    # one permutation gives two values of a band: its smallest and its largest
    for union in range(5, 2000):
        common = -(-MH.STAGE_PERCENT * union // 100)
        both = common / union * (common - 1) / (union - 1)
        assert (1 - both ** (MH.STAGE_ROWS // 2)) ** MH.STAGE_BANDS < 1e-6


def test_min_max_bands_find_similar_sets():
    rng = np.random.default_rng(0)
    missed = 0
    for _ in range(60):
        x = rng.integers(0, 1 << 62, 200).astype(np.uint64)
        y = np.concatenate((x[15:], rng.integers(0, 1 << 62, 15).astype(np.uint64)))  # similarity 0.86
        a, b = MH.min_max_bands([x, y])
        missed += not (a == b).any()
    assert missed == 0


# language model

def plain_scores(texts, order, least, backoff):
    words = [WORD.findall(t or "") for _, t in texts]
    c = Counter(tuple(w[i:i + n]) for w in words for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, words))
    out = []
    for w in words:
        s = 0.0
        for i in range(len(w)):
            k = min(i, order - 1)
            drop = 0
            while k and c[tuple(w[i - k:i + 1])] < least:
                k, drop = k - 1, drop + 1
            s += math.log(c[tuple(w[i - k:i + 1])] / (c[tuple(w[i - k:i])] if k else total)) + drop * math.log(backoff)
        out.append(s)
    return out


@pytest.mark.parametrize("order", [1, 2, 4])
def test_stupid_backoff_equals_brute_force(spark, make_docs, order):
    rng = random.Random(order)
    texts = [(i, " ".join(rng.choice("abcdefg") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 40)))) for i in range(50)] + [(60, None), (61, ""), (1, "a b"), (None, "a b c a b c")]
    got = LM.lm_scores(make_docs(texts), order=order, batch_bytes=300, range_grams=100).collect()
    want = Counter((i, len(WORD.findall(t or "")), round(s, 6)) for (i, t), s in zip(texts, plain_scores(texts, order, 2, 0.4)))
    assert Counter((r.id, r.n_words, round(r.log_score, 6)) for r in got) == want
    assert all(sum(r.n_by_order) == r.n_words and (r.mean_log is None) == (r.n_words == 0) for r in got)
    assert LM.lm_scores(make_docs([])).collect() == []


# archives

def test_archive_round_trip(spark):
    rows = [(1, "u", "x"), (2, None, None), (3, "a b", "x"), (4, "é", ""), (None, "n", "x"), (1, "u", "x"), (5, "z", "y\r\n\r\nq"), (None, "q", "only"), (6, "l", "<p>long</p>" * 50000)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, k string, refers_to int")
    got = WZ.archive_and_read(df).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got) == Counter(
        [(1, "response", None, 1)] * 2 + [(2, "response", None, 0), (3, "revisit", 1, 1), (4, "revisit", 2, 0), (None, "revisit", 1, 1), (5, "response", None, 6),
                                          (None, "response", None, 4), (6, "response", None, 550000)])
    assert {bytes(r.payload).decode() for r in got if r.payload is not None} == {"x", "", "y\r\n\r\nq", "only", "<p>long</p>" * 50000}
    assert all(r.record_type == "response" for r in WZ.archive_and_read(df, min_payload=2).collect() if r.payload_bytes < 2)
    assert WZ.archive_and_read(df.limit(0)).collect() == []


def test_archive_layout():
    records = [WZ.build_record(i, "http://a/", (f"<p>{i % 7} shared text of pages</p>" * 60).encode(), "D", None, "2000-01-01T00:00:00Z") for i in range(400)]
    frames = list(WZ.archive_frames(iter(records), "2000-01-01T00:00:00Z"))
    assert frames[0][:4] == WZ.DICT_MAGIC and len(frames) == len(records) + 2
    data = WZ.SEPARATOR.encode().join(frames) + WZ.SEPARATOR.encode()
    assert [block for _, block in WZ.read_archive(data)][1:] == [r.split(b"\r\n\r\n", 1)[1][:-4] for r in records]
    alone = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(frames[0][8:])).decompress(frames[9])
    assert alone == records[7]  # any record can be read with the dictionary and its own frame
    broken = bytearray(data)
    broken[len(data) - len(WZ.SEPARATOR) - 8] ^= 255  # in the last record
    with pytest.raises(Exception):
        list(WZ.read_archive(bytes(broken)))


# vectors

def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(600):
        v = centres[i % 6] + rng.normal(size=12) * (0.05 if i % 3 else 0.6)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(0, 2)) if i % 50 else None))
    rows += [(700 + i, rows[1][1], rows[1][2]) for i in range(30)] + [(800, [2 * x for x in rows[1][1]], rows[1][2])]
    rows += [(900, None, 0), (901, [0.0] * 12, 0), (902, [1.0, None] + [1.0] * 10, 0), (903, [float("nan")] * 12, 0), (904, [1.0, 2.0], 0), (905, [2.0, 4.0], 0), (906, [float("inf")] * 12, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, id string").repartition(4)

    def good(v):
        return v is not None and None not in v and np.isfinite(v).all() and np.any(v)

    links = []
    for k, (i, v, a) in enumerate(rows):
        for j, w, b in rows[:k]:
            if a is not None and a == b and good(v) and good(w) and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                    links.append((i, j))
    deg = Counter(x for e in links for x in e)
    comp = groups({r[0] for r in rows}, links)
    assert len(links) > 500
    for block in (16, 2048):
        got = ED.near_duplicate_vectors(df, block=block, max_sample=300, subspaces=4).collect()
        assert {r.id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (deg[i], comp[i], comp[i] == i) for i, _, _ in rows}
    nulls = spark.createDataFrame([(None, [1.0, 0.0], 1, "x"), (4, [1.0, 0.0], 1, "x")], df.schema)
    assert {(r.id, r.n_links, r.component_id, r.kept) for r in ED.near_duplicate_vectors(nulls).collect()} == {(None, 0, None, True), (4, 0, 4, True)}
    assert ED.near_duplicate_vectors(df.limit(0)).collect() == []


# pipeline

def test_stage_keeps_one_of_repeated_rows(spark, make_docs):
    t, u = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(1, t), (1, t), (None, t), (None, t), (5, t), (None, u), (None, u), (8, None), (8, None), (None, ""), (9, u + " x"), (9, "other words entirely here now")]
    docs = make_docs(rows).withColumn("row", F.lit(1)).withColumn("d1", F.lit(2)).withColumn("rep", F.lit("z"))
    out = MH.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got == Counter({(1, t): 1, (None, u): 1, (8, None): 2, (None, ""): 1, (9, u + " x"): 1, (9, "other words entirely here now"): 1})
    copies = MH.drop_near_duplicates(make_docs([(None, t)] * 30 + [(3, u)] * 20)).collect()
    assert Counter((r.doc_id, r.text) for r in copies) == Counter({(None, t): 1, (3, u): 1})


def odd_rows():
    base = [" ".join(f"{a}{i}" for i in range(30)) for a in "abc"]
    rows = [(i, base[i % 3] + (f" extra{i}" if i % 5 == 0 else ""), "s1" if i % 2 else "s2") for i in range(30)]
    return rows + [(None, base[0], None), (None, None, "s1"), (3, base[0], "s1"), (3, base[0], "s1"), (40, "", "s1"), (41, None, None), (42, "\n\t", "s2"), (43, "w " * 30_000, "s2")]


def test_pipeline_on_odd_rows(spark, make_docs, monkeypatch, tmp_path):
    """Null ids, repeated rows, empty and very long texts, clashing columns, empty tables: every stage, and run()."""
    for rows in (odd_rows(), []):
        docs = make_docs(rows).withColumn("lang", F.lit("en")).withColumn("n_chars", F.lit(1).cast("long"))
        docs.write.parquet(f"{tmp_path}/{len(rows)}/documents.parquet")
        spark.createDataFrame([(i, int(i < 20), 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{len(rows)}/labels.parquet")
        at = docs
        for name, stage in CP.STAGES:
            out = stage(spark, at, f"{tmp_path}/{len(rows)}")
            assert name == "pieces" or out.columns == docs.columns, name
            n = at.count()
            assert name == "source mix" or out.count() <= n
            at = out
        assert CP.run(spark, f"{tmp_path}/{len(rows)}").count() == at.count()


def test_pipeline_stages(spark):
    from tidemark.llm.quality_crf import quality, train_field
    docs = read_table(spark, SF_SMALL, "documents")
    labels = read_table(spark, SF_SMALL, "labels")
    kept = CP.STAGES[0][1](spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    good = {r.doc_id for r in quality(docs, train_field(docs, labels)).filter("kept").collect()}
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert set(texts) == good
    for i, t in texts.items():
        w = WORD.findall(t)
        assert len(w) >= 20
    once = CP.STAGES[1][1](spark, kept, SF_SMALL)
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = groups(sets, links)
    assert {r.doc_id for r in once.collect()} == {i for i in sets if comp[i] == i}
    clean = CP.STAGES[2][1](spark, once, SF_SMALL)
    assert clean.columns == docs.columns and clean.count() == once.count()
    assert clean.filter(F.col("text").rlike("AKIA[A-Z0-9]{16}|[0-9a-f]{24}")).count() == 0
    mixed = CP.STAGES[3][1](spark, clean, SF_SMALL)
    assert mixed.columns == docs.columns
    last = CP.STAGES[4][1](spark, mixed, SF_SMALL)
    assert last.count() == mixed.count() and last.filter("not lossless").count() == 0
    first = CP.run(spark, SF_SMALL)
    assert sorted((r.doc_id, r.n_pieces) for r in first.collect()) == sorted((r.doc_id, r.n_pieces) for r in last.collect())
    assert CP.ORACLE_SQL is None and 4 <= len(CP.STAGES) <= 5
