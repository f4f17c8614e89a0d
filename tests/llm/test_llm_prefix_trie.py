"""Prefix trie against a dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie as PT
from tidemark.llm import queries as LQ

from llm_fixtures import shipped  # noqa: F401

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos double, tid int, ids string, id long"


def table(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1.0, 2, "y", 3) for r in rows], SCHEMA)
    return df.repartition(3) if rows else df


def rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs[c].append(((turn is not None, turn or 0), role, digest, (role, text)))
    convs = {c: [x[-1] for x in sorted(t)] for c, t in convs.items()}
    out = {}
    for c, t in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + t[h:]
    return out


def brute(convs):
    nodes = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    kids = defaultdict(int)
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def generated(rng, n, longest, words):
    rows = []
    for c in rng.sample(range(0, 400), n):
        rows += [(c, i, rng.choice(["user", "bot"]), rng.choice(words)) for i in range(rng.choice([1, 2, 3, longest]))]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_query_matches_prefix_dictionary(spark, monkeypatch, seed):
    rng = random.Random(seed)
    rows = generated(rng, 60, 23, ["a", "é", "日本語", "", "long text"])
    rows += [(500, i, "user", "same") for i in range(40)] + [(501, i, "user", "same") for i in range(30)]  # one the start of the other
    rows += [(600, None, None, None), (600, None, "user", "x"), (600, 3, "b", "t"), (600, 3, "a", "t"), (600, 3, "a", "t"), (None, 0, "user", "x")]
    rng.shuffle(rows)
    monkeypatch.setattr(LQ, "read_table", lambda *a: table(spark, rows))
    got = LQ.QUERIES["op11_prefix_trie"](spark, "")
    assert got.columns == COLUMNS
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rebuilt(rows))


def test_copies_and_slices(spark, monkeypatch):
    """Many copies of one conversation; windows and lists cut into slices of a few turns or ids."""
    monkeypatch.setattr(PT, "SLICE", 4)
    rows = [(c, i, "user", f"t{i}") for c in range(1000, 1100) for i in range(3)] + [(7, i, "user", f"t{i % 2}") for i in range(60)]
    turns = PT.turn_rows(table(spark, rows), payload=["role", "text"])
    convs = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        convs.setdefault(c, []).append((role, text))
    sizes = turns.groupBy("conv").count().withColumnRenamed("count", "n_turns")
    for width in (1, 5):
        nodes = PT.prefix_trie(turns, sizes, width=width)
        assert sorted(str(tuple(r)) for r in nodes.select(*COLUMNS).collect()) == brute(convs)
    said = PT.with_last_turn(nodes, turns).collect()
    assert len(said) == nodes.count()
    assert all((r.role, r.text) == (convs[r.conv_id][r.depth - 1] if r.depth else (None, None)) for r in said)


def test_turnless_and_empty(spark, monkeypatch):
    rows = [(c, 0, "user", "x") for c in range(101, 140)]  # no conversation 100: short ones lose all their turns
    monkeypatch.setattr(LQ, "read_table", lambda *a: table(spark, rows))
    got = sorted(str(tuple(r)) for r in LQ.QUERIES["op11_prefix_trie"](spark, "").collect())
    assert got == brute(rebuilt(rows)) and any(not t for t in rebuilt(rows).values())
    monkeypatch.setattr(LQ, "read_table", lambda *a: table(spark, []))
    assert LQ.QUERIES["op11_prefix_trie"](spark, "").collect() == []
    monkeypatch.setattr(LQ, "read_table", lambda *a: table(spark, [(None, 0, "user", "x")]))
    assert LQ.QUERIES["op11_prefix_trie"](spark, "").collect() == []
