"""Word handling, quality field, secrets, token counts, piece sampling against plain versions."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import piece_sampling as PS
from tidemark.llm import quality_crf as Q
from tidemark.llm import secret_scan as SS
from tidemark.llm import token_count as TC
from tidemark.llm import words as W
from tidemark.sources.tables import read_table

from llm_fixtures import SF_MID, SF_SMALL, make_docs, shipped  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXT = st.text(alphabet=st.sampled_from("ab É漢😀▁\x85\x1c\xa0　\n\t .,'5<|>"), max_size=60)
ODD = [None, "", " ", "\n\n", "a", "a  b\n\nc\t d ", "é漢 x\x85y\xa0z", "<|endoftext|> a<|endoftext|>b", "it's 'sa 5x", "▁ ▁x", "word " * 3000, "x" * 40000]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6), st.integers(1, 40))
def test_words_and_windows(texts, limit):
    got, grams = [], []
    for _, _, data, off in W.segments(pa.array(texts, pa.string()), limit):
        s, e, first = W.word_spans(data, off)
        raw = data.tobytes()
        h = W.span_hashes(data, s, e)
        ok = W.within(first, 3)
        for a, b in zip(first[:-1], first[1:]):
            got.append([raw[x:y].decode() for x, y in zip(s[a:b], e[a:b])])
            grams.append(int(ok[a:b].sum()))
            assert len(set(h[a:b].tolist())) == len(set(got[-1]))
    assert got == [WORD.findall(t) for t in texts]
    assert grams == [max(0, len(g) - 2) for g in got]


def test_long_windows_equal_short_formula():
    h = W.mix(np.arange(500, dtype=np.uint64) % 7)
    g = W.ngram_hashes(h, 50)
    assert len(set(g.tolist())) == len({tuple(h[i:i + 50].tolist()) for i in range(451)})


def plain_base(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é|\n"), max_size=150), max_size=5))
def test_base_counts(texts):
    for a, b, data, off in W.segments(pa.array(texts, pa.string()), 100):
        m = Q.measure(data, off)
        got = list(zip(m.n_words.tolist(), m.word_chars.tolist(), m.n_symbols.tolist(), m.n_dup_lines.tolist(), m.n_repeat_words.tolist()))
        assert got == [plain_base(t) for t in texts[a:b]]


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(1, 8))
        crf = Q.Field(rng.normal(size=Q.N_FEATURES), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, Q.N_FEATURES))

        def value(s):
            return sum(x[i] @ crf.weights for i in range(n) if s[i]) + sum(crf.trans[a, b] for a, b in zip(s, s[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert tuple(crf.viterbi(x, np.array([0, n]))) == best


def test_quality_holds_out_and_takes_any_input(spark, make_docs):
    docs, labels = read_table(spark, SF_MID, "documents"), read_table(spark, SF_MID, "labels")
    crf = Q.train_field(docs.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 0"))
    held = Q.quality(docs, crf).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").select("kept", "quality").collect()
    assert held and np.mean([r.kept == (r.quality == 1) for r in held]) > 0.97
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, "a b"), (None, "c d")]
    got = Q.quality(make_docs(rows), crf).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t in rows)
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 20)
    assert Q.quality(make_docs([]), crf).collect() == []
    none = Q.train_field(docs.limit(0), labels.limit(0))
    assert Q.quality(docs, none).filter("kept = base_failed").count() == 0
    kept = Q.keep_quality(docs, crf)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in Q.quality(docs, crf).filter("kept").select("doc_id").collect()}


def test_entropy_is_incremental():
    s = "aZ09bbQx7812aaaaZZ"
    for w in (1, 4, 9):
        plain = [-sum(k / w * math.log2(k / w) for k in Counter(s[i:i + w]).values()) for i in range(len(s) - w + 1)]
        assert np.allclose(SS.window_entropies(s, w), plain)


def test_secrets(spark, make_docs):
    scan = SS.Scanner().scan
    assert scan("é PassWord = 'hunter22' x") == [("assign", 2, 22)]
    assert scan("token=abc") == [] and scan("ſecret=abcdef") == []
    assert scan("password=password=a") == [("assign", 0, 19)]
    assert scan("AKIA" + "A" * 15) == [] and [k for k, _, _ in scan("AKIA" + "ABCD1234EFGH5678")] == ["access"]
    assert [x[0] for x in scan("id " + "0f" * 12)] == ["hex"] and scan("0f" * 11) == []
    key = "kR7mZq2Xv9TbL4nWc8Yp3HsD"
    assert [k for k, _, _ in scan("see " + key)] == ["entropy_alnum"]
    assert scan("see " + key + "example") == [] and scan("123e4567-e89b-12d3-a456-426614174000") == []
    assert scan("secret: " + key) == [("assign", 0, 8 + len(key))]
    assert scan("thationthshouentederblesntthatlying of") == []
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, "a token=abcdefg b"), (50, "a token=abcdefg b"), (None, "AKIA" + "Q1" * 9)]
    got = SS.scan_secrets(make_docs(rows)).collect()
    assert len(got) == len(rows) and sum(len(r.spans) for r in got) == 3
    assert {r.redacted for r in got if r.doc_id == 50} == {"a <assign> b"}
    assert SS.scan_secrets(make_docs([])).collect() == []
    out = SS.redact_secrets(make_docs(rows).withColumn("n_chars", F.length("text")))
    assert out.filter("n_chars <> length(text)").count() == 0 and out.count() == len(rows)


def test_entropy_finds_random_secrets_of_every_class():
    scan = SS.Scanner().scan
    rng = random.Random(7)
    upper, lower, digits = (bytes(range(a, a + n)).decode() for a, n in ((65, 26), (97, 26), (48, 10)))
    for alphabet in (upper + lower, upper + lower + digits, upper + lower + digits + "+/", upper + "234567", lower + digits):
        for n in (20, 24, 32, 40):
            keys = ["".join(rng.choices(alphabet, k=n)) for _ in range(300)]
            assert sum(bool(scan(f"see {k} now")) for k in keys) >= 255  # 85%
    key = "kR7mZq2Xv9TbL4nWc8Yp3HsD"
    for before in ("sample_key=", "samples/", "see my-example-", "dummy=x_", "docs/" + "some/longer/path/of/words/" * 8):
        found = scan(before + key)
        assert found and found[0][1] <= len(before) and found[-1][2] == len(before) + len(key)
    assert scan("sample_key=" + key) == [("entropy_alnum", 11, 35)] and scan("samples/" + key) == [("entropy_alnum", 8, 32)]
    for plain in ("getElementsByTagNameFromDocument", "articles/2023/12/05/introduction-to-something", "INTERNATIONALIZATION", "2023-12-05-2024-01-07-00-00",
                  "id=123e4567-e89b-12d3-a456-426614174000", "=" * 60, "a_very_long_name_of_a_variable_2", "some/longer/path/of/words/" * 8):
        assert scan("see " + plain) == []


def test_base_spans_equal_plain_patterns(spark):
    letters = "".join
    word = "|".join(letters(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_", "apikey"))
    assign = re.compile(f"({word.replace('[Aa][Pp][Ii]_|[Aa][Pp][Ii][Kk][Ee][Yy]', '[Aa][Pp][Ii]_?[Kk][Ee][Yy]')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    texts = {r.doc_id: r.text for r in read_table(spark, SF_SMALL, "documents").collect()}
    for r in SS.scan_secrets(read_table(spark, SF_SMALL, "documents")).collect():
        t = texts[r.doc_id]
        want = [("assign", *m.span()) for m in assign.finditer(t) if len(m[2]) >= 6]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert {tuple(s) for s in r.spans if s.kind in ("assign", "access", "hex")} == set(want)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_pieces_add_up(text):
    t = Tokenizer.from_file(BPE)
    assert "".join(TC.safe_pieces(text)) == text
    assert sum(len(t.encode(p, add_special_tokens=False).ids) for p in TC.safe_pieces(text)) == len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, make_docs, name):
    path = public_tokenizers.path(name)
    if name == "word_bpe_49k.json":
        count = TC.Lengths(path).count  # a normaliser trims blanks: pieces count alike
        t = Tokenizer.from_file(path)
        assert count(["a b\nc d", "Hello, World"]) == [len(t.encode(x, add_special_tokens=False).ids) for x in ("a b\nc d", "Hello, World")]
        return
    if name.endswith(".json"):
        t = Tokenizer.from_file(path)
        size = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    else:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lambda x: len(sp.encode(x))
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (None, "x y")]
    got = TC.token_counts(make_docs(rows), path, batch_bytes=64).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == Counter(
        (i, len((t or "").encode()), size(t or ""), size(t or "") > 1024) for i, t in rows)
    assert TC.token_counts(make_docs([]), path).collect() == []


def test_known_table_is_bounded():
    small = TC.Lengths(BPE, known_bytes=2000)
    assert small.count([f"w{i} x" for i in range(500)]) == TC.Lengths(BPE).count([f"w{i} x" for i in range(500)])
    assert small.size <= 2000 and len(small.known) < 20


@pytest.fixture(scope="module")
def model():
    return PS.Model(PIECES)


@settings(max_examples=80, deadline=None)
@given(st.lists(TEXT, max_size=5), st.integers(0, 5))
def test_pieces_round_trip(model, texts, seed):
    ids, n = PS.encode_texts(model, texts, [PS.row_key(i, seed) for i in range(len(texts))])
    assert [b.decode() for b in PS.decode_ids(model, ids, n)] == texts
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    at = 0
    for t, k in zip(texts, n):
        if "▁" not in t:  # the library reads its blank mark as a blank
            assert sp.decode(ids[at:at + k].tolist()) == t
        at += k


def test_sampling_follows_the_lattice(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    paths = {}

    def walk(rest, ids):
        if not rest:
            paths[tuple(ids)] = math.exp(sum(model.weight[i] for i in ids))
        for k in range(1, len(rest) + 1):
            i = sp.piece_to_id(rest[:k])
            if i > 258 and sp.id_to_piece(i) == rest[:k]:
                walk(rest[k:], [*ids, i])

    walk("▁there", [])
    n = 20000
    ids, count = PS.encode_texts(model, ["there"] * n, [PS.row_key(i, 3) for i in range(n)])
    seen, at = Counter(), 0
    for k in count:
        seen[tuple(ids[at:at + k].tolist())] += 1
        at += k
    total = sum(paths.values())
    assert set(seen) <= set(paths) and max(abs(seen[p] / n - v / total) for p, v in paths.items()) < 0.01


def test_sampling_query_is_reproducible(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(4, "a"), (None, "b c"), (99, "the same words again " * 50)]
    one = PS.sample_pieces(make_docs(rows, 1), PIECES).collect()
    two = PS.sample_pieces(make_docs(rows, 4), PIECES).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.piece_ids)
    assert sorted(one, key=key) == sorted(two, key=key) and all(r.lossless for r in one)
    other = PS.sample_pieces(make_docs(rows), PIECES, seed=1).filter("doc_id = 99").first()
    assert other.piece_ids != next(r.piece_ids for r in one if r.doc_id == 99)
    back = {r.doc_id: r.text for r in PS.decode_pieces(spark.createDataFrame([(r.doc_id, r.piece_ids) for r in one if r.doc_id], "doc_id long, piece_ids array<int>"), PIECES).collect()}
    assert all(back[i] == (t or "") for i, t in rows[1:len(ODD)])
    assert PS.sample_pieces(make_docs([]), PIECES).collect() == []


def test_long_texts_are_walked_in_chunks(model, monkeypatch):
    text = "some words here and  there\n" * 200
    whole = PS.encode_texts(model, [text], [5])[0].tolist()
    monkeypatch.setattr(PS, "CHUNK_CHARS", 100)
    monkeypatch.setattr(PS._chunks, "__defaults__", (100,))
    assert PS.encode_texts(model, [text], [5])[0].tolist() == whole


def test_batches_are_balanced_by_bytes():
    from tidemark.llm.token_count import byte_batches, n_bytes
    pieces = ["日本語"] * 50 + ["abc"] * 50 + ["é" * 30, "x" * 500]
    batches = list(byte_batches(pieces, 90))
    assert [p for b in batches for p in b] == pieces
    assert all(sum(len(p.encode()) for p in b) <= 90 or len(b) == 1 for b in batches)
    assert n_bytes("日本語") == 9 and n_bytes("") == 0
