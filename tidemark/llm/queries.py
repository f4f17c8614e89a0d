"""Registered queries of the numbered operators: name -> builder, DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from tidemark.session import ship_package
from tidemark.sources.tables import read_table

QUERIES = {}
ORACLE = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def query(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op2_quality_crf")
def op2(spark, sf_dir):
    from tidemark.llm.quality_crf import quality, train_field
    docs = read_table(spark, sf_dir, "documents")
    return quality(docs, train_field(docs, read_table(spark, sf_dir, "labels")))


@register("op3_secret_scan")
def op3(spark, sf_dir):
    from tidemark.llm.secret_scan import scan_secrets
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


@register("op4_token_counts")
def op4(spark, sf_dir):
    import public_tokenizers
    from tidemark.llm.token_count import token_counts
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op5_mixing", r"""
    WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS n, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
                 (SELECT sum(size)::DOUBLE FROM d) AS budget FROM d GROUP BY source),
    l(k, level) AS (SELECT 0, 0.0::DOUBLE
                    UNION ALL SELECT * FROM (SELECT l.k + 1, (any_value(budget) - coalesce(sum(3.0 * n) FILTER (w * level >= 3 * n), 0))
                                                             / nullif(sum(w) FILTER (w * level < 3 * n), 0) AS level
                                             FROM s, l WHERE l.k < 64 GROUP BY l.k, l.level) WHERE level IS NOT NULL),
    t AS (SELECT source, n, least(w * (SELECT max(level) FROM l), 3.0 * n) AS target FROM s),
    q AS (SELECT d.*, t.n AS source_size, t.target,
                 sum(size) OVER (PARTITION BY d.source ORDER BY CAST(('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8)) AS BIGINT), doc_id, size
                                 ROWS UNBOUNDED PRECEDING) AS cum
          FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
    c AS (SELECT *, CASE WHEN size > 0 THEN (cum - size / 2.0 <= target)::INT + (source_size + cum - size / 2.0 <= target)::INT
                                            + (2 * source_size + cum - size / 2.0 <= target)::INT ELSE 0 END AS copies FROM q)
    SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM c""")
def op5(spark, sf_dir):
    from tidemark.llm.mixing import mix_sources
    mixed = mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")


_LINKED = """
    r(a, b) AS (SELECT id, id FROM nodes UNION SELECT r.a, l.b FROM r JOIN links l ON l.a = r.b)"""


@register("op7_minhash_dedup", r"""
    WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                     ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS g FROM w),
    nodes AS (SELECT id, count(s.g) AS n FROM w LEFT JOIN s USING (id) GROUP BY id),
    p AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.g = y.g AND x.id <> y.id GROUP BY ALL),
    links AS MATERIALIZED (SELECT a, b FROM p JOIN nodes AS m ON m.id = a JOIN nodes AS k ON k.id = b WHERE 100 * c >= 85 * (m.n + k.n - c)),"""
          + _LINKED + """
    SELECT id AS doc_id, any_value(n) AS n_shingles, min(b) AS component_id, id = min(b) AS kept FROM nodes JOIN r ON r.a = id GROUP BY id""")
def op7(spark, sf_dir):
    from tidemark.llm.minhash_dedup import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register("op10_embed_dedup", """
    WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
    ok AS (SELECT * FROM nodes WHERE v IS NOT NULL AND label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND list_dot_product(v, v) > 0),
    links AS MATERIALIZED (SELECT x.id AS a, y.id AS b FROM ok AS x JOIN ok AS y ON x.label = y.label AND x.id <> y.id AND len(x.v) = len(y.v)
                           WHERE list_cosine_similarity(x.v, y.v) >= 0.98),"""
          + _LINKED + """
    SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, min(b) AS component_id, id = min(b) AS kept
    FROM nodes JOIN r ON r.a = id GROUP BY id""")
def op10(spark, sf_dir):
    from tidemark.llm.embed_dedup import near_duplicate_vectors
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@register("op1_substring_dedup", r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)),
    f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
    lost AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM g JOIN f USING (g) WHERE first < doc_id),
    l AS (SELECT doc_id, list(i) AS i FROM lost GROUP BY doc_id)
    SELECT w.doc_id, len(w) AS n_words, coalesce(len(l.i), 0) AS n_removed,
           sha256(array_to_string(CASE WHEN l.i IS NULL THEN w ELSE [w[k] for k in range(1, len(w) + 1) if NOT list_contains(l.i, k)] END, ' ')) AS kept_sha256
    FROM w LEFT JOIN l USING (doc_id)""")
def op1(spark, sf_dir):
    from tidemark.llm.substring_dedup import substring_dedup
    found = substring_dedup(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@register("op9_warc_dictionary", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
    h AS (SELECT *, sha1(html) AS x FROM p)
    SELECT page_id, octet_length(encode(html)) AS payload_bytes,
           list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                  1 + CAST((('0x' || substr(x, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31 AS INT), 1)
                           for i in range(0, 32)], 'string_agg', '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM h""")
def op9(spark, sf_dir):
    from tidemark.llm.warc_zstd import archive_and_read
    back = archive_and_read(read_table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_piece_sampling")
def op6(spark, sf_dir):
    import public_tokenizers
    from tidemark.llm.piece_sampling import sample_pieces
    return sample_pieces(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op8_lm_score", r"""
    WITH t AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i
               FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents)),
    g AS (SELECT doc_id, i, w, lag(w) OVER d AS h1, lag(w, 2) OVER d AS h2 FROM t WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
    c1 AS (SELECT w, count(*) AS n FROM t GROUP BY ALL),
    c2 AS (SELECT h1, w, count(*) AS n FROM g WHERE h1 IS NOT NULL GROUP BY ALL),
    c3 AS (SELECT h2, h1, w, count(*) AS n FROM g WHERE h2 IS NOT NULL GROUP BY ALL),
    s AS (SELECT g.doc_id,
                 CASE WHEN c3.n >= 2 THEN ln(c3.n / hh.n)
                      WHEN c2.n >= 2 THEN ln(c2.n / h.n) + (CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END)
                      ELSE ln(c1.n / (SELECT count(*) FROM t)) + least(i - 1, 2) * ln(0.4) END AS s,
                 CASE WHEN c3.n >= 2 THEN 3 WHEN c2.n >= 2 THEN 2 ELSE 1 END AS k
          FROM g JOIN c1 ON c1.w = g.w LEFT JOIN c1 AS h ON h.w = g.h1
          LEFT JOIN c2 ON c2.h1 = g.h1 AND c2.w = g.w LEFT JOIN c2 AS hh ON hh.h1 = g.h2 AND hh.w = g.h1
          LEFT JOIN c3 ON c3.h2 = g.h2 AND c3.h1 = g.h1 AND c3.w = g.w)
    SELECT d.doc_id, count(s.doc_id) AS n_words, coalesce(sum(s.s), 0.0) AS log_score, sum(s.s) / nullif(count(s.doc_id), 0) AS mean_log,
           count(*) FILTER (k = 1) AS n_unigram, count(*) FILTER (k = 2) AS n_bigram, count(*) FILTER (k = 3) AS n_trigram
    FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id""")
def op8(spark, sf_dir):
    from tidemark.llm.lm_score import lm_scores
    scored = lm_scores(read_table(spark, sf_dir, "documents"))
    return scored.select(F.col("id").alias("doc_id"), "n_words", "log_score", "mean_log",
                         *[F.element_at("n_by_order", k).alias(name) for k, name in enumerate(("n_unigram", "n_bigram", "n_trigram"), 1)])


def _crc32(x: str) -> str:
    """DuckDB expression: unsigned crc32 of the decimal digits of ``x`` (bit by bit; a byte enters before its eight steps)."""
    return f"""xor(list_reduce(flatten([[ascii(c), 0, 0, 0, 0, 0, 0, 0]::BIGINT[] for c in string_split({x}::VARCHAR, '')]),
                               lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1)), 4294967295::BIGINT), 4294967295)"""


@register("op11_prefix_trie", rf"""
    WITH t AS (SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS i
               FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT conv_id, list(x ORDER BY i) AS w, {_crc32('conv_id')} % 6 AS h FROM t GROUP BY conv_id),
    c AS (SELECT o.conv_id, coalesce(b.w[1:o.h], []) || o.w[o.h + 1:] AS w FROM o LEFT JOIN o AS b ON b.conv_id = o.conv_id - o.conv_id % 100),
    p AS (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM c),
    n AS (SELECT d, w[1:d] AS k, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(w) = d) AS ends
          FROM p GROUP BY ALL),
    u AS (SELECT d, n_convs, k, CASE WHEN d > 0 THEN (n_convs - 1) * length(k[d].t) ELSE 0 END AS saved,
                 NOT EXISTS (SELECT 1 FROM n AS m WHERE m.d = n.d + 1 AND m.k[1:n.d] = n.k) AS leaf FROM n),
    s AS (SELECT d, k, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves
          FROM (SELECT a AS d, k[1:a] AS k, saved, leaf FROM (SELECT k, saved, leaf, unnest(range(0, d + 1)) AS a FROM u)) GROUP BY ALL),
    m AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL)
    SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(m.n, 0) AS n_children, s.leaves AS n_leaves,
           s.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
    FROM n JOIN s ON s.d = n.d AND s.k = n.k LEFT JOIN m ON m.d = n.d AND m.k = n.k LEFT JOIN n AS q ON q.d = n.d - 1 AND q.k = n.k[1:n.d - 1]""")
def op11(spark, sf_dir):
    from tidemark.llm.prefix_trie import prefix_trie, turn_rows, with_shared_heads
    nodes = prefix_trie(*with_shared_heads(turn_rows(read_table(spark, sf_dir, "conversations"))))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@register("op12_periodic_runs", rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc32('doc_id')} AS h FROM documents),
    x AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g FROM d),
    t AS (SELECT doc_id, n, CASE WHEN planted
                                 THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] for i in range(0, n)]
                                 ELSE w END AS w FROM x),
    u AS (SELECT doc_id, n, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM t),
    p AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM u AS l JOIN u AS r ON l.doc_id = r.doc_id AND l.w = r.w AND r.i > l.i AND 3 * (r.i - l.i) <= l.n),
    c AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM p)
          GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(24, 3 * q)),
    r AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS o WHERE o.doc_id = c.doc_id AND o.q < c.q AND o.s <= c.s AND o.s + o.l >= c.s + c.l)),
    b AS (SELECT doc_id, count(*) AS n_runs, first({{'s': s, 'l': l, 'q': q}} ORDER BY l / q::DOUBLE DESC, s, q) AS best,
                 sha256(string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256 FROM r GROUP BY doc_id),
    lost AS (SELECT doc_id, list(DISTINCT i) AS i FROM (SELECT doc_id, unnest(range(s + q, s + l)) AS i FROM r) GROUP BY doc_id)
    SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period, 1000 * best.l // best.q AS exponent_milli,
           coalesce(runs_sha256, sha256('')) AS runs_sha256,
           sha256(array_to_string(CASE WHEN lost.i IS NULL THEN w ELSE [w[k] for k in range(1, n + 1) if NOT list_contains(lost.i, k - 1)] END, ' ')) AS collapsed_sha256
    FROM t LEFT JOIN b USING (doc_id) LEFT JOIN lost USING (doc_id)""")
def op12(spark, sf_dir):
    from tidemark.llm.periodic_runs import collapse_runs
    found = collapse_runs(read_table(spark, sf_dir, "documents"), plant=True)

    def better(best, r):  # exact comparison of length / period; runs come by start, then period
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), better)
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@register("op13_toxicity")
def op13(spark, sf_dir):
    from tidemark.llm.toxicity import toxicity, train_toxicity
    docs = read_table(spark, sf_dir, "documents")
    model = train_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


@register("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
