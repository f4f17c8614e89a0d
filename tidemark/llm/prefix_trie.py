"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

Two conversations share a node of depth ``d`` when their first ``d`` turns (role
and text) are equal.  A turn is known by its 128-bit digest; texts do not travel.

1. The turns of a conversation are cut into blocks of ``width`` positional
   columns.  A block is keyed by the node that the block before it ended in:
   the running exclusive-or of position-dependent 64-bit hashes (two of them).
   So blocks of a conversation of any length are aggregated at the same time.
2. ``GROUP BY block key, ROLLUP (t0, t1, ...)`` gives a row per prefix;
   ``grouping_id`` tells its depth.  A first pass names the nodes by their
   smallest conversation.  The nodes that a conversation names are the last
   ones of its path, so each conversation's share of all nodes, their code
   points and leaves, are conversation-level numbers.
3. A second ROLLUP sums those numbers over the members of every prefix, which
   yields sums over subtrees without walking the tree level by level.
4. Only nodes where a conversation branches off look up their parent; all
   others are named by the same conversation as their parent.

A conversation with a third of all turns is spread over its blocks, a prefix
shared by a third of all conversations is combined before it is shuffled, and
member lists are hashed as a stream of chunks of 1,024 ids: SHA-256 takes them
in order, so one task reads a node's chunks, but holds one at a time.

Turns are ordered by ``turn`` (numeric; null first), ties by role, then by the
text's digest; repeated rows are turns of their own.  Null role or text counts
as empty.  Rows without a conversation id belong to no conversation.  Extra
columns are ignored.  An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.materialize import materialize
from tidemark.operators.rank import default_bucket_count, dist_rank, with_quantile_bucket

#: turns (rows, blocks, ids) that a window or a list may hold of one conversation
SLICE = 1024


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", payload: Sequence[str] = ()) -> DataFrame:
    """(conv, pos, tid, *payload): turns in order, numbered from 1; ``tid`` holds digest and code points.

    ``payload`` may name ``role`` and ``text``.
    """
    c = conversations
    role, text = F.coalesce(c[role_col], F.lit("")), F.coalesce(c[text_col], F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = c.filter(c[conv_col].isNotNull()).select(
        c[conv_col].alias("conv"), c[turn_col].alias("turn"), role.alias("role"), *([text.alias("text")] if "text" in payload else []),
        F.struct(digest.alias("id"), F.length(text).alias("chars")).alias("tid"))
    rows = materialize(rows.withColumn("slice", F.floor(F.col("turn") / SLICE)), "turns")
    # a slice of a conversation is bounded by its turn numbers, a long conversation by quantiles of them
    cut = with_quantile_bucket(rows, ["conv"], "slice", default_bucket_count(rows.sparkSession), name="cut")
    cut = cut.withColumn("cut", F.when(F.col("turn").isNull(), F.lit(-1)).otherwise(F.col("cut")))
    ranked = dist_rank(cut, ["conv"], ["turn", "role", "tid"], "cut", "pos")
    return ranked.select("conv", F.col("pos").cast("long").alias("pos"), "tid", *payload)


def with_shared_heads(turns: DataFrame, span: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns and (conv, n_turns): conversation c starts with the first h turns of conversation c - c % span.

    h = crc32(decimal c) % most; c's own turns after its first h follow.  All
    turns of the other if it has fewer, none if it is absent.
    """
    extra = [x for x in turns.columns if x not in ("conv", "pos")]
    h = F.crc32(F.col("conv").cast("string")) % most
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    first = turns.filter((F.col("conv") % span == 0) & (F.col("pos") < most))
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", *extra))).alias("head"))  # below ``most``
    convs = convs.withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % span).join(heads, "base", "left")
    convs = convs.withColumn("n_head", F.least("h", F.when(F.col("head").isNull(), 0).otherwise(F.size("head"))).cast("int"))
    convs = materialize(convs.withColumn("n_turns", F.col("n_head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "conversations")
    shared = convs.filter("n_head > 0").select("conv", F.inline(F.slice("head", F.lit(1), F.col("n_head"))))
    own = turns.join(convs.select("conv", "h", "n_head"), "conv").filter("pos > h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("n_head")).alias("pos"), *extra)
    return shared.select("conv", "pos", *extra).unionByName(own), convs.select("conv", "n_turns")


def _place_hash(salt: int, digest: Column, pos: Column) -> Column:
    return F.coalesce(F.xxhash64(F.lit(salt), digest, pos.cast("long")), F.lit(0))


def _blocks(turns: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """(conv, block, ids, p1, p2, pre): blocks of ``width`` turns under the key of the prefix before them."""
    at = F.col("pos") - 1
    blocks = (turns.withColumn("x1", _place_hash(1, F.col("tid.id"), F.col("pos"))).withColumn("x2", _place_hash(2, F.col("tid.id"), F.col("pos")))
              .groupBy("conv", F.floor(at / width).alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("pos", "tid"))).alias("ids"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
                   F.sum("tid.chars").alias("chars"))
              .withColumn("ids", F.transform("ids", lambda t: t["tid"])))
    none = convs.filter("n_turns = 0").select("conv", F.lit(0).cast("long").alias("block"), F.array().cast(blocks.schema["ids"].dataType).alias("ids"),
                                              F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"), F.lit(0).cast("long").alias("chars"))
    blocks = materialize(blocks.unionByName(none).withColumn("cut", F.floor(F.col("block") / SLICE)), "blocks")

    def running(window):
        zero = F.lit(0).cast("long")
        return [F.coalesce(F.bit_xor("x1").over(window), zero).alias("p1"), F.coalesce(F.bit_xor("x2").over(window), zero).alias("p2"),
                F.coalesce(F.sum("chars").over(window), zero).alias("pre")]

    def before(*keys):
        return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)

    totals = blocks.groupBy("conv", "cut").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("chars").alias("chars"))
    offsets = totals.select("conv", "cut", *running(before("conv", "cut"))).toDF("conv", "cut", "q1", "q2", "qre")
    within = blocks.select("conv", "cut", "block", "ids", *running(before("conv", "cut", "block")))
    keyed = within.join(offsets, ["conv", "cut"])
    return keyed.select("conv", "block", "ids", F.col("p1").bitwiseXOR(F.col("q1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("q2")).alias("p2"),
                        (F.col("pre") + F.col("qre")).alias("pre"))


def _conversation_ends(blocks: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """(conv, n_turns, total, e1, e2): code points and end node of every conversation, from its last block."""
    last = blocks.join(convs, "conv").filter(F.col("block") == F.floor(F.greatest(F.col("n_turns") - 1, F.lit(0)) / width))

    def end(salt):
        return F.aggregate(F.transform("ids", lambda t, i: _place_hash(salt, t["id"], F.col("block") * width + i + 1)),
                           F.col(f"p{salt}"), lambda a, b: a.bitwiseXOR(b))

    total = F.aggregate("ids", F.col("pre"), lambda a, t: a + t["chars"])
    return last.select("conv", "n_turns", total.alias("total"), end(1).alias("e1"), end(2).alias("e2"))


def _rollup(rows: DataFrame, width: int, aggregates: str) -> DataFrame:
    """A row per prefix: depth, k1, k2 (node), u1, u2 (its parent), pre (code points before the last turn), chars, and ``aggregates``."""
    t = [f"t{i}" for i in range(width)]
    rows = rows.select("*", *[F.get("ids", F.lit(i)).alias(t[i]) for i in range(width)])
    found = rows.sparkSession.sql(f"""
        SELECT block, p1, p2, pre, {', '.join(t)}, {width} - bit_count(grouping_id()) AS n, {aggregates}
        FROM {{rows}} GROUP BY block, p1, p2, pre, ROLLUP ({', '.join(t)})""", rows=rows)
    n = F.col("n")
    last = F.element_at(F.array(*t), F.greatest(n, F.lit(1)))
    # a prefix is real if its last turn is there; the empty one counts once, before the first block
    found = found.withColumn("last", last).filter(((n == 0) & (F.col("block") == 0)) | ((n > 0) & F.col("last").isNotNull()))
    depth = F.col("block") * width + n

    def key(salt, size):
        k = F.col(f"p{salt}")
        for i, name in enumerate(t):
            k = k.bitwiseXOR(F.when(size > i, _place_hash(salt, F.col(name)["id"], F.col("block") * width + i + 1)).otherwise(F.lit(0).cast("long")))
        return k

    before = F.col("pre")
    for i, name in enumerate(t):
        before = before + F.when(n - 1 > i, F.col(name)["chars"]).otherwise(0)
    names = [a.rsplit(" AS ", 1)[1].strip() for a in aggregates.split(", ")]
    return found.select(depth.alias("depth"), key(1, n).alias("k1"), key(2, n).alias("k2"), key(1, n - 1).alias("u1"), key(2, n - 1).alias("u2"),
                        before.alias("pre"), F.when(n > 0, F.col("last")["chars"]).otherwise(0).alias("chars"), *names)


def member_digests(ends: DataFrame) -> DataFrame:
    """(e1, e2, sha): SHA-256 of the ids (``conv``, integers) that end in a node, ascending, comma-joined.

    Ids are gathered in chunks of bounded size first; a node's chunks then pass
    through one task as a stream.
    """
    chunks = ends.groupBy("e1", "e2", F.floor(F.col("conv") / SLICE).alias("chunk")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    chunks = chunks.select("e1", "e2", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    chunks = chunks.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "chunk")

    def run(batches):
        key, state = None, None

        def batch(done):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], pa.int64()), pa.array([r[1] for r in done], pa.int64()),
                                               pa.array([r[2] for r in done], pa.string())], names=["e1", "e2", "sha"])

        for b in batches:
            done = []
            for e1, e2, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if (e1, e2) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (e1, e2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
            yield batch(done)
        if key is not None:
            yield batch([(*key, state.hexdigest())])

    return chunks.mapInArrow(run, "e1 long, e2 long, sha string")


def prefix_trie(turns: DataFrame, convs: DataFrame, width: int = 4) -> DataFrame:
    """A row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, and ``k1``, ``k2`` (the node's key).

    ``turns`` has (conv, pos, tid) as of :func:`turn_rows`, ``convs`` every
    conversation with its number of turns.  The last turn of a node is turn
    ``depth`` of ``conv_id``.  ``saved_tokens`` sums, over the node's subtree,
    the code points of the last text for all members but one.
    """
    blocks = materialize(_blocks(turns, convs, width), "blocks")
    ends = materialize(_conversation_ends(blocks, convs, width), "ends")
    rows = materialize(blocks.join(ends.select("conv", "n_turns", "total"), "conv"), "rows")
    named = _rollup(rows, width, "min(conv) AS conv, max(n_turns) AS longest")
    # what a conversation names: from which depth, how many code points, and whether its end is a leaf
    facts = named.groupBy("conv").agg(F.min("depth").alias("since"), F.sum("chars").alias("own"), F.max((F.col("longest") == F.col("depth")).cast("int")).alias("leaf"))
    facts = materialize(ends.select("conv", F.col("n_turns").alias("n_own"), F.col("total").alias("total_own")).join(facts, "conv"), "facts")
    shares = rows.join(facts.select("conv", "own", "leaf"), "conv", "left")
    nodes = _rollup(shares, width, "min(conv) AS conv, count(1) AS n_convs, sum(total) AS total, sum(own) AS own, sum(leaf) AS n_leaves")
    nodes = nodes.join(facts.select("conv", "since", "n_own", "total_own", F.col("own").alias("own_first")), "conv")
    # code points below and at the node over all members, less those of its distinct nodes
    before = F.col("total_own") - F.col("own_first")
    saved = F.col("total") - F.col("n_convs") * F.col("pre") - (F.col("own") + before - F.col("pre"))
    nodes = materialize(nodes.withColumn("saved_tokens", saved).drop("total", "own", "pre", "chars", "total_own", "own_first"), "nodes")
    branch = (F.col("since") == F.col("depth")) & (F.col("depth") > 0)
    kids = nodes.filter(branch).groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(F.count(F.lit(1)).alias("branches"))
    digests = member_digests(ends).toDF("k1", "k2", "sha")
    known = nodes.join(kids, ["k1", "k2"], "left").join(digests, ["k1", "k2"], "left")
    known = known.withColumn("n_children", F.coalesce("branches", F.lit(0)) + (F.col("n_own") > F.col("depth")).cast("int"))
    known = materialize(known.withColumn("ends_sha256", F.coalesce("sha", F.sha2(F.lit(""), 256))), "known")
    parents = known.filter("branches > 0").select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv").alias("parent"))
    out = ["conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "k1", "k2"]
    off = known.filter(branch).join(parents, ["u1", "u2"]).select(*out)
    on = known.filter(~branch).withColumn("parent", F.when(F.col("depth") > 0, F.col("conv"))).select(*out)
    return on.unionAll(off).withColumnsRenamed({"conv": "conv_id", "parent": "parent_conv_id"})


def with_last_turn(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with ``role`` and ``text`` of their last turn (null at the root); ``turns`` carries both as payload."""
    said = turns.select(F.col("conv").alias("conv_id"), F.col("pos").alias("depth"), "role", "text")
    return nodes.join(said, ["conv_id", "depth"], "left")
