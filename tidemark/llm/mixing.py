"""Mixing sources to target weights by weighted fair queueing.

A document's size is its number of words.  Sources, ordered by code point with
null last, carry weights in turn; they share the budget by weight, but no
source exceeds ``max_repeat`` times its own size - what it cannot use is
reshared by weight until none is above.

Every source's documents are put in a random order that depends on the seed
and the id alone.  A copy's *virtual finish time* is the source's words up to
and including it divided by the source's target (later rounds go on counting),
so sources are served at rates proportional to their targets and the budget,
the sum of the targets, is used up at virtual time 1.  The mix is sorted by
finish time over the whole table and truncated there; a copy that time 1 falls
into is taken if at least half of it is due.  So a source's words are off its
target by half a document at most, and the whole by the sum of those.

Prefix sums run per (source, slice of the random order), so a source that
holds a third of all rows is spread over many tasks; only ids, sources and
sizes are shuffled for the schedule, texts once to join it and once for the
order of the mix.  Null text: size 0, nothing taken.  Null source: a source of
its own.  Null ids are one id; rows of one id, source and text are served one by
one and stand for each other.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_uniform
from tidemark.llm.words import segments, word_spans
from tidemark.operators.joins import join_keys
from tidemark.operators.materialize import materialize
from tidemark.operators.rank import default_bucket_count, dist_cumsum, unit_bucket


def word_counts(docs: DataFrame, text_col: str = "text", name: str = "size") -> DataFrame:
    """``docs`` with the text replaced by its number of words (null text: 0)."""
    others = [c for c in docs.columns if c != text_col]
    src = docs.select(*[docs[c] for c in others], docs[text_col])
    schema = src.select(*others).withColumn(name, F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            n = [np.zeros(0, np.int64)]
            for _, _, data, off in segments(batch.column(len(others))):
                n.append(np.diff(word_spans(data, off)[2]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(np.concatenate(n).astype(np.int64))],
                                             names=[*others, name])

    return src.mapInArrow(run, schema)


def ranked_sources(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(source, source_size, weight): weights in turn by code point, null last."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = materialize(totals.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id()), "sources")
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    rank = (F.col("_at") + F.col("_off")) % len(weights)
    return placed.join(parts, "_part").select("source", "source_size", F.element_at(turn, (rank + 1).cast("int")).alias("weight"))


def source_targets(sources: DataFrame, budget: float, max_repeat: int) -> DataFrame:
    """Adds ``target``: shares by weight, stopped at ``max_repeat`` source sizes, the excess reshared.

    One keyless aggregate per round over the table of sources; the level (words
    per weight) only rises, and the rounds end when no further source is full.
    """
    full = F.col("source_size") * max_repeat
    level, n_full = 0.0, -1
    while True:
        is_full = F.col("weight") * F.lit(level) >= full
        row = sources.agg(F.sum(F.when(is_full, full)).alias("fixed"), F.sum(F.when(~is_full, F.col("weight"))).alias("weight"),
                          F.count(F.when(is_full, 1)).alias("n")).first()
        if row["n"] == n_full or not row["weight"]:
            break
        n_full = row["n"]
        level = (budget - float(row["fixed"] or 0)) / row["weight"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), full.cast("double")) if row["weight"] else full.cast("double"))


def _schedule(rows: DataFrame, weights: Sequence[float], budget_share: float, max_repeat: int, seed: int) -> DataFrame:
    """``rows`` (id, source, text, and others) without the text, with size, source_size, target, ``cum`` and copies; written once."""
    sizes = materialize(word_counts(rows), "sizes")
    total = sizes.agg(F.sum("size").alias("n")).first()["n"] or 0
    sources = materialize(source_targets(materialize(ranked_sources(sizes, weights), "ranked"), budget_share * total, max_repeat), "targets")
    draw = hash_uniform(seed, F.coalesce(F.col("id").cast("string"), F.lit("")))
    n = default_bucket_count(rows.sparkSession)
    queued = dist_cumsum(sizes.withColumn("_u", draw), ["source"], ["_u", "id", "size"], unit_bucket("_u", n), {"cum": "size"})
    queued = join_keys(queued, sources, ["source"]).drop("weight", "_u")
    half_due = [F.when((F.col("size") > 0) & (e * F.col("source_size") + F.col("cum") - F.col("size") / 2 <= F.col("target")), 1).otherwise(0) for e in range(max_repeat)]
    return materialize(queued.withColumn("copies", sum(half_due[1:], half_due[0])), "queued")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), budget_share: float = 1.0, max_repeat: int = 3,
                seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``, ``finish``.

    ``finish`` is the virtual finish time of the row's first copy (null for a target of 0).
    """
    rows = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), docs[text_col].alias("text"))
    queued = _schedule(rows, weights, budget_share, max_repeat, seed)
    return queued.select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"),
                         F.when(F.col("target") > 0, F.col("cum") / F.col("target")).alias("finish"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), budget_share: float = 1.0, max_repeat: int = 3,
                    seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` in the mix, each as often as it is taken, with all columns, sorted by virtual finish time.

    Rows of one id, source and text are taken as copies of one of them, as often as all of them together.
    """
    key = ["id", "source", "text_hash"]
    rows = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), F.xxhash64(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))
    queued = _schedule(rows, weights, budget_share, max_repeat, seed)
    again = materialize(queued.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated")
    found = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), F.xxhash64(docs[text_col]).alias("text_hash"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    if not again.isEmpty():  # one of several equal rows stands for all
        several = join_keys(found, again, key, "left_semi").groupBy(*key).agg(F.first("row").alias("row"))
        found = join_keys(found, again, key, "left_anti").unionByName(several)
    copies = queued.filter("copies > 0").select(*key, F.explode(F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda e: (
        e * F.col("source_size") + F.col("cum")) / F.col("target"))).alias("finish"))
    mixed = join_keys(copies, found, key)
    return mixed.orderBy("finish", "id").select("row.*")
