"""JSON arrays written as one file and read by many tasks.

A file that holds all rows has one writer, which copies text that all tasks made.
The order of the file is stated by the row's position in that one task, not by
the order in which Spark puts partitions together.

Spark reads a file that holds one array in a single task.  Here the file is cut
at closing braces (``lineSep`` of the text source, whose splits Spark places),
and what a split cannot know - whether it starts inside a string, and how deep -
is settled in a first pass:

1. Every split reports, for both possible starts (outside and inside a string),
   the parity of its unescaped quotes, its change of nesting depth, its least
   depth and the first brackets above that which it leaves open.
2. A running fold over the splits of each file, in order, gives every split its
   true start and whether the element open there is an object.  There is a row
   per split, as in Spark's own split listing.
3. With it each split returns the records that lie inside it.  A record that is
   cut by a split's end comes back in pieces, at most two a split and whatever
   lies between, which are put together by a window per file.

A split is scanned in runs of some MB: memory is bounded by a batch, by a small
multiple of a run and by a record.
The records are the objects that are elements of the top-level array (or, where
a file does not start with ``[``, the objects at its top level); other elements
are skipped, however many splits they fill.  Encoding is UTF-8.  A record that
the schema does not fit has null fields, as with ``spark.read.json``.  Empty
files have no records.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.materialize import materialize, temporary_tables

_OPEN, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_OPEN[[0x5B, 0x7B]] = True
_CLOSE[[0x5D, 0x7D]] = True
_RUN = 2 << 20  # the scan takes some 40 bytes a byte
_MEASURED = pa.schema([("file", pa.string()), ("block", pa.int64()), ("array", pa.bool_()), ("odd", pa.bool_()), ("d0", pa.int64()), ("low0", pa.int64()), ("left0", pa.binary()),
                       ("d1", pa.int64()), ("low1", pa.int64()), ("left1", pa.binary())])


def structure(data: np.ndarray, inside: bool) -> tuple[np.ndarray, int]:
    """(change of depth at every byte outside strings, number of unescaped quotes); no escape reaches into the data from before."""
    quote = np.flatnonzero(data == 0x22)
    if len(quote):
        slash = data == 0x5C
        if slash.any():
            last = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))  # last byte that is no backslash
            before = quote - 1
            run = np.where(before >= 0, before - last[before], 0)
            quote = quote[run % 2 == 0]
    change = _OPEN[data].astype(np.int32) - _CLOSE[data]
    flips = np.zeros(len(data) + 1, np.int8)
    flips[quote] = 1
    string = (np.cumsum(flips[:-1], dtype=np.int64) + int(inside)) % 2 == 1
    change[string] = 0
    return change, len(quote)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): what stands before each closing brace, by split and in order within it."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _by_split(batches):
    """(file, block, bytes) of every run of pieces of one split in a batch, ``_RUN`` bytes and a piece at most; the brace that the reader cut off is put back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column(1).to_numpy()
        file = batch.column(0).to_pylist()
        run = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(), dtype=np.int64) // _RUN
        cut = [0, *[i for i in range(1, len(file)) if run[i] != run[i - 1] or block[i] != block[i - 1] or file[i] != file[i - 1]], len(file)]
        for a, b in zip(cut[:-1], cut[1:]):
            yield file[a], int(block[a]), b"}".join(batch.column(2).slice(a, b - a).to_pylist()) + b"}"


def _unclosed(data: np.ndarray, change: np.ndarray) -> tuple[int, int, bytes]:
    """(change of depth, least depth, brackets left open at the first two depths above it), counted from the start of the data."""
    at = np.flatnonzero(change)
    level = np.cumsum(change[at])
    end, low = (int(level[-1]), min(0, int(level.min()))) if len(at) else (0, 0)
    left = [at[np.flatnonzero((level == d) & (change[at] > 0))[-1]] for d in range(low + 1, min(low + 2, end) + 1)]
    return end, low, data[left].tobytes()


def _measure(batches):
    seen: dict[tuple, list] = {}
    for file, block, raw in _by_split(batches):
        data = np.frombuffer(raw, np.uint8)
        # per split: first structural byte, quotes, (depth, least depth, open brackets) from outside and from inside
        row = seen.setdefault((file, block), [raw.lstrip(b"\xef\xbb\xbf \t\r\n")[:1], 0, (0, 0, b""), (0, 0, b"")])
        odd = bool(row[1] % 2)
        for inside in (False, True):
            change, quotes = structure(data, odd ^ inside)
            depth, low, left = row[2 + inside]
            d, m, more = _unclosed(data, change)
            row[2 + inside] = depth + d, min(low, depth + m), (left[:max(0, depth + m - low)] + more)[:2]
        row[1] += quotes
    for (file, block), (head, quotes, outside, inside) in seen.items():
        yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "array": head == b"[", "odd": quotes % 2 == 1, "d0": outside[0], "low0": outside[1], "left0": outside[2],
                                           "d1": inside[0], "low1": inside[1], "left1": inside[2]}], schema=_MEASURED)


def _starts(summary: list) -> dict[tuple, tuple[bool, int, int, bool]]:
    """{(file, block): (inside a string, depth, depth of the records' surroundings, whether the element open there is an object)}."""
    out, file = {}, None
    for r in sorted(summary, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            file, inside, depth, base, record = r["file"], False, 0, int(r["array"]), False
        out[file, r["block"]] = (inside, depth, base, record)
        d, low, left = (r["d1"], r["low1"], r["left1"]) if inside else (r["d0"], r["low0"], r["left0"])
        k = base - (depth + low)  # 0: the element open at the end stands on the split's least depth; below 0: it was open before
        if k >= 0:
            record = left[k:k + 1] == b"{"
        depth += d
        inside ^= r["odd"]
    return out


def _extract(starts: dict):
    """Function for ``mapInArrow``: (file, block, part, text); part 0 whole record, 1 end, 2 middle and 3 start of a cut one."""
    def run(batches):
        state: dict[tuple, list] = {}

        def batch(key, part, texts):
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array([part] * n, pa.int32()),
                                               pa.array(texts, pa.binary())], names=["file", "block", "part", "text"])

        for file, block, raw in _by_split(batches):
            key = (file, block)
            if key not in state:
                inside, depth, base, record = starts[key]
                # inside, depth, base, open parts of a record, whether it began before the split
                state[key] = [inside, depth, base, [] if record else None, record]
            inside, depth, base, parts, early = state[key]
            data = np.frombuffer(raw, np.uint8)
            change, quotes = structure(data, inside)
            at = np.flatnonzero(change)
            level = depth + np.cumsum(change[at])
            # starts and ends of elements take turns
            begins = at[(level == base + 1) & _OPEN[data[at]]]
            ends = at[(level == base) & _CLOSE[data[at]]]
            if parts is not None:
                parts.append(raw[:ends[0] + 1] if len(ends) else raw)
            if depth > base and len(ends):
                if parts is not None:
                    yield batch(key, 1 if early else 0, [b"".join(parts)])
                ends, parts, early = ends[1:], None, False
            whole = [raw[a:b + 1] for a, b in zip(begins, ends) if raw[a] == 0x7B]
            if len(begins) > len(ends) and raw[begins[-1]] == 0x7B:
                parts, early = [raw[begins[-1]:]], False
            if whole:
                yield batch(key, 0, whole)
            state[key] = [inside ^ (quotes % 2 == 1), depth + int(change.sum()), base, parts, early]
        for key, (_, _, _, parts, early) in state.items():
            if parts:
                yield batch(key, 2 if early else 3, [b"".join(parts)])

    return run


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): every record of the array files at ``path``, as text."""
    pieces = _pieces(spark, path)
    summary = pieces.mapInArrow(_measure, "file string, block long, array boolean, odd boolean, d0 long, low0 long, left0 binary, d1 long, low1 long, left1 binary").collect()  # a row per split
    found = pieces.mapInArrow(_extract(_starts(summary)), "file string, block long, part int, text binary")
    whole = found.filter("part = 0").select("file", "text")
    # a cut record: its start, splits without any end, its end; an end comes before the next start of its split
    order = Window.partitionBy("file").orderBy("block", "part")
    cut = found.filter("part > 0").withColumn("record", F.sum((F.col("part") == 3).cast("int")).over(order))
    parts = cut.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["text"]))
    return whole.unionAll(parts.select("file", joined.alias("text"))).select("file", F.decode("text", "UTF-8").alias("text"))


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A row per record with the columns of ``schema``."""
    return json_records(spark, path).select(F.from_json("text", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")


def write_json_array(df: DataFrame, path: str) -> None:
    """One file at ``path`` that holds the rows as one array, an element a line, null fields included.

    The elements' text is made by all tasks and written as a table; one task copies it into the file.
    """
    spark = df.sparkSession
    with temporary_tables(spark):
        text = materialize(df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("text")), "array_text")
        last = text.count() - 1
        line = text.coalesce(1).withColumn("at", F.monotonically_increasing_id())  # of one task: position in the file
        line = line.select(F.concat(F.when(F.col("at") == 0, "[").otherwise(""), "text", F.when(F.col("at") == last, "]").otherwise(",")).alias("value"))
        if last < 0:
            line = spark.createDataFrame([("[]",)], "value string").coalesce(1)
        line.write.text(path)
