"""WARC archives compressed with a dictionary: one Zstandard frame per record.

Layout of an archive: a skippable frame that embeds the dictionary, a frame
with the ``warcinfo`` record, then a frame for every record.  The dictionary
is built from the archive's own first records (at most ``sample_bytes`` of
them); compression alone depends on it, so any record can be read with the
dictionary and its own frame.

Archives are written by Spark's text writer, one per partition, through the
committer of whatever file system holds the folder: a lost executor's attempt
leaves nothing behind.  The writer needs a separator between rows; an empty
skippable frame serves, which readers of the format pass over.

Records with equal payloads of at least ``min_payload`` bytes are stored once:
the one with the smallest id is a ``response``, the others are ``revisit``
records that refer to it.  Payloads are matched by SHA-256 and length in a
partial aggregate, so a payload that a third of all pages share is one row per
task; pages are joined to the decisions on their id, not on the payload.

Null html is an empty payload.  A row with a null id is a response unless a
row with an id has the same payload.  Rows that repeat an id and payload get a
record each (of the same type); so do rows that repeat an id with another
payload.  An empty table writes no archive and gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.materialize import materialize
from tidemark.session import scratch_path

ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 1 << 20
DICT_BYTES = 32 << 10
DICT_MAGIC = b"\x5d\x2a\x4d\x18"
#: an empty skippable frame: all of its bytes are ASCII, as the text writer wants
SEPARATOR = "\x50\x2a\x4d\x18\x00\x00\x00\x00"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headers(fields: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def record_uri(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _clean(url: str | None) -> str:
    return "".join("%%%02X" % b if b <= 32 or b == 127 else chr(b) if b < 128 else "%%%02X" % b for b in (url or "about:blank").encode())


def build_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A response, or a revisit if ``refers_to`` names another page; a revisit keeps the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_uri(page_id, digest)),
              ("WARC-Date", date), ("WARC-Target-URI", _clean(url)), ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", record_uri(refers_to, digest)), ("Refers-To-Page-Id", str(refers_to))]
    return _headers(fields) + block + b"\r\n\r\n"


def warcinfo(date: str) -> bytes:
    body = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    return _headers([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                     ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(body)))]) + body + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> zstandard.ZstdCompressionDict:
    """Built from records; too few to train on: their raw content."""
    if len(samples) >= 16 and sum(map(len, samples)) >= 8 * size:
        try:
            return zstandard.train_dictionary(size, samples, k=512, d=8)
        except zstandard.ZstdError:
            pass  # the trainer refuses uniform samples
    return zstandard.ZstdCompressionDict(b"".join(samples)[-size:] or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_frames(records: Iterator[bytes], date: str, sample_bytes: int = SAMPLE_BYTES, level: int = 3) -> Iterator[bytes]:
    """Dictionary frame, warcinfo frame, a frame per record; only the sample is held."""
    sample, size = [], 0
    for r in records:
        sample.append(r)
        size += len(r)
        if size >= sample_bytes:
            break
    if not sample:
        return
    book = build_dictionary([r[:64 << 10] for r in sample])
    raw = book.as_bytes()
    yield DICT_MAGIC + len(raw).to_bytes(4, "little") + raw
    c = zstandard.ZstdCompressor(level=level, dict_data=book, write_checksum=True)
    yield c.compress(warcinfo(date))
    for r in sample:
        yield c.compress(r)
    for r in records:
        yield c.compress(r)


def frame_end(data: memoryview, at: int) -> int:
    """End of the Zstandard frame at ``at``, from its block headers."""
    params = zstandard.get_frame_parameters(bytes(data[at:at + 18]))
    at += zstandard.frame_header_size(bytes(data[at:at + 18]))
    while True:
        head = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if (head >> 1) & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * params.has_checksum


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record; checksums are verified by the decompressor."""
    view, at, d = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        if 0x184D2A50 <= int.from_bytes(view[at:at + 4], "little") <= 0x184D2A5F:
            size = int.from_bytes(view[at + 4:at + 8], "little")
            if view[at:at + 4] == DICT_MAGIC:
                raw = bytes(view[at + 8:at + 8 + size])
                kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
                d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
            at += 8 + size
            continue
        end = frame_end(view, at)
        record = d.decompress(view[at:end])
        at = end
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[:int(fields["Content-Length"])]


def decide(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """(id, k, refers_to) of the revisits: rows whose payload a smaller id has."""
    keys = pages.select("id", "k", "size").filter(F.col("size") >= min_payload)
    first = materialize(keys.groupBy("k", "size").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "first-payload")
    later = materialize(keys.distinct(), "payloads").join(first, ["k", "size"]).filter(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
    return later.select("id", "k", F.col("first").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = "2000-01-01T00:00:00Z",
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write every row as a WARC record to archives under ``folder``."""
    html = F.coalesce(pages[html_col], F.lit(""))
    src = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), html.alias("html"))
    src = src.withColumn("k", F.unhex(F.sha2(F.col("html").cast("binary"), 256))).withColumn("size", F.octet_length("html"))
    total = src.agg(F.sum("size").alias("n")).first()["n"] or 0
    n = int(max(1, -(-total // archive_bytes)))
    key = F.concat_ws("/", F.hex("k"), F.col("id").cast("string")).alias("_key")  # no key is hot: only repeated rows share one
    r = decide(src, min_payload).select(key, "refers_to").repartition(n, "_key")
    rows = src.select("id", "url", "html", key).repartition(n, "_key").join(r, "_key", "left").select("id", "url", "html", "refers_to")

    def run(batches):
        def records():
            for batch in batches:
                for i, url, html, ref in zip(*(c.to_pylist() for c in batch.columns)):
                    payload = html.encode()
                    yield build_record(i, url, payload, payload_digest(payload), ref, date)

        for frame in archive_frames(records(), date):
            yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], names=["frame"])

    frames = rows.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", SEPARATOR).text(folder)
    return folder


def read_archives(spark, folder: str, id_type: str = "bigint") -> DataFrame:
    """Records of all archives: ``page_id``, ``url``, ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to``, ``payload``.

    ``payload`` is null for revisits; a response's digest and size are computed
    from the stored block and compared with its headers.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    number = pa.int32() if id_type == "int" else pa.int64() if id_type == "bigint" else pa.string()

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in read_archive(content.as_buffer()):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    head, _, body = block.partition(b"\r\n\r\n")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    length = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
                    if fields["WARC-Type"] == "response" and (payload_digest(body), len(body)) != (digest, length):
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                    rows.append((fields.get("Page-Id"), fields["WARC-Target-URI"], fields["WARC-Type"], length, digest,
                                 fields.get("Refers-To-Page-Id"), body if fields["WARC-Type"] == "response" else None))
                    size += len(body) + 300
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows):
        c = list(zip(*rows))
        own = [None if x is None else int(x) if number != pa.string() else x for x in c[0]]
        ref = [None if x is None else int(x) if number != pa.string() else x for x in c[5]]
        return pa.RecordBatch.from_arrays(
            [pa.array(own, number), pa.array(c[1], pa.string()), pa.array(c[2], pa.string()), pa.array(c[3], pa.int64()),
             pa.array(c[4], pa.string()), pa.array(ref, number), pa.array(c[6], pa.binary())],
            names=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])

    return files.mapInArrow(run, f"page_id {id_type}, url string, record_type string, payload_bytes long, payload_digest string, "
                                 f"refers_to {id_type}, payload binary")


def archive_and_read(pages: DataFrame, min_payload: int = 0, id_col: str = "page_id") -> DataFrame:
    """Write the pages to archives in the shared scratch folder and read them back."""
    spark = pages.sparkSession
    folder = write_archives(pages, scratch_path(spark, "warc"), min_payload, id_col=id_col)
    return read_archives(spark, folder, pages.schema[id_col].dataType.simpleString())
