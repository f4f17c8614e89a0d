"""Token counts: batch encoding that returns lengths only.

Texts are split at safe boundaries - before a blank or line feed that follows
a non-blank character.  No pre-token of a byte-level BPE crosses such a place
and no special string holds one, so the counts of the pieces add up to the
count of the whole text.  Repeated pieces of a batch are encoded once; pieces
go to the library in batches of about equal bytes; a table of bounded size,
kept by the Python worker, holds the lengths of the first pieces it saw (the
common ones come first).  Nothing but lengths leaves the task.

Null or empty text: 0 bytes, 0 tokens.  Repeated rows and null ids are
returned as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.words import segments

BATCH_BYTES = 256 << 10
KNOWN_BYTES = 200 << 20

#: blanks, then a word; other white space never starts a piece of its own
_PIECE = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")


def safe_pieces(text: str) -> list[str]:
    """Pieces of a text whose token counts add up to the text's."""
    return _PIECE.findall(text)


def n_bytes(text: str) -> int:
    """UTF-8 length."""
    return len(text) if text.isascii() else len(text.encode("utf-8", "replace"))


def byte_batches(pieces: list[str], batch_bytes: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Lists of pieces of about ``batch_bytes`` each; a longer piece stands alone."""
    batch, size = [], 0
    for p in pieces:
        n = n_bytes(p)
        if batch and size + n > batch_bytes:
            yield batch
            batch, size = [], 0
        batch.append(p)
        size += n
    if batch:
        yield batch


class Lengths:
    """Token counts of pieces, with a table of known ones bounded by bytes."""

    def __init__(self, tokenizer_path: str, batch_bytes: int = BATCH_BYTES, known_bytes: int = KNOWN_BYTES):
        self.batch_bytes, self.known_bytes = batch_bytes, known_bytes
        self.known: dict[str, int] = {}
        self.size = 0
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        if tokenizer_path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path)
            self.encode = lambda batch: [len(x) for x in sp.encode(batch, num_threads=1)]
            self.split = lambda text: [text] if text else []  # a leading blank has a meaning of its own
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(tokenizer_path)
            t.no_truncation()
            t.no_padding()
            self.encode = lambda batch: [len(x.ids) for x in t.encode_batch_fast(batch, add_special_tokens=False)]
            self.split = safe_pieces

    def count(self, texts: list[str]) -> list[int]:
        split = [self.split(t) for t in texts]
        seen = set()
        for pieces in split:
            seen.update(pieces)
        known = self.known
        new = list(seen.difference(known))
        added = sum(map(n_bytes, new)) + 150 * len(new)
        if self.size + added > self.known_bytes:
            known = {p: known[p] for p in seen if p in known}  # full: the new ones serve this batch only
        else:
            self.size += added
        for batch in byte_batches(new, self.batch_bytes):
            known.update(zip(batch, self.encode(batch)))
        get = known.__getitem__
        return [sum(map(get, pieces)) for pieces in split]


_lengths: dict[tuple, Lengths] = {}


def lengths_for(tokenizer_path: str, batch_bytes: int = BATCH_BYTES) -> Lengths:
    """The worker's table for a tokenizer; tasks that reuse the worker share it."""
    key = (tokenizer_path, batch_bytes)
    if key not in _lengths:
        _lengths.clear()
        _lengths[key] = Lengths(tokenizer_path, batch_bytes)
    return _lengths[key]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens)."""
    src = docs.select(docs[id_col], docs[text_col])
    id_type = src.schema[id_col].dataType.simpleString()

    def run(batches):
        lengths = lengths_for(tokenizer_path, batch_bytes)
        for batch in batches:
            counts, sizes = [], []
            for _, _, data, off in segments(batch.column(1), batch_bytes * 4):
                raw = data.tobytes()
                counts += lengths.count([raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])])
                sizes.append(np.diff(off))
            n = np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(sizes) if sizes else n), pa.array(n), pa.array(n > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
