"""Secret scans: fixed patterns, plus sliding-window entropy per character class.

Patterns (kinds ``assign``, ``access``, ``hex``) are matched leftmost and
non-overlapping over whole texts; short matches are dropped.  The entropy
scan takes *candidate strings* - runs of at least ``shortest`` characters of
``[A-Za-z0-9+/_=-]``.  A run that holds ``=`` before its end is cut there (a
name and its value), and parts between ``+/_=-`` that are on the allow list
(placeholder words, repeated units) are cut out, so that a word beside a value
does not hide it.  Over what is left slides a window of ``window`` characters,
or of the whole value if it is shorter.  The value must mix character classes
(``mixes``); if it does not, as a long path with a secret in it, the window must.  The character counts of the window are kept incrementally (one
character leaves, one enters), so a step costs O(1).  A window counts when its
Shannon entropy reaches the threshold of its class: ``hex`` (only hexadecimal
digits), ``alnum`` (letters and digits; a lower one if the value has letters of
one case only, as base32 has) or ``base64`` (others as well).  Thresholds are
for a window of 24 and scale with the logarithm of the length.  Counting
windows that touch are joined into one span of kind ``entropy_<class>``.
Values and spans on the allow list (UUIDs, digits or letters in order) and
spans inside a pattern match are suppressed.

Offsets are code points, end exclusive.  Null text counts as empty: no spans.
Repeated rows and null ids are returned as they come; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.words import segments

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")
ORDER = {k: i for i, k in enumerate(KINDS)}

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: suppressed whatever their entropy
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?i).*(example|placeholder|changeme|dummy|sample|redacted|xxxx).*",
    r"(?i)(0123456789|abcdefghij|1234567890).*",
    r"(.{1,8})\1{2,}.{0,7}",
)


@dataclass(frozen=True)
class EntropyRule:
    """Window length, shortest value and thresholds (bits per character of a window of 24) by class."""

    window: int = 24
    shortest: int = 16
    hex_bits: float = 3.0
    single_case_bits: float = 3.4
    alnum_bits: float = 3.9
    base64_bits: float = 4.0
    allowed: tuple[str, ...] = ALLOWED


def window_entropies(s: str, window: int) -> list[float]:
    """Shannon entropy (bits) of every window of ``s``, by incremental counts.

    With counts n_c of a window of w characters the entropy is
    ``log2 w - sum(n_c log2 n_c) / w``; moving the window changes two terms.
    """
    n = len(s)
    if n < window:
        return []
    term = [0.0] + [k * math.log2(k) for k in range(1, window + 1)]
    count: dict[str, int] = {}
    total = 0.0
    out = []
    base = math.log2(window)
    for i, ch in enumerate(s):
        if i >= window:  # one leaves first: no count exceeds the window
            old = s[i - window]
            k = count[old]
            total += term[k - 1] - term[k]
            count[old] = k - 1
        k = count.get(ch, 0)
        total += term[k + 1] - term[k]
        count[ch] = k + 1
        if i >= window - 1:
            out.append(base - total / window)
    return out


_HEX_CHARS = frozenset("0123456789abcdefABCDEF")
_JOINT = re.compile(r"[+/_=-]+")
#: neighbours of different class: lower-case letter, upper-case letter, digit
_TURN = re.compile(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])")


def mixes(s: str, share: int = 4) -> bool:
    """Does a value mix character classes as drawn ones do?

    Classes change between neighbours, at least once in eight characters (words,
    numbers and dates joined by separators change rarely), and there are digits
    (a sixteenth of the letters and digits) or letters of both cases (one in
    ``share`` each; names in camel case have fewer capitals).
    """
    if s.islower() and s.isalpha():
        return False
    digits = sum(map(str.isdigit, s))
    upper = sum(map(str.isupper, s))
    lower = sum(map(str.islower, s))
    if not upper + lower:
        return False
    if 16 * digits < digits + upper + lower and share * min(upper, lower) < upper + lower:
        return False
    return len(_TURN.findall(s)) >= max(2, len(s) // 8)


def entropy_spans(s: str, rule: EntropyRule) -> list[tuple[str, int, int]]:
    """(kind, start, end) in a value, before suppression by pattern matches."""
    w = min(rule.window, len(s))
    whole = mixes(s)
    if w < rule.shortest or not whole and (w == len(s) or not _TURN.search(s)):
        return []
    scale = math.log2(w) / math.log2(24)
    alnum_bits = rule.alnum_bits if s.lower() != s != s.upper() else rule.single_case_bits
    plain = [0]
    hexes = [0]
    for ch in s:
        plain.append(plain[-1] + ch.isalnum())
        hexes.append(hexes[-1] + (ch in _HEX_CHARS))
    spans: list[list] = []
    for i, bits in enumerate(window_entropies(s, w)):
        if hexes[i + w] - hexes[i] == w:
            kind, least = "entropy_hex", rule.hex_bits
        elif plain[i + w] - plain[i] == w:
            kind, least = "entropy_alnum", alnum_bits
        else:
            kind, least = "entropy_base64", rule.base64_bits
        if bits < least * scale or not whole and not mixes(s[i:i + w], 3):
            continue
        if spans and i <= spans[-1][2]:
            spans[-1][2] = i + w
            if ORDER[kind] > ORDER[spans[-1][0]]:
                spans[-1][0] = kind  # the wider class names a joined span
        else:
            spans.append([kind, i, i + w])
    return [tuple(x) for x in spans]


class Scanner:
    def __init__(self, rule: EntropyRule = EntropyRule()):
        self.rule = rule
        self.candidate = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % rule.shortest)
        self.allow = [re.compile(p, re.S) for p in rule.allowed]

    def allowed(self, s: str) -> bool:
        return any(p.fullmatch(s) for p in self.allow)

    def values(self, run: str) -> list[tuple[int, int]]:
        """(start, end) of the values in a run: cut behind ``=`` and around parts on the allow list."""
        found = []
        end = len(run.rstrip("="))
        cuts = [0, *(m.end() for m in re.finditer("=", run[:end])), len(run)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a < self.rule.shortest or not _TURN.search(run, a, b):
                continue
            at = x = a
            for m in [*_JOINT.finditer(run, a, b), None]:
                y = m.start() if m else b
                if y > x and self.allowed(run[x:y]):
                    found.append((at, x))
                    at = m.end() if m else b
                x = m.end() if m else b
            found.append((at, b))
        return [(a, b) for a, b in found if b - a >= self.rule.shortest and not self.allowed(run[a:b])]

    def scan(self, text: str, has_long_run: bool = True) -> list[tuple[str, int, int]]:
        """All spans of a text in order of start, then kind.  ``has_long_run``: it may hold a run of ``shortest`` or more candidate characters."""
        spans = []
        low = text.lower()
        if "passw" in low or "secret" in low or "token" in low or "api" in low:
            spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
        if "AKIA" in text:
            spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
        if has_long_run:
            spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
            base = sorted((a, b) for _, a, b in spans)
            for m in self.candidate.finditer(text):
                for c, d in self.values(m.group()):
                    c, d = c + m.start(), d + m.start()
                    for kind, a, b in entropy_spans(text[c:d], self.rule):
                        a, b = a + c, b + c
                        if any(x <= a and b <= y for x, y in base) or self.allowed(text[a:b]):
                            continue
                        spans.append((kind, a, b))
        spans.sort(key=lambda x: (x[1], ORDER[x[0]], x[2]))
        return spans


_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True


def long_runs(data: np.ndarray, off: np.ndarray, least: int) -> np.ndarray:
    """Per text: does it hold a run of ``least`` or more candidate characters (may also tell yes for runs over a text's end)."""
    c = _CANDIDATE[data]
    stop = np.flatnonzero(~c)
    gap = np.diff(stop, prepend=-1, append=len(data))
    begin = np.concatenate(([0], stop + 1))
    hit = begin[gap > least]
    if not len(hit):
        return np.zeros(len(off) - 1, bool)
    end = hit + gap[gap > least] - 1
    d = np.zeros(len(off), np.int64)
    first = np.searchsorted(off, hit, side="right") - 1
    last = np.searchsorted(off, np.maximum(end - 1, hit), side="right") - 1
    np.add.at(d, np.clip(first, 0, len(off) - 1), 1)
    np.add.at(d, np.clip(last + 1, 0, len(off) - 1), -1)
    return np.cumsum(d)[:-1] > 0


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (joined where they overlap) replaced by ``<kind>``."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rule: EntropyRule = EntropyRule()) -> DataFrame:
    """One row per row of ``docs``: id, ``spans`` array of (kind, start, end), ``redacted`` text (null if nothing was found)."""
    src = docs.select(docs[id_col], docs[text_col])
    id_type = src.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    least = min(24, rule.shortest)

    def run(batches):
        scanner = Scanner(rule)
        for batch in batches:
            found, clean = [], []
            for _, _, data, off in segments(batch.column(1)):
                raw = data.tobytes()
                for a, b, long_run in zip(off[:-1], off[1:], long_runs(data, off, least)):
                    text = raw[a:b].decode("utf-8", "replace")
                    spans = scanner.scan(text, bool(long_run))
                    found.append([{"kind": k, "start": x, "end": y} for k, x, y in spans])
                    clean.append(redact(text, spans) if spans else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind), pa.array(clean, pa.string())],
                                             names=[id_col, "spans", "redacted"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, spans array<struct<kind:string,start:int,end:int>>, redacted string")



def redact_secrets(docs: DataFrame, rule: EntropyRule = EntropyRule(), text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by its kind, and the length column (if there is one) brought up to date; no shuffle."""
    at = docs.columns.index(text_col)
    long_at = docs.columns.index(length_col) if length_col in docs.columns else None
    least = min(24, rule.shortest)

    def run(batches):
        scanner = Scanner(rule)
        for batch in batches:
            for a, b, data, off in segments(batch.column(at)):
                part = batch.slice(a, b - a)
                raw = data.tobytes()
                changed = {}
                for k, (x, y, long_run) in enumerate(zip(off[:-1], off[1:], long_runs(data, off, least))):
                    text = raw[x:y].decode("utf-8", "replace")
                    if spans := scanner.scan(text, bool(long_run)):
                        changed[k] = redact(text, spans)
                if changed:
                    columns = list(part.columns)
                    texts = columns[at].to_pylist()
                    for k, text in changed.items():
                        texts[k] = text
                    columns[at] = pa.array(texts, columns[at].type)
                    if long_at is not None:
                        sizes = columns[long_at].to_pylist()
                        for k, text in changed.items():
                            sizes[k] = len(text)
                        columns[long_at] = pa.array(sizes, columns[long_at].type)
                    part = pa.RecordBatch.from_arrays(columns, names=docs_columns)
                yield part

    docs_columns = docs.columns
    return docs.mapInArrow(run, docs.schema)
