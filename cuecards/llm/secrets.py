"""Secret scan with multipart credential linking.

Every whole text is searched for three base kinds (``assign``, ``access``,
``hex``), which are always reported, and for weak parts: short or temporary
access identifiers and user names (``weak_id``), long mixed tokens that no
keyword announces (``weak_secret``), and addresses (``endpoint``).  A weak part
alone proves nothing.  Within a text, parts are joined by an interval join on
their distance (at most ``scope`` code points between them): a weak secret
counts when an identifier (``access`` or ``weak_id``) lies in scope, a weak
identifier when a secret (``assign``, ``hex`` or ``weak_secret``) does, and an
endpoint when both do.  The scope never reaches into another text, so the join
needs no shuffle: both sides are sorted by position and swept once.

Base rules, leftmost and non-overlapping per kind, failing matches dropped:
see the fixed patterns below.  Offsets are code points, end exclusive.

Defined results: a null or empty text has no spans; repeated rows give the same
spans; weak parts that overlap a base span are not parts of their own; extra
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.llm import textvec as tv
from cuecards.llm.common import per_segment

# The base patterns (on UTF-8 bytes, so "either case" is ASCII only).
_ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LEN = 12, 18
# Weak parts.
_WEAK_ID = re.compile(rb"(?:AKIA|ASIA|AROA)[A-Z0-9]{8,}"
                      rb"|(?i:user(?:name)?|login|client_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}")
_WEAK_SECRET = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
_ENDPOINT = re.compile(rb"[a-z][a-z0-9+]{1,9}://[A-Za-z0-9._~:/@%-]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?")
KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]

_HEX_CLASS = np.zeros(256, bool)
_HEX_CLASS[[*b"0123456789abcdef"]] = True
_TOKEN_CLASS = np.zeros(256, bool)
_TOKEN_CLASS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes of the three base kinds."""
    out = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEN]
    out += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(out)


def weak_parts(text: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak candidates that overlap no base span nor an earlier weak kind."""
    found: list[tuple[int, int, int]] = []
    taken = list(base)
    for kind, pattern in ((5, _ENDPOINT), (3, _WEAK_ID), (4, _WEAK_SECRET)):
        starts = np.array([s for s, _, _ in sorted(taken)], np.int64)
        far = np.maximum.accumulate(np.array([e for _, e, _ in sorted(taken)] or [0], np.int64))
        new = []
        for m in pattern.finditer(text):
            before = int(np.searchsorted(starts, m.end(), "left"))  # spans that start before this one ends
            if before and far[before - 1] > m.start():
                continue
            token = m.group()
            if kind == 4 and not (re.search(rb"[0-9]", token) and re.search(rb"[A-Za-z]", token)):
                continue
            new.append((m.start(), m.end(), kind))
        found += new
        taken += new
    return found


def _near(points: list[tuple[int, int, int]], to: list[tuple[int, int, int]], scope: int) -> np.ndarray:
    """Whether each interval of ``points`` has one of ``to`` within ``scope``
    (both sorted by start): a sorted interval join that needs no pairs."""
    if not points or not to:
        return np.zeros(len(points), bool)
    s, e = np.array(points)[:, 0], np.array(points)[:, 1]
    to_s = np.array(to)[:, 0]
    reach = np.maximum.accumulate(np.array(to)[:, 1])
    upto = np.searchsorted(to_s, e + scope, "right")  # candidates that start before the scope ends
    return (upto > 0) & (reach[np.maximum(upto, 1) - 1] >= s - scope)


def link(spans: list[tuple[int, int, int]], scope: int) -> list[tuple[int, int, int]]:
    """The weak parts among ``spans`` (sorted, in code points) whose
    complementary parts lie in scope."""
    ids = [x for x in spans if x[2] in (1, 3)]
    secrets = [x for x in spans if x[2] in (0, 2, 4)]
    ends = [x for x in spans if x[2] == 5]
    weak_ids, weak_secrets = [x for x in ids if x[2] == 3], [x for x in secrets if x[2] == 4]
    out = [x for x, ok in zip(weak_secrets, _near(weak_secrets, ids, scope), strict=True) if ok]
    out += [x for x, ok in zip(weak_ids, _near(weak_ids, secrets, scope), strict=True) if ok]
    both = _near(ends, ids, scope) & _near(ends, secrets, scope)
    return out + [x for x, ok in zip(ends, both, strict=True) if ok]


def _runs(raw: np.ndarray, off: np.ndarray, cls: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    start, end, _ = tv.word_bounds(raw, off, cls)
    long = end - start >= least
    return start[long], end[long]


def _scanner(scope: int):
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def one(raw, off, carry):
        n = len(off) - 1
        # a text without any of these bytes or runs cannot hold a span
        suspect = np.zeros(n, bool)
        marks = [np.flatnonzero((raw == 0x3A) | (raw == 0x3D)), _runs(raw, off, _HEX_CLASS, 16)[0]]
        starts, ends = _runs(raw, off, _TOKEN_CLASS, 12)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[raw])])
        marks.append(starts[digits[ends] > digits[starts]])
        seg = raw.tobytes()
        marks.append(np.array([m.start() for m in re.finditer(rb"AKIA|ASIA|AROA", seg)], np.int64))
        for where in marks:
            suspect[np.searchsorted(off, where, "right") - 1] = True
        base_out, all_out = [], []
        for i in range(n):
            if not suspect[i]:
                base_out.append([])
                all_out.append([])
                continue
            text = seg[off[i]: off[i + 1]]
            base = base_spans(text)
            parts = base + weak_parts(text, base)
            if not parts:
                base_out.append([])
                all_out.append([])
                continue
            lead = np.concatenate([[0], np.cumsum((raw[off[i]: off[i + 1]] & 0xC0) != 0x80)])
            points = sorted((int(lead[s]), int(lead[e]), k) for s, e, k in parts)
            kept = [x for x in points if x[2] < 3]
            row = lambda x: {"kind": KINDS[x[2]], "start": x[0], "end": x[1]}
            in_order = lambda xs: [row(x) for x in sorted(xs, key=lambda x: (x[0], x[2], x[1]))]
            base_out.append(in_order(kept))
            all_out.append(in_order(kept + link(points, scope)))
        return pa.RecordBatch.from_arrays(
            [carry["doc"], pa.array(base_out, pa.list_(span)), pa.array(all_out, pa.list_(span))],
            ["doc", "base", "spans"])

    return per_segment(one, "text", "doc")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 200) -> DataFrame:
    """Per row: ``doc``, the ``base`` spans and all ``spans`` (kind, start,
    end), ordered by start and then kind."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    spans = "array<struct<kind: string, start: int, end: int>>"
    return src.mapInArrow(_scanner(scope), f"doc long, base {spans}, spans {spans}")
