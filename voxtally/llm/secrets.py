"""Secret scanning with linking of the parts of a credential.

Patterns with a keyword or a fixed form are reported by themselves.  Other parts are weak: an opaque string, a
named account or an address proves nothing alone.  They are reported only when
complementary parts meet: positions of weak secrets are joined with the positions of identifiers and
endpoints of the same scope by interval, and those within reach of each other are linked.
A scope is a stretch of a text without an empty line.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.common import map_batches, present, whole_documents

# The kinds that are reported by themselves, in their order.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: The kinds that need a partner.
WEAK_KINDS = ("weak_secret", "weak_identifier", "weak_endpoint")
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_IDENTIFIER = re.compile(r"""\b(?:client|account|access|user|login)[_-]?(?:id|key_id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}""", re.IGNORECASE | re.ASCII)
_ENDPOINT = re.compile(r"""\b(?:https?|jdbc:[a-z]+|mongodb|postgres(?:ql)?|amqps?|redis|s3)://[^\s"'<>]+""", re.IGNORECASE | re.ASCII)
_HEX_RUN = re.compile(r"[0-9a-f]{24,}")
_BREAK = re.compile(r"\n[ \t\r]*\n")

KINDS = {kind: i for i, kind in enumerate(BASE_KINDS + WEAK_KINDS)}
#: Code points between parts that still belong together.
REACH = 300

Span = tuple[int, int, str]
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def base_spans(text: str) -> list[Span]:
    """What is reported by itself: start, end, kind."""
    found: list[Span] = []
    low = text.lower()
    if any(key in low for key in ("passw", "secret", "token", "api")):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    # A run of hexadecimal digits is taken whole, so its least length may stand in the pattern.
    found += [(*m.span(), "hex") for m in _HEX_RUN.finditer(text)]
    return sorted(found, key=_place)


def _place(span: Span) -> tuple[int, int]:
    return span[0], KINDS[span[2]]


def _opaque(value: str) -> bool:
    """Digits, capitals and small letters together, as made-up words do not have them."""
    return any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value)


def linked_spans(text: str, base: list[Span], reach: int = REACH) -> list[Span]:
    """Weak parts that complement each other within a scope; none overlaps a base span's text."""
    taken = sorted((s, e) for s, e, _ in base)
    starts = np.array([s for s, _ in taken])
    ends = np.maximum.accumulate([e for _, e in taken]) if taken else starts

    def free(span: tuple[int, int]) -> bool:
        k = int(np.searchsorted(starts, span[1])) - 1
        return k < 0 or ends[k] <= span[0]

    secrets = [m.span() for m in _OPAQUE.finditer(text) if _opaque(m[0])]
    secrets = [s for s in secrets if free(s)]
    low = text.lower() if secrets or base else ""
    endpoints = [m.span() for m in _ENDPOINT.finditer(text)] if "://" in low else []
    names = [m.span() for m in _IDENTIFIER.finditer(text) if free(m.span())] if low and any(k in low for k in ("client", "account", "access", "user", "login")) else []
    secrets = _outside(secrets, endpoints) if endpoints else secrets
    strong_secrets = [(s, e) for s, e, kind in base if kind in ("assign", "hex")]
    strong_names = [(s, e) for s, e, kind in base if kind == "access"]
    breaks = np.array([m.end() for m in _BREAK.finditer(text)])
    others = names + strong_names + endpoints
    known = secrets + strong_secrets
    out = [(*s, "weak_secret") for s, near in zip(secrets, _near(secrets, others, breaks, reach), strict=True) if near]
    out += [(*s, "weak_identifier") for s, near in zip(names, _near(names, known, breaks, reach), strict=True) if near]
    # An endpoint goes with a credential that has both an identifier and a secret.
    both = np.logical_and(_near(endpoints, known, breaks, reach), _near(endpoints, names + strong_names, breaks, reach))
    return out + [(*s, "weak_endpoint") for s, near in zip(endpoints, both, strict=True) if near]


def _outside(spans: list[tuple[int, int]], covers: list[tuple[int, int]]) -> list[tuple[int, int]]:
    begins, stops = np.array([c[0] for c in covers]), np.array([c[1] for c in covers])
    at = np.searchsorted(begins, [s[0] for s in spans], side="right") - 1
    return [s for s, k in zip(spans, at, strict=True) if k < 0 or stops[k] <= s[0]]


def _near(left: list[tuple[int, int]], right: list[tuple[int, int]], breaks: np.ndarray, reach: int) -> np.ndarray:
    """Interval join: which of ``left`` have one of ``right`` in their scope within ``reach``.  Both sides are
    sorted, and each interval is one pair of binary searches, however many parts a text has."""
    if not left or not right:
        return np.zeros(len(left), bool)
    starts = np.sort([s for s, _ in right])
    stops = np.sort([e for _, e in right])
    begin, end = np.array([s for s, _ in left]), np.array([e for _, e in left])
    edges = np.concatenate([[0], breaks, [np.iinfo(np.int64).max]])
    scope = np.searchsorted(edges, begin, side="right")
    lowest = np.maximum(begin - reach, edges[scope - 1])
    highest = np.minimum(end + reach, edges[scope])
    after = np.searchsorted(starts, highest) > np.searchsorted(starts, begin)  # begins at or after it, within reach
    before = np.searchsorted(stops, begin, side="right") > np.searchsorted(stops, lowest, side="right")
    return after | before


def all_spans(text: str, reach: int = REACH) -> list[Span]:
    base = base_spans(text)
    return sorted([*base, *linked_spans(text, base, reach)], key=_place)


def told(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id`` and ``spans`` (array of kind, start, end in code points) of every whole text.

    A null text is an empty one and has no spans.  Rows are treated alone, so repeated rows give repeated results.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in all_spans(present(t.as_py()), reach)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return map_batches(whole_documents(documents), work, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def digests(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans as text; rows as in :func:`scan`, null ids stay null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            for text in batch.column("text"):
                spans = all_spans(present(text.as_py()), reach)
                base = [s for s in spans if s[2] in BASE_KINDS]
                for column, value in zip(columns, (
                    *(sum(s[2] == kind for s in base) for kind in BASE_KINDS), hashlib.sha256(told(base).encode()).hexdigest(), told(spans),
                ), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns, kinds)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            )

    return map_batches(whole_documents(documents), work, SCHEMA)


def redacted(text: str, reach: int = REACH) -> str:
    """The text with every reported span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at, kind = [], 0, ""
    merged: list[list] = []
    for start, end, kind in all_spans(text, reach):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[at:start], f"<{kind}>"]
        at = end
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """All columns of ``documents``, secrets in ``text`` replaced; a null text stays null, ``n_chars`` is counted anew."""
    names = documents.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redacted(t, reach) for t in batch.column("text").to_pylist()]
            arrays = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(arrays, list(names))

    out = documents.mapInArrow(work, documents.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out
