"""Secrets in texts, and credentials whose parts only count together.

Three kinds of base spans always count: assignments of a secret, access key
ids and long hexadecimal runs.  Weak parts (names of accounts, random-looking
words, endpoints) are common in clean text; they are joined with the other
parts of the same text whose intervals lie within a scope of SCOPE code
points, and reported only when the complementary part is there: an identifier
or a random-looking word needs the other, an endpoint needs both.

The interval join runs over the sorted parts of one text by binary search, so
a text with very many parts costs n log n, and no text leaves its task.

Defined results: a null text is empty and has no spans; rows are independent.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pricepanel.lineage import ship
from pricepanel.llm.columns import text_slices

#: Kinds of base spans in their order, patterns, and least lengths.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: Weak parts; their names may have a prefix before an underscore, as in DB_USER or aws_access_key_id.
LINKED = ("identifier", "weak_secret", "endpoint")
IDENTIFIER = re.compile(
    r"""(?<![A-Za-z0-9])(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|app_?id|key_?id|access_?key_?id)"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})""",
    re.I | re.A,
)
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"""\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+"""
    r"""|(?<![A-Za-z0-9])(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::\d+)?""",
    re.I | re.A,
)
#: Code points between parts of one scope.
SCOPE = 300

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, without the failing ones."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], BASE.index(s[0])))


# A run of the class that is long enough is matched whole, as the plain pattern would.
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)


def _looks_random(word: str) -> bool:
    kinds = sum(bool(re.search(p, word)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    return kinds == 3 and len(set(word)) >= 12


class _Intervals:
    """Sorted intervals without overlap; says whether one lies within the scope of another interval."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [s for s, _ in self.spans]
        self.ends = [e for _, e in self.spans]

    def near(self, start: int, end: int) -> bool:
        # Those that end at or after start - SCOPE and start at or before end + SCOPE.
        lo, hi = bisect_left(self.ends, start - SCOPE), bisect_right(self.starts, end + SCOPE)
        # One of them ends before this interval, or starts behind it.
        return lo < bisect_right(self.ends, start) or bisect_left(self.starts, end) < hi

    def overlaps(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end


def _apart(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unite spans that overlap."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak parts whose complementary parts are within their scope."""
    taken = _Intervals(_apart([(s, e) for _, s, e in base]))
    weak_id = [m.span() for m in IDENTIFIER.finditer(text) if not taken.overlaps(*m.span())]
    identifiers = _Intervals(_apart(weak_id + [(s, e) for kind, s, e in base if kind == "access"]))
    if not identifiers.spans:
        return []
    used = _Intervals(_apart(taken.spans + identifiers.spans))
    weak_secret = [
        m.span() for m in RANDOM.finditer(text) if _looks_random(m[0]) and not used.overlaps(*m.span())
    ]
    secrets = _Intervals(_apart(weak_secret + [(s, e) for kind, s, e in base if kind != "access"]))
    if not secrets.spans:
        return []
    out = [("identifier", s, e) for s, e in weak_id if secrets.near(s, e)]
    out += [("weak_secret", s, e) for s, e in weak_secret if identifiers.near(s, e)]
    for m in ENDPOINT.finditer(text):
        s, e = m.span()
        if identifiers.near(s, e) and secrets.near(s, e):
            out.append(("endpoint", s, e))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_ORDER = {kind: i for i, kind in enumerate(BASE + LINKED)}
_NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"]


def scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans as text, number of linked parts."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = []
            for doc_id, body in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                base = base_spans(body or "")
                more = linked_spans(body or "", base)
                every = sorted(base + more, key=lambda s: (s[1], _ORDER[s[0]]))
                counts = [sum(s[0] == kind for s in base) for kind in BASE]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((doc_id, *counts, digest, _joined(every), len(more)))
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)

    chosen = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text}` AS text")
    return chosen.mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long",
    )
