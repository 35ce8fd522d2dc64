"""Secrets in text: single patterns, and credentials whose parts stand apart.

Base patterns find assigned secrets, access identifiers and long hexadecimal strings
anywhere. Weaker candidates, too common to report alone, are other identifiers,
long random-looking strings and endpoints. They are joined by interval: the scope
of a candidate reaches ``WITHIN`` characters to both sides, but not over an empty
line. A weak identifier is reported with a secret in its scope, a weak secret with
an identifier, an endpoint with both. An identifier's own value is not its secret.

Defined results: a null text counts as empty and has no spans; positions are code
points, ends exclusive; spans stand by start, then kind as listed; repeated rows
give repeated results.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import map_texts

BASE_KINDS = ("assign", "access", "hex")
LINKED_KINDS = ("ident", "secret", "endpoint")

#: How far a candidate's scope reaches, in characters.
WITHIN = 400

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
IDENT = re.compile(
    r"""(?:client|key|account|user|tenant)_?(?:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{4,}""", re.IGNORECASE | re.ASCII
)
# Whole runs of any length, also of the URL alphabet and escaped, and also right behind a '='.
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]|%[0-9A-Fa-f]{2}){32,}+={0,2}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"""(?:https?|jdbc:[a-z]+|mongodb|redis|amqp|s3)://[^\s"'<>]+""")
EMPTY_LINE = re.compile(r"\n[\x20\t\r]*\n")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each pattern that do not overlap; those too short are dropped afterwards."""
    found: list[Span] = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    # Matches are whole runs, so asking for the length at once finds the same ones.
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _random_looking(text: str) -> bool:
    return all(re.search(c, text) for c in ("[A-Z]", "[a-z]", "[0-9]"))


def _near(own: list[Span], others: list[Span], breaks: np.ndarray, apart: bool = False) -> list[bool]:
    """Whether each span has one of the others in its scope; one that does not overlap it, if ``apart``.

    Both are sorted and free of overlaps within a kind, so starts and ends are
    searched apart: an interval join without comparing pairs.
    """
    if not own or not others:
        return [False] * len(own)
    start, end = (np.array([s[i] for s in own]) for i in (1, 2))
    others_start, others_end = (np.sort([s[i] for s in others]) for i in (1, 2))
    section = np.searchsorted(breaks, start)
    limits = np.concatenate(([0], breaks, [np.iinfo(np.int64).max]))
    low = np.maximum(start - WITHIN, limits[section])
    high = np.minimum(end + WITHIN, limits[section + 1])
    before = np.searchsorted(others_end, low, side="right")
    count = np.searchsorted(others_start, high, side="left") - before
    if apart:
        count -= np.searchsorted(others_start, end, side="left") - np.searchsorted(others_end, start, side="right")
    return (count > 0).tolist()


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """The weak candidates that have their complementary parts in scope."""
    lower = text.lower()
    idents = [("ident", *m.span()) for m in IDENT.finditer(text)] if "id" in lower or "name" in lower else []
    access = [s for s in base if s[0] == "access"]
    if not idents and not access:
        return []
    taken = np.array(sorted(s[1:] for s in base), np.int64).reshape(-1, 2)
    reached = np.maximum.accumulate(taken[:, 1])

    def free(spans: list[Span]) -> list[Span]:
        """Those that overlap no base span."""
        begun = np.searchsorted(taken[:, 0], [s[2] for s in spans])
        return [s for s, i in zip(spans, begun.tolist(), strict=True) if not i or reached[i - 1] <= s[1]]

    idents = free(idents)
    weak = free([("secret", *m.span()) for m in SECRET.finditer(text) if _random_looking(m[0])])
    strong = [s for s in base if s[0] != "access"]
    breaks = np.array([m.start() for m in EMPTY_LINE.finditer(text)], np.int64)

    def chosen(own: list[Span], *groups: list[Span], apart: bool = False) -> list[Span]:
        """Those of ``own`` with one span of any of the groups in scope."""
        hits = [_near(own, g, breaks, apart) for g in groups]
        return [s for s, *h in zip(own, *hits, strict=True) if any(h)]

    found_idents = chosen(idents, weak, *_by_kind(strong), apart=True)
    found_secrets = chosen(weak, access, idents, apart=True)
    ends = free([("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]) if "://" in text else []
    with_ident = chosen(ends, access, found_idents)
    found_ends = chosen(with_ident, found_secrets, *_by_kind(strong))
    return found_idents + found_secrets + found_ends


def _by_kind(spans: list[Span]) -> list[list[Span]]:
    return [[s for s in spans if s[0] == k] for k in BASE_KINDS]


def spans_of(text: str | None) -> list[Span]:
    if not text:
        return []
    base = base_spans(text)
    order = {k: i for i, k in enumerate(BASE_KINDS + LINKED_KINDS)}
    return sorted(base + linked_spans(text, base), key=lambda s: (s[1], order[s[0]]))


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping ones by the first's."""
    if not spans:
        return text
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _array(spans: list[list[Span]]) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in found] for found in spans], SPAN_TYPE)


def scan(docs: DataFrame) -> DataFrame:
    """Replaces the text column by ``spans``: an array of kind, start and end."""
    return map_texts(
        docs,
        "spans array<struct<kind: string, start: bigint, end: bigint>>",
        lambda: lambda texts: {"spans": _array([spans_of(t) for t in texts])},
    )


def redact(docs: DataFrame) -> DataFrame:
    """The text column, moved to the end, with all spans masked."""
    return map_texts(
        docs, "masked string", lambda: lambda texts: {"masked": pa.array([masked(t, spans_of(t)) for t in texts], pa.string())}
    ).withColumnRenamed("masked", "text")


def joined(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans, comma-joined; of some kinds only, if given."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
