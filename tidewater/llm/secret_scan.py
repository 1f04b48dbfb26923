"""Secret scans: base patterns, and multipart credentials linked in scopes.

Three base kinds are reported wherever they stand (assign, access, hex).  Weak
parts are reported only in company: an identifier next to a secret, an
endpoint next to a secret, a random-looking value next to an identifier or an
endpoint.  Next to means: the intervals of the two parts, widened by ``REACH``
code points on either side, overlap inside one scope (a block of lines without
a blank line between).  A secret inside an endpoint or an identifier, or across
its border, is next to it too; a value inside an identifier is the identifier's
own.  The interval join is a sweep over sorted parts: an overlap or the nearest
one on either side decides, and a document with n parts takes n log n steps
whatever it holds.

Null and empty texts have no spans.  Rows are independent of each other:
repeated rows give the same result each, an empty table an empty one; columns
besides id and text are not looked at.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as S

# --- fixed values: the base patterns --------------------------------------
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# --- end fixed values -----------------------------------------------------
HEX_LONG = re.compile(r"[0-9a-f]{24,}")  # a run is taken whole, so short runs need no match of their own
ASSIGN_HINTS = ("passw", "secret", "token", "api_key", "apikey")
IDENT = re.compile(r"""\b(?:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|access_?(?:key_?)?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""", re.I | re.A)
IDENT_HINTS = ("user", "login", "account", "client", "access", "key_id", "keyid")
ENDPOINT = re.compile(r"""\b[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+|\b(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{2,5})?""", re.I | re.A)
ENDPOINT_HINTS = ("://", "host", "endpoint", "server")
VALUE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
KINDS = ["assign", "access", "hex", "ident", "endpoint", "value"]
BASE = KINDS[:3]
REACH = 200
BITS = 3.5
PIECE = 256  # of a longer value the whole or one piece has to look random
BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def random_looking(value: str) -> bool:
    return (any(map(str.isdigit, value)) and any(map(str.isupper, value)) and any(map(str.islower, value))
            and (entropy(value) >= BITS or any(entropy(value[k:k + PIECE]) >= BITS for k in range(0, len(value), PIECE))))


def base_spans(text: str, lower: str) -> list[tuple[str, int, int]]:
    out = []
    if any(h in lower for h in ASSIGN_HINTS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in HEX_LONG.finditer(text)]
    return out


class Parts:
    """Intervals of one class, for overlap and nearest-neighbour checks."""

    def __init__(self, found: list[tuple[int, int]]):
        self.found = sorted(found)
        self.starts = [s for s, _ in self.found]
        self.ends = sorted(e for _, e in self.found)
        self.furthest = list(accumulate((e for _, e in self.found), max))

    def near(self, start: int, end: int, blanks: list[int]) -> bool:
        """Is a part other than this one within reach, in the same scope?"""
        k = bisect_left(self.starts, end)
        if k < len(self.starts) and self.starts[k] - end <= 2 * REACH and not _blank(blanks, end, self.starts[k]):
            return True
        k = bisect_right(self.ends, start) - 1
        return k >= 0 and start - self.ends[k] <= 2 * REACH and not _blank(blanks, self.ends[k], start)


    def overlap(self, start: int, end: int) -> bool:
        """Does a part share a code point with this span?"""
        k = bisect_left(self.starts, end)
        return k > 0 and self.furthest[k - 1] > start


def _blank(blanks: list[int], start: int, end: int) -> bool:
    k = bisect_left(blanks, start)
    return k < len(blanks) and blanks[k] < end


def find(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text, by start and then kind: base ones score 1, linked
    weak parts 0.5."""
    lower = text.lower()
    base = base_spans(text, lower)
    idents = [m.span() for m in IDENT.finditer(text)] if any(h in lower for h in IDENT_HINTS) else []
    endpoints = [m.span() for m in ENDPOINT.finditer(text)] if any(h in lower for h in ENDPOINT_HINTS) else []
    weak: list[tuple[str, int, int]] = []
    access = [(s, e) for k, s, e in base if k == "access"]
    if idents or endpoints or access:
        taken = Parts([(s, e) for _, s, e in base] + endpoints)
        values = []
        for m in VALUE.finditer(text):
            k = bisect_right(taken.starts, m.start())
            inside = k and taken.found[k - 1][1] > m.start() or k < len(taken.starts) and taken.starts[k] < m.end()
            if not inside and random_looking(m[0]):
                values.append(m.span())
        if values or len(base) > len(access):
            blanks = [m.start() for m in BLANK_LINE.finditer(text)]
            told = Parts([(s, e) for k, s, e in base if k != "access"])
            secrets = Parts(told.found + values)
            holders, places = Parts(idents + access), Parts(endpoints)
            weak += [("ident", s, e) for s, e in idents if told.overlap(s, e) or secrets.near(s, e, blanks)]
            weak += [("endpoint", s, e) for s, e in endpoints if told.overlap(s, e) or secrets.near(s, e, blanks)]
            weak += [("value", s, e) for s, e in values if holders.near(s, e, blanks) or places.near(s, e, blanks)]
    order = {k: i for i, k in enumerate(KINDS)}
    return [(k, s, e, 1.0 if k in BASE else 0.5) for k, s, e in sorted(base + weak, key=lambda x: (x[1], order[x[0]], x[2]))]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """Per row: id and spans (kind, start, end in code points, score)."""
    return S.find_spans(docs, find, id_col, text_col, keep_row)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span (overlapping ones as one) replaced by ``mark``."""
    if not text or not (found := find(text)):
        return text
    out, at = [], 0
    for _, start, end, _ in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", *(S.count(k).alias(f"n_{k}") for k in BASE), S.base_digest(BASE).alias("base_sha256"),
                        S.joined(F.col("spans")).alias("spans"))
