"""Personal data: patterns propose spans, checks confirm them, context adjusts.

Four base kinds (email, ip, card, phone) are always reported.  Further kinds
start from a prior, gain from a passed check (mod-97 of an IBAN, Luhn of a
short card number, the ranges of a social security number) and from context
words, whole ones, within ``REACH`` code points before them, and are reported from a score
of ``ENOUGH``; what fails its check is dropped.  Base spans carry scores too.

Null and empty texts have no spans.  Rows are independent: repeated rows give
the same result each, an empty table an empty one; other columns are not
looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as S

# --- fixed values: the base patterns --------------------------------------
# email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+  (matched from its
# sign outwards, so that long runs without one cost nothing)
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]")
# ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+): possessive digits, as none gives back,
# and no start inside a run of digits, as it fails where the run's start does
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# --- end fixed values -----------------------------------------------------
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
#: Lengths by country; of other codes every length is tried, the longest first.
IBAN_LENGTHS = {c: int(x[:2]) for x in (
    "15 NO", "16 BE", "18 DK FI FK FO GL NL SD", "19 MK SI", "20 AT BA EE KZ LT LU MN XK", "21 CH HR LI LV", "22 BG BH CR DE GB GE IE ME RS VA",
    "23 AE GI IL IQ OM SO TL", "24 AD CZ ES MD PK RO SA SE SK TN VG", "25 LY PT ST", "26 IS TR", "27 BI DJ FR GR IT MC MR SM", "28 AL AZ BY CY DO GT HN HU LB NI PL SV",
    "29 BR EG PS QA UA", "30 JO KW MU YE", "31 MT SC", "32 LC", "33 RU") for c in x[3:].split()}
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "card13"]
BASE = KINDS[:4]
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.3, "ssn": 0.3, "card13": 0.1}
CHECKED, NEARBY, ENOUGH, REACH = 0.4, 0.3, 0.5, 60
CARD_WORDS = {"card", "cards", "creditcard", "visa", "mastercard", "credit", "payment", "payments"}
CONTEXT = {
    "email": {"mail", "mails", "email", "emails", "contact", "write"}, "ip": {"ip", "ips", "ipv", "address", "addresses", "host", "hosts"}, "card": CARD_WORDS,
    "phone": {"phone", "phones", "telephone", "call", "tel", "telefon", "mobile"}, "iban": {"iban", "account", "accounts", "bank", "konto", "compte"},
    "ssn": {"ssn", "social", "security"}, "card13": CARD_WORDS,
}
LETTERS = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    iban = iban.replace(" ", "")
    return 15 <= len(iban) <= 34 and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str):
    last = 0
    for m in EMAIL_DOMAIN.finditer(text):
        at = start = m.start()
        while start > last and EMAIL_NAME.match(text[start - 1]):
            start -= 1
        if start < at:
            yield start, m.end()
            last = m.end()


def ibans(text: str):
    """Spans of numbers that pass their check.  The pattern may run on into the
    words that follow: a match is cut at a border of its groups."""
    at = 0
    while m := IBAN.search(text, at):
        start, at = m.start(), m.start() + 4
        ends = [k for k in range(m.end(), start + 14, -1) if k == m.end() or text[k] == " "]
        told = IBAN_LENGTHS.get(m[0][:2])
        for end in ends:
            if told in (None, end - start - text.count(" ", start, end)) and mod97(text[start:end]):
                yield start, end
                at = end
                break


def propose(text: str):
    """(kind, start, end, check passed or None where there is none)."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end, None
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in (x[-4:] if not x[:-4].strip("0") else "999" for x in m[0].split("."))):
            yield "ip", *m.span(), None
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span(), True
            elif len(digits) == 13:
                yield "card13", *m.span(), luhn(digits)
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                yield "phone", *m.span(), None
    for start, end in ibans(text):
        yield "iban", start, end, True
    if "-" in text:
        for m in SSN.finditer(text):
            yield "ssn", *m.span(), m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"


def find(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text with their scores, by start and then kind."""
    out = []
    for kind, start, end, passed in propose(text):
        if passed is False:
            continue
        before = set(LETTERS.findall(text[max(0, start - REACH):start].lower()))
        score = PRIOR[kind] + CHECKED * (passed is True and kind != "ssn") + NEARBY * (not before.isdisjoint(CONTEXT[kind]))
        if kind in BASE or score >= ENOUGH:
            out.append((kind, start, end, round(min(1.0, score), 2)))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda x: (x[1], order[x[0]]))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """Per row: id and spans (kind, start, end in code points, score)."""
    return S.find_spans(docs, find, id_col, text_col, keep_row)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", *(S.count(k).alias(f"n_{k}") for k in BASE), S.base_digest(BASE).alias("base_sha256"),
                        S.joined(F.col("spans")).alias("spans"))
