"""Finding personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Kinds are email, ip, card (Luhn), phone and iban (mod 97). Patterns match leftmost and do not overlap
within a kind; a match that its validator refuses is dropped without another try, except that an iban is
tried at every shorter end before a space, and the next at the word after. Every pattern is entered only where a run of its characters begins, so long runs cost linear time.

Results in special cases: a NULL text counts as empty; an empty text has no spans; repeated rows
give one result each; other columns of the input are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import map_text, pick

# The patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
KINDS = ["email", "ip", "card", "phone", "iban"]

# Score of a confirmed span, what one context word adds, and how near it must stand.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": ["mail", "email", "e-mail", "contact", "write", "kontakt", "correo"],
    "ip": ["address", "server", "host", "login"],
    "card": ["card", "visa", "credit", "payment", "karte", "carte", "tarjeta"],
    "phone": ["phone", "telephone", "call", "tel", "mobile", "fax"],
    "iban": ["iban", "bank", "account", "konto", "compte", "cuenta"],
}
AGAINST = {"ip": ["version", "release"], "card": ["order", "serial", "isbn"], "phone": ["order", "serial"]}
WEIGHT, NEAR = 0.1, 40


def _any_of(words: list[str]) -> re.Pattern[str]:
    """The words as whole words, or in the plural."""
    return re.compile(r"\b(" + "|".join(words) + r")s?\b")


OWN, OTHERS = ({kind: _any_of(words) for kind, words in lists.items()} for lists in (CONTEXT, AGAINST))

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    """Whether the digits' weighted sum is a multiple of ten."""
    odd = sum(map(int, digits[::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number's rotated value leaves 1 when divided by 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost e-mail addresses: from each sign back over the local part, then on over the domain."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        matched = DOMAIN.match(text, at) if start < at else None
        done = matched.end() if matched else at + 1
        if matched:
            found.append((start, done))
        at = text.find("@", done)
    return found


def _digits(string: str) -> str:
    return "".join(c for c in string if "0" <= c <= "9")


def ibans(text: str) -> list[tuple[int, int]]:
    """Leftmost account numbers, each to the last end before a space at which its checksum holds."""
    found, m = [], IBAN.search(text)
    while m:
        start, end = m.span()
        while end > start and not (15 <= len(plain := text[start:end].replace(" ", "")) <= 34 and mod97(plain)):
            end = text.rfind(" ", start, end)
        if end > start:
            found.append((start, end))
        m = IBAN.search(text, max(end, start + 1))
    return found


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Confirmed matches by kind, then start."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:] or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found + [("iban", s, e) for s, e in ibans(text)]


def score(text: str, kind: str, start: int, end: int) -> float:
    """The prior of the kind, raised by words of its own nearby and lowered by words of others."""
    low, high = max(0, start - NEAR), min(len(text), end + NEAR)
    while low and low > start - 2 * NEAR and text[low - 1].isalnum():  # whole words
        low -= 1
    while high < min(len(text), end + 2 * NEAR) and text[high].isalnum():
        high += 1
    near = f"{text[low:start]} {text[end:high]}".lower()
    change = len(set(OWN[kind].findall(near))) - (len(set(OTHERS[kind].findall(near))) if kind in OTHERS else 0)
    return round(min(1.0, max(0.0, PRIOR[kind] + WEIGHT * change)), 3)


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and ``spans``, an array of (kind, start, end, score), by kind, then start."""
    span = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def work(texts: list[str | None]) -> dict[str, list]:
        made = []
        for t in texts:
            spans = proposals(t) if t else []
            made.append([{"kind": k, "start": s, "end": e, "score": score(t, k, s, e)} for k, s, e in spans])
        return {"spans": made}

    return map_text(pick(docs, key, text), work, T.StructType([T.StructField("spans", T.ArrayType(span))]), text)


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts, digests and scores of the spans per document."""
    found = find_pii(docs)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] != "iban")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"),
    )
