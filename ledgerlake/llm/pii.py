"""Personal data: regular expressions propose spans, validators confirm them, context scores them.

Offsets are code points, ends exclusive. Base kinds (email, ip, card, phone) have the
fixed patterns below and always stay once confirmed. Two more kinds are added: iban
(mod-97) and ssn, which needs a context word nearby because its shape proves little.

Defined cases: a null or empty text has no spans; texts are read whole, whatever their
length (every pattern runs in linear time: runs are possessive and start only where a
run starts, and an address is found from its "@" outwards); rows are independent, so
ties and repeated rows get equal results; an empty table gives no rows; other columns
are kept and not looked at.
"""
from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]

# The base patterns, written so that a failed start costs no second scan of its run.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_ANY = re.compile(r"[0-9@]")

BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
CONTEXT = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social", "security"),
}
CONTEXT_WINDOW = 40
CONTEXT_BONUS = 0.2
MIN_SCORE = 0.5  # for the added kinds only
_WORDS = {k: re.compile(r"(?<![a-z])(?:" + "|".join(v) + r")(?![a-z])") for k, v in CONTEXT.items()}


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97_ok(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1, start):
            start -= 1
        hit = _DOMAIN.match(text, at + 1) if start < at else None
        if hit:
            yield start, hit.end()
            done = hit.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m.group())
            if 13 <= len(d) <= 19 and luhn_ok(d):
                yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            yield m.span()


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        s = m.group().replace(" ", "")
        if 15 <= len(s) <= 34 and mod97_ok(s):
            yield m.span()


def _ssns(text: str):
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by kind as listed in KINDS, then by start."""
    if not text or not _ANY.search(text):
        return []
    found = []
    for kind, seek in (("email", _emails), ("ip", _ips), ("card", _cards), ("phone", _phones),
                       ("iban", _ibans), ("ssn", _ssns)):
        if kind == "email" and "@" not in text or kind == "phone" and "+" not in text:
            continue
        for a, b in seek(text):
            near = (text[max(0, a - CONTEXT_WINDOW):a] + " " + text[b:b + CONTEXT_WINDOW]).lower()
            score = min(1.0, BASE_SCORE[kind] + (CONTEXT_BONUS if _WORDS[kind].search(near) else 0.0))
            if kind in BASE_KINDS or score >= MIN_SCORE:
                found.append((kind, a, b, score))
    return found


_SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))


@F.pandas_udf(_SPANS)
def _spans_udf(text: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in find_spans(t)] for t in text])


def pii_spans(text: Column) -> Column:
    """array<struct<kind, start, end, score>> of a text column."""
    return _spans_udf(text)


_SUMMARY = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS]
                        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                           T.StructField("max_score", T.DoubleType())])


@F.pandas_udf(_SUMMARY)
def _summary_udf(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        spans = find_spans(t)
        said = [f"{k}:{a}:{b}" for k, a, b, _ in spans]
        base = ",".join(x for x, s in zip(said, spans) if s[0] in BASE_KINDS)
        rows.append((*(sum(s[0] == k for s in spans) for k in BASE_KINDS), hashlib.sha256(base.encode()).hexdigest(),
                     ",".join(said), max((s[3] for s in spans), default=0.0)))
    return pd.DataFrame(rows, columns=[f.name for f in _SUMMARY.fields])


def pii_summary(text: Column) -> Column:
    """struct of counts by base kind, the digest of the base spans, all spans as text, the top score."""
    return _summary_udf(text)


def redact(docs: DataFrame, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """`docs` with every span of at least `min_score` replaced by its kind in angle brackets.
    Overlapping spans are replaced once, by the kind that starts first."""
    @F.pandas_udf("string")
    def mask(text: pd.Series) -> pd.Series:
        out = []
        for t in text:
            parts, at = [], 0
            for k, a, b, s in sorted(find_spans(t), key=lambda x: (x[1], -x[2])):
                if s >= min_score and a >= at:
                    parts += [t[at:a], f"<{k}>"]
                    at = b
            out.append(t if at == 0 else "".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)
    return docs.withColumn(text_col, mask(F.col(text_col)))
