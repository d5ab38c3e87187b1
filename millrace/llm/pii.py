"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score
(native DataFrame functions only).

Base kinds (email, ip, card, phone) keep every proposed span that passes its validator. Added
kinds are kept when their score reaches ``ACCEPT``: a base value per kind, raised by a checksum
(mod-97 for IBAN, Luhn for short card numbers) and by a context word close to the span.

Defined cases: NULL text counts as empty and gives zero spans; spans are code points, end
exclusive; repeated rows and equal ids each give their own row; an empty table gives an empty
result; further columns of the input do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled, regex_spans, sha256_hex, text_or_empty

# Possessive forms of the stated patterns: the same matches without backtracking, so that long
# runs cost linear time. (?:\G|(?<!..)) lets an e-mail start only where its run starts or the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])"
SSN = r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])"

ACCEPT = 60
#: Score of a confirmed span by kind, and what a context word adds.
SCORES = {"email": 70, "ip": 50, "card": 70, "phone": 50, "iban": 80, "ssn": 40, "shortcard": 40}
CONTEXT_BONUS = 30
CONTEXT_CHARS = 40
CONTEXT_WORDS = {
    "email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|credit|debit|payment",
    "phone": "phone|tel|mobile|call|fax", "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social|security|insurance", "shortcard": "card|amex|visa|credit|diners",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "shortcard")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True if a string of digits has a valid Luhn checksum."""
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(F.reverse(number), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """True if an IBAN without spaces has remainder 1: first four characters last, letters as 10 to 35."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        n = F.when(is_digit, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (acc * F.when(is_digit, 10).otherwise(100) + n) % 97
    chars = F.filter(F.split(moved, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), add) == 1


def confirmed(kind: str, value: Column) -> Column:
    """The validator of a kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def part_ok(p: Column) -> Column:
            short = F.regexp_replace(p, "^0+", "")
            return F.when(F.length(short) <= 3, F.coalesce(short.try_cast("int"), F.lit(0)) <= 255).otherwise(False)
        return F.forall(F.split(value, r"\."), part_ok)
    if kind in ("card", "shortcard"):
        low, high = (16, 19) if kind == "card" else (13, 15)
        d = digits(value)
        return F.when(F.length(d).between(low, high), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    if kind == "iban":
        v = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(F.length(v).between(15, 34), mod97(v)).otherwise(False)
    area = F.substring(value, 1, 3)
    return ~area.isin("000", "666") & (area < "900") & (F.substring(value, 5, 2) != "00") & (F.substring(value, 8, 4) != "0000")


def score(kind: str, span: Column) -> Column:
    near = F.concat_ws(" ", span["before"], span["after"])
    return F.lit(SCORES[kind]) + F.when(near.rlike(rf"(?i)(?<![A-Za-z0-9_])(?:{CONTEXT_WORDS[kind]})"), CONTEXT_BONUS).otherwise(0)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one array<struct<start,end,value,score>> column per kind (base, then added)."""
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "ssn": SSN, "shortcard": CARD}
    text = text_or_empty(text_col)

    def spans(kind: str) -> Column:
        ok = F.filter(regex_spans(text, patterns[kind], CONTEXT_CHARS), lambda s: confirmed(kind, s["value"]))
        rated = F.transform(ok, lambda s: F.struct(s["start"], s["end"], s["value"], score(kind, s).alias("score")))
        return F.filter(rated, lambda s: s["score"] >= ACCEPT) if kind in ADDED else rated

    return docs.select(F.col(id_col).alias("doc_id"), *[spans(k).alias(k) for k in BASE + ADDED])


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find_pii``."""
    base = F.concat(*[labelled(k, F.col(k)) for k in BASE])
    added = F.concat(*[labelled(k, F.col(k)) for k in ADDED])
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE],
        sha256_hex(F.array_join(base, ",")).alias("base_sha256"),
        F.array_join(F.concat(base, added), ",").alias("spans"))
