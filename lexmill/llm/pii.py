"""Format-preserving pseudonyms: validated numbers and dates are permuted by a keyed Feistel network.

A value is turned into an integer of its format's domain (card numbers with a right check digit, IBANs with right
check digits, dates of two centuries, ...), permuted there (walking on while outside the domain) and written in the
same format, so pseudonyms are valid, distinct values stay distinct and equal values stay equal in all documents.
Only values that pass their check are touched. Row by row, no shuffle; the key is a parameter and never stored.

Equal values are linked however they are written: separators are no part of a value; a phone number is its digits, those
behind a country code apart from it, so ``+49 151 2345678`` and ``+491512345678`` get the same digits; capitals of an
e-mail address are those of the pseudonym too, but don't change its letters.

Cards and IBANs whose match fails its check are tried again by shorter ends (cards at each separator or end, down to 13
digits; IBANs to their country's length, unknown countries at each token), and the search resumes after the number's own end.

Defined results: null texts stay null with no finding; texts without findings stay as they are; overlapping
findings go to the one that starts first, then to the earlier kind in ``KINDS``; extra columns stay, one named like the
column of findings is replaced; repeated rows and null ids are rows like others; an empty table stays empty.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import arrow_pass

ROUNDS = 8
KINDS = ["iban", "card", "ssn", "date", "ip", "phone", "email"]


def permuted(x: int, domain: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0 .. domain - 1: a Feistel network over two nearly equal parts, with cycle walking."""
    if domain < 2:
        return x
    a = math.isqrt(domain - 1) + 1
    b = -(-domain // a)
    seed = hashlib.blake2b(f"{tweak}:{domain}".encode(), key=key[:64], digest_size=16).digest()

    def step(i: int, half: int) -> int:
        return int.from_bytes(hashlib.blake2b(half.to_bytes(64, "big"), key=seed, salt=bytes([i]), digest_size=40).digest(), "big")

    while True:
        left, right = divmod(x, b)  # left in a, right in b
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                right = (right + sign * step(i, left)) % b
            else:
                left = (left + sign * step(i, right)) % a
        x = left * b + right
        if x < domain:
            return x


def luhn(digits: str) -> int:
    """The check digit of ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(value: str, key: bytes, tweak: str) -> str:
    return str(permuted(int(value), 10 ** len(value), key, f"{tweak}{len(value)}")).zfill(len(value))


def _card(value: str, key: bytes) -> str | None:
    d = re.sub(r"\D", "", value)
    if not 13 <= len(d) <= 19 or luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    body = _digits(d[:-1], key, "card")
    return _refill(value, body + str(luhn(body)))


#: Lengths of IBANs by country; one of another country may have any.
IBAN_LENGTHS = {
    c: int(n)
    for n, cs in (x.split(":") for x in (
        "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
        "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE "
        "31:MT,SC 33:LC,RU"
    ).split())
    for c in cs.split(",")
}


def _iban(value: str, key: bytes) -> str | None:
    raw = value.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if number(raw[4:] + raw[:4]) % 97 != 1:
        return None
    body = _classes(raw[4:], key, f"iban{raw[:2]}")
    check = 98 - number(body + raw[:2] + "00") % 97
    it = iter(f"{raw[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(it) for c in value)


def _iban_ends(value: str) -> list[int]:
    """Ends of a match to be tried: the token's that gives the country's length, then its own; without a known length all."""
    ends = [m.end() for m in re.finditer(r"[A-Z0-9](?![A-Z0-9])", value)][::-1]
    if want := IBAN_LENGTHS.get(value[:2]):
        return [*(e for e in ends if e < len(value) and len(value[:e].replace(" ", "")) == want), len(value)]
    return [len(value), *(e for e in ends[1:] if len(value[:e].replace(" ", "")) >= 15)]


def _card_ends(value: str) -> list[int]:
    """Ends of a match to be tried, longest first: those of its runs of digits."""
    ends = [m.end() for m in re.finditer(r"\d(?!\d)", value)]
    return [e for e in reversed(ends) if 13 <= sum(map(str.isdigit, value[:e])) <= 19]


def _found(kind: str, text: str, key: bytes) -> Iterator[tuple[int, int, str]]:
    """(start, end, pseudonym) of what passes its check, from left to right."""
    pattern, change = PATTERNS[kind]
    if kind not in ENDS:
        for m in pattern.finditer(text):
            if (new := change(m, key)) is not None:
                yield m.start(), m.end(), new
        return
    at = 0
    while m := pattern.search(text, at):
        for end in ENDS[kind](m[0]):
            if (new := change(m[0][:end], key)) is not None:
                yield m.start(), m.start() + end, new
                at = m.start() + end
                break
        else:  # a number may begin at a later token of what failed
            later = re.search(r"[^A-Za-z0-9]+", m[0])
            at = m.start() + later.end() if later else m.end()


def _classes(value: str, key: bytes, tweak: str) -> str:
    """Letters become letters of their case, digits digits; other characters stay."""
    kinds = [("0", 10) if c.isascii() and c.isdigit() else ("a", 26) if "a" <= c <= "z" else ("A", 26) if "A" <= c <= "Z" else (c, 1) for c in value]
    domain, x = 1, 0
    for c, (base, size) in zip(value, kinds, strict=True):
        domain, x = domain * size, x * size + ord(c) - ord(base)
    y = permuted(x, domain, key, tweak + "".join(k for k, _ in kinds))
    out = []
    for base, size in reversed(kinds):
        y, d = divmod(y, size)
        out.append(chr(ord(base) + d))
    return "".join(reversed(out))


def _ssn(m: re.Match, key: bytes) -> str | None:
    area, group, serial = int(m[1]), int(m[2]), int(m[3])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    x = permuted((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, "ssn")
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


FIRST, LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _date(m: re.Match, key: bytes) -> str | None:
    g = m.groupdict()
    order = "ymd" if g["y1"] else "dmy"
    y, mo, d = (g["y1"], g["m1"], g["d1"]) if g["y1"] else (g["y2"], g["m2"], g["d2"])
    sep = m["s1"] or m["s2"]
    try:
        day = dt.date(int(y), int(mo), int(d))
    except ValueError:
        if order == "ymd":
            return None
        try:  # month first
            day, order = dt.date(int(y), int(d), int(mo)), "mdy"
        except ValueError:
            return None
    if not FIRST <= day.toordinal() <= LAST:
        return None
    new = dt.date.fromordinal(FIRST + permuted(day.toordinal() - FIRST, LAST - FIRST + 1, key, "date"))
    return sep.join({"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}[c] for c in order)


def _ip(m: re.Match, key: bytes) -> str | None:
    parts = [int(p) for p in m[0].split(".")]
    if max(parts) > 255:
        return None
    x = permuted(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


#: Country codes of one and two digits (fixed values of the numbering plan); all others have three.
COUNTRY = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")


def _phone(m: re.Match, key: bytes) -> str | None:
    d = re.sub(r"\D", "", m[0])
    if not 9 <= len(d) <= 15:
        return None
    keep = COUNTRY.match(d).end() if m[0].startswith("+") else 0
    return _refill(m[0], d[:keep] + _digits(d[keep:], key, f"phone{d[:keep]}"))


def _email(m: re.Match, key: bytes) -> str | None:
    new = _classes(m[1].lower(), key, "email" + m[2].lower())
    return f"{''.join(n.upper() if c.isupper() else n for c, n in zip(m[1], new, strict=True))}@{m[2]}"


#: Kinds whose matches are also tried by shorter ends.
ENDS = {"iban": _iban_ends, "card": _card_ends}
PATTERNS: dict[str, tuple[re.Pattern, Callable[..., str | None]]] = {
    "iban": (re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"), _iban),
    "card": (re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w])"), _card),
    "ssn": (re.compile(r"(?<![\w-])(\d{3})-(\d{2})-(\d{4})(?![\w-])"), _ssn),
    "date": (re.compile(r"(?<![\w./-])(?:(?P<y1>\d{4})(?P<s1>[-/.])(?P<m1>\d{2})(?P=s1)(?P<d1>\d{2})|(?P<d2>\d{2})(?P<s2>[-/.])(?P<m2>\d{2})(?P=s2)(?P<y2>\d{4}))(?![\w/-]|\.\d)"), _date),
    "ip": (re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"), _ip),
    "phone": (re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])"), _phone),
    "email": (re.compile(r"(?<![\w.+-])([A-Za-z0-9._%+-]{1,64})@((?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![\w-])"), _email),
}
ANY = re.compile(r"[0-9@]")


def pseudonymized(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int, str]]]:
    """The new text and the findings (kind, start and end in the old text, pseudonym), from left to right."""
    if not ANY.search(text):
        return text, []
    found = []
    for rank, kind in enumerate(KINDS):
        found += [(start, rank, end, new) for start, end, new in _found(kind, text, key)]
    out, findings, at = [], [], 0
    for start, rank, end, new in sorted(found):
        if start >= at:
            out += [text[at:start], new]
            findings.append((KINDS[rank], start, end, new))
            at = end
    return "".join([*out, text[at:]]), findings


FINDING = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("pseudonym", StringType())])


def pseudonymize(documents: DataFrame, key: bytes, text: str = "text", findings: str = "findings") -> DataFrame:
    """``documents`` with pseudonyms in ``text``; adds ``findings``: array of (kind, start, end, pseudonym)."""
    documents = documents.drop(findings)
    names = documents.columns
    at = names.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = functools.partial(pseudonymized, key=key)
        for b in batches:
            done = [change(t.as_py()) if t.is_valid else (None, []) for t in b.column(at)]
            columns = [*b.columns]
            columns[at] = pa.array([d[0] for d in done], pa.string())
            rows = [[dict(zip(("kind", "start", "end", "pseudonym"), f, strict=True)) for f in d[1]] for d in done]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind)], [*names, findings])

    return arrow_pass(documents, run, StructType([*documents.schema.fields, StructField(findings, ArrayType(FINDING))]))
