"""Format-preserving pseudonyms for personal data.

A value is first validated and taken apart into an index within the set of all valid values of its
kind; a keyed Feistel network permutes that set; the new index is written in the old spelling. The
same value therefore gets the same pseudonym in every document and spelling, and no two values share one.
"""

from __future__ import annotations

import datetime
import re
from bisect import bisect
from collections.abc import Callable, Iterable
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakemart.llm.common import add_columns

ROUNDS = 10
FIELDS = "{text} string, pii array<struct<kind:string,start:int,stop:int,pseudonym:string>>"

# First and last day that counts as a date; month lengths come with the calendar.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
# Total length of an account number (IBAN) by country, as registered.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


def permute(index: int, size: int, key: bytes, kind: str) -> int:
    """Keyed permutation of ``range(size)``: an alternating Feistel network on the pair (left, right)
    with left in range(a), right in range(b), a * b >= size, walked on until it falls inside."""
    if size < 2:
        return index
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(index, b)
        for i in range(ROUNDS):
            if i % 2:
                right = (right + _mix(key, kind, size, i, left)) % b
            else:
                left = (left + _mix(key, kind, size, i, right)) % a
        index = left * b + right
        if index < size:
            return index


def _mix(key: bytes, kind: str, size: int, number: int, half: int) -> int:
    data = f"{kind}|{size}|{number}|{half}".encode()
    return int.from_bytes(blake2b(data, key=key, digest_size=32).digest(), "big")


def luhn_digit(digits: str) -> int:
    """Check digit that makes ``digits`` + it valid."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        d = int(d) * (2 if place % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def respell(old: str, digits: str) -> str:
    """``digits`` in the places of the digits of ``old``."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in old)


def _card(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or digits[0] not in "23456" or luhn_digit(digits[:-1]) != int(digits[-1]) \
            or len(set(digits)) == 1:
        return None
    middle = digits[1:-1]
    new = digits[0] + str(permute(int(middle), 10 ** len(middle), key, "card")).zfill(len(middle))
    return respell(found, new + str(luhn_digit(new)))


def _address(found: str, key: bytes) -> str | None:
    parts = found.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    new = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip")
    return ".".join(str(b) for b in new.to_bytes(4, "big"))


def _national(digits: str, key: bytes) -> str | None:
    """Ten-digit number whose area and exchange start with 2 to 9."""
    if digits[0] in "01" or digits[3] in "01":
        return None
    area, exchange, line = int(digits[:3]) - 200, int(digits[3:6]) - 200, int(digits[6:])
    new, line = divmod(permute((area * 800 + exchange) * 10_000 + line, 800 * 800 * 10_000, key, "phone"), 10_000)
    return f"{new // 800 + 200}{new % 800 + 200}{line:04d}"


def _phone(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    plus = found.startswith("+")
    if len(digits) == 11 and digits[0] == "1" or len(digits) == 10 and not plus:
        new = _national(digits[-10:], key)
        return new and respell(found, digits[:-10] + new)
    if plus and 8 <= len(digits) <= 15:
        rest = digits[2:]
        return respell(found, digits[:2] + str(permute(int(rest), 10 ** len(rest), key, "phone" + digits[:2])).zfill(len(rest)))
    return None


def _social(found: str, key: bytes) -> str | None:
    area, group, serial = map(int, found.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    index = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rest, serial = divmod(permute(index, 898 * 99 * 9999, key, "ssn"), 9999)
    area, group = divmod(rest, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _account(found: str, key: bytes) -> str | None:
    plain = found.replace(" ", "")
    if len(plain) != IBAN_LENGTH.get(plain[:2]) or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    body = _permute_classes(plain[4:], key, "iban" + plain[:2])
    new = iter(f"{plain[:2]}{98 - _mod97(body + plain[:2] + '00'):02d}{body}")
    return "".join(c if c == " " else next(new) for c in found)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _permute_classes(text: str, key: bytes, kind: str) -> str:
    """Digits become digits, capital and small letters stay such; everything else stays as it is."""
    classes = [(i, base, size) for i, c in enumerate(text) for base, size in
               ((48, 10), (65, 26), (97, 26)) if base <= ord(c) < base + size]
    index, total = 0, 1
    for i, base, size in classes:
        index, total = index * size + ord(text[i]) - base, total * size
    shape = "".join({10: "0", 26: "a"}[size] for _, _, size in classes)
    new, out = permute(index, total, key, f"{kind}|{shape}|{text.translate(_FLAT)}"), list(text)
    for i, base, size in reversed(classes):
        new, digit = divmod(new, size)
        out[i] = chr(base + digit)
    return "".join(out)


# Letters and digits all alike, so that only the shape of a text remains.
_FLAT = {**{c: "0" for c in range(48, 58)}, **{c: "A" for c in range(65, 91)}, **{c: "a" for c in range(97, 123)}}


def _mail(found: str, key: bytes) -> str | None:
    name, domain = found.lower().rsplit("@", 1)
    return f"{_permute_classes(name, key, 'mail')}@{domain}"


def _day(year: str, month: str, day: str, key: bytes) -> datetime.date | None:
    try:
        date = datetime.date(int(year), int(month), int(day))
    except ValueError:
        return None
    if not FIRST_DAY <= date <= LAST_DAY:
        return None
    days = (LAST_DAY - FIRST_DAY).days + 1
    return FIRST_DAY + datetime.timedelta(days=permute((date - FIRST_DAY).days, days, key, "date"))


def _date(found: str, key: bytes) -> str | None:
    """Year first, or day first; with slashes month first unless only day first is a date."""
    a, sep, b, _, c = re.split(r"([-/.])", found)
    if len(a) == 4:
        new = _day(a, b, c, key)
        return new and f"{new.year:04d}{sep}{new.month:02d}{sep}{new.day:02d}"
    if sep == "/" and int(a) <= 12:
        new = _day(c, a, b, key)
        return new and f"{new.month:02d}/{new.day:02d}/{new.year:04d}"
    new = _day(c, b, a, key)
    return new and f"{new.day:02d}{sep}{new.month:02d}{sep}{new.year:04d}"


# Kinds in order of precedence: the left border, the value, what must not follow, and the rule. What a
# rule does not validate is left as it is. Digits after a blank are no bar: values stand beside other numbers.
KINDS: list[tuple[str, str, str, str, Callable]] = [
    ("iban", r"(?<![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", r"[A-Za-z0-9]", _account),
    ("card", r"(?<![0-9])(?<![0-9][.-])", r"[0-9](?:[ -]?[0-9]){12,18}", r"-?[0-9]", _card),
    ("ssn", r"(?<![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9-]", _social),
    ("ip", r"(?<![0-9.])", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", r"[0-9]|\.[0-9]", _address),
    ("date", r"(?<![0-9./-])", r"(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})", r"[0-9]|[./-][0-9]", _date),
    ("phone", r"(?<![0-9+])", r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}", r"[0-9]", _phone),
]
#: No value of a kind in ``KINDS`` is longer: an account number with a blank before every character.
LONGEST = 64
MAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")


class Pseudonyms:
    """Finds and replaces personal data in texts."""

    def __init__(self, key: bytes):
        self.key = key
        self.kinds = [(kind, re.compile(f"{before}(?={value})"), re.compile(value), re.compile(after), lru_cache(65_536)(rule))
                      for kind, before, value, after, rule in KINDS]
        self.digit = re.compile("[0-9]")
        # Any stretch in which one of the number patterns can lie.
        self.stretch = re.compile(r"[A-Z0-9+(][A-Z0-9 ().+/-]{6,}")
        self.mail = lru_cache(65_536)(_mail)

    def find(self, text: str) -> list[tuple[str, int, int, str]]:
        """Disjoint (kind, start, stop, pseudonym) in order of place."""
        found: list[tuple[str, int, int, str]] = []  # sorted by place
        if "@" in text:
            for m in MAIL.finditer(text):
                found.append(("mail", m.start(), m.end(), self.mail(m[0], self.key)))
        for area in self.stretch.finditer(text):
            if not self.digit.search(text, area.start(), area.end()):
                continue
            for kind, starts, value, after, rule in self.kinds:
                at = 0
                for m in starts.finditer(text, area.start(), area.end()):
                    if m.start() < at:
                        continue
                    # Every right end, the farthest first.
                    for stop in range(min(area.end(), m.start() + LONGEST), m.start(), -1):
                        if text[stop - 1].isalnum() and not after.match(text, stop) and value.fullmatch(text, m.start(), stop) \
                                and (new := rule(text[m.start():stop], self.key)):
                            place = bisect(found, m.start(), key=lambda f: f[1])
                            if (place == 0 or found[place - 1][2] <= m.start()) and (place == len(found) or stop <= found[place][1]):
                                found.insert(place, (kind, m.start(), stop, new))
                                at = stop
                                break
        return found

    @staticmethod
    def replace(text: str, found: Iterable[tuple[str, int, int, str]]) -> str:
        out, at = [], 0
        for _, start, stop, new in found:
            out += text[at:start], new
            at = stop
        return "".join([*out, text[at:]])


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``pii``: kind, place in the old text, new value.

    Kinds: payment cards (Luhn), account numbers (mod 97), social security numbers, IPv4 addresses,
    phone numbers, dates, and mail addresses, whose domain stays. Of the ends a value can have, the farthest
    valid one counts; invalid candidates stay as they are, and where two kinds overlap the first in ``KINDS`` wins. Null stays null, with no findings. Whole
    texts, row by row, no shuffle. ``key`` (16 to 64 bytes) is the secret; the same key gives the same
    pseudonyms in every run. An existing ``pii`` column is replaced.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")

    def start():
        worker = Pseudonyms(key)

        def work(texts: pa.Array):
            new, places = [], []
            for body in texts.to_pylist():
                found = worker.find(body) if body else []
                new.append(worker.replace(body, found) if found else body)
                places.append([{"kind": k, "start": a, "stop": b, "pseudonym": p} for k, a, b, p in found])
            return new, places
        return work

    return add_columns(docs, [text], FIELDS.format(text=text), start)


def pii_report(docs: DataFrame, key: bytes) -> DataFrame:
    """Pseudonymised text and findings per document."""
    done = pseudonymise(docs.select("doc_id", "text"), key)
    return done.select("doc_id", "text", F.size("pii").cast("long").alias("n_found"),
                       F.array_join(F.transform("pii", lambda p: p["kind"]), ",").alias("kinds"))
