"""Column helpers. All are built-in expressions, so they stay inside generated code.

ANSI mode is left on: bad input becomes null through the ``try_`` forms and the cleaning
rules then reject it.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

__all__ = [
    "MONEY", "accents_removed", "blank_to_null", "days_between", "digest", "hours_between", "money",
    "on_or_after", "parse_timestamp", "ratio", "region_of", "row_hash", "score_category", "share", "tidy",
    "tidy_lower", "tidy_title", "tidy_upper", "valid_zip", "year_month",
]

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONEY = "decimal(18,2)"

# Letters that no decomposition makes plain, and ligatures.
PLAIN_LETTERS = {"Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ħ": "H", "ħ": "h", "Ŧ": "T",
                 "ŧ": "t", "ı": "i", "Ŀ": "L", "ŀ": "l", "ſ": "s", "ĸ": "k", "Ŋ": "N", "ŋ": "n"}
LIGATURES = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "TH", "þ": "th", "Ĳ": "IJ", "ĳ": "ij", "ŉ": "n"}
MARKS = "".join(map(chr, range(0x300, 0x370)))


def _letters() -> tuple[str, str]:
    """Accented letters of Latin-1 and Latin Extended-A and their plain forms, position by position. Marks
    that follow a letter have no counterpart and are taken out."""
    plain = dict(PLAIN_LETTERS)
    for letter in map(chr, range(0xC0, 0x180)):
        base = unicodedata.normalize("NFD", letter)[0]
        if base != letter and base.isascii() and letter not in LIGATURES:
            plain[letter] = base
    return "".join(plain) + MARKS, "".join(plain.values())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact two-digit decimal, null when the value does not fit."""
    return _col(c).try_cast(MONEY)


def ratio(numerator, denominator) -> Column:
    """Double quotient, null on a zero denominator.

    Operands are exact sums and counts, so the result does not depend on row order.
    """
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def share(value, over) -> Column:
    """Part of the window total."""
    return ratio(value, F.sum(_col(value)).over(over))


def tidy(c) -> Column:
    return F.trim(_col(c))


def tidy_lower(c) -> Column:
    return F.lower(F.trim(_col(c)))


def tidy_upper(c) -> Column:
    return F.upper(F.trim(_col(c)))


def tidy_title(c) -> Column:
    return F.initcap(F.trim(_col(c)))


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def accents_removed(c) -> Column:
    """Letters of Latin-1 and Latin Extended-A without accents, composed or not; ligatures are spelled out."""
    spelled = _col(c)
    for ligature, letters in LIGATURES.items():
        spelled = F.replace(spelled, F.lit(ligature), F.lit(letters))
    return F.translate(spelled, *_letters())


def valid_zip(c) -> Column:
    """Zip prefixes are kept as text; one to five digits."""
    return F.trim(_col(c)).rlike("^[0-9]{1,5}$")


def parse_timestamp(c, fmt: str = TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def year_month(c) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def days_between(later, earlier) -> Column:
    """Calendar days, null if either side is null."""
    return F.datediff(_col(later), _col(earlier))


def hours_between(later, earlier) -> Column:
    """Elapsed hours with fraction."""
    return ratio(F.unix_timestamp(_col(later)) - F.unix_timestamp(_col(earlier)), F.lit(3600))


def on_or_after(later, earlier) -> Column:
    """True when the order holds or one side is unknown."""
    return F.coalesce(_col(later) >= _col(earlier), F.lit(True))


def score_category(c) -> Column:
    return F.when(_col(c) <= 2, "Negative").when(_col(c) == 3, "Neutral").otherwise("Positive")


def region_of(state, regions: dict[str, str], default: str = "Unknown") -> Column:
    """State to region. The mapping is a small parameter, compiled into one ``case``."""
    expr = None
    for region in dict.fromkeys(regions.values()):
        states = [s for s, r in regions.items() if r == region]
        matches = _col(state).isin(states)
        expr = F.when(matches, region) if expr is None else expr.when(matches, region)
    return F.lit(default) if expr is None else expr.otherwise(default)


def digest(*columns) -> Column:
    """Surrogate key: 128-bit digest of the natural key, null for a null key.

    64-bit hashes start to collide at some billion keys, so they are not used.
    """
    parts = [_col(c).cast("string") for c in columns]
    known = parts[0].isNotNull()
    for part in parts[1:]:
        known = known & part.isNotNull()
    return F.when(known, F.md5(F.concat_ws("\u0001", *parts)))


def row_hash(*columns) -> Column:
    """Content hash; null and empty text differ, and so do ``a|b`` and ``ab|``."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("\u0000")) for c in columns]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)
