"""Numeric parsing of dirty text (inventory X11-X18, X21, X26, P11).

All parsing uses ``try_cast`` (Spark 4 runs in ANSI mode, where a plain cast of
dirty text raises) behind a guard regex where Spark would be more lenient than
Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, ColumnOrName

# fixed values: the strict Roman numeral form accepted for parsing (1..4999)
ROMAN_PATTERN = r"^M{0,4}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"
# fixed values: letter values of Roman numerals
ROMAN_VALUES = {"M": 1000, "D": 500, "C": 100, "L": 50, "X": 10, "V": 5, "I": 1}

# fixed values: words that count as numbers
INT_WORD_PATTERN = r"^[0-9]+([,.][0-9]{3})*$"
FLOAT_WORD_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

DEFAULT_YEAR = 1678


def try_int(c: ColumnOrName) -> Column:
    """Python ``int(s)`` for strings: surrounding blanks allowed, and integral decimals
    (``2015.0``, as exports with gaps write them); else null."""
    return F.regexp_extract(_c(c).cast("string"), r"^\s*([+-]?\d+)(?:\.0*)?\s*$", 1).try_cast("int")


def _count_char(s: Column, ch: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))


def roman_to_int(c: ColumnOrName) -> Column:
    """Strict upper-case Roman numeral -> int, else null.

    Value = sum of letter values, minus the double-counted letter of each
    subtractive pair (CM/CD: 200, XC/XL: 20, IX/IV: 2); the guard admits at
    most one pair per decade, so ``contains`` is exact.
    """
    s = _c(c)
    total = sum(_count_char(s, ch) * v for ch, v in ROMAN_VALUES.items())
    total = (total
             - F.when(s.contains("CM") | s.contains("CD"), 200).otherwise(0)
             - F.when(s.contains("XC") | s.contains("XL"), 20).otherwise(0)
             - F.when(s.contains("IX") | s.contains("IV"), 2).otherwise(0))
    return F.when(s.rlike(ROMAN_PATTERN) & (F.length(s) > 0), total.cast("int"))


def volume_to_int(c: ColumnOrName) -> Column:
    """X11 + P11: int, else Roman (upper case only), else 0; above 10000 -> 0."""
    v = F.coalesce(try_int(c), roman_to_int(c), F.lit(0))
    return F.when(v > 10000, F.lit(0)).otherwise(v)


def issue_to_int(c: ColumnOrName) -> Column:
    """Int, else the first character as int, else 0 (``'12-13'`` -> 1, Q16)."""
    s = _c(c)
    return F.coalesce(try_int(s), try_int(F.substring(s, 1, 1)), F.lit(0))


def page_to_int(c: ColumnOrName) -> Column:
    """Int, else Roman numeral of the upper-cased text, else 0."""
    s = _c(c)
    return F.coalesce(try_int(s), roman_to_int(F.upper(s)), F.lit(0))


def clamp(c: ColumnOrName, low_exclusive, high_exclusive, default) -> Column:
    """Keep values strictly inside (low, high), else ``default``; null -> default."""
    x = _c(c)
    return F.when((x > low_exclusive) & (x < high_exclusive), x).otherwise(F.lit(default))


def page_count(c: ColumnOrName) -> Column:
    """X15 (+P11): ``'start-end'`` -> end - start, clamped to (0, 2e9) else 0.

    Uses the first two parts (``'1-2-3'`` -> 1); a single page or null -> 0 (Q15).
    """
    parts = F.split(_c(c), "-")
    start = page_to_int(F.get(parts, 0))
    end = page_to_int(F.get(parts, 1))
    return clamp(end - start, 0, 2000000000, 0)


def year_to_date(c: ColumnOrName) -> Column:
    """X16 + P11: year number -> 1 January of that year when 1676 < y < 2263,
    else (or null) 1 January 1678 (Q14: 1677 is kept)."""
    y = _c(c).cast("int")
    ok = (y > 1676) & (y < 2263)
    return F.when(ok, F.make_date(y, F.lit(1), F.lit(1))).otherwise(
        F.make_date(F.lit(DEFAULT_YEAR), F.lit(1), F.lit(1)))


def word_to_int(c: ColumnOrName) -> Column:
    """Digits with optional thousands groups (``1,234`` / ``1.234``) -> bigint."""
    s = _c(c)
    return F.when(s.rlike(INT_WORD_PATTERN),
                  F.regexp_replace(s, "[,.]", "").try_cast("bigint"))


def word_to_float(c: ColumnOrName) -> Column:
    """A plain decimal/exponent literal -> double; finite values only (Q22)."""
    s = _c(c)
    v = s.try_cast("double")
    return F.when(s.rlike(FLOAT_WORD_PATTERN) & ~F.isnan(v)
                  & (F.abs(v) != F.lit(float("inf"))), v)


def drop_null_and_zero(arr: ColumnOrName) -> Column:
    """Python ``filter(None, xs)`` — removes nulls and zeros."""
    return F.filter(_c(arr), lambda x: x.isNotNull() & (x != 0))


def int_or_zero(c: ColumnOrName) -> Column:
    """``0 if null else int(x)``."""
    return F.coalesce(_c(c).cast("bigint"), F.lit(0).cast("bigint"))
