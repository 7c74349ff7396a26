"""String and array column expressions (inventory X1-X10, X19, X20, X22, X25, X27).

Every function maps Columns to a Column and stays inside whole-stage codegen:
no Python UDF anywhere. Regular expressions are Java regexes; Python's ``\\w``,
``\\s`` and IGNORECASE are Unicode-aware, so the Java forms carry ``(?U)`` /
``(?iu)``, and ``(?d)`` makes ``.`` stop only at ``\\n`` as in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower(c: ColumnOrName) -> Column:
    """Case folding of keywords."""
    return F.lower(_c(c))


def strip(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (Spark's ``trim`` removes only spaces)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def split_literal(c: ColumnOrName, sep: str) -> Column:
    """Split on a literal separator such as ``'; '`` or ``', '``."""
    import re
    return F.split(_c(c), re.escape(sep))


def tokens(c: ColumnOrName) -> Column:
    """``str.split()`` without argument — runs of whitespace, no empties."""
    return F.filter(F.split(_c(c), r"(?U)\s+"), lambda t: t != F.lit(""))


def split_words_flat(arr: ColumnOrName) -> Column:
    """List of strings -> list of the words of all strings (split on one space)."""
    return F.flatten(F.transform(_c(arr), lambda s: F.split(s, " ")))


def clean_name(c: ColumnOrName) -> Column:
    """Remove digits, ``&word`` entities, ``@word`` tags, ``'| '``, then the
    characters ``; ( ) . |``, then surrounding whitespace."""
    # fixed values: the patterns that are removed, in this order
    x = F.regexp_replace(_c(c), "[0-9]+", "")
    x = F.regexp_replace(x, r"(?U)&\w+", "")
    x = F.regexp_replace(x, r"(?U)@\w+", "")
    x = F.regexp_replace(x, r"\| ", "")
    x = F.regexp_replace(x, r"[;().|]", "")
    return strip(x)


def split_fullname(c: ColumnOrName) -> Column:
    """``'Surname, First Middle ...'`` -> struct(surname, firstname, middlename).

    Without a comma the whole string is the surname and the other two are null;
    only the first word after the first given name is kept as middle name.
    """
    parts = split_literal(c, ", ")
    first_middle = F.split(F.get(parts, 1), " ")
    return F.struct(
        F.get(parts, 0).alias("surname"),
        F.get(first_middle, 0).alias("firstname"),
        F.get(first_middle, 1).alias("middlename"),
    )


def pairs(arr: ColumnOrName) -> Column:
    """Flatten the strings of ``arr`` by spaces and cut the words into
    consecutive pairs; an odd last word is dropped (floor(n/2) pairs, decision Q6).
    """
    words = split_words_flat(arr)
    n_pairs = F.floor(F.size(words) / 2).cast("int")
    return F.when(
        n_pairs >= 1,
        F.transform(F.sequence(F.lit(0), n_pairs - 1),
                    lambda i: F.slice(words, i * 2 + 1, 2)),
    ).otherwise(F.array().cast("array<array<string>>"))


def remove_first(arr: ColumnOrName, value: str, min_size: int = 3) -> Column:
    """Remove the first occurrence of ``value`` from lists of at least
    ``min_size`` elements (``array_remove`` would drop every occurrence)."""
    a = _c(arr)
    pos = F.array_position(a, value).cast("int")
    n = F.size(a)
    return F.when(
        (n >= min_size) & (pos > 0),
        F.concat(F.slice(a, 1, pos - 1), F.slice(a, pos + 1, n - pos)),
    ).otherwise(a)


def parse_name_list(name_list: ColumnOrName) -> Column:
    """X9 on one author: list from ``split(author, ', ')`` -> array of
    (surname, firstname) pairs.

    * 2 parts: kept as they are;
    * more than 2 (after removing a first ``'Van'``): words cut into pairs;
    * 1 part: kept only if longer than 2 characters, then cut into pairs.
    """
    a = remove_first(name_list, "Van")
    n = F.size(a)
    return (
        F.when(n == 2, F.array(a))
        .when(n > 2, pairs(a))
        .when((n == 1) & (F.length(F.get(a, 0)) > 2), pairs(a))
        .otherwise(F.array().cast("array<array<string>>"))
    )


def parse_author_string(c: ColumnOrName) -> Column:
    """``'Smith, John; Brown, Kim'`` -> array of [surname, firstname] pairs,
    in order of appearance. Explode the result for one row per author."""
    return F.flatten(F.transform(split_literal(c, "; "),
                                 lambda a: parse_name_list(F.split(a, ", "))))


def strip_single_quote(c: ColumnOrName) -> Column:
    """Delete every ``'``."""
    return F.translate(_c(c), "'", "")


def text_before_citation(c: ColumnOrName) -> Column:
    """The part of a sentence before the first ``START_CITE ... END_CITE``
    (Python ``re.split(...)[0]``; the marker pair must lie on one line)."""
    return F.regexp_replace(_c(c), r"(?d)START_CITE .* END_CITE(?s:.*)", "")


def matches_heading(c: ColumnOrName, pattern: str) -> Column:
    """``re.match(pattern, s, re.IGNORECASE)`` — anchored at the start only,
    case-insensitive in Unicode, ``.`` not crossing a line break. Null -> false."""
    return F.coalesce(_c(c).rlike(f"(?iud)^(?:{pattern})"), F.lit(False))


def is_blank(c: ColumnOrName) -> Column:
    """P7 helper: ``str.isspace()`` — non-empty and only whitespace."""
    return _c(c).rlike(r"(?U)^\s+$")


def words(c: ColumnOrName) -> Column:
    """Letter runs of a text (used to derive keywords/entities from prose)."""
    return F.regexp_extract_all(_c(c), F.lit(r"\p{L}+"), 0)


def counted(values: Column) -> Column:
    """array<struct(value, n)>: the distinct values of an array, sorted, with their counts. Equal values lie
    together in the sorted array; a count is the distance between the starts of two runs."""
    def runs(ordered: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1),
                          lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        # an array of one binds a value to a name, so that it is computed once
        return F.flatten(F.transform(F.array(starts), lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(ordered, i).alias("value"),
            (F.coalesce(F.get(at, k + 1), F.size(ordered)) - i).cast("bigint").alias("n")))))
    found = F.flatten(F.transform(F.array(F.array_sort(values)), runs))
    return F.when(F.size(values) > 0, found)
