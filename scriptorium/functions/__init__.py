"""Column expressions: ``text`` (strings, names, arrays), ``numbers``
(numerals, pages, years, numeric tokens) and ``weights`` (vote weights and
the category rules of the paper summary)."""

from . import numbers, text, weights  # noqa: F401
