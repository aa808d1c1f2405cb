"""What the operators agree on: words, lines and null texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, \n, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"


def filled(text: str | Column) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: str | Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(filled(text), F.lit(WORD), F.lit(0))


def lines_with_words(text: str | Column) -> Column:
    """The lines (split at \\n) that have a word, in order."""
    return F.filter(F.split(filled(text), "\n", -1), lambda line: line.rlike(WORD))
