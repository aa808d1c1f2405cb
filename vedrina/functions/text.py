"""Text functions: extraction, dictionaries, folding of accented letters."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the plain letters they fold to.
ACCENTED = "ČĆŽŠĐčćžšđÀÂÄÇÈÉÊËÎÏÔÖÙÛÜÑÁÍÓÚàâäçèéêëîïôöùûüñáíóú"
PLAIN = "CCZSDcczsdAAACEEEEIIOOUUUNAIOUaaaceeeeiioouuunaiou"


def fold(text: Column) -> Column:
    """The text with accented letters replaced by plain ones."""
    return F.translate(text, ACCENTED, PLAIN)


def translate_words(text: Column, words: dict[str, str]) -> Column:
    """The translation of the whole value; values the dictionary lacks stay as they are.

    For a dictionary kept as a table see ``operators.dictionary.translate_with``.
    """
    if not words:
        return text
    table = F.create_map(*[F.lit(word) for word in chain.from_iterable(words.items())])
    return F.coalesce(F.try_element_at(table, text), text)


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """What a group of the pattern matches; null where the pattern does not match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))
