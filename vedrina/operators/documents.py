"""JSON texts read once for any number of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.functions.json_fields import typed
from vedrina.operators.parsing import PROBLEMS, RAW, READABLE, UNREADABLE

_TEXT, _DOCUMENT = "_text", "_document"


def read_document(text: Column) -> Column:
    """A JSON text as a variant; null where it is no JSON, or has something behind its end.

    The parser stops at the end of the first value. So the text is read as the first of two elements, the second of which no text
    can contain.
    """
    mark = F.xxhash64(text).cast("string")
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))

    def first(read: Column) -> Column:
        ended = F.try_variant_get(read, "$[1]", "string") == mark
        return F.when(ended & F.try_variant_get(read, "$[2]", "variant").isNull(), F.try_variant_get(read, "$[0]", "variant"))

    # A name for the parsed text, which would be parsed again wherever it is used.
    return F.element_at(F.transform(F.array(both), first), 1)


def select_paths(
    df: DataFrame, column: str, paths: list[tuple[str, str, str]], keep: list[str] | None = None
) -> DataFrame:
    """One row per text with the values at ``paths``, each given as (path such as ``$.a[0].b``, name, type), and the findings
    of ``parsing.parse_messages``: ``readable``, ``problems``, ``raw``. None is dropped here.

    The text is parsed once, whatever the number of paths; the schema need not be known, and arrays can be reached into. A value
    that does not fit its type is null and named in ``problems``; a missing one, or a JSON null, is null. Objects and
    arrays can be asked for as ``string`` and come as JSON.
    """
    keep = keep or []
    # Exploded from one element, the document is a column of its own and not parsed again for each path.
    read = df.select(*keep, F.col(column).cast("string").alias(_TEXT))
    read = read.select(*keep, _TEXT, F.explode(F.array(read_document(F.col(_TEXT)))).alias(_DOCUMENT))
    readable = F.col(_DOCUMENT).isNotNull()
    values, misfits = [], []
    for path, name, kind in paths:
        text = F.try_variant_get(_DOCUMENT, path, "string")
        value = typed(text, kind)
        values.append(value.alias(name))
        if kind != "string":
            misfits.append(F.when(text.isNotNull() & value.isNull(), F.lit(name)))
    names = F.array_compact(F.array(*misfits)) if misfits else F.array().cast("array<string>")
    problems = F.when(readable, names).otherwise(F.array(F.lit(UNREADABLE)))
    return read.select(
        *keep, *values, readable.alias(READABLE), problems.alias(PROBLEMS), F.when(F.size(problems) > 0, F.col(_TEXT)).alias(RAW)
    )


def explode_array(df: DataFrame, column: str, path: str, paths: list[tuple[str, str, str]], keep: list[str] | None = None) -> DataFrame:
    """One row per element of the array at ``path`` of a JSON text, numbered from 0 as ``element_no``, with the values at
    ``paths`` of the element (``$`` is the element). The text is parsed once, and its elements not again. Texts that are no JSON
    or have no array there give no row; ``select_paths`` finds them."""
    keep = keep or []
    read = df.select(*keep, F.explode(F.array(read_document(F.col(column).cast("string")))).alias(_DOCUMENT))
    elements = F.try_variant_get(_DOCUMENT, path, "array<variant>")
    each = read.select(*keep, F.posexplode(elements).alias("element_no", "element"))
    return each.select(*keep, "element_no", *[typed(F.try_variant_get("element", own, "string"), kind).alias(name) for own, name, kind in paths])
