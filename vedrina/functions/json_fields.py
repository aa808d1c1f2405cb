"""JSON held in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vedrina.functions.numbers import real_from_text, whole_from_text

CORRUPT = "_corrupt"


def json_path(text: Column, path: str) -> Column:
    """The scalar at a path such as ``$.current.temp_c``, as text; null where there is none."""
    return F.get_json_object(text, path)


def read_elements(text: Column) -> Column:
    """A JSON array as the text of each of its elements, in one more array, whose second entry tells that nothing followed the
    array: see ``whole_array``. Parse it once and test it then."""
    wrapped = F.concat(F.lit("["), text, F.lit(',["'), _end_mark(text), F.lit('"]]'))
    return F.from_json(wrapped, "array<array<string>>")


def whole_array(read: Column, text: Column) -> Column:
    """Whether ``read``, made of ``text`` by ``read_elements``, is one array and nothing else."""
    end = F.try_element_at(read, F.lit(2))
    found = (F.size(read) == 2) & F.try_element_at(read, F.lit(1)).isNotNull() & (F.try_element_at(end, F.lit(1)) == _end_mark(text))
    return F.coalesce(found, F.lit(False))


def _end_mark(text: Column) -> Column:
    # A text that closes the array itself and goes on would have to contain its own hash.
    return F.xxhash64(text).cast("string")


def text_schema(paths: list[str], real: set[str] = frozenset(), prefix: str = "") -> T.StructType:
    """The struct that holds every dotted path as text, those in ``real`` as doubles."""
    children: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        children.setdefault(head, [])
        if rest:
            children[head].append(rest)
    return T.StructType(
        [
            T.StructField(
                name,
                text_schema(rest, real, f"{prefix}{name}.") if rest
                else T.DoubleType() if prefix + name in real else T.StringType(),
            )
            for name, rest in children.items()
        ]
    )


def read_record(text: Column, paths: list[str], real: set[str] = frozenset()) -> Column:
    """Parse one JSON object; its ``_corrupt`` field holds the text when it is no such object, or has something else than a
    number at a path in ``real``, which are read as doubles and the others as text."""
    schema = text_schema(paths, real).add(CORRUPT, "string")
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT})


def typed(text: Column, data_type: str) -> Column:
    """A JSON scalar, held as text, in its type; null where it does not fit.

    Whole numbers may be written with a decimal point (``65.0``), and numbers may be quoted.
    """
    if data_type == "string":
        return text
    if data_type in ("timestamp_ntz", "date"):
        return text.try_cast(data_type)
    number = F.btrim(text, F.lit('"'))
    if data_type in ("int", "bigint"):
        return whole_from_text(number, data_type)
    if data_type in ("float", "double"):
        return real_from_text(number, data_type)
    return number.try_cast(data_type)
