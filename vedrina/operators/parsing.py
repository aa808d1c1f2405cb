"""Messages to typed rows, with the malformed ones set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.functions.json_fields import CORRUPT, read_record, typed
from vedrina.functions.times import date_of
from vedrina.schemas import FLAT_MESSAGE, NESTED_MESSAGE

READABLE, PROBLEMS, RAW = "readable", "problems", "raw"
FINDINGS = [READABLE, PROBLEMS, RAW]
UNREADABLE = "message"


def parse_messages(
    messages: DataFrame,
    fields: list[tuple[str, str, str]],
    value: str = "value",
    keep: list[str] | None = None,
    real: list[str] | None = None,
) -> DataFrame:
    """One typed row per message; none is dropped here.

    ``fields`` lists (path, column, type). Besides these columns a row has ``readable``, false when
    the text is no JSON object or has none of the fields (a message of another shape); ``problems``,
    the names of the fields whose text did not fit their type (``message`` for an unreadable text); and
    ``raw``, the text of a message with problems.

    ``real`` lists paths of kind "string" that mostly hold bare numbers for which a double is exact enough. They are read as
    doubles, which spares the reader a JSON writer per number, and given as the text of the double, which is also how the reader
    gives a bare fraction as text (``65`` becomes ``65.0``). A message with anything else there is read again, all as text.
    """
    keep = keep or []
    paths = [path for path, _, _ in fields]
    if real:
        return _parse_by_reals(messages, fields, value, keep, paths, set(real))
    record = read_record(F.col("_text"), paths)
    # Exploding the one record makes it a column of its own. As a plain expression it would be
    # parsed again in every filter that the optimizer moves below this projection.
    parsed = messages.select(*keep, F.col(value).cast("string").alias("_text")).select(
        *keep, "_text", F.explode(F.array(record)).alias("_record")
    )
    whole = F.col("_record").isNotNull() & F.col(f"_record.{CORRUPT}").isNull()
    return _rows(parsed, fields, keep, {path: F.col(f"_record.{path}") for path in paths}, whole)


def _parse_by_reals(
    messages: DataFrame, fields: list[tuple[str, str, str]], value: str, keep: list[str], paths: list[str], real: set[str]
) -> DataFrame:
    text = F.col("_text")
    # As in ``parse_messages``, each record is exploded to be parsed once.
    parsed = messages.select(*keep, F.col(value).cast("string").alias("_text")).select(
        *keep, "_text", F.explode(F.array(read_record(text, paths, real))).alias("_by_reals")
    )
    again = F.when(F.col(f"_by_reals.{CORRUPT}").isNotNull(), read_record(text, paths))
    parsed = parsed.select(*keep, "_text", "_by_reals", F.explode(F.array(again)).alias("_record"))
    fits = F.col(f"_by_reals.{CORRUPT}").isNull()
    texts = {path: F.when(fits, F.col(f"_by_reals.{path}").cast("string")).otherwise(F.col(f"_record.{path}")) for path in paths}
    # The texts are columns of their own, since they are used more than once.
    names = {path: f"_field{n}" for n, path in enumerate(paths)}
    read = F.col("_record").isNotNull() & F.col(f"_record.{CORRUPT}").isNull()
    whole = F.when(fits, F.col("_by_reals").isNotNull()).otherwise(read)
    parsed = parsed.select(*keep, "_text", whole.alias("_read"), *[texts[path].alias(names[path]) for path in paths])
    return _rows(parsed, fields, keep, {path: F.col(name) for path, name in names.items()}, F.col("_read"))


def _rows(
    parsed: DataFrame, fields: list[tuple[str, str, str]], keep: list[str], texts: dict[str, Column], whole: Column
) -> DataFrame:
    """The typed rows of records whose fields are ``texts`` by path; ``whole`` tells a record that could be read."""
    columns = [typed(texts[path], kind).alias(name) for path, name, kind in fields]
    readable = whole & F.coalesce(*[texts[path] for path, _, _ in fields]).isNotNull()
    problems = _problems(fields, texts, readable)
    return parsed.select(
        *keep,
        *columns,
        readable.alias(READABLE),
        problems.alias(PROBLEMS),
        F.when(F.size(problems) > 0, F.col("_text")).alias(RAW),
    )


def _problems(fields: list[tuple[str, str, str]], texts: dict[str, Column], readable: Column) -> Column:
    misfits = []
    for path, name, kind in fields:
        text = texts[path]
        if kind != "string":
            misfits.append(F.when(text.isNotNull() & typed(text, kind).isNull(), F.lit(name)))
    names = F.array_compact(F.array(*misfits)) if misfits else F.array().cast("array<string>")
    return F.when(readable, names).otherwise(F.array(F.lit(UNREADABLE)))


def parse_flat(messages: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Flat observation messages."""
    return parse_messages(messages, FLAT_MESSAGE, value, keep)


def parse_nested(messages: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Nested observation messages; the date comes from the local time."""
    rows = parse_messages(messages, NESTED_MESSAGE, value, keep)
    others = [name for name in rows.columns if name not in FINDINGS]
    return rows.select(*others, date_of(F.col("lokalno_vreme")).alias("datum"), *FINDINGS)


def accepted(parsed: DataFrame) -> DataFrame:
    """The rows to store: every readable message, misfit fields as null."""
    return parsed.filter(READABLE).drop(*FINDINGS)


def rejected(parsed: DataFrame) -> DataFrame:
    """The messages to look at: unreadable ones and those with misfit fields."""
    return parsed.filter(F.size(PROBLEMS) > 0)


def without_key(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """The messages without problems that lack a key, so that no upsert can place them: the names of
    the missing keys as ``problems``, and the parsed row as ``raw``."""
    missing = F.array_compact(F.array(*[F.when(F.col(key).isNull(), F.lit(key)) for key in keys]))
    row = F.to_json(F.struct(*[name for name in parsed.columns if name not in FINDINGS]))
    clean = parsed.filter(F.size(PROBLEMS) == 0)
    return clean.select(missing.alias(PROBLEMS), row.alias(RAW)).filter(F.size(PROBLEMS) > 0)
