"""License scan by canonical digests, in DataFrame functions only.

A text is brought to a canonical form: small letters, lines that claim a copyright dropped (but no line inside a paragraph that only
begins with the word or has it in quotes, so that the form does not hang on where lines break), everything but letters and digits one space, spellings
that mean the same made the same. Its SHA-256 is looked up among the digests of known
licences and licence notices. What is looked up is a whole document, and each of its lines: a licence matches only
when the entire text (or line) is that licence, never by a part of it.

Defined results: a null or empty text, and one of punctuation only, matches nothing. Rows that share an id are scanned as
one document; rows without an id too. Known texts with one canonical form
are one licence, the first in order of names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vedrina.llm.entire_licenses import entire
from vedrina.llm.known_licenses import KNOWN, SPELLINGS
from vedrina.llm.text import filled

# The statement of a text's own publisher may stand inside a paragraph, where a line break may fall anywhere.
FOUNDATION = r"copyright[ \t\n\r]+\(c\)[ \t\n\r]+[0-9][0-9, \t\n\r-]*free[ \t\n\r]+software[ \t\n\r]+foundation,?[ \t\n\r]+inc\.([ \t\n\r]*<[^>\n]*>)?"
# Lines without a letter or digit; they part paragraphs.
BLANK_LINES = r"(^|\n)[^\p{L}\p{N}©]*\n"
# A line with a copyright sign or word and a year claims a copyright wherever it stands; one that only begins like a claim does so
# at the head of a paragraph, or below another claim.
_DATED = r"[^\p{L}\p{N}©\n]*(?:copyright[^\p{L}\p{N}\n]*(?:c[^\p{L}\p{N}\n]+)?[0-9]{4}|\(c\)[^\p{L}\p{N}\n]*[0-9]{4}|©)[^\n]*"
_CLAIM = r"[^\p{L}\p{N}©\x22“\n]*(?:copyright|all rights reserved)[^\n]*"
CLAIMS = rf"(?:(?:^|\n){_DATED}|(?:^|\n\n){_CLAIM})(?:\n+(?:{_DATED}|{_CLAIM}))*"
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column, spellings: tuple[tuple[str, str], ...] = SPELLINGS) -> Column:
    """The canonical form."""
    plain = F.regexp_replace(F.lower(text), FOUNDATION, " ")
    plain = F.regexp_replace(F.regexp_replace(plain, BLANK_LINES, "\n\n"), CLAIMS, " ")
    plain = F.concat(F.lit(" "), F.regexp_replace(plain, NOT_A_WORD, "  "), F.lit(" "))
    # Two spaces between words, so that neighbours do not share one.
    for spelling, same_as in spellings:
        plain = F.replace(plain, F.lit(f" {spelling.replace(' ', '  ')} "), F.lit(f" {same_as} "))
    plain = F.trim(F.regexp_replace(plain, " +", " "))
    return plain


def digest(text: Column, spellings: tuple[tuple[str, str], ...] = SPELLINGS) -> Column:
    return F.sha2(canonical(text, spellings), 256)


def _listed(spark: SparkSession, columns: str, rows: list[tuple[str, str]]) -> DataFrame:
    values = ", ".join(f"(:n{k}, :t{k})" for k in range(len(rows)))
    named = {f"n{k}": name for k, (name, _) in enumerate(rows)} | {f"t{k}": text for k, (_, text) in enumerate(rows)}
    return spark.sql(f"SELECT * FROM VALUES {values} AS known({columns})", named)


def known_digests(spark: SparkSession, known: dict[str, list[str]] | None = None) -> DataFrame:
    """``digest`` and ``license`` of the known texts (those of ``known_licenses`` and ``entire_licenses`` unless others are
    given). Its size is that of the list, which the planner sees: the digests are made first, and pass through the driver."""
    listed = [known] if known is not None else [KNOWN, entire()]
    rows = [(name, text) for names in listed for name, texts in names.items() for text in texts]
    # A form that is all copyright lines would match every text of which nothing is left.
    texts = _listed(spark, "license, text", rows).filter(canonical(F.col("text")) != "")
    digests = texts.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license"))
    return _listed(spark, "license, digest", [(row["license"], row["digest"]) for row in digests.collect()]).select("digest", "license")


def matches(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and per line of it: the id, ``line`` (from 0; -1: the whole text) and ``license``, null where
    nothing matches."""
    whole = F.array(F.struct(F.lit(-1).alias("line"), filled(text).alias("unit")))
    split = F.transform(F.split(filled(text), "\n", -1), lambda u, k: F.struct(k.alias("line"), u.alias("unit")))
    units = docs.select(F.col(id), F.explode(F.concat(whole, split)).alias("_unit"))
    digests = units.select(id, F.col("_unit.line").alias("line"), digest(F.col("_unit.unit")).alias("digest"))
    return digests.join(known, "digest", "left").select(id, "line", "license")


def license_scan(docs: DataFrame, known: DataFrame | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, ``n_lines``, ``n_matching_lines``, ``licenses`` (in order, joined by commas) and
    ``is_license``: the whole text is one."""
    known = known_digests(docs.sparkSession) if known is None else known
    found = matches(docs, known, id, text)
    is_line = F.col("line") >= 0
    return found.groupBy(id).agg(
        F.count_if(is_line).alias("n_lines"),
        F.count_if(is_line & F.col("license").isNotNull()).alias("n_matching_lines"),
        # At most as many names as the list of known licences has.
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
        F.max((F.col("line") == -1) & F.col("license").isNotNull()).alias("is_license"),
    )
