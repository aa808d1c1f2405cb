"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A document is kept if it breaks no rule. The rules are tried one after the other and the first that is
broken ends the trial, so their order changes the cost and never the verdict. The order comes from a sample:
for each rule the time it takes there and the share of documents it rejects; rules with the
highest rejection per second go first.

Defined results: a null text has no words, so it breaks ``few_words``. Rules are never null. An empty table
keeps its columns and the rules their given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.llm.text import filled, lines_with_words, words
from vedrina.shared import new_path, written

SYMBOLS = r"[#*$%&|<>]"
# The sample has about this many documents. It only decides the order of the rules.
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    """``broken`` tells from the text and the list of its words whether the document is to be rejected."""

    name: str
    broken: Callable[[Column, Column], Column]


# --- measures of a text -------------------------------------------------------------------------


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(filled(text), SYMBOLS.replace("[", "[^", 1) + "+", "")).cast("bigint")


def word_chars(word_list: Column) -> Column:
    return F.length(F.array_join(word_list, "")).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    lines = lines_with_words(text)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def windows(word_list: Column, width: int = 3) -> Column:
    """A hash for each window of ``width`` words."""
    starts = F.sequence(F.lit(0), F.size(word_list) - width)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[word_list[i + k] for k in range(width)]))
    return F.when(F.size(word_list) >= width, hashes).otherwise(F.array().cast("array<bigint>"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _repeated(pairs: Column) -> Column:
    # In sorted order equal hashes are neighbours.
    neighbours = F.zip_with(
        pairs, F.slice(pairs, 2, F.size(pairs)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
    )
    return F.sort_array(F.array_distinct(F.flatten(F.filter(neighbours, lambda p: p.isNotNull()))))


def repeated_starts(hashes: Column) -> Column:
    """The places of the hashes that occur twice or more, in order."""
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return bound(F.sort_array(pairs), _repeated)


def covered_words(starts: Column, width: int = 3) -> Column:
    """How many words the windows at these (ordered) starts cover together."""
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        starts,
        state,
        lambda s, p: F.struct((p + width).alias("end"), (s["n"] + p + width - F.greatest(p, s["end"])).alias("n")),
        lambda s: s["n"],
    )


def n_repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more. Texts without such windows are not sorted."""
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeats, covered_words(repeated_starts(hashes))).otherwise(F.lit(0).cast("bigint"))


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (in place of such columns)."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    kept = [name for name in docs.columns if name not in names]
    # In steps, so that each list is made once.
    first = docs.select(*kept, words(text).alias("_words"))
    second = first.select(*kept, "_words", windows(F.col("_words")).alias("_windows"))
    return second.select(
        *kept,
        F.size("_words").cast("bigint").alias("n_words"),
        word_chars(F.col("_words")).alias("word_chars"),
        n_symbols(F.col(text)).alias("n_symbols"),
        n_dup_lines(F.col(text)).alias("n_dup_lines"),
        n_repeat_words(F.col("_windows")).alias("n_repeat_words"),
    )


# --- rules --------------------------------------------------------------------------------------


def _few_words(text: Column, word_list: Column) -> Column:
    return F.size(word_list) < 50


def _repeats(text: Column, word_list: Column) -> Column:
    return bound(windows(word_list), n_repeat_words) * 100 > F.size(word_list) * 50


def _symbols(text: Column, word_list: Column) -> Column:
    return n_symbols(text) * 10 > F.size(word_list) * 3


def _duplicate_lines(text: Column, word_list: Column) -> Column:
    lines = lines_with_words(text)
    return bound(lines, lambda l: (F.size(l) - F.size(F.array_distinct(l))) * 10 > F.size(l) * 6)


def _word_length(text: Column, word_list: Column) -> Column:
    least, most = F.size(word_list) * 2, F.size(word_list) * 20
    return bound(word_chars(word_list), lambda n: (n < least) | (n > most))


def _shouting(text: Column, word_list: Column) -> Column:
    capitals = F.length(F.regexp_replace(filled(text), r"\P{Lu}+", ""))
    letters = F.length(F.regexp_replace(filled(text), r"\P{L}+", ""))
    return capitals * 2 > letters


#: Every document that these reject is junk by its own measure; the two of the contract are the first.
RULES = [
    Rule("few_words", _few_words),
    Rule("repeats", _repeats),
    Rule("symbols", _symbols),
    Rule("duplicate_lines", _duplicate_lines),
    Rule("word_length", _word_length),
    Rule("shouting", _shouting),
]


# --- the cascade --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-3)


def estimate(docs: DataFrame, rules: list[Rule], text: str = "text", rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Each rule's cost and selectivity on a sample of about ``rows`` documents, best first."""
    total = docs.count()
    share = min(1.0, rows / total) if total else 1.0
    sample = docs.select(filled(text).alias("text")).sample(share, seed=7).withColumn("words", words("text"))
    sample = written(sample, new_path(docs.sparkSession, "quality-sample"))

    def timed(column: Column) -> tuple[float, float]:
        began = time.perf_counter()
        share = sample.agg(F.avg(column.cast("double"))).first()[0]
        return time.perf_counter() - began, share or 0.0

    timed(F.lit(True))
    reading = min(timed(F.lit(True))[0] for _ in range(2))
    found = []
    for rule in rules:
        runs = [timed(rule.broken(F.col("text"), F.col("words"))) for _ in range(2)]
        found.append(Estimate(rule, min(seconds for seconds, _ in runs) - reading, runs[0][1]))
    return sorted(found, key=lambda e: -e.worth)


def first_broken(rules: list[Rule], text: str = "text") -> Column:
    """The name of the first rule in the given order that the text breaks, else null. Later ones are not tried. The words
    are listed once for all rules."""

    def tried(word_list: Column) -> Column:
        first = F.lit(None).cast("string")
        for rule in reversed(rules):
            first = F.when(rule.broken(F.col(text), word_list), F.lit(rule.name)).otherwise(first)
        return first

    return bound(words(text), tried)


def quality_cascade(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``broken_rule`` and ``kept`` (which replace columns of that name); the rules are tried in the
    order that a sample suggests."""
    ordered = [e.rule for e in estimate(docs, rules, text)]
    return docs.withColumn("broken_rule", first_broken(ordered, text)).withColumn("kept", F.col("broken_rule").isNull())


def good_documents(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows that break no rule, with their own columns only."""
    return docs.filter(first_broken([e.rule for e in estimate(docs, rules, text)], text).isNull())
