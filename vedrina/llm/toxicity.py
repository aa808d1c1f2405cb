"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton after folding.

Folding: compatibility forms and case, letters of other scripts that look like Latin ones, invisible characters, and
digits or signs that stand for letters inside a word ("1d1ot"; a number stays a number). The words are joined by single spaces,
so an entry " ab" matches words that begin with ab and " ab " the word itself.

The lexicon is learned: from a bounded sample of labelled rows, the word beginnings, whole words, and phrases of two or three
words that toxic texts have far more often than others, each with its log odds as weight. Counted are in each text the
places behind different words, and the texts. A place in a passage (PASSAGE words or more) that n toxic texts share counts as 1 / n, so that
words of a copied passage do not pass for frequent ones; a shorter set phrase counts in each. Of a chain
of beginnings with the same occurrences the longest is the entry; of nested entries the shortest. A match inside an exception phrase
does not count. The score is the logistic function of the summed weights per logarithm of the
number of words, with the two coefficients fitted on the same sample.

Defined results: null and empty texts have no match, so they get the lowest score. Labels count by the largest
``toxic`` of an id; null ids and null labels teach nothing. Unless both labels occur the lexicon is empty and
all scores are 0. Rows stay one to one with the input.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vedrina.llm.batches import parts
from vedrina.shared import new_path, written

# Letters that look like a Latin one, and signs and digits used in its place.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ɡ": "g", "ո": "n", "ս": "u", "ı": "i",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
INVISIBLE = "­​‌‍⁠﻿"
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "clown fish", "pond scum", "scum line", "idiot proof", "worthless check",
)

# At most so many rows of each label are read to learn from.
SAMPLE_ROWS = 10_000
# An entry occurs in so many toxic texts of the sample at least.
LEAST = 5
# Its log odds, and the log-likelihood ratio of its share in toxic texts against chance, are at least these.
LEAST_WEIGHT, LEAST_RATIO = 3.5, 35.0
MOST_WEIGHT = 8.0
MOST_ENTRIES = 5_000
SHORTEST, LONGEST = 3, 24
PHRASE_WORDS = (2, 3)
PASSAGE = 6

_LETTERS = str.maketrans(HOMOGLYPHS | {c: None for c in INVISIBLE})
_SIGNS = str.maketrans(SUBSTITUTES)
# A sign belongs to a word where a letter or digit follows it.
_WORD = re.compile(r"(?:[@$!|]?[^\W_])+")
_STANDS_IN = re.compile(r"[0-9@$!|]")


def folded_words(text: str | None) -> list[str]:
    """The words of a text after folding."""
    if not text:
        return []
    text = unicodedata.normalize("NFKC", text).lower().translate(_LETTERS)
    words = _WORD.findall(text)
    if _STANDS_IN.search(text):
        # A word without any letter is a number.
        words = [w.translate(_SIGNS) if not w.isalpha() and any(map(str.isalpha, w)) else w for w in words]
    return words


def phrase_key(phrase: str) -> str:
    return " ".join(folded_words(phrase))


@dataclass(frozen=True)
class Lexicon:
    """``weights``: by entry. The score is logistic(slope * rate + shift)."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float = 1.0
    shift: float = 0.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(found):
            found.make_automaton()
        return found

    def score(self, rate: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(rate))
        return 1 / (1 + np.exp(-np.clip(self.slope * rate + self.shift, -30, 30)))


def rate_of(words: list[str], automaton) -> float:
    """The weights of the matches, outside exceptions, per logarithm of the number of words."""
    if not words or not len(automaton):
        return 0.0
    hits, excused = [], []
    for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
        (hits if weight is not None else excused).append((end - length + 1, end, weight))
    if excused:
        # A match excused by a phrase begins inside it.
        hits = [h for h in hits if not any(a <= h[0] < b for a, b, _ in excused)]
    return sum(weight for _, _, weight in hits) / math.log(math.e + len(words))


# --- learning -----------------------------------------------------------------------------------


def training_sample(docs: DataFrame, labels: DataFrame, may_teach: Column, rows: int, id: str, text: str) -> DataFrame:
    """``text`` and ``toxic`` of at most ``rows`` labelled rows of each label, chosen by a hash of the id, each
    text once. At most 2 * rows ids are broadcast; only the chosen texts are kept, in the shared folder."""
    known = labels.filter(F.col(id).isNotNull() & F.col("toxic").isNotNull() & may_teach)
    known = known.groupBy(id).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    order = [F.xxhash64(id), F.col(id)]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(rows).unionByName(known.filter("toxic = 0").orderBy(*order).limit(rows))
    chosen = written(chosen, new_path(docs.sparkSession, "toxicity-ids"))
    found = docs.select(id, F.col(text).alias("text")).join(F.broadcast(chosen), id).select("text", "toxic")
    found = found.filter("text is not null").dropDuplicates(["text", "toxic"])
    return written(found, new_path(docs.sparkSession, "toxicity-sample"))


def _phrases(words: list[str]) -> Iterator[tuple[str, int, int]]:
    """The phrases of a text, each with a space behind it, and where they begin and end."""
    for n in PHRASE_WORDS:
        for at in range(len(words) - n + 1):
            yield " ".join(words[at : at + n]) + " ", at, at + n


def _tallied(counts: list[Counter]) -> Iterator[pa.RecordBatch]:
    for toxic, found in enumerate(counts):
        label = pa.array([toxic] * len(found), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64()), label], ["entry", "n", "toxic"])


def _by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of words in toxic and in other texts."""
    for part in parts(batches, 0):
        counts = [Counter(), Counter()]
        for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            words = folded_words(text)
            counts[toxic].update(word for word, _ in set(zip(words, ["", *words])))
        yield from _tallied(counts)


def _by_phrase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of phrases in toxic texts."""
    for part in parts(batches, 0):
        counts = Counter()
        for text in part.column(0).to_pylist():
            words = ["", *folded_words(text)]
            counts.update(phrase for phrase, _ in {(phrase, words[start]) for phrase, start, _ in _phrases(words[1:])})
        yield from _tallied([Counter(), counts])


class _Places:
    """Where the candidates occur in a text."""

    def __init__(self, candidates: set[str]) -> None:
        self.candidates = candidates
        self.of_word: dict[str, list[str]] = {}

    def of(self, words: list[str]) -> Iterator[tuple[str, int, int]]:
        for at, word in enumerate(words):
            entries = self.of_word.get(word)
            if entries is None:
                whole = f"{word} "
                beginnings = (whole[:k] for k in range(SHORTEST, min(len(whole), LONGEST) + 1)) if len(word) >= SHORTEST else ()
                entries = self.of_word[word] = [entry for entry in beginnings if entry in self.candidates]
            for entry in entries:
                yield entry, at, at + 1
        for phrase, start, end in _phrases(words):
            if phrase in self.candidates:
                yield phrase, start, end


def _by_candidate(candidates: Broadcast):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The places of candidate phrases in toxic and in other texts."""
        known = candidates.value
        for part in parts(batches, 0):
            counts = [Counter(), Counter()]
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = ["", *folded_words(text)]
                found = {(phrase, words[start]) for phrase, start, _ in _phrases(words[1:]) if phrase in known}
                counts[toxic].update(phrase for phrase, _ in found)
            yield from _tallied(counts)

    return of_batches


def _passages(candidates: Broadcast):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each text and place of a candidate the runs of PASSAGE words around it; a place without any has one null."""
        places = _Places(candidates.value)
        for part in parts(batches, 0):
            rows: list[tuple] = []
            for text in part.column(0).to_pylist():
                words = folded_words(text)
                key = hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()
                for entry, start, end in places.of(words):
                    firsts = range(max(0, end - PASSAGE), min(start, len(words) - PASSAGE) + 1)
                    runs = [(start - at, " ".join(words[at : at + PASSAGE])) for at in firsts]
                    hashes = [hashlib.md5(f"{at} {run}".encode("utf-8", "surrogatepass")).digest() for at, run in runs]
                    behind = f"{words[start - 1] if start else ''} {words[start]}"
                    rows += [(entry, key, behind, start, run) for run in hashes or [None]]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string(), pa.binary(), pa.string(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["entry", "key", "behind", "place", "run"])

    return of_batches


def _merged(toxic: DataFrame, candidates: Broadcast) -> DataFrame:
    """``entry``, ``a`` and ``texts``: its places and the texts that have it, the copies of a passage counted once."""
    spark = toxic.sparkSession
    runs = toxic.mapInArrow(_passages(candidates), "entry string, key binary, behind string, place int, run binary")
    runs = written(runs, new_path(spark, "toxicity-runs"))
    shared = runs.filter("run is not null").groupBy("entry", "run").agg(F.count_distinct("key").alias("n")).filter("n > 1")
    joined = runs.join(written(shared, new_path(spark, "toxicity-shared")), ["entry", "run"], "left")
    places = joined.groupBy("entry", "key", "behind", "place").agg(F.max(F.coalesce("n", F.lit(1))).alias("n"))
    places = places.groupBy("entry", "key", "behind").agg(F.min("n").alias("n"))
    texts = places.groupBy("entry", "key").agg(F.sum(1 / F.col("n")).alias("a"), F.min("n").alias("n"))
    # Sums of fractions in any order, to an even number of digits.
    return texts.groupBy("entry").agg(F.round(F.sum("a"), 6).alias("a"), F.round(F.sum(1 / F.col("n")), 6).alias("texts"))


def learned_weights(sample: DataFrame) -> dict[str, float]:
    """The lexicon's entries with their weights: at most ``MOST_ENTRIES``."""
    spark = sample.sparkSession
    n = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        return {}
    schema = "entry string, n bigint, toxic int"
    sample = sample.select("text", "toxic")
    in_toxic, in_other = (F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)) for k in (1, 0))
    words = sample.mapInArrow(_by_word, schema).groupBy(F.col("entry").alias("word"))
    words = written(words.agg(in_toxic.alias("in_toxic"), in_other.alias("in_other")), new_path(spark, "toxicity-words"))
    all_toxic, all_other = words.agg(F.sum("in_toxic"), F.sum("in_other")).first()
    if not all_toxic or not all_other:
        return {}
    chance = all_toxic / (all_toxic + all_other)
    # With fewer the ratio is below its least even if no other text has the entry.
    least = max(LEAST, LEAST_RATIO / (2 * math.log(1 / chance)))

    def strong(table: DataFrame) -> DataFrame:
        a, b = F.col("a"), F.col("b")
        odds = F.log((a + 0.5) / F.lit(all_toxic + 1.0)) - F.log((b + 0.5) / F.lit(all_other + 1.0))
        share = (a / (a + b)).cast("double")
        rest = F.when(b > 0, b * F.log((1 - share) / (1 - chance))).otherwise(0.0)
        ratio = 2 * (a * F.log(share / chance) + rest)
        enough = table.filter(a >= least).withColumn("weight", odds)
        return enough.filter((F.col("weight") >= LEAST_WEIGHT) & (ratio >= LEAST_RATIO))

    # Every beginning of a word, and with a space behind it the whole word.
    ends = F.sequence(F.lit(SHORTEST), F.least(F.length("word") + 1, F.lit(LONGEST)))
    beginnings = words.filter(F.length("word") >= SHORTEST).select(
        F.explode(F.transform(ends, lambda k: F.substring(F.concat("word", F.lit(" ")), F.lit(1), k))).alias("entry"), "in_toxic", "in_other"
    )
    beginnings = beginnings.groupBy("entry").agg(F.sum("in_toxic").alias("a"), F.sum("in_other").alias("b"))
    toxic = sample.filter("toxic = 1")
    phrases = toxic.mapInArrow(_by_phrase, schema).groupBy("entry").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    # No more than the toxic sample has words, by ``least``.
    candidates = spark.sparkContext.broadcast({row["entry"] for row in phrases.select("entry").collect()})
    phrases = sample.mapInArrow(_by_candidate(candidates), schema).groupBy("entry").agg(in_toxic.alias("a"), in_other.alias("b"))
    counted = beginnings.withColumn("is_phrase", F.lit(False)).unionByName(phrases.withColumn("is_phrase", F.lit(True)))
    rows = strong(counted).orderBy(F.desc("weight"), F.desc("a"), "entry").limit(MOST_ENTRIES * 4)
    rows = written(rows, new_path(spark, "toxicity-strong"))
    likely = spark.sparkContext.broadcast({row["entry"] for row in rows.select("entry").collect()})
    counted = rows.select("entry", "b", "is_phrase").join(_merged(toxic, likely), "entry").filter(F.col("texts") >= LEAST)
    found = {row["entry"]: row for row in strong(counted).collect()}
    # Only the longest of the beginnings that (nearly) always go together.
    longer = {}
    for entry, row in found.items():
        if not row["is_phrase"] and row["a"] > longer.get(entry[:-1], 0):
            longer[entry[:-1]] = row["a"]
    closed = [entry for entry, row in found.items() if row["is_phrase"] or longer.get(entry, 0) < 0.9 * row["a"]]
    chosen: dict[str, float] = {}
    for entry in sorted(closed, key=lambda e: (e.count(" ", 0, -1), len(e), e)):
        if not found[entry]["is_phrase"]:
            inside = any(entry[:k] in chosen for k in range(SHORTEST, len(entry)))
        else:
            parts_of = entry.split()
            inside = any(" ".join(parts_of[k : k + 2]) + " " in chosen for k in range(len(parts_of) - 1))
            inside = inside or any(f"{word} "[:k] in chosen for word in parts_of for k in range(SHORTEST, len(word) + 2))
        if not inside:
            chosen[entry] = min(found[entry]["weight"], MOST_WEIGHT)
    top = sorted(chosen, key=lambda e: (-chosen[e], e))[:MOST_ENTRIES]
    return {f" {entry}": chosen[entry] for entry in top}


def fitted(rates: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic function by ridge regression; both labels weigh the same."""
    share = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum())) * len(toxic)
    x = np.column_stack([rates, np.ones(len(rates))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (toxic - p)) - 1e-3 * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0)), float(w[1])


def _rates(lexicon: Lexicon, column: int, names: list[str]):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for part in parts(batches, column):
            rates = [rate_of(folded_words(text), automaton) for text in part.column(column).to_pylist()]
            others = [c for k, c in enumerate(part.columns) if k != column]
            yield pa.RecordBatch.from_arrays([*others, pa.array(rates, pa.float64())], names)

    return of_batches


def learn(
    docs: DataFrame,
    labels: DataFrame,
    may_teach: Column,
    exceptions: tuple[str, ...] = EXCEPTIONS,
    rows: int = SAMPLE_ROWS,
    id: str = "doc_id",
    text: str = "text",
) -> Lexicon:
    """The lexicon from the labelled rows for which ``may_teach`` holds."""
    sample = training_sample(docs, labels, may_teach, rows, id, text)
    bare = Lexicon(learned_weights(sample), tuple(map(phrase_key, exceptions)))
    if not bare.weights:
        return bare
    # As many numbers as the sample has rows.
    found = sample.select("text", "toxic").mapInArrow(_rates(bare, 0, ["toxic", "rate"]), "toxic int, rate double").toPandas()
    slope, shift = fitted(found["rate"].to_numpy(), found["toxic"].to_numpy())
    return Lexicon(bare.weights, bare.exceptions, slope, shift)


def scored(docs: DataFrame, lexicon: Lexicon, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and ``score`` of each row."""
    kind = docs.schema[id].dataType.simpleString()
    rates = docs.select(id, text).mapInArrow(_rates(lexicon, 1, [id, "rate"]), f"`{id}` {kind}, rate double")
    if not lexicon.weights:
        return rates.select(id, F.lit(0.0).alias("score"))
    score = 1 / (1 + F.exp(-(F.col("rate") * lexicon.slope + lexicon.shift)))
    return rates.select(id, score.alias("score"))
