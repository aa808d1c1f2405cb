import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau".split()


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text[, source]) as documents, over several partitions."""

    def made(rows, parts=3):
        full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return made


@pytest.fixture(scope="session")
def prose():
    """A text of n words from a seed."""

    def made(n, seed, words=WORDS):
        dice = random.Random(seed)
        return " ".join(dice.choice(words) for _ in range(n))

    return made


@pytest.fixture(scope="session")
def awkward(spark, prose):
    """Null ids and texts, empty and blank ones, repeated rows, a very long text, foreign letters, and columns with names
    that the operators use."""
    long = prose(60_000, 1)
    rows = [
        (1, prose(60, 2), "a"), (2, None, "a"), (3, "", "b"), (4, " \t\n\v\f\r ", None), (None, prose(60, 3), "b"),
        (None, None, None), (5, prose(60, 2), "a"), (6, prose(70, 4), "b"), (6, prose(70, 4), "b"), (7, long, "c"),
        (8, "日本語 ﬁ 𝔘 é́ ▁    x", "c"), (9, "a" * 5000, "c"), (10, "one", ""),
    ]
    columns = "doc_id bigint, text string, source string, kept string, size string, taken string, fp string, component_id string, " \
        "n_words string, ids string, score string, rate string, word string, c string, block string, bucket string, target string, " \
        "ordinal string, shard string, keep_id string, license string, line string, digest string, broken_rule string, node string, " \
        "toxic string, id string, held_out string, documents string, numbers string, words string, label string, rep string"
    names = [part.split()[0] for part in columns.split(", ")]
    full = [(*row, *["own"] * (len(names) - 3)) for row in rows]
    return spark.createDataFrame(full, columns).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
