"""Lines that many documents share, against a count over all lines."""

import hashlib
import random
from collections import Counter

import pytest

from vedrina.llm.line_runs import LineRuns, common_lines, deduplicated, keyed_lines


def key_of(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\v\f\r"))


def by_hand(rows, least_documents=10, least_chars=1):
    texts = [(row[0], (row[1] or "").split("\n")) for row in rows]
    n = Counter(key for _, lines in texts for key in {key_of(line) for line in lines} if len(key) >= least_chars)
    found = []
    for id, lines in texts:
        kept = [line for line in lines if n[key_of(line)] < least_documents]
        found.append((id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(found, key=repr)


def found(frame):
    return sorted(((row.doc_id, row.text, row.n_lines, row.n_dropped) for row in frame.collect()), key=repr)


def invented(seed, n):
    dice = random.Random(seed)
    lines = [f"line {k}" for k in range(60)] + ["", " ", "Line 1", "\tLINE 2 ", "é", "É", "x", "a\rb"]
    rows = [(k, "\n".join(dice.choice(lines) for _ in range(dice.randrange(1, 14)))) for k in range(n)]
    copy = "Menu\nHome\n\n" + "\n".join(f"only here {k}" for k in range(5))
    return rows + [(n + k, copy) for k in range(n // 2)] + [(5000, None), (5001, ""), (5002, "one line"), (5002, "one line")]


@pytest.mark.parametrize("least_documents, least_chars, batches, fanout", [(10, 1, 8, 4), (3, 2, 5, 2), (1, 1, 1, 2), (25, 0, 3, 2), (1000, 1, 2, 4)])
def test_lines(docs_of, least_documents, least_chars, batches, fanout):
    rows = invented(least_documents, 120)
    frame = deduplicated(docs_of(rows), "text", least_documents, least_chars, batches, fanout)
    assert found(frame) == by_hand(rows, least_documents, least_chars)


def test_levels(spark):
    """Counts add up over batches, runs are compacted, and what is common already is not written again."""
    runs = LineRuns(spark, least_documents=10, fanout=2, buckets=3)
    sizes = []
    for batch in range(7):
        counts = [(bytes([7]) * 16, 10), (bytes([batch]) * 16 + b"x", 1), (bytes([9]) * 16, 2)]
        runs.add(spark.createDataFrame(counts, "key binary, documents bigint"))
        sizes.append([len(level) for level in runs.levels])
        assert sum(run.filter("documents >= 10 and key = unhex(repeat('07', 16))").count() for run in runs.runs()) == 1
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1], [0, 1, 1], [1, 1, 1]]
    assert {bytes(row.key)[:1] for row in runs.common().collect()} == {b"\x07", b"\x09"}
    for run in runs.runs():
        for path in run.inputFiles():
            keys = [bytes(row.key) for row in spark.read.parquet(path).collect()]
            assert keys == sorted(keys)
    runs.close()
    assert runs.runs() == []


def test_runs_are_joined_without_shuffling_them(spark):
    runs = LineRuns(spark, buckets=8)
    some = spark.range(1000).selectExpr("unhex(md5(string(id))) as key", "20L as documents")
    runs.add(some)
    [run] = runs.runs()
    joined = some.join(run.filter("documents >= 10").select("key").hint("merge"), "key", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    runs.fanout = 3
    runs.add(some.limit(500))
    merged = runs._merged(runs.levels[0])
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == 1000
    runs.close()


def test_awkward_rows(awkward, spark):
    rows = [(row.doc_id, row.text) for row in awkward.collect()]
    frame = deduplicated(awkward, least_documents=2)
    assert frame.columns == awkward.columns + ["n_lines", "n_dropped"]
    assert found(frame) == by_hand(rows, 2)
    names = "doc_id bigint, text string, key string, text_key string, dropped string, row string, whole string, own_key string, line string, n_lines string"
    clashing = spark.createDataFrame([(1, "a\nb", *"01234567"), (2, "A\nc", *"01234567")], names)
    frame = deduplicated(clashing, least_documents=2)
    assert found(frame) == by_hand([(1, "a\nb"), (2, "A\nc")], 2)
    assert {row.key for row in frame.collect()} == {"0"} and frame.columns[-2:] == ["n_lines", "n_dropped"]


def test_a_very_long_text(docs_of):
    many = "\n".join(f"l{k % 30_000}" for k in range(60_000))
    rows = [(k, f"l{k}\nown {k}") for k in range(12)] + [(100 + k, "l3") for k in range(10)] + [(200, many)]
    assert found(deduplicated(docs_of(rows), least_documents=2)) == by_hand(rows, 2)


def test_no_rows(empty):
    assert deduplicated(empty).count() == 0 and common_lines(keyed_lines(empty)).count() == 0


def test_keyed_lines(docs_of):
    rows = keyed_lines(docs_of([(1, " \x0bABc \xc9\r\n\nabc \xc9\n\x1c")], 1), least_chars=1).orderBy("place").collect()
    keys = [hashlib.md5(key.encode()).digest() for key in ("abc \xc9", "abc \xc9", "\x1c")]
    assert [row.key and bytes(row.key) for row in rows] == [keys[0], None, keys[1], keys[2]]
    assert [row.first for row in rows] == [True, False, False, True]
