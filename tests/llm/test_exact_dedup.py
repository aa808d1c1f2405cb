import hashlib
from collections import Counter

from pyspark.sql import functions as F

from vedrina.llm import bitmap, exact_dedup
from vedrina.llm.exact_dedup import distinct_documents, exact_copies


def by_hand(rows):
    """(id, text) pairs to one result per distinct pair."""
    groups = {}
    for id, text in rows:
        groups.setdefault(text or "", []).append(id)
    found = set()
    for id, text in set((id, text or "") for id, text in rows):
        known = [i for i in groups[text] if i is not None]
        keep = max(known) if known else None
        found.add((id, keep, len(groups[text]), id == keep, hashlib.sha256(text.encode()).hexdigest()))
    return found


def results(docs):
    digest = {"text_sha256": F.sha2(F.coalesce("text", F.lit("")), 256)}
    return [tuple(row) for row in exact_copies(docs, carry=digest).collect()]


def test_awkward_rows(awkward):
    rows = [(row.doc_id, row.text) for row in awkward.collect()]
    found = results(awkward)
    assert len(found) == len(set(found)) and set(found) == by_hand(rows)


def test_texts_that_agree_in_length_and_prefix(docs_of):
    head = "x" * 200
    rows = [(n, head + tail) for n, tail in enumerate(["a", "b", "a", "c", "A", "a ", "a\n", ""])] + [(9, head.encode().decode())]
    assert set(results(docs_of(rows))) == by_hand(rows)


def test_kept_rows_with_all_columns(awkward):
    kept = distinct_documents(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    assert Counter(row.text or "" for row in rows) == Counter(set(row.text or "" for row in awkward.collect()))
    by_text = {row.text or "": row for row in rows}
    assert by_text[""].doc_id == 3 and sum(row.doc_id == 5 for row in rows) == 1 and not any(row.doc_id == 1 for row in rows)
    assert all(row.kept == "own" for row in rows)


def test_no_rows(empty):
    assert exact_copies(empty).count() == 0 and distinct_documents(empty).count() == 0


def test_only_candidates_are_hashed_in_full(docs_of):
    rows = [(n, "t" * n) for n in range(20)] + [(100, "t" * 7)]
    hashed = {row.doc_id for row in exact_dedup.with_full_hash(docs_of(rows)).collect() if row._full}
    assert hashed == {7, 100}


def test_bitmap_is_of_fixed_size_and_forgets_nothing(spark):
    keys = spark.range(0, 50_000).select(F.xxhash64("id").alias("k"))
    pages = bitmap.bitmap_of(keys, F.col("k"))
    assert pages.count() <= 1 << (bitmap.BITS - bitmap.PAGE_BITS)
    marked = bitmap.with_membership(spark.range(0, 100_000), F.xxhash64("id"), pages, "found")
    assert marked.filter("id < 50000 and not found").count() == 0
    assert marked.filter("id >= 50000 and found").count() < 100


def test_a_full_bitmap_only_costs_time(docs_of, prose, monkeypatch):
    monkeypatch.setattr(bitmap, "BITS", 16)
    monkeypatch.setattr(bitmap, "PAGE_BITS", 15)
    rows = [(n, prose(5, n % 40)) for n in range(120)]
    assert set(results(docs_of(rows))) == by_hand(rows)


def test_columns_with_names_of_the_operators_own(spark, prose):
    names = "_id _source _hash _order _ordinal _ordinal_of _shard _n_shards _times _cut _copy _again _once_more _full _candidate _page " \
        "_page_bytes _length _prefix _rows _all row own_id own_text own_source size source_size"
    columns = "doc_id bigint, text string, source string, " + ", ".join(f"{name} string" for name in names.split())
    rows = [(n, prose(40, n % 5), f"s{n % 2}", *[f"{n} {name}" for name in names.split()]) for n in range(12)]
    docs = spark.createDataFrame(rows, columns).repartition(3)
    plain = docs.select("doc_id", "text", "source")
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    found = sorted(map(tuple, kept.collect()))
    assert sorted(row[:3] for row in found) == sorted(map(tuple, distinct_documents(plain).collect()))
    assert set(found) <= set(rows) and len(found) > 2
