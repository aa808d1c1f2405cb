import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vedrina.llm import simhash
from vedrina.llm.components import connected_components
from vedrina.llm.simhash import fingerprint, links_in_list, near_duplicates, without_near_duplicates


def by_hand(text, width=3):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ")
             .replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(nodes, linked):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("text", ["", " \n", "one", "one Two", "one two three", "ÄÖ Äö äö X", "a b c a b c a b c", "x\vy\fz\rw\tv", None])
def test_fingerprint(text):
    assert fingerprint(text) % (1 << 64) == by_hand(text)


def test_fingerprint_of_a_long_text(prose, monkeypatch):
    text = prose(5000, 3)
    assert fingerprint(text) % (1 << 64) == by_hand(text)
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES", 64)
    assert fingerprint(text) == whole


def test_spark_agrees_on_the_hash(spark):
    [row] = spark.range(1).select(F.xxhash64(F.lit("one two three")).alias("h")).collect()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


def clustered(seed, n, spread):
    """Fingerprints in clusters, each some bits from another of its cluster."""
    dice = random.Random(seed)
    found = [dice.getrandbits(64)]
    while len(found) < n:
        near = dice.choice(found) if dice.random() < 0.9 else dice.getrandbits(64)
        for _ in range(dice.randrange(spread)):
            near ^= 1 << dice.randrange(64)
        found.append(near)
    return found


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


@pytest.mark.parametrize("seed, spread", [(1, 4), (2, 3), (3, 6), (4, 2)])
def test_links(spark, seed, spread):
    fps = sorted(set(clustered(seed, 400, spread)))
    entries = spark.createDataFrame([(signed(fp),) for fp in fps], "fp bigint").repartition(5)
    for max_bits, long in ((2, None), (2, 3), (1, 2), (3, 4), (0, 1)):
        links = simhash.fingerprint_links(entries, max_bits, long)
        found = {row.node: row.component for row in connected_components(links, "a", "b").collect()}
        label = components_by_hand(range(len(fps)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= max_bits)
        groups = {}
        for n, fp in enumerate(fps):
            groups.setdefault(label[n], []).append(signed(fp))
        expected = {fp: min(group) for group in groups.values() for fp in group}
        assert {fp: found.get(fp, fp) for fp in expected} == expected, (max_bits, long)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
@pytest.mark.parametrize("block", [1 << 20, 700])
def test_links_in_a_list(max_bits, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_PAIRS", block)
    dice = random.Random(max_bits)
    base = dice.getrandbits(64)
    fps = sorted({base ^ dice.getrandbits(16) for _ in range(300)})
    expected = components_by_hand(range(len(fps)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= max_bits)
    found = links_in_list(np.array(fps, dtype=np.uint64), max_bits)
    assert dict(enumerate(found.tolist())) == expected


def test_the_tally_drops_pairs_below_the_minimum(monkeypatch):
    """Of pairs that share the four bytes of a list only those with six in common have their bits compared."""
    compared = []
    real = np.bitwise_count
    monkeypatch.setattr(simhash.np, "bitwise_count", lambda values: compared.append(len(values)) or real(values))
    base = 0x1122334455667788
    # Six, five and four bytes in common with the first, and one that is within two bits.
    fps = np.array([base, base ^ 0x1010, base ^ 0x030303, base ^ 0x04040404, base ^ 0x0100], dtype=np.uint64)
    assert links_in_list(fps, 2).tolist() == [0, 0, 2, 3, 0]
    # Every member with itself, and the three pairs of the first, second and last in both orders; of 25.
    assert sum(compared) == 5 + 6


def test_a_pair_that_reaches_the_minimum_is_in_one_list(spark):
    dice = random.Random(9)
    pairs = []
    for n in range(60):
        fp = dice.getrandbits(64)
        pairs.append((n, fp, fp ^ (1 << dice.randrange(64)) ^ (1 << dice.randrange(64))))
    rows = spark.createDataFrame([(n, signed(a), signed(b)) for n, a, b in pairs], "n int, a bigint, b bigint")
    lists = [rows.select("n", simhash.index_keys(F.col(side), 2).alias("key")).distinct() for side in "ab"]
    assert lists[0].join(lists[1], ["n", "key"]).select("n").distinct().count() == 60
    assert lists[0].groupBy("n").count().filter("count <> 6").count() == 0
    # So it is in the shorter lists of each list that has it.
    finer = [part.select("n", "key", F.explode(simhash.finer_keys(F.col("fp"), F.col("key.positions"), 2)).alias("finer")) for part in (
        rows.select("n", F.col(side).alias("fp"), simhash.index_keys(F.col(side), 2).alias("key")) for side in "ab")]
    met = lists[0].join(lists[1], ["n", "key"]).distinct().count()
    assert finer[0].join(finer[1], ["n", "key", "finer"]).select("n", "key").distinct().count() == met


def test_another_text_under_a_dropped_id_stays(docs_of, prose):
    a, b = prose(80, 1), prose(80, 2)
    kept = without_near_duplicates(docs_of([(1, a), (5, a), (5, b), (None, prose(80, 3))])).collect()
    assert sorted((row.doc_id or 0, row.text) for row in kept) == sorted([(1, a), (5, b), (0, prose(80, 3))])


def test_documents_without_ids_link_others(docs_of, monkeypatch):
    """Two texts that only a text without an id is near to are one group."""
    near = {"a": 0b0011, "b": 0b1111, "c": 0b111111}
    monkeypatch.setattr(simhash, "fingerprint", lambda text, width: near[text])
    found = near_duplicates(docs_of([(3, "a"), (None, "b"), (7, "c")])).collect()
    assert {(row.doc_id, row.component_id) for row in found} == {(3, 3), (None, 3), (7, 3)}
    assert sorted(str(row.doc_id) for row in without_near_duplicates(docs_of([(3, "a"), (None, "b"), (7, "c")])).collect()) == ["3", "None"]


def test_components_of_chains_and_stars(spark):
    chain = [(n, n + 1) for n in range(100, 400)]
    star = [(1000, n) for n in range(1001, 1200)]
    loops = [(5, 5), (None, 7), (8, None), (3, 2), (2, 3), (2, 3)]
    links = spark.createDataFrame(chain + star + loops, "a bigint, b bigint").repartition(6)
    found = {row.node: row.component for row in connected_components(links, "a", "b").collect()}
    assert found == {n: 100 for n in range(100, 401)} | {n: 1000 for n in range(1000, 1200)} | {2: 2, 3: 2}
    assert connected_components(links.limit(0), "a", "b").count() == 0


def near_copies(prose, n=120):
    dice = random.Random(4)
    rows = []
    for k in range(n):
        words = prose(400, k % 7).split()
        for _ in range(dice.randrange(4)):
            words[dice.randrange(len(words))] = f"new{dice.randrange(50)}"
        rows.append((k, " ".join(words)))
    return rows


def test_documents(docs_of, prose):
    rows = near_copies(prose) + [(500, ""), (501, None), (502, "\n"), (503, "one"), (504, "ONE")]
    found = near_duplicates(docs_of(rows)).collect()
    fps = {id: by_hand(text) for id, text in rows}
    expected = components_by_hand(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert {row.doc_id: (row.fp % (1 << 64), row.component_id) for row in found} == {id: (fps[id], expected[id]) for id in fps}
    assert len(found) == len(rows)
    kept = without_near_duplicates(docs_of(rows)).collect()
    assert sorted(row.doc_id for row in kept) == sorted(set(expected.values()))
    assert 7 <= len(kept) < len(rows)


def test_awkward_rows(awkward):
    found = near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    component = {row.doc_id: row.component_id for row in found}
    assert component[2] == component[3] == component[4] == 2 and component[5] == component[1] == 1 and component[6] == 6
    null_ids = {row.component_id for row in found if row.doc_id is None}
    assert null_ids == {2, None}
    kept = without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [row.doc_id for row in kept.collect()]
    assert ids.count(None) == 2 and ids.count(6) == 2 and 5 not in ids and 3 not in ids


def test_no_rows(empty):
    assert near_duplicates(empty).count() == 0 and without_near_duplicates(empty).count() == 0


def test_distance_beyond_the_index(empty):
    with pytest.raises(ValueError, match="max_bits"):
        near_duplicates(empty, max_bits=4)
