"""The index and the search against all documents scored one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from vedrina.llm import lexical
from vedrina.llm.lexical import build_index, search, terms_of
from vedrina.shared import BATCH_LIMITS, LARGE_ROWS, written

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id bigint, text string"


def terms_by_hand(text):
    return [re.sub("[A-Z]", lambda c: c.group().lower(), term) for term in TERM.findall(text or "")]


def by_hand(docs, items, k=50):
    docs = [(id, Counter(terms), len(terms)) for id, text in docs if (terms := terms_by_hand(text))]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(term for _, counts, _ in docs for term in counts)
    weight = {term: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * count + 1))) for term, count in df.items()}
    wanted = {}
    for id, text in items:
        wanted.setdefault(id, set()).update(terms_by_hand(text))
    rows = []
    for item, terms in wanted.items():
        scored = []
        for id, counts, n in docs:
            m = 100 - 50 + 50 * n * n_docs // n_terms
            score = sum(weight[t] * (10**9 * counts[t] // (1000 * counts[t] + 20 * m)) for t in terms if t in counts)
            if score > 0:
                scored.append((-score, id is None, id or 0))
        for rank, (score, none, id) in enumerate(sorted(scored)[:k], 1):
            rows.append((item, rank, None if none else id, -score))
    return sorted(rows, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("text", ["", None, "Don't stop-me NOW", "a1B2\x7fc\x00d", "ÀÉ ÇA 日本語x ß_ß", "x" * 1000, "{|}~@[`:/"])
def test_terms(text):
    assert [term.decode() for term in terms_of(text)] == terms_by_hand(text)


def corpus(prose, n, seed):
    """Texts of few different words, so that scores tie, lengths repeat and one stratum holds a third of all rows."""
    dice = random.Random(seed)
    rows = [(k, prose(dice.choice([3, 3, 3, 8, 8, 20, 60, 300]), dice.randrange(40)) + dice.choice(["", " Rare", " odd-word"])) for k in range(n)]
    return rows + [(n + k, "omega alpha beta") for k in range(n // 2)]


def test_search(docs_of, prose, spark):
    rows = corpus(prose, 200, 1)
    items = [(1, "alpha, beta; gamma!"), (2, "rare odd word"), (3, "omega"), (4, "nowhere at all"), (5, ""), (6, None), (7, prose(60, 3)), (2, "OMEGA")]
    index = build_index(docs_of(rows), block_terms=50)
    assert index.blocks.count() > 20
    assert found(search(index, spark.createDataFrame(items, ITEMS))) == by_hand(rows, items)
    for k, terms in ((1, 1 << 20), (7, 5), (1000, 1)):
        assert found(search(index, spark.createDataFrame(items, ITEMS), k=k, item_terms=terms)) == by_hand(rows, items, k)
    one_block = build_index(docs_of(rows, 1))
    assert found(search(one_block, spark.createDataFrame(items, ITEMS))) == by_hand(rows, items)


def test_a_block_is_of_one_stratum_and_bounded(docs_of, prose):
    rows = corpus(prose, 300, 2)
    index = build_index(docs_of(rows), block_terms=60)
    n_docs, n_terms = index.documents, index.terms
    m_of = {id: 50 + 50 * len(terms_by_hand(text)) * n_docs // n_terms for id, text in rows}
    seen = []
    for block in index.blocks.collect():
        ids = np.frombuffer(block.ids, "<i8")
        assert {m_of[id] for id in ids} == {block.m} and list(ids) == sorted(ids)
        assert len(np.frombuffer(block.tfs, "<u4")) <= 600
        seen += list(ids)
    assert sorted(seen) == sorted(id for id, _ in rows)


def test_bounds_spare_blocks(docs_of, prose, spark, monkeypatch):
    """Blocks whose bound is below the k-th score are not visited, and the answer is the same."""
    rows = [(k, prose(5 + k, k)) for k in range(80)] + [(500 + k, "zebra zebra zebra") for k in range(60)]
    index = build_index(docs_of(rows, 1), block_terms=40)
    wanted = [lexical._wanted_of(b.asDict(), lexical.pa.array([b"alpha", b"zebra"], lexical.pa.large_binary()), np.array([3, 900]), np.array([0, 1]), np.array([0])) for b in index.blocks.collect()]
    blocks = [b for b in wanted if b is not None]
    visited = []
    real = np.zeros
    monkeypatch.setattr(lexical.np, "zeros", lambda *a: visited.append(1) or real(*a))
    ids, _, scores = lexical._best_of(blocks, 0, [0, 1], 5)
    assert len(ids) == 5 and 0 < len(visited) < len(blocks)
    monkeypatch.undo()
    every = sorted(((-int(sum(b.gains[s:e][b.places[s:e] == at].sum() for s, e in b.starts.values())), int(id)) for b in blocks for at, id in enumerate(b.ids)))
    assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == every[:5]


def test_awkward_rows(awkward, spark):
    rows = [(row.doc_id, row.text) for row in awkward.collect()]
    items = [(None, "alpha beta"), (1, "日本語 ﬁ one"), (2, None), (None, "gamma"), (3, "a" * 5000)]
    frame = spark.createDataFrame([(*row, "own", "own") for row in items], ITEMS + ", rank string, doc_id string")
    assert found(search(build_index(awkward, block_terms=100), frame)) == by_hand(rows, items)


def test_no_rows(empty, docs_of, spark):
    some = spark.createDataFrame([(1, "alpha")], ITEMS)
    assert found(search(build_index(empty), some)) == []
    assert found(search(build_index(docs_of([(1, None), (2, " .")])), some)) == []
    assert found(search(build_index(docs_of([(1, "alpha"), (2, "beta")])), some.limit(0))) == []


def test_blocks_are_handled_in_small_batches(docs_of, spark, monkeypatch):
    """Whatever the operator stores runs with small batches, its rows of megabytes in small row groups, and the session's settings stay."""
    seen, before = {}, {name: spark.conf.get(name) for name in BATCH_LIMITS}

    def watched(df, path, *args, **options):
        seen[path.rsplit("/", 1)[1].rsplit("-", 1)[0]] = ({name: int(spark.conf.get(name)) for name in BATCH_LIMITS}, options)
        return written(df, path, *args, **options)

    monkeypatch.setattr(lexical, "written", watched)
    rows, items = [(1, "alpha beta"), (2, "beta")], [(1, "beta")]
    assert found(search(build_index(docs_of(rows)), spark.createDataFrame(items, ITEMS))) == by_hand(rows, items)
    assert all(limits == BATCH_LIMITS for limits, _ in seen.values())
    assert seen["lexical-vectors"][1] == seen["lexical-blocks"][1] == LARGE_ROWS
    assert {"lexical-items", "lexical-found"} < set(seen)
    assert {name: spark.conf.get(name) for name in BATCH_LIMITS} == before
