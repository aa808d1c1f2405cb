import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vedrina.llm import language_model as lm
from vedrina.llm.language_model import Training, lm_scores, shares, train, untrained, with_ends
from vedrina.shared import BATCH_LIMITS, LARGE_ROWS, written


def held_out_rows():
    return F.expr("pmod(crc32(coalesce(string(doc_id), '')), 7) = 2")


def is_held_out(id):
    return zlib.crc32(("" if id is None else str(id)).encode()) % 7 == 2


def base_by_hand(rows):
    counts = Counter()
    for id, text in rows:
        if not is_held_out(id):
            counts.update((text or "").encode().lower().split() + [b""])
    n, v = sum(counts.values()), len(counts)
    found = []
    for id, text in rows:
        tokens = (text or "").encode().lower().split() + [b""]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        found.append((str(id), is_held_out(id), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    return sorted(found)


def results(docs):
    return sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in lm_scores(docs, held_out_rows()).collect()
    )


def languages(prose, n=160):
    """Two languages with words of their own: the words before tell which ones may follow."""
    one = [f"{w}ing" for w in "go run see find read make take give keep hold".split()]
    two = [f"{w}heit" for w in "frei neu schoen ganz klar wahr echt rein voll leer".split()]
    return [(k, prose(60, k, one if k % 2 else two) + (f" rare{k}ing" if k % 2 else f" rare{k}heit")) for k in range(n)]


def test_base_scores(docs_of, prose):
    rows = [(n, prose(n % 50, n)) for n in range(80)] + [(100, "The THE the\tthe"), (101, "É é"), (102, ""), (103, None)]
    assert results(docs_of(rows)) == base_by_hand(rows)


def test_small_blocks_and_buckets(docs_of, prose, monkeypatch):
    rows = [(n, prose(n % 50, n)) for n in range(80)]
    whole = sorted(map(tuple, lm_scores(docs_of(rows), held_out_rows()).collect()))
    monkeypatch.setattr(lm, "BLOCK_ROWS", 1)
    monkeypatch.setattr(lm, "LEAST_BUCKETS", 3)
    again = sorted(map(tuple, lm_scores(docs_of(rows), held_out_rows()).collect()))
    assert [row[:5] for row in again] == [row[:5] for row in whole]
    assert np.allclose([row[5:] for row in again], [row[5:] for row in whole])


def test_awkward_rows(awkward):
    rows = [(row.doc_id, row.text) for row in awkward.collect()]
    assert results(awkward) == base_by_hand(rows)
    assert lm_scores(awkward, held_out_rows()).columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_no_rows_and_nothing_to_learn_from(empty, docs_of):
    assert lm_scores(empty, held_out_rows()).count() == 0
    held = next(n for n in range(100) if is_held_out(n))
    [row] = lm_scores(docs_of([(held, "a b")]), held_out_rows()).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert math.isfinite(row.score) and row.score < 0


def test_the_model_beats_the_base_on_held_out_texts(docs_of, prose):
    found = [row for row in lm_scores(docs_of(languages(prose)), held_out_rows()).collect() if row.held_out]
    assert len(found) > 10
    gain = sum(row.score - row.base_score for row in found) / sum(row.n_tokens for row in found)
    assert gain > 0.2
    assert sum(row.score > row.base_score for row in found) > 0.9 * len(found)


def test_a_shuffled_text_is_less_likely(docs_of, prose):
    rows = languages(prose)
    held = next(n for n in range(1000, 2000) if is_held_out(n))
    one, two = prose(60, 1, "going running seeing".split()).split(), prose(60, 2, "freiheit neuheit klarheit".split()).split()
    mixed = [w for pair in zip(one, two) for w in pair]
    other = next(n for n in range(held + 1, 3000) if is_held_out(n))
    found = {r.doc_id: r.score for r in lm_scores(docs_of(rows + [(held, " ".join(one + two)), (other, " ".join(mixed))]), held_out_rows()).collect()}
    assert found[held] > found[other]


def trained(counts, tokens, steps=1, seed=0):
    training = Training(untrained(counts), shares(counts), 0.1, seed)
    for _ in range(steps):
        training.step(*tokens)
    return training.model


def test_probabilities_sum_to_one():
    dice = np.random.default_rng(1)
    for leaves in (17, 101, 400):
        tokens = tuple(dice.integers(0, leaves, (3, 500)))
        model = trained(np.bincount(tokens[2], minlength=leaves), tokens, 20)
        for context in ((leaves, leaves), (3, leaves), (5, 16)):
            before, second = np.full(leaves, context[0]), np.full(leaves, context[1])
            logs = model.log_probabilities(before, second, np.arange(leaves))
            assert np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-4)
        again = trained(np.bincount(tokens[2], minlength=leaves), tokens, 20)
        assert (again.flat() == model.flat()).all()


def test_probabilities_by_hand():
    """Both softmaxes over all groups and all leaves, one token at a time."""
    dice = np.random.default_rng(2)
    leaves = 50
    tokens = tuple(dice.integers(0, leaves, (3, 300)))
    model = trained(np.bincount(tokens[2], minlength=leaves), tokens, 5)
    found = model.log_probabilities(*tokens)
    for before, second, token, log in zip(*(t[:40] for t in tokens), found[:40]):
        h = model.given[before] @ model.near + model.given[second] @ model.far
        groups = np.exp(h @ model.group.T + model.group_bias)
        mine = [leaf for leaf in range(leaves) if leaf // 8 == token // 8]
        members = {leaf: math.exp(h @ model.target[leaf] + model.bias[leaf]) for leaf in mine}
        assert log == pytest.approx(math.log(groups[token // 8] / groups.sum() * members[token] / sum(members.values())), abs=1e-4)


def test_the_second_factor_sums_to_one():
    """Over the known words of a class and one more for the unseen ones."""
    counts = [5, 1, 1, 0]
    known = [c for c in counts if c]
    total = sum(known) + len(known) + 1
    assert sum((c + 1) / total for c in known) + 1 / total == pytest.approx(1)


def test_steps_raise_the_objective():
    """After training, probabilities come near the data: two contexts, three leaves."""
    dice = np.random.default_rng(3)
    leaves, start = 30, 30
    one, two = dice.choice([1, 12, 29], 3000, p=[0.7, 0.2, 0.1]), dice.choice([1, 12, 29], 3000, p=[0.1, 0.1, 0.8])
    before, second = np.repeat([start, 5], 3000), np.full(6000, start)
    token = np.concatenate([one, two])
    model = trained(np.bincount(token, minlength=leaves), (before, second, token), 300)
    for context, expected in ((start, [0.7, 0.2, 0.1]), (5, [0.1, 0.1, 0.8])):
        logs = model.log_probabilities(np.full(3, context), np.full(3, start), np.array([1, 12, 29]))
        assert np.exp(logs) == pytest.approx(expected, abs=0.08)


def test_contexts():
    before, second, token = with_ends(np.array([1, 2, 1, 2]), np.array([3, 0, 1]), 9)
    assert token.tolist() == [1, 2, 1, 0, 0, 2, 0]
    assert list(zip(before.tolist(), second.tolist())) == [(9, 9), (1, 9), (2, 1), (1, 2), (9, 9), (9, 9), (2, 9)]


def learned(docs_of, rows):
    frame = docs_of(rows).select(F.col("doc_id").alias("id"), "text", held_out_rows().alias("held_out"))
    blocks = lm.blocks_of(frame)
    counts = lm.word_counts(blocks)
    c = {row.word: row.c for row in counts.collect()}
    leaves = lm.leaves_of(counts, sum(c.values()))
    return blocks, c, leaves


def test_leaves(docs_of, prose):
    """Every word that is frequent enough has its own, and the rest are counted by theirs; more text has more leaves."""
    sizes = []
    for n in (30, 300):
        _, c, leaves = learned(docs_of, [(k, prose(100, k) + f" x{k}y x{k % 7}z q{k}") for k in range(n)])
        least = lm.least_count(sum(c.values()))
        assert set(leaves.words) == {word for word, count in c.items() if count >= least} | {""}
        tokens, words = Counter(), Counter()
        for word, count in c.items():
            tokens[leaves.of(word.encode())] += count
            words[leaves.of(word.encode())] += 1
        assert [tokens[k] for k in range(len(leaves.tokens))] == leaves.tokens.tolist()
        assert [words[k] for k in range(len(leaves.tokens))] == leaves.n_words.tolist()
        assert len(leaves.words) <= lm.SHARE * math.sqrt(sum(c.values())) + 1
        sizes.append(least)
    assert sizes[1] > sizes[0]
    assert lm.passes_over(10_000) == lm.MOST_PASSES and lm.passes_over(10**10) == 1


def test_scores_by_hand(docs_of, prose, monkeypatch):
    """The whole score of each document from the counts, the leaves and the model."""
    rows = languages(prose, 60)
    models = []
    monkeypatch.setattr(lm, "train", lambda *given: models.append(train(*given)) or models[-1])
    found = {row.doc_id: row.score for row in lm_scores(docs_of(rows), held_out_rows()).collect()}
    _, c, leaves = learned(docs_of, rows)
    [model] = models
    for id, text in rows[::7]:
        words = text.lower().split()
        tokens = with_ends(np.array([leaves.of(word.encode()) for word in words]), np.array([len(words)]), len(leaves.tokens))
        score = float(model.log_probabilities(*tokens).sum()) / math.log(10)
        for word, leaf in zip(words, tokens[2]):
            if word not in leaves.words:
                score += math.log10((c.get(word, 0) + 1) / (leaves.tokens[leaf] + leaves.n_words[leaf] + 1))
        assert found[id] == pytest.approx(score, rel=1e-5)


def test_moves_are_averaged_by_tokens():
    import pyarrow as pa

    rows = [(0, 300, [1.0, 2.0]), (0, 100, [5.0, -2.0]), (1, 100, [0.5])]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([np.array(r[2], "<f2").tobytes() for r in rows])], ["piece", "trained", "moves"]
    )
    [summed] = lm._sum_moves(iter([batch]))
    assert [np.frombuffer(m, "<f4").tolist() for m in summed["moves"].to_pylist()] == [[2.0, 1.0], [0.5]]


def test_a_block_is_stored_in_bounded_rows(prose, monkeypatch):
    """Documents of a block lie in rows of about ROW_TOKENS tokens or one longer document, from which the block's leaves come back in order."""
    import pyarrow as pa

    monkeypatch.setattr(lm, "ROW_TOKENS", 100)
    texts = [prose(n, n) for n in (30, 30, 30, 30, 250, 0, 99, 100, 1)] + [None]
    block = lm._Block()
    block.add(pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array([k % 3 == 0 for k in range(len(texts))])], ["id", "text", "held_out"]))
    packed = pa.Table.from_batches(list(block.packed(7, 4)))
    rows = packed.sort_by("bucket").to_pylist()
    stored = [row for row in rows if row["bucket"] < -1]
    assert len(stored) > 4 and [row["bucket"] for row in rows].count(-1) == 1
    assert all(row["block"] == 7 and sum(d["size"] for d in row["documents"][1:]) <= 100 for row in stored)
    assert [d["id"] for row in stored for d in row["documents"]] == list(range(len(texts)))

    words = {word: n for row in rows if row["bucket"] >= 0 for n, word in enumerate(row["words"].split(b"\n"), row["bucket"] * 1000)}
    answers = [
        {"bucket": row["bucket"], "words": None, "numbers": np.array([(1, words[word]) for word in row["words"].split(b"\n")], "<i8").tobytes(), "documents": None}
        if row["bucket"] >= 0 else {name: row[name] for name in ("bucket", "words", "numbers", "documents")}
        for row in rows
    ]
    batch = pa.RecordBatch.from_pylist(answers, packed.schema.remove(0))

    class Fixed:
        value = (1, np.full(10_000, np.nan))

    found = [row for answered in lm._answer_blocks(Fixed)(iter([batch.slice(k, 1) for k in range(len(rows))] + [batch])) for row in answered.to_pylist()]
    expected = [words[word] for text in texts for word in lm.words_of(text)]
    assert [leaf for row in found for leaf in lm._from_planes(row["leaves"]).tolist()] == expected * 2
    assert [d["id"] for row in found for d in row["documents"]] == list(range(len(texts))) * 2
    assert len(found) == 2 * len(stored)


def test_blocks_are_handled_in_small_batches(docs_of, prose, spark, monkeypatch):
    """Whatever is stored and trained on runs with small batches, rows of megabytes lie in small row groups, and the session's settings stay."""
    seen, before = {}, {name: spark.conf.get(name) for name in BATCH_LIMITS}

    def settings():
        return {name: int(spark.conf.get(name)) for name in BATCH_LIMITS}

    def watched(df, path, *args, **options):
        seen[path.rsplit("/", 1)[1].rsplit("-", 1)[0]] = (settings(), options)
        return written(df, path, *args, **options)

    monkeypatch.setattr(lm, "written", watched)
    monkeypatch.setattr(lm, "train", lambda *given: seen.update(train=(settings(), {})) or train(*given))
    assert lm_scores(docs_of([(k, prose(20, k)) for k in range(10)]), held_out_rows()).count() == 10
    assert set(seen) == {"lm-blocks", "lm-counts", "lm-leaves", "train", "lm-scores"}
    assert all(limits == BATCH_LIMITS for limits, _ in seen.values())
    assert seen["lm-blocks"][1] == seen["lm-leaves"][1] == LARGE_ROWS
    assert {name: spark.conf.get(name) for name in BATCH_LIMITS} == before
