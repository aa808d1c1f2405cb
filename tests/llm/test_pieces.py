import numpy as np
import pytest

from tests.conftest import SF_DIR
from vedrina.llm import pieces, sentencepiece, token_counts
from vedrina.llm.pieces import MARKER, build, double_array, load, units_of

TEXTS = [
    "", "  a  b ", "\n\n x\ty", "日本語 𝔘 é́ ▁", "a" * 300, "hello world", " ", "\t", "x" * 40 + "\n" * 5, "ﬁ ﬂ ½", "Zürich Straße", "▁▁", "a▁b", "\0\x01",
]


@pytest.fixture(scope="module")
def vocabulary():
    return load()


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()
    return [row.text for row in rows] + TEXTS


def small(scores):
    """A vocabulary of a few pieces; bytes are the ids from 100."""
    names = list(scores)
    bytes_of = [n.replace(MARKER, " ").encode() for n in names] + [b""] * (100 - len(names)) + [bytes([b]) for b in range(256)]
    return build([(n, scores[n]) for n in names], list(range(100, 356)), list(range(len(names))), 356, bytes_of)


def best_by_hand(scores, unit):
    """The best score over all ways to cut a unit into pieces; a character without one costs the unknown score."""
    unknown = min(scores.values()) - pieces.UNKNOWN_PENALTY
    text = unit.replace(" ", MARKER)
    best = [0.0] + [-1e30] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            if piece in scores:
                best[end] = max(best[end], best[start] + scores[piece])
        if text[end - 1] not in scores:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]


SCORES = {MARKER: -2.0, "a": -1.5, "b": -1.7, "ab": -2.1, f"{MARKER}a": -2.2, "abab": -3.9, "ba": -3.6, f"{MARKER}{MARKER}": -2.5, "c": -4.0}


def test_double_array():
    words = {"a": 0, "ab": 1, "abc": 2, "b": 3, "bca": 4, "ccc": 5}
    letters = {"a": 1, "b": 2, "c": 3}
    base, check, value = double_array(words, letters)

    def found(word):
        state = 0
        for letter in word:
            to = base[state] + letters[letter]
            if check[to] != state:
                return None
            state = to
        return value[state]

    assert {word: found(word) for word in words} == words
    assert found("bc") == -1 and found("ac") is None and found("cccc") is None


def test_double_array_holds_the_whole_vocabulary(vocabulary):
    for i in np.flatnonzero(vocabulary.score)[::37]:
        state = np.zeros(1, np.int32)
        for letter in vocabulary.codes([vocabulary.bytes_of[i].decode()]):
            state, there = vocabulary.step(state, np.array([letter]))
            assert there.all()
        assert vocabulary.piece[state[0]] == i


@pytest.mark.parametrize("unit", [" a", "  ab", " abab", "ababab", " abba", "cab", " xaby", "   ", "b", "aba ", " acéb"])
def test_best_segmentation(unit):
    vocabulary = small(SCORES)
    ids, cuts = sentencepiece.segment(vocabulary, [unit, "b", unit])
    for n in (0, 2):
        tokens = ids[cuts[n] : cuts[n + 1]].tolist()
        assert b"".join(vocabulary.bytes_of[i] for i in tokens).decode() == unit
        unknown = sum(1 for c in unit if c not in "abc ")
        score = sum(vocabulary.score[i] for i in tokens if i < 100) + unknown * (min(SCORES.values()) - pieces.UNKNOWN_PENALTY)
        assert score == pytest.approx(best_by_hand(SCORES, unit), abs=1e-4)
        assert token_counts.unit_counts(vocabulary, [unit]).tolist() == [len(tokens)]


def test_pieces_that_would_cross_units():
    with pytest.raises(ValueError, match="cross"):
        small(SCORES | {f"a{MARKER}b": -1.0})


def test_round_trip(vocabulary, texts):
    ids, cuts = sentencepiece.encode_texts(vocabulary, texts)
    for text, low, high in zip(texts, cuts[:-1], cuts[1:]):
        assert sentencepiece.decode_ids(vocabulary, ids[low:high]) == text


def test_same_scores_as_the_library(vocabulary, texts):
    """The library's own unigram segmentation with the same pieces and scores. It adds up a whole text in single
    precision, so paths with (nearly) equal scores may differ."""
    library = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    with open(pieces.VOCABULARY, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for i, piece in enumerate(model.pieces):
        if piece.type == 1:
            piece.score = float(vocabulary.score[i])
    processor = library.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = [text for text in texts if MARKER not in text and "\0" not in text]
    ids, cuts = sentencepiece.encode_texts(vocabulary, texts)
    same = 0
    for text, low, high in zip(texts, cuts[:-1], cuts[1:]):
        ours, theirs = ids[low:high].tolist(), processor.encode(text)
        same += ours == theirs
        assert vocabulary.score[ours].astype(float).sum() >= vocabulary.score[theirs].astype(float).sum() - 1e-3
    assert same >= 0.9 * len(texts)


def test_counts_are_those_of_the_ids(vocabulary, texts):
    _, cuts = sentencepiece.encode_texts(vocabulary, texts)
    tokens, units = token_counts.count_tokens(vocabulary, texts)
    assert tokens.tolist() == np.diff(cuts).tolist()
    assert units.tolist() == [len(units_of(text)) for text in texts]


def test_prefixes_are_shared(vocabulary):
    """Units in any order, and with any others, have the same counts."""
    units = [" theater", " the", " thesis", " th", "the", " other", " othe", "日本", "日", "\n"]
    together = token_counts.unit_counts(vocabulary, units)
    assert together.tolist() == [token_counts.unit_counts(vocabulary, [unit])[0] for unit in units]
    assert together[::-1].tolist() == token_counts.unit_counts(vocabulary, units[::-1]).tolist()


def test_awkward_rows(awkward):
    counted = token_counts.token_counts(awkward).collect()
    encoded = sentencepiece.encode(awkward)
    assert encoded.columns == [name for name in awkward.columns if name not in ("text", "ids")] + ["ids"]
    checked = sentencepiece.encoded_and_checked(awkward).collect()
    assert len(counted) == len(checked) == awkward.count() and all(row.round_trip for row in checked)
    key = lambda row: (str(row.doc_id), row.n_tokens)
    assert sorted(map(key, counted)) == sorted(map(key, checked))
    assert {row.n_tokens for row in counted if row.doc_id in (2, 3)} == {0}
    texts = sorted(str(row.text or "") for row in awkward.collect())
    assert sorted(str(row.text) for row in sentencepiece.decode(encoded).collect()) == texts


def test_no_rows(empty):
    assert token_counts.token_counts(empty).count() == 0 and sentencepiece.encode(empty).count() == 0


def test_parts_of_batches(spark, docs_of, prose, monkeypatch):
    from vedrina.llm import batches

    docs = docs_of([(n, prose(n * 13 % 300, n)) for n in range(60)], parts=2)
    whole = sorted(map(tuple, token_counts.token_counts(docs).collect()))
    monkeypatch.setattr(batches.parts, "__defaults__", (500,))
    assert sorted(map(tuple, token_counts.token_counts(docs).collect())) == whole


def unigram_file(path):
    """A small unigram file with byte fallback, written as the library reads it."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback = 1, True
    model.trainer_spec.unk_id, model.trainer_spec.bos_id, model.trainer_spec.eos_id, model.trainer_spec.pad_id = 0, 1, 2, -1
    model.normalizer_spec.name, model.normalizer_spec.add_dummy_prefix = "identity", True
    model.normalizer_spec.remove_extra_whitespaces, model.normalizer_spec.escape_whitespaces = False, True
    entries = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]]
    entries += [(name, score, 1) for name, score in SCORES.items()]
    for name, score, kind in entries:
        model.pieces.add(piece=name, score=score, type=kind)
    with open(path, "wb") as file:
        file.write(model.SerializeToString())


@pytest.mark.parametrize("text", ["ab abab", "abba  ba", "cab abc a", "ababab b", "", "a", "bb abab"])
def test_a_unigram_files_own_scores_count(tmp_path, text):
    library = pytest.importorskip("sentencepiece")
    path = str(tmp_path / "unigram.model")
    unigram_file(path)
    own = load(path)
    assert [own.score[259 + n] for n in range(len(SCORES))] == [np.float32(score) for score in SCORES.values()]
    ids, cuts = sentencepiece.encode_texts(own, [text])
    expected = library.SentencePieceProcessor(model_file=path).encode(text)
    assert ids[cuts[0] : cuts[1]].tolist() == expected
    assert sentencepiece.decode_ids(own, ids) == text


def test_kinds_of_files(tmp_path, vocabulary):
    path = str(tmp_path / "unigram.model")
    unigram_file(path)
    with open(path, "rb") as own, open(pieces.VOCABULARY, "rb") as public:
        assert pieces.model_kind(own.read()) == pieces.UNIGRAM and pieces.model_kind(public.read()) == pieces.BPE
    assert pieces.model_kind(b"") == pieces.UNIGRAM
    # Ranks are under Zipf's law.
    assert vocabulary.score[vocabulary.score < 0].max() > -5 and vocabulary.score.min() > -30
