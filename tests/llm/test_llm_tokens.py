"""Token operators against the library whose model they read."""

import random

import pytest

from vitrine.llm import sentence_pieces, token_counts
from vitrine.llm.piece_model import PieceModel, count_word, merged, parse_model
from vitrine.llm.queries import model_file

sentencepiece = pytest.importorskip("sentencepiece")
PARTS = ["a", "b", "the", "  ", "   ", " ", "▁", "漢", "é", "\n", ".", "..", "=", "-", "\x00", "😀", "ing", "xxxxx", " " * 19, "\t",
         "<s>", "<0x41>", "\u200b", "ﬁ", "A", "00", "Hello", " world"]


def texts():
    rnd = random.Random(1)
    out = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    return out + [c * n for c in ".-=a *#0▁" for n in (1, 2, 3, 5, 17, 33, 64, 500)] + ["", " ", "word " * 20_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=model_file())


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(texts())] + [(7, "again"), (7, "again"), (None, None), (9, None)]


def test_counts(spark, library, rows):
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id bigint, text string, n_tokens int, n_bytes int").repartition(4)
    got = token_counts.count_tokens(docs, model_file(), 100)
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for d, t in rows]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert token_counts.count_tokens(docs.where("false"), model_file(), 100).count() == 0


def test_identifiers_and_text(spark, library, rows):
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, ids int").repartition(4)
    got = sentence_pieces.encode(docs, model_file(), threads=2)
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append(library.encode(t or ""))
    for r in got.collect():
        assert list(r.ids) in ids[r.doc_id] and r.n_tokens == len(r.ids)
    marked = {d for d, t in rows if "▁" in (t or "")}
    assert {r.doc_id for r in got.where("NOT round_trip").collect()} == marked
    back = {(r.doc_id, r.text) for r in sentence_pieces.decode(got, model_file()).collect()}
    assert back == {(d, library.decode(library.encode(t or ""))) for d, t in rows}
    assert sentence_pieces.encode(docs.where("false"), model_file()).count() == 0


def test_merging_takes_the_lowest_rank_then_the_leftmost():
    model = PieceModel(["a", "b", "ab", "ba", "aba"], [0, 0, -2.0, -1.0, -3.0], [1] * 5, kind=2)
    assert merged(model, "abab") == (["aba", "b"], 2)
    assert merged(model, "ababa") == (["aba", "ba"], 3)
    assert count_word(model, "ababa") == 2


def test_unigram_models_take_the_best_path():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -1.0, "▁ab": -4.5}
    model = PieceModel(["<unk>", *scores], [0.0, *scores.values()], [2, 1, 1, 1, 1, 1], kind=1)
    codec = sentence_pieces.Codec(model)
    assert codec.encode_batch(["ab", "abb"]) == [[1, 4], [1, 4, 3]]
    assert codec.decode_batch([[1, 4, 3]]) == ["abb"]


@pytest.mark.parametrize("most", [1, 40, 10**6])
def test_remembered_words_change_nothing(library, monkeypatch, most):
    monkeypatch.setattr(sentence_pieces, "KNOWN_WORDS", most)
    codec = sentence_pieces.Codec(parse_model(model_file()))
    for i in range(0, 600, 50):
        batch = texts()[i:i + 50]
        flat, ends, same = codec.encode_checked(batch)
        ids = [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
        assert ids == library.encode(batch) and same == [a == b for a, b in zip(batch, codec.decode_batch(ids))]


def test_special_piece_types_are_refused():
    for kind in (4, 5):
        with pytest.raises(ValueError):
            PieceModel(["<unk>", "a", "b"], [0.0, 0.0, 0.0], [2, 1, kind])


def test_unknown_normalisers_are_refused():
    data = model_file()
    model = parse_model(data)
    assert model.byte_fallback and model.cuttable and len(model.pieces) == 32_000
    with pytest.raises(ValueError):
        parse_model(data + b"\x1a\x04\x12\x02ab")  # a normaliser with a character map
