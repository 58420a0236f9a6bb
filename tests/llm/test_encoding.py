from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from martkit.llm import sentencepiece_bpe as bpe
from martkit.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = bpe.read_model(PATH)
CODEC = bpe.PieceCodec(MODEL)


def same_as_library(text: str) -> None:
    ids = LIBRARY.encode(text)
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids)
    assert CODEC.surfaces(CODEC.stretches(text)) == LIBRARY.decode(ids)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same_as_library(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" abcdeinrst\n\t,.'-0123_▁é", max_size=80))
def test_texts_of_frequent_characters(text):
    same_as_library(text)


def test_pieces_in_a_row():
    rng = random.Random(4)
    pieces = list(CODEC.ids)
    for _ in range(400):
        same_as_library("".join(rng.choice(pieces) for _ in range(rng.randint(1, 15))).replace(bpe.SPACE, " "))


def test_runs_of_spaces_and_long_words():
    for n in (1, 2, 15, 16, 17, 33, 50):
        same_as_library(" " * n)
        same_as_library("a" + " " * n + "b")
        same_as_library(" " * n + "word")
    same_as_library("antidisestablishmentarianism" * 200)


def test_going_back_over_failed_positions():
    """Every neighbour pair of an encoding is compatible, and no shorter prefix was skipped wrongly."""
    for word in ("▁thing", "▁unbelievably", "▁aaaaabaaaab", "▁<s></s>"):
        pieces = CODEC.pieces_of(word)
        assert "".join(pieces) == word
        assert all(CODEC.compatible(a, b) for a, b in zip(pieces, pieces[1:], strict=False))


def test_unfit_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    (tmp_path / "m").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="merge model"):
        bpe.read_model(str(tmp_path / "m"))


def test_table(docs, odd_rows):
    rows = bpe.encoding_digests(docs(odd_rows, clash=True), MODEL).collect()
    assert len(rows) == len(odd_rows)
    for (key, text), row in zip(odd_rows, rows, strict=True):
        ids = LIBRARY.encode(text or "")
        assert row.doc_id == key and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    encoded = bpe.encode_texts(docs(odd_rows), MODEL)
    decoded = bpe.decode_ids(encoded, MODEL)
    assert [r.text for r in decoded.collect()] == [t or "" for _, t in odd_rows]
    assert bpe.encoding_digests(docs([]), MODEL).count() == 0
