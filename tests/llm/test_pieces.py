"""Encoding against the sentencepiece library: ids, spans, normalisation, decoding."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from sentencepiece import sentencepiece_model_pb2

from minuteflow.llm import pieces
from minuteflow.llm.queries import QUERIES

from .conftest import HARD

ODD = [
    "", " ", "  ", "▁", "a▁b", " ▁ x", "\n\n a  b\t", "漢字漢字 x", "q" * 5_000, "</s><s><unk> <0x0A>",
    "\x00\x01 é é 🙂🙂 ", "trailing  ", "   lead", "a　b\xa0c", "﻿x�", "ﬁ ½ Ａｂ　ｃ ㍿ ç ​ x\xad  ¨ ",
]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(public_tokenizers.path(pieces.MODEL))


def check(model, text):
    ids, begins, ends = model.encoded([text])[0]
    assert ids.tolist() == model.library.encode(text)
    data = text.encode()
    made = model.library.encode(text, return_type="proto")
    for piece, begin, end in zip(made.pieces, begins, ends, strict=True):
        if piece.surface:
            assert data[begin:end].decode() == piece.surface
    if len(ids):
        aligned = model.aligned(text)
        assert [a.tolist() for a in aligned] == [ids.tolist(), begins.tolist(), ends.tolist()]
        # Spans follow each other without a gap.
        assert begins[0] == 0 and ends[-1] == len(data)
        assert all(b == e or b == b0 for b, e, b0 in zip(begins[1:], ends, begins))


def test_ids_and_spans(model, texts):
    random.seed(4)
    mixed = ["".join(random.choices("ab ▁  \n漢é🙂<0x>s\t.1Ā", k=random.randint(1, 60))) for _ in range(2_000)]
    for text in ODD + mixed + [t or "" for _, t in texts[:60]]:
        check(model, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8")))
def test_any_text(text):
    check(pieces.PieceModel.of(public_tokenizers.path(pieces.MODEL)), text)


def test_long_texts_go_in_runs(model, monkeypatch):
    text = "one  two▁three 漢 " * 300 + "z" * 900
    whole = [x.tolist() for x in model.encoded([text])[0]]
    monkeypatch.setattr(pieces, "RUN_CHARS", 50)
    assert [x.tolist() for x in model.encoded([text])[0]] == whole


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("trims", [True, False])
def test_character_maps(rule, trims, texts):
    normalizer = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=trims
    )
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(normalizer.serialized_model_proto())
    own = pieces.PieceModel.__new__(pieces.PieceModel)
    own.map = pieces.CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    own.prefix, own.trims = True, trims
    for text in ODD + [t or "" for _, t in texts[:40]]:
        normal, begins, ends = own.normalised(text)
        assert normal == normalizer.normalize(text)
        assert len(normal) == len(begins) == len(ends)
        assert all(b <= e for b, e in zip(begins, ends))


def test_spans_through_a_character_map(model):
    """A model whose map folds widths and case keeps spans in the source."""
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nfkc_cf")
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(normalizer.serialized_model_proto())
    own = pieces.PieceModel.__new__(pieces.PieceModel)
    own.__dict__.update(model.__dict__)
    own.map = pieces.CharacterMap(spec.normalizer_spec.precompiled_charsmap)
    text = "Ｈｅｌｌｏ ﬁsh"
    ids, begins, ends = own.encoded([text])[0]
    assert ids.tolist() == model.library.encode("hello fish")
    data = text.encode()
    assert data[begins[0] : ends[1]].decode() == "Ｈｅｌｌｏ"  # ▁hell, o
    assert ends[-1] == len(data)


def test_query(spark, sf_dir, texts, model):
    got = {r.doc_id: r for r in QUERIES["op12_sentencepiece"](spark, sf_dir).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        ids = [*model.library.encode(text or ""), model.library.eos_id()]
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(model.library.decode(ids).encode()).hexdigest()
        assert row.span_bytes == len((text or "").encode())


def test_hard_rows(hard, empty, model):
    rows = pieces.encoded(hard).collect()
    assert sorted(((r.doc_id or 0), r.n_bytes, r.ids) for r in rows) == sorted(
        ((d or 0), len((t or "").encode()), [*model.library.encode(t or ""), 2]) for d, t, _ in HARD
    )
    assert all(r.begins[-1] == r.ends[-1] == r.n_bytes for r in rows)
    assert pieces.encoded(empty).count() == 0


def test_other_models_are_refused(tmp_path):
    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path(pieces.MODEL), "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.byte_fallback = False
    (tmp_path / "other.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        pieces.PieceModel(str(tmp_path / "other.model"))
