import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from knotwork.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "　", "é", "１", "½", "中", "́", "😀", "\t", "▁", "\x00", "राम", "​", "﻿", "Th", "the", " token", "12", "ﬁ", "\r\n"]


def odd_texts(n=1500):
    rng = random.Random(1)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", "a" * 3000, " " * 500]


def test_rows_against_the_library(docs, rows, none):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)

    def want(text):
        ids = library.encode(text or "")
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    got = pieces.encode(docs, PATH, with_spans=True).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((r[0], *want(r[1])) for r in rows)
    assert all(len(r.spans) == r.n_tokens for r in got)
    assert all(zlib.crc32(np.asarray([[s.begin for s in r.spans], [s.end for s in r.spans]], "<u4").tobytes()) == r.spans_crc32 for r in got)
    assert pieces.encode(none, PATH).count() == 0


def spans_of_library(library, text):
    """(begin, end) in bytes by the library's own surfaces; the bytes of a character that fell back share its span."""
    return [(x.id, x.begin, x.end) for x in library.encode(text, return_type="proto").pieces]


def test_odd_texts_and_spans():
    library, coder = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.PieceCoder(PATH)
    texts = odd_texts()
    for text, x in zip(texts, coder.code(texts), strict=True):
        own = library.encode(text)
        assert (x.ids, x.plain) == (",".join(map(str, own)), library.decode(own))
        spans = coder.spans(text)
        assert [s[0] for s in spans] == own
        data, at = text.encode(), 0
        for k, (i, piece, begin, end) in enumerate(spans):
            assert begin == at and end - begin in (1, 0) if library.is_byte(i) else begin == at
            if not library.is_byte(i) and "\u2581" not in text:
                assert data[begin:end].decode() == (piece if k else piece.removeprefix("\u2581")).replace("\u2581", " ")
            at = end
        assert not spans or at == len(data)
        # the library's surfaces: the same, but for the bytes of characters that fell back, which it gives to the last one
        for (i, _, begin, end), (j, low, high) in zip(spans, spans_of_library(library, text), strict=True):
            assert i == j and (library.is_byte(i) or (begin, end) == (low, high))


def other_model(folder, **rules):
    """The given model with another normaliser, or without pieces for bytes."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    if rules.pop("no_bytes", False):
        model.trainer_spec.byte_fallback = False
        for p in model.pieces:
            if p.type == 6:
                p.type = 5
    if rule := rules.pop("rule", None):
        named = pb.ModelProto()
        named.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        model.normalizer_spec.CopyFrom(named.normalizer_spec)
    path = folder / "other.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


@pytest.mark.parametrize("rules", [{"rule": "nmt_nfkc"}, {"rule": "nfkc_cf"}, {"no_bytes": True}, {"no_bytes": True, "rule": "nmt_nfkc"}], ids=str)
def test_other_models(tmp_path, rules):
    path = other_model(tmp_path, **rules)
    library, coder = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceCoder(path)
    texts = [x for x in odd_texts(400) if "\x00" not in x and "\u2581" not in x]
    for text, x in zip(texts, coder.code(texts), strict=True):
        own = library.encode(text)
        assert (x.ids, x.plain) == (",".join(map(str, own)), library.decode(own))
        assert (x.begins <= x.ends).all() and (x.begins[1:] == x.ends[:-1]).all()
        if "rule" not in rules:
            assert list(zip(own, x.begins.tolist(), x.ends.tolist(), strict=True)) == spans_of_library(library, text)


def test_normalisation_follows_the_compiled_map():
    from sentencepiece import sentencepiece_model_pb2 as pb

    for rule in ("nmt_nfkc", "nfkc_cf", "identity"):
        library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        model = pb.ModelProto()
        model.ParseFromString(library.serialized_model_proto())
        spec, coder = model.normalizer_spec, pieces.PieceCoder(PATH)
        coder.map = pieces.CharsMap(spec.precompiled_charsmap)
        coder.dummy, coder.squeeze, coder.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        coder.identity = rule == "identity" and not coder.squeeze
        for text in odd_texts(500):
            normal = coder.normalise(text)
            assert normal.text == library.normalize(text)
            assert len(normal.source) == len(normal.text.encode()) + 1 and list(normal.source) == sorted(normal.source)
