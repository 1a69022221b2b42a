import hashlib

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from brute import as_dicts, rows

from tripmill.llm import pieces, queries


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.read_model(queries.piece_model()))


def test_every_document_as_the_library_does(spark, sf_dir, library):
    docs = rows(sf_dir, "documents")
    got = {r["doc_id"]: r for r in as_dicts(queries.op9_offset_encoding(spark, sf_dir))}
    assert len(got) == len(docs)
    for d, ids in zip(docs, library.encode([d["text"] or "" for d in docs], num_threads=1)):
        row = got[d["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert row["covered_bytes"] == len((d["text"] or "").encode())


ODD = ["", " ", "  a  b ", "▁", "▁▁x", "a▁b", "\t\n\r\x00\x7f", "中文字 und 🙂🙂", "é", "<s></s><unk><0x41>",
       "   " * 30 + "x", "a" * 3000, "\u200b\ufeff\u00a0", "🙂" * 200, "the the the", "�", "x\u2581 y",
       "ab" * 20_000, "\n" * 500, "مرحبا بالعالم", "İIıi", " \u3000 "]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text, model, library):
    ids, starts, ends = model.encode(text)
    assert ids.tolist() == library.encode(text)
    assert model.decode(ids.tolist()) == library.decode(library.encode(text))
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(starts, ends)) == raw


def test_spans_are_those_of_the_library(model, library):
    for text in ODD + ["Hello wörld, 中文 and more."]:
        ids, starts, ends = model.encode(text)
        at = [0]
        for c in text:
            at.append(at[-1] + len(c.encode()))
        for piece, i, a, b in zip(library.encode(text, return_type="proto").pieces, ids,
                                  starts, ends, strict=True):
            if model.kinds[i] != pieces.BYTE:
                assert (piece.begin, piece.end) == (a, b)


def test_any_ids_decode_as_in_the_library(model, library):
    for ids in ([], [1, 2], [0], [5, 6, 7], [200, 201, 300], [3 + 0xE4, 3 + 0xB8, 300],
                [3 + 0xE4, 3 + 0xB8, 3 + 0xAD, 259, 29871], [29871, 29871, 1, 29871, 450],
                [3 + 0xFF] * 4 + [450, 0, 450], [1, 450], [3 + 32, 450]):
        assert model.decode(ids) == library.decode(ids), ids


def test_compiled_maps_replace_the_longest_prefix():
    for rule in ("nmt_nfkc", "nfkc_cf"):
        theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        proto = dict(pieces.fields(theirs.serialized_model_proto()))
        spec = dict(pieces.fields(proto[3]))
        ours = object.__new__(pieces.PieceModel)
        ours.map = pieces.CharacterMap(spec[2])
        ours.squeeze, ours.dummy_prefix, ours.escape = False, False, False
        assert ours.map.units
        for text in ["ﬁne ①② ｶﾞ Ａ", "ａ\u0301b", "½ ㌔ e\u0301", "plain", "Ǆ\u00a0x", "中文🙂"]:
            plain, origin = ours.normalise(text)
            assert plain.strip(" ") == theirs.normalize(text).replace("▁", " ").strip(" ")
            assert len(origin) == len(plain) + 1 and origin[-1] == len(text.encode())
            assert (origin[1:] >= origin[:-1]).all()


def test_squeezed_spaces_and_prefix():
    ours = object.__new__(pieces.PieceModel)
    ours.map = pieces.CharacterMap(b"")
    ours.squeeze = ours.dummy_prefix = ours.escape = True
    plain, origin = ours.normalise("  a   b ")
    assert plain == "▁a▁b" and origin.tolist() == [2, 2, 3, 6, 7]
    assert ours.normalise("   ")[0] == ""


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, None, 1), (None, "a b", 2), (None, "a b", 2)],
                                 "doc_id long, text string, n_tokens int")
    got = sorted(r["n_tokens"] for r in as_dicts(pieces.digests(docs, queries.piece_model())))
    assert got == [0, 2, 2]
    assert pieces.digests(docs.limit(0), queries.piece_model()).count() == 0
    kept = pieces.with_pieces(docs, queries.piece_model())
    assert kept.columns == ["doc_id", "text", "n_tokens", "ids", "starts", "ends"]


def test_digests_come_from_spans_and_decoded_ids(model, library, monkeypatch):
    texts = [*ODD, None, "Hello wörld, 中文 and more.", "Hello wörld"]
    for text, (ids, starts, ends) in zip(texts, model.encode_all([t or "" for t in texts])):
        assert ids.tolist() == library.encode(text or "")
        assert [x.tolist() for x in (starts, ends)] == [x.tolist() for x in model.encode(text or "")[1:]]
    told = []
    encode_all, decode = pieces.PieceModel.encode_all, pieces.PieceModel.decode
    monkeypatch.setattr(pieces.PieceModel, "encode_all", lambda self, some: [
        (ids, starts, starts) for ids, starts, ends in encode_all(self, some)])
    monkeypatch.setattr(pieces.PieceModel, "decode",
                        lambda self, ids: told.append(list(ids)) or decode(self, ids))
    got = pieces._teller(pieces.read_model(queries.piece_model()), True).func(pd.Series(texts))
    assert told == [library.encode(t or "") for t in texts]
    for text, row in zip(texts, got.itertuples()):
        assert row.n_tokens == len(row.ids) == len(library.encode(text or ""))
        assert row.covered_bytes == 0  # by the spans, which were emptied


def test_bytes_covered_count_once():
    def covered(*spans):
        return pieces.covered(*np.array(spans, np.int32).reshape(-1, 2).T)
    assert covered() == 0
    assert covered((0, 3), (0, 3), (0, 3), (3, 5)) == 5
    assert covered((2, 4), (6, 7)) == 3


def test_remembering_forgets_nothing_of_a_batch(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    ours = pieces.PieceModel(pieces.read_model(queries.piece_model()))
    texts = [f"w{i} w{i + 1} w{i % 4} 中文w{i}" for i in range(20)] * 2
    for begin in range(0, len(texts), 7):
        part = texts[begin:begin + 7]
        assert [ids.tolist() for ids, _, _ in ours.encode_all(part)] == library.encode(part)
