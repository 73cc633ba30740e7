from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from partyard.llm import piece_codec

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

LETTERS = [*"ab  \n\t.,éñ中😀́ﬁ 　ｶﾞ１①ß▁\x7f", "<s>", "</s>", "<0x41>"]


def scraps(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


TEXTS = ["", " ", "  ", "a", " a ", "▁ ▁a", "\x00b", *scraps(2000, 1)]


@pytest.fixture(scope="module")
def model():
    with open(piece_codec.model_path(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def test_ids_are_the_library_s(model, library):
    encoded = piece_codec.Codec(model).encode([t.encode() for t in TEXTS])
    assert [ids for ids, _ in encoded] == [library.encode(t) + [library.eos_id()] for t in TEXTS]


def test_bounds_cut_the_source(model, library):
    codec = piece_codec.Codec(model)
    for text, (ids, bounds) in zip(TEXTS, codec.encode([t.encode() for t in TEXTS]), strict=True):
        source = text.encode()
        assert len(bounds) == len(ids) + 1
        assert bounds[0] == 0 and bounds[-1] == len(source) and (bounds[1:] >= bounds[:-1]).all()
        for place, piece in enumerate(library.encode(text, return_type="proto").pieces):
            own = source[bounds[place] : bounds[place + 1]]
            if piece.piece.startswith("<0x") and library.is_byte(piece.id):
                assert own == bytes([int(piece.piece[1:-1], 16)])
            else:
                assert (bounds[place], bounds[place + 1]) == (piece.begin, piece.end)
                assert own.replace(b" ", piece_codec.MARK) == piece.piece.encode() or place == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("dummy", [True, False])
def test_character_maps(rule, squeeze, dummy):
    """Compiled maps of the library, walked here, against its own normaliser."""
    from sentencepiece import sentencepiece_model_pb2

    theirs = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=squeeze
    )
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(theirs.serialized_model_proto())
    ours = piece_codec.Normalizer(proto.normalizer_spec)
    for text in TEXTS[:800]:
        found, places = ours(text.encode())
        want, offsets = theirs.normalize(text, with_offsets=True)
        assert found.decode() == want
        if want:
            ends = [len(want[:k].encode()) for k in range(len(want) + 1)]
            assert [places[e] for e in ends] == [len(text[:o].encode()) for o in offsets]


def test_longest_key_and_its_place():
    from sentencepiece import sentencepiece_model_pb2

    theirs = sentencepiece.SentencePieceNormalizer(norm_map=[("ab", "x"), ("abc", "yz"), ("d", "")])
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(theirs.serialized_model_proto())
    spec = proto.normalizer_spec
    spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
    found, places = piece_codec.Normalizer(spec)(b"abcdabq")
    assert found == b"yzxq"
    assert places.tolist() == [0, 0, 4, 6, 7]


def test_rows(spark, odd_docs, odd_rows, clashing_docs, no_docs, library):
    out = piece_codec.encode_documents(odd_docs)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    want = sorted(
        (repr(i), tuple(library.encode(t or "") + [library.eos_id()])) for i, t, *_ in odd_rows
    )
    assert sorted((repr(r.doc_id), tuple(r.ids)) for r in rows) == want
    assert all(r.decoded == library.decode(r.ids) for r in rows)
    assert sorted(map(tuple, piece_codec.digests(piece_codec.encode_documents(clashing_docs)).collect()), key=repr) == sorted(
        map(tuple, piece_codec.digests(out).collect()), key=repr
    )
    assert piece_codec.encode_documents(no_docs).count() == 0


def test_digests(spark, library):
    import hashlib

    text = "Zwei  é中\n x"
    row = piece_codec.digests(
        piece_codec.encode_documents(spark.createDataFrame([(3, text)], "doc_id long, text string"))
    ).first()
    ids = library.encode(text) + [library.eos_id()]
    assert row.n_tokens == len(ids)
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert row.n_bytes == len(text.encode())


def test_without_end(spark, library):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = piece_codec.encode_documents(docs, end=False).select("ids", F.size("bounds").alias("n")).first()
    assert row.ids == library.encode("a b") and row.n == len(row.ids) + 1
