"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from test_operators import SCHEMA, odd_texts

from ledgerlens.llm import common, sentence_pieces

ODD = [
    " ", "  ", " " * 15, " " * 16, " " * 29, " " * 300, "▁", "\n", "\t", "the", "ing", "!=", "==", "=====", "###", "$('#", "日本", "🙂", "é", "é",
    "\x00", "<s>", "</s>", "<unk>", "<0x41>", "#" * 40, "*" * 33, "--", "1", "23", "xx", "ABC", "/", "http", "ﬁ", "﻿", "ß", "привет", "'s", "{}", "\r\n",
]


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.read_model()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.model_file())


def mixed(rng, parts, most):
    return "".join(rng.choice(parts) for _ in range(rng.randrange(most)))


def same(model, library, texts):
    ids, begin = sentence_pieces.Encoder(model)(texts)
    want = library.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == want
    assert sentence_pieces.Decoder(model)(ids, begin) == [library.decode(w) for w in want]


def test_texts(model, library):
    rng = random.Random(1)
    parts = [p for p, k in zip(model.pieces, model.kinds) if k == sentence_pieces.PIECE]
    same(model, library, ["", " ", "a", *(mixed(rng, ODD, 50) for _ in range(800)), *(mixed(rng, parts, 50) for _ in range(800))])
    # Few letters make many pairs of one rank, side by side.
    same(model, library, [mixed(rng, "ab=!#-", 400) for _ in range(150)])


def test_long_words_and_parts(model, library, monkeypatch):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABC0123456789+/") for _ in range(3000))
    texts = [long, long[:50] + " " + long, mixed(rng, ODD, 500) * 3]
    same(model, library, texts)
    monkeypatch.setattr(sentence_pieces, "LONGEST", 40)
    same(model, library, texts)
    monkeypatch.setattr(sentence_pieces, "PART", 37)
    same(model, library, texts)


def test_words_of_equal_hash(model, library, monkeypatch):
    """Words are merged by themselves if hashes of unlike ones agree."""
    monkeypatch.setattr(common, "mix64", lambda x: x % np.uint64(3))
    same(model, library, ["some words that share three hashes", "and some other words"])


def test_any_ids_decode(model, library):
    rng = random.Random(3)
    kinds = (lambda: rng.randrange(32000), lambda: rng.randrange(259), lambda: rng.randrange(3, 259), lambda: rng.randrange(3))
    rows = [[rng.choice(kinds)() for _ in range(rng.randrange(12))] for _ in range(3000)]
    begin = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    found = sentence_pieces.Decoder(model)(np.array([i for r in rows for i in r]), begin)
    assert found == [library.decode(r) for r in rows]
    with pytest.raises(ValueError):
        sentence_pieces.Decoder(model)(np.array([32000]), np.array([0, 1]))


def plain(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    decoded = library.decode(ids)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_query(spark, library):
    texts = [*odd_texts(), (20, "▁ marks "), (21, " " * 5000 + "x"), (22, "\x00")]
    df = spark.createDataFrame([(i, t, "en", "s", 0, 1, 0.5, 7, "t", 1) for i, t in texts], SCHEMA)
    # Columns of the result's own names don't matter.
    df = df.withColumnsRenamed({"tid": "ids", "part": "decoded", "size": "n_tokens"})
    found = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentence_pieces.op11_pieces(df).collect())
    assert found == sorted((i or -1, *plain(library, t)) for i, t in texts)
    assert sentence_pieces.op11_pieces(df.limit(0)).count() == 0
    kept = sentence_pieces.encode(df, keep=("doc_id", "lang"), bos=False, eos=False).filter("doc_id = 7").first()
    assert (kept.lang, np.frombuffer(kept.ids, "<u4").tolist()) == ("en", library.encode("Two words"))


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    with open(sentence_pieces.model_file(), "rb") as f:
        body = f.read()
    for change in (
        lambda p: setattr(p.trainer_spec, "model_type", 1), lambda p: setattr(p.normalizer_spec, "remove_extra_whitespaces", True),
        lambda p: setattr(p.pieces[300], "type", 4),
    ):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(body)
        change(proto)
        (tmp_path / "m").write_bytes(proto.SerializeToString())
        with pytest.raises(ValueError):
            sentence_pieces.read_model(str(tmp_path / "m"))
