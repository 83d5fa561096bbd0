import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from leadpipe.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as file:
        return file.read()


TEXTS = [
    "",
    " ",
    "  Two  blanks \t tab\n\n and a line.\nNext  ",
    "literal ▁mark▁▁ here",
    "</s> <s> <unk> <0x41>",
    "日本語のテキスト、空白なし。" * 30,
    "naïve é \U0001f600\U0001f680   　 ﻿ ​",
    "x\u0000y \u0000 z",
    "a" * 5000,
    " " * 700 + "end",
    "Hello world, it's 12 o'clock.\n" * 9000,
]


def test_ids_and_texts_are_those_of_the_library(library, model):
    codec = pieces.Pieces(model)
    for text in TEXTS:
        ids = np.frombuffer(codec.encode(text, True), "<u4")
        assert ids.tolist() == library.encode(text, add_eos=True)
        assert codec.decode(ids) == library.decode(ids.tolist())


def test_random_texts_and_small_tables_and_parts(library, model, monkeypatch):
    draw = random.Random(4)
    letters = "abc deE \n.▁é中\U0001f600 12"
    codec = pieces.Pieces(model, table_chars=20)
    for size in (1, 7, 1 << 16):
        monkeypatch.setattr(pieces, "PART", size)
        monkeypatch.setattr(pieces.parts, "__defaults__", (size,))
        for _ in range(200):
            text = "".join(draw.choice(letters) for _ in range(draw.randrange(60)))
            ids = np.frombuffer(codec.encode(text, False), "<u4")
            assert ids.tolist() == library.encode(text)
            # Any ids can be decoded, bytes of half a character too.
            noise = np.array([draw.randrange(1, 400) for _ in range(30)], "<u4")
            for some in (ids, noise):
                assert codec.decode(some) == library.decode(some.tolist())


def test_each_distinct_word_is_segmented_once(model):
    codec = pieces.Pieces(model)
    asked, segment = [], codec.word.encode

    class Counted:
        def encode(self, words, num_threads):
            asked.extend(words)
            return segment(words, num_threads=num_threads)

    codec.word = Counted()
    for _ in range(3):
        codec.encode("one two one three two", True)
    assert sorted(asked) == ["▁one", "▁three", "▁two"]


def test_models_whose_pieces_cross_markers_are_refused(model):
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    spec.pieces[500].piece = "of▁the"
    with pytest.raises(ValueError, match="marker"):
        pieces.Pieces(spec.SerializeToString())


def test_edges(edges, none, library):
    kept = edges.select("doc_id", "text", "tokens", "n_words")
    rows = pieces.decode(pieces.encode(kept, MODEL), MODEL).collect()
    assert len(rows) == 9
    texts = {r.doc_id: r.text or "" for r in edges.collect()}
    for r in rows:
        assert np.frombuffer(r.tokens, "<u4").tolist() == library.encode(texts[r.doc_id], add_eos=True)
        assert r.n_tokens == len(r.tokens) // 4 and r.n_words == 5
        assert r.decoded == texts[r.doc_id]
    assert pieces.decode(pieces.encode(none, MODEL, keep=["doc_id"]), MODEL).count() == 0


def test_digests(frame, library):
    docs = frame([(1, "One text."), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in pieces.digests(pieces.decode(pieces.encode(docs, MODEL), MODEL)).collect()}
    ids = " ".join(map(str, library.encode("One text.", add_eos=True)))
    assert found[1].ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert (found[2].n_tokens, found[2].ids_sha256) == (1, hashlib.sha256(b"2").hexdigest())
    assert found[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
