import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from leadpipe.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def codec() -> tiktoken.Encoding:
    with open(RANKS, "rb") as file:
        return bpe.encoding(file.read(), PATTERN)


def test_pieces_give_the_tokens_of_the_whole_text():
    texts = [
        "Hello world, it's 12 o'clock.\n\n  Two  blanks \t tab\n" * 40,
        "a" * 500 + " b",
        "\n\n\n" * 100,
        "don't  won't x 'll we'll  " * 30,
        "été 12abc34 !!?? 　 \U0001f600 " * 30,
        "",
    ]
    for text in texts:
        for size in (1, 7, 50):
            cut = list(bpe.pieces(text, size))
            assert "".join(cut) == text
            ids = [i for p in cut for i in codec().encode_ordinary(p)]
            assert ids == codec().encode_ordinary(text)


def test_long_texts_are_cut():
    assert len(list(bpe.pieces("word " * 100_000))) > 5
    assert len(list(bpe.pieces("x" * 200_000))) == 1


def test_ids_and_bytes_are_those_of_the_library(edges, none):
    kept = edges.select("doc_id", "text", "tokens")
    rows = bpe.decode(bpe.encode(kept, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert len(rows) == 9
    texts = {r.doc_id: r.text or "" for r in edges.collect()}
    for r in rows:
        assert bytes(r.tokens) == np.array(codec().encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert r.n_tokens == len(r.tokens) // 4
        assert bytes(r.decoded) == texts[r.doc_id].encode()
    assert bpe.encode(none, RANKS, PATTERN, keep=["doc_id"]).count() == 0


def test_special_strings_are_text_and_digests(frame):
    docs = frame([(1, "a <|endoftext|> b"), (2, None)], "doc_id long, text string")
    decoded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    found = {r.doc_id: r for r in bpe.digests(decoded).collect()}
    ids = codec().encode_ordinary("a <|endoftext|> b")
    assert found[1].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert found[2].n_tokens == 0 and found[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_decoding_need_not_give_text(frame):
    half = "é".encode()[:1]
    tokens = frame([(1, bytearray(np.array([codec().encode_single_token(half)], "<u4").tobytes())), (2, None)], "doc_id long, tokens binary")
    found = {r.doc_id: bytes(r.decoded) for r in bpe.decode(tokens, RANKS, PATTERN).collect()}
    assert found == {1: half, 2: b""}
