"""Byte-level BPE with tiktoken over a local rank file."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpipe.llm import words as W

# Longer texts are encoded in pieces of about so many characters.
PIECE_CHARS = 1 << 16
# A letter or digit before a blank or line feed: no match of the split pattern
# reaches over the place between them, as white space only ever starts one.
SAFE = re.compile(r"[^\W_][ \n]")


@functools.lru_cache(maxsize=2)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file's content, built once per worker process."""
    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut at safe places only; whole where it has none."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start() + 1]
        start = cut.start() + 1
    yield text[start:]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The kept columns (all others than the text unless named) with `tokens`, the ids of the
    whole text as little-endian unsigned 32-bit integers, and `n_tokens`.

    The rank file is read by the driver, its size is that of a vocabulary, and goes to the
    executors as a broadcast variable.  A null text counts as empty and has no tokens;
    repeated rows stay repeated; strings of special tokens are ordinary text.  Kept columns
    called like a new one are left out.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())
    kept = [c for c in (keep or docs.columns) if c != text and c.lower() not in ("tokens", "n_tokens")]

    def run(texts: pa.Array) -> list:
        codec = encoding(ranks.value, pattern)
        packed = []
        for value in texts:
            ids = [np.array(codec.encode_ordinary(p), "<u4").tobytes() for p in pieces(value.as_py())]
            packed.append(b"".join(ids))
        return [pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())]

    return W.map_texts(docs, run, "tokens binary, n_tokens long", kept, text)


def decode(
    encoded: DataFrame, ranks_path: str, pattern: str, tokens: str = "tokens", into: str = "decoded"
) -> DataFrame:
    """The rows with the bytes their tokens stand for; whether those are UTF-8 is not asked.

    Null tokens count as none and give no bytes.
    """
    ranks = encoded.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())
    kept = [c for c in encoded.columns if c.lower() != into.lower()]
    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(ranks.value, pattern)
        for batch in batches:
            for part in W.slices(batch, kept.index(tokens)):
                ids = (np.frombuffer(v.as_py() or b"", "<u4").tolist() for v in part.column(kept.index(tokens)))
                made = pa.array([codec.decode_bytes(i) for i in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=schema.fieldNames())

    W.bound_batches(encoded.sparkSession)
    return encoded.select(*kept).mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """SHA-256 of the packed ids and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
