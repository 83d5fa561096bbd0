"""SentencePiece by a table of distinct chunks.

Where no piece of a model goes on behind a white space marker, no merge crosses
the place in front of one.  The marked words of a text, white space markers and
what follows up to the next ones, are then segmented apart from each other, and
equal words get equal ids.  So the library segments each distinct word once; the
ids of a text are those of its words, joined back by position.

The table is one of a worker: words repeat so much that each worker meets most
of them in its first texts, while a table of all words would shuffle every word
of every text.  It is bounded in characters and starts anew when it is full.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from leadpipe.llm import words as W

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
BORDER = re.compile(f"[^{MARK}]{MARK}")
# Longer texts are taken in parts of about so many characters or ids.
PART = 1 << 16
# Characters of the words in a worker's table; about 100 MB with their ids.
TABLE_CHARS = 1 << 23


class Pieces:
    """A model with the table of the words it has segmented."""

    def __init__(self, model: bytes, table_chars: int = TABLE_CHARS):
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        names = [p.piece for p in spec.pieces]
        if spec.trainer_spec.treat_whitespace_as_suffix or any(BORDER.search(n) for n in names):
            raise ValueError("the model has pieces that go on behind a white space marker")
        if not spec.normalizer_spec.escape_whitespaces:
            raise ValueError("the model does not mark white space")
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        rules = spec.normalizer_spec
        # Without a map of characters and with all white space kept, only the markers are new.
        self.plain = not (rules.precompiled_charsmap or rules.remove_extra_whitespaces) and not any(
            p.type == p.USER_DEFINED for p in spec.pieces
        )
        self.prefix = MARK if rules.add_dummy_prefix else ""
        # Words come with their markers, so nothing is left to normalise.
        rules.Clear()
        rules.name = "identity"
        rules.add_dummy_prefix = rules.remove_extra_whitespaces = rules.escape_whitespaces = False
        self.word = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.end = self.whole.eos_id()
        self.marked = np.array([n.startswith(MARK) for n in names])
        self.guard = next(i for i, n in enumerate(names) if re.fullmatch("[a-z]", n))
        self.table: dict[str, bytes] = {}
        self.chars, self.table_chars = 0, table_chars

    def marked_text(self, text: str) -> str:
        """The text as the model segments it, white space as markers."""
        if not self.plain:
            return self.whole.normalize(text)
        return self.prefix + text.replace(" ", MARK) if text else ""

    def encode(self, text: str, end: bool) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        packed = []
        for part in parts(self.marked_text(text)):
            chunks = CHUNK.findall(part)
            unseen = list(set(chunks).difference(self.table))
            for chunk, ids in zip(unseen, self.word.encode(unseen, num_threads=1), strict=True):
                self.table[chunk] = np.array(ids, "<u4").tobytes()
                self.chars += len(chunk)
            packed.extend(map(self.table.__getitem__, chunks))
            if self.chars > self.table_chars:
                self.table, self.chars = {}, 0
        if end:
            packed.append(np.array([self.end], "<u4").tobytes())
        return b"".join(packed)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, in parts that begin with a marked piece.

        A leading marker is white space the model added only at the begin of a
        text, so later parts are decoded behind a letter.
        """
        starts = np.flatnonzero(self.marked[ids])
        cuts, texts = [0], []
        while len(ids) - cuts[-1] > PART:
            i = np.searchsorted(starts, cuts[-1] + PART)
            if i == len(starts):
                break
            cuts.append(int(starts[i]))
        for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True):
            part = ids[a:b].tolist()
            texts.append(self.whole.decode([self.guard, *part])[1:] if a else self.whole.decode(part))
        return "".join(texts)


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A marked text cut in front of markers only."""
    start = 0
    while len(text) - start > size:
        cut = BORDER.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start() + 1]
        start = cut.start() + 1
    if start < len(text):
        yield text[start:]


@functools.lru_cache(maxsize=2)
def pieces(model: bytes) -> Pieces:
    """The model of a file's content, built once per worker process."""
    return Pieces(model)


def encode(
    docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None, end: bool = True
) -> DataFrame:
    """The kept columns (all others than the text unless named) with `tokens`, the ids of the whole
    text as little-endian unsigned 32-bit integers, and `n_tokens`, an end id at last if asked for.

    The model file is read by the driver, its size is that of a vocabulary, and goes to the
    executors as a broadcast variable.  A null or empty text has the end id alone; repeated rows
    stay repeated; an empty table gives an empty one; strings of control pieces are ordinary text.
    Kept columns called like a new one are left out.
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    kept = [c for c in (keep or docs.columns) if c != text and c.lower() not in ("tokens", "n_tokens")]

    def run(texts: pa.Array) -> list:
        codec = pieces(model.value)
        packed = [codec.encode(value.as_py(), end) for value in texts]
        return [pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())]

    return W.map_texts(docs, run, "tokens binary, n_tokens long", kept, text)


def decode(encoded: DataFrame, model_path: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """The rows with the text their tokens stand for; null tokens count as none and give an empty one.

    Bytes that are no text become replacement characters, as in the library.
    """
    model = encoded.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    kept = [c for c in encoded.columns if c.lower() != into.lower()]
    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pieces(model.value)
        for batch in batches:
            for part in W.slices(batch, kept.index(tokens)):
                ids = (np.frombuffer(v.as_py() or b"", "<u4") for v in part.column(kept.index(tokens)))
                made = pa.array([codec.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=schema.fieldNames())

    W.bound_batches(encoded.sparkSession)
    return encoded.select(*kept).mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """SHA-256 of the decimal ids, joined by one blank, and of the decoded text."""

    def decimal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = (np.frombuffer(v.as_py(), "<u4").tolist() for v in batch.column(2))
            made = pa.array([hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() for ids in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], made, batch.column(3)], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    tokens, text = F.coalesce("tokens", F.lit(b"")).alias("tokens"), F.sha2("decoded", 256).alias("decoded_sha256")
    rows = decoded.select("doc_id", "n_tokens", tokens, text)
    id_type = decoded.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(decimal, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
