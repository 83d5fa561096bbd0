"""Removal of passages that repeat, as spans of consecutive sentences.

Every run of several sentences is hashed, wherever it starts.  A run met in
more than one place is kept where it comes first and its sentences are removed
everywhere else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpipe.llm import words as W
from leadpipe.operators.relational import same_key

# A run has at least so many sentences, and so many more that it has enough words.
RUN_SENTENCES = 3
RUN_WORDS = 16
# Longer sentences are cut after words that one hash in CUT_EVERY selects, so
# that the parts of a passage are the same wherever a sentence around it starts.
LONG_SENTENCE = 12
CUT_EVERY = 5

# What ends a sentence, also where no blank follows, and what may stand behind that.
WIDE_STOPS = np.array([ord(c) for c in "。！？｡"], np.uint32)
STOPS = np.array([ord(c) for c in ".!?…।॥۔؟։።。！？｡"], np.uint32)
CLOSERS = np.array([ord(c) for c in "\"')]}”’»」』）】］"], np.uint32)
# All scripts without blanks have characters that begin with this byte or a higher one.
UNSPACED_BYTE = 0xE0
FACTOR = 0x9E3779B97F4A7C15
UNFACTOR = pow(FACTOR, -1, 1 << 64)


def _words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words are what white space parts; in scripts without blanks each letter begins one, and so
    does what follows a wide full stop and the marks that close behind it."""
    if not (data >= UNSPACED_BYTE).any():
        return W.NOT_SPACE[data], np.zeros(len(data), bool)
    _, breaks = W.letters(data, edges)
    if (data >= 0xE3).any():
        places, code, _ = W.characters(data)
        stop, closer = np.isin(code, WIDE_STOPS), np.isin(code, CLOSERS)
        bare = np.maximum.accumulate(np.where(closer, 0, np.arange(len(code))))
        ended = stop[bare]
        breaks[places[1:][ended[:-1] & ~closer[1:] & ~np.isin(code[1:], STOPS)]] = True
    return W.NOT_SPACE[data], breaks


def _up_to(data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and code point of the character before each place."""
    start = stop - 1
    for _ in range(3):
        start = start - ((data[start] & 0xC0) == 0x80)
    return start, W.code_points(data, start, stop - start)


class Sentences:
    """The sentences of each text and their runs.

    start, stop: bytes of each sentence with the white space behind it; first:
    index of each text's first one.  run_from, run_to, run_hash: runs of
    sentences, both ends included; run_first: index of each text's first run.
    """

    def __init__(self, texts: pa.Array):
        self.data, self.at = W.buffers(texts)
        found = W.Runs(self.data, self.at, _words)
        owner = found.owner
        ends = np.flatnonzero(self._ends(found, owner))
        begins = np.concatenate([[0], ends[:-1] + 1])[: len(ends)].astype(np.int64)
        self.owner = owner[ends]
        self.first = np.searchsorted(self.owner, np.arange(len(self.at)))
        self.start = found.start[begins]
        self.stop = np.append(self.start[1:], len(self.data))
        last = self.owner != np.append(self.owner[1:], -1)
        self.stop[last] = self.at[self.owner[last] + 1]
        place = np.arange(len(owner)) - np.repeat(begins, ends + 1 - begins)
        scaled = found.hash * W.POWERS[place & (len(W.POWERS) - 1)]
        hashes = W.mix(np.add.reduceat(scaled, begins)) if len(begins) else np.zeros(0, np.uint64)
        self._runs(hashes, np.concatenate([begins, [len(owner)]]))

    def _ends(self, found: W.Runs, owner: np.ndarray) -> np.ndarray:
        """Words that end a sentence: by a full stop, a line's end or the text's."""
        data = self.data
        if not len(owner):
            return np.zeros(0, bool)
        last, tail = _up_to(data, found.end)
        stopped = np.isin(tail, STOPS)
        closed = np.flatnonzero(np.isin(tail, CLOSERS) & (last > found.start))
        stopped[closed] = np.isin(_up_to(data, last[closed])[1], STOPS)
        breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
        following = np.append(found.start[1:], len(data))
        ends = stopped | (breaks[following] > breaks[found.end])
        ends |= owner != np.append(owner[1:], -1)
        sentence = np.cumsum(ends) - ends
        long = np.bincount(sentence)[sentence] > LONG_SENTENCE
        return ends | (long & (found.hash % np.uint64(CUT_EVERY) == 0))

    def _runs(self, hashes: np.ndarray, words: np.ndarray) -> None:
        """For each sentence the shortest run from it on, and the shortest one up to it."""
        n = len(hashes)
        index = np.arange(n)
        final, initial = self.first[self.owner + 1] - 1, self.first[self.owner]
        to = np.maximum(index + RUN_SENTENCES - 1, np.searchsorted(words, words[:-1] + RUN_WORDS) - 1)
        of = np.minimum(index - RUN_SENTENCES + 1, np.searchsorted(words, words[1:] - RUN_WORDS, "right") - 1)
        on, back = to <= final, of >= initial
        # Two ascending lists, which a stable sort merges.
        pairs = np.sort(np.concatenate([index[on] * n + to[on], of[back] * n + index[back]]), kind="stable")
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]]
        self.run_from, self.run_to = (pairs // n, pairs % n) if n else (pairs, pairs)
        self.run_first = np.searchsorted(self.run_from, self.first)
        powers = np.cumprod(np.full(n, FACTOR, np.uint64)) if n else np.zeros(0, np.uint64)
        unpowers = np.cumprod(np.full(n, UNFACTOR, np.uint64)) if n else powers
        total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers, dtype=np.uint64)])
        length = (self.run_to - self.run_from + 1).astype(np.uint64)
        raw = (total[self.run_to + 1] - total[self.run_from]) * unpowers[self.run_from]
        self.run_hash = W.mix(raw + length)

    def later(self) -> np.ndarray:
        """Runs met before in the same text."""
        _, again = W.repeated(self.run_hash + W.mix(self.owner[self.run_from].astype(np.uint64)))
        return again

    def covered(self, runs: np.ndarray) -> np.ndarray:
        """Sentences in any of the chosen runs."""
        edge = np.bincount(self.run_from[runs], minlength=len(self.start) + 1)
        edge = edge - np.bincount(self.run_to[runs] + 1, minlength=len(self.start) + 1)
        return np.cumsum(edge)[:-1] > 0


def _hashes(texts: pa.Array) -> list:
    found = Sentences(texts)
    first = ~found.later()
    counts = np.concatenate([[0], np.cumsum(first)])[found.run_first]
    values = pa.array(found.run_hash[first].view(np.int64), pa.int64())
    return [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)]


def _cleaned(texts: pa.Array, elsewhere: pa.Array) -> list:
    """Texts without the sentences in runs that are repeats, and how many were there and went."""
    found = Sentences(texts)
    listed, at = elsewhere.flatten().to_numpy(zero_copy_only=False).view(np.uint64), _starts(elsewhere)
    owner_key = W.mix(np.repeat(np.arange(len(texts)), np.diff(at)).astype(np.uint64))
    own_key = W.mix(found.owner[found.run_from].astype(np.uint64))
    repeats = np.isin(found.run_hash + own_key, listed + owner_key) | found.later()
    gone = found.covered(repeats)
    removed = W.sums(gone, found.first)
    out, data = texts.to_pylist(), found.data.tobytes()
    for i in np.flatnonzero(removed):
        kept = np.flatnonzero(~gone[found.first[i] : found.first[i + 1]]) + found.first[i]
        lead = data[found.at[i] : found.start[found.first[i]]]
        out[i] = (lead + b"".join(data[found.start[s] : found.stop[s]] for s in kept)).decode()
    return [pa.array(out, pa.string()), np.diff(found.first), removed]


def _starts(lists: pa.Array) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and `hashes`, the runs of each document that come first in another one.

    First means the smallest id; rows of the same id are one document.  Rows
    without an id are no document of the corpus: they lose only what they repeat
    themselves, and nothing is removed for their sake.  Hashes alone are shuffled,
    once to find the first place, partly aggregated, and once to tell the others,
    with hot ones split.  They are computed twice, as a table of them would take
    more disk than the texts' second reading takes time.
    """
    plain = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    hashed = W.map_texts(plain, _hashes, "hashes array<long>", ["id"], "text")
    held = hashed.select("id", F.explode("hashes").alias("hash"))
    places = held.groupBy(F.col("hash").alias("met")).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    repeated = places.where("low <> high").select("met", "low")
    others = held.join(repeated, same_key(F.col("hash"), F.col("met"))).where("id <> low")
    return others.groupBy("id").agg(F.collect_set("hash").alias("hashes"))


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, `text` without repeated spans, `n_sentences` of the whole text
    and `n_removed` of them.

    Removed are the sentences of every run that is not the first of its kind, in
    its own or another document; the text around them stays as it is, a partly
    repeated sentence too.  A null text stays null and has no sentences.  Rows
    of the same id are one document and do not repeat each other; other columns
    are left out.  An empty table gives an empty one.
    """
    marks = repeats(docs, id, text).withColumnRenamed("id", "marked")
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    joined = rows.join(marks, same_key(F.col("id"), F.col("marked")), "left").select(
        "id", "text", F.coalesce("hashes", F.array().cast("array<long>")).alias("hashes")
    )
    schema = T.StructType(
        [T.StructField(id, docs.schema[id].dataType), T.StructField("text", T.StringType())]
        + T.StructType.fromDDL("n_sentences long, n_removed long").fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, 1):
                texts = part.column("text")
                clean, total, gone = _cleaned(pa.compute.fill_null(texts, ""), part.column("hashes"))
                clean = pa.compute.if_else(pa.compute.is_null(texts), texts, clean)
                arrays = [part.column("id"), clean, pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    W.bound_batches(docs.sparkSession)
    return joined.mapInArrow(run, schema)
