"""Words and hashes of many texts at once, with numpy inside Arrow batches."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts handled at a time: at most so many bytes, or one text.
SLICE_BYTES = 1 << 20
BATCH_BYTES = 2 << 20
# Bytes whose intermediate arrays are alive at a time; a longer word alone goes beyond it.
CHUNK_BYTES = 1 << 20


def fresh(name: str, taken: Sequence[str]) -> str:
    """A column name nobody uses yet, whatever the case of its letters."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def map_texts(
    docs: DataFrame,
    function: Callable[[pa.Array], Sequence],
    fields: str,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """The kept columns and what `function` makes of the texts, one value per row.

    `function` gets an Arrow array of texts (null: empty) and returns one
    sequence per field of the DDL text `fields`.
    """
    made = T.StructType.fromDDL(fields)
    schema = T.StructType([docs.schema[c] for c in keep] + made.fields)
    names, kept = schema.fieldNames(), len(keep)
    if text in keep and docs.schema[text].dataType == T.StringType():
        rows, column = docs.select(*keep), list(keep).index(text)
    else:
        rows, column = docs.select(*keep, F.col(text).cast("string").alias(fresh("_text", keep))), kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                values = function(pc.fill_null(part.column(column), ""))
                arrays = [*part.columns[:kept], *(v if isinstance(v, pa.Array) else pa.array(v) for v in values)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    bound_batches(docs.sparkSession)
    return rows.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of the session hold more than BATCH_BYTES, or one row.

    Spark's own bound is for rows of numbers; with whole texts or files each
    task holds several batches of that size at once.  A lower setting stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of a bounded number of bytes in one column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.columns[column]), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts, end to end, and where each one starts; the last entry is the end."""
    if pa.types.is_large_string(texts.type):
        width = np.int64
    else:
        texts, width = texts.cast(pa.string()), np.int32
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random odd numbers."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(step + np.uint64(seed)) | np.uint64(1)


BYTE_VALUES = stream(1, 256)
POWERS = stream(2, 1 << 12)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
NOT_NEWLINE = np.arange(256) != 0x0A

# What a character is to words: no part of one, a letter or digit, a letter of a script without
# blanks, and a mark that goes with the character before it.
OUTSIDE, LETTER, ALONE, MARK = range(4)
# First and last code points of scripts that are written without blanks.
UNSPACED = (
    (0x0E00, 0x0EFF),  # Thai, Lao
    (0x1000, 0x109F),  # Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x2E80, 0x2FDF),  # radicals
    (0x3005, 0x3007),  # iteration marks and zero
    (0x3040, 0x30FF),  # Hiragana, Katakana
    (0x3100, 0x312F),  # Bopomofo
    (0x31A0, 0x31BF),
    (0x31F0, 0x31FF),
    (0x3400, 0x4DBF),  # Han
    (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F),  # Katakana of half width
    (0x20000, 0x3FFFF),
)


@functools.cache
def kinds() -> np.ndarray:
    """The kind of each code point, by its Unicode category and script; built once per process."""
    by_category = {"L": LETTER, "N": LETTER, "M": MARK}
    table = np.array([by_category.get(unicodedata.category(chr(c))[0], OUTSIDE) for c in range(0x110000)], np.uint8)
    for first, last in UNSPACED:
        # Digits of these scripts make numbers as others do.
        alone = np.array([unicodedata.category(chr(c))[0] == "L" for c in range(first, last + 1)])
        table[first : last + 1][alone] = ALONE
    return table


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, code point and number of bytes of each character of UTF-8 text."""
    places = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[places].astype(np.uint32)
    width = np.ones(len(places), np.int64)
    if len(places) < len(data):
        long = np.flatnonzero(code >= 0x80)
        width[long] = np.append(places, len(data))[long + 1] - places[long]
        code[long] = code_points(data, places[long], width[long])
    return places, code, width


def code_points(data: np.ndarray, start: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Code points of the UTF-8 characters of so many bytes that start at some places."""
    code = data[start].astype(np.uint32)
    long = np.flatnonzero(width > 1)
    start, width = start[long], width[long]
    value = code[long] & (0x7F >> width)
    for more in (1, 2, 3):
        some = width > more
        value[some] = (value[some] << 6) | (data[start[some] + more] & 0x3F)
    code[long] = value
    return code


def letters(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of UTF-8 texts that begin at `edges`: is it of a word, and must one begin there.

    Words are runs of letters, digits and marks; in scripts without blanks each
    letter is a word, with the marks on it.
    """
    places, code, width = characters(data)
    kind = kinds()[code]
    breaks = np.zeros(len(data), bool)
    # Only marks and letters that stand alone need a look at their neighbours.
    if (kind >= ALONE).any():
        opening = np.searchsorted(places, edges)
        kind[opening] = np.where(kind[opening] == MARK, LETTER, kind[opening])
        # The last character before each one that is no mark.
        bare = np.maximum.accumulate(np.where(kind != MARK, np.arange(len(kind)), 0))
        before = np.concatenate([[np.uint8(OUTSIDE)], kind[bare[:-1]]])
        breaks[places] = (kind == ALONE) | ((kind == LETTER) & (before == ALONE))
    return np.repeat(kind != OUTSIDE, width), breaks


Rule = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Runs:
    """Maximal runs of some bytes in each text: words or lines.

    `member` tells the bytes by their values, or is a rule like `letters`.  start, end: byte positions in the concatenated texts; hash:
    64 bits each; first: index of each text's first run, with the number of runs
    at the end.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, member: np.ndarray | Rule = letters):
        parts = [_runs(data, at, *stretch) for stretch in _stretches(data, at, member)]
        empty = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        self.start, self.end, self.hash = (np.concatenate(x) for x in zip(*(parts or empty), strict=True))
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The text of each run."""
        return np.repeat(np.arange(len(self.count)), self.count)


def _stretches(
    data: np.ndarray, at: np.ndarray, member: np.ndarray | Rule
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None]]:
    """Bounded stretches of the bytes that cut no run, which bytes are in runs and where one must begin."""
    start, size = 0, CHUNK_BYTES
    while start < len(data):
        stop = min(start + size, len(data))
        if isinstance(member, np.ndarray):
            inside, breaks = member[data[start:stop]], None
        else:
            while stop < len(data) and data[stop] & 0xC0 == 0x80:
                stop += 1
            inside, breaks = member(data[start:stop], at[(at >= start) & (at < stop)] - start)
        if stop < len(data):
            # The last place where no run goes on: behind a byte of none, or where one must begin.
            cut = np.flatnonzero(~inside)[-1:] + 1
            if breaks is not None:
                cut = np.append(cut, np.flatnonzero(breaks)[-1:])
            if not len(cut) or cut.max() == 0:
                size *= 2
                continue
            stop = start + int(cut.max())
        yield start, stop, inside[: stop - start], None if breaks is None else breaks[: stop - start]
        start, size = stop, CHUNK_BYTES


def _runs(data: np.ndarray, at: np.ndarray, a: int, b: int, inside: np.ndarray, breaks: np.ndarray | None):
    edges = at[(at > a) & (at < b)] - a
    anew = np.zeros(len(inside), bool)
    anew[edges] = True
    if breaks is not None:
        anew |= breaks
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | anew[1:]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | anew[1:]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    length = end - start
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    first = np.cumsum(length) - length
    place = np.arange(first[-1] + length[-1]) - np.repeat(first, length)
    values = BYTE_VALUES[data[a:b][inside]] * POWERS[place & (len(POWERS) - 1)]
    if len(values) and place.max() >= len(POWERS):
        values *= (place // len(POWERS)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return start + a, end + a, mix(np.add.reduceat(values, first) + length.astype(np.uint64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` successive hashes, text borders aside."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(stream(3, size)):
        total += hashes[i : i + n] * factor
    return mix(total)


def whole(first: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of the n windows lie within one text; `first` as in Runs."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return owner[:n] == owner[size - 1 : size - 1 + n]


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it met more than once, and was it met before."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    often, again = np.zeros(len(key), bool), np.zeros(len(key), bool)
    often[order[1:][same]] = often[order[:-1][same]] = True
    again[order[1:][same]] = True
    return often, again


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
