"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch of words of smallest period q, four periods long at
least.  At the scale t, a power of two, each stretch of t words has a hash; a
position is chosen if the least hash of the t + 1 stretches from it on is the
first or the last one.  So the choice depends on the next 2t words alone, and
places with equal words, as those a period apart in a run, are chosen alike.

In a run of a period q from t up to 2t, one of the first t positions is chosen,
and so is the position a period later, with the same 2t words: their distance is
q.  Equal words at a shorter distance would make the period shorter, so it is
enough to look at neighbours among positions of equal words.  Each such pair
proposes its distance as a period, and comparing words to both sides gives the
run.  Stretches of a period of t/4 at most would be chosen over and over; they
have no hash.  They lie in runs of small periods, which smaller scales have
found before, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadpipe.llm import words as W

# Least length of a run, in periods and in words.
EXPONENT = 4
LEAST_WORDS = 6
# Periods of one in so many of a stretch's words make it highly periodic.
DENSE = 4
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
STEP = 256


def _ahead(values: np.ndarray, by: int, fill) -> np.ndarray:
    """The value `by` places later, `fill` behind the end."""
    moved = np.full(len(values), fill, values.dtype)
    if by < len(values):
        moved[: len(values) - by] = values[by:]
    return moved


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of `size` + 1 values from each place on; `size` is a power of two."""
    least, width = values, 1
    while width < size:
        least = np.minimum(least, _ahead(least, width, NONE))
        width *= 2
    return np.minimum(least, _ahead(least, 1, NONE))


def synchronising(stretch: np.ndarray, periodic: np.ndarray | None, t: int) -> np.ndarray:
    """Positions whose least hash among the next t + 1 stretches is the first or the last.

    `stretch` has the hash of the t words from each place on, `periodic` tells
    which of them are highly periodic and count as none.
    """
    hashes = stretch if periodic is None else np.where(periodic, NONE, stretch)
    least = _least(hashes, t)
    return np.flatnonzero((least != NONE) & ((hashes == least) | (_ahead(hashes, t, NONE) == least)))


def _proposals(chosen: np.ndarray, context: np.ndarray, where: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances from t up to 2t of neighbours among the chosen with equal contexts."""
    order = np.argsort(context[chosen], kind="stable")
    at, key = where[chosen][order], context[chosen][order]
    near = np.flatnonzero((key[1:] == key[:-1]) & (np.diff(at) >= t) & (np.diff(at) < 2 * t))
    return at[near], at[near + 1] - at[near]


def _same(words: np.ndarray, place: int, by: int, step: int) -> int:
    """How many places on, or back for a negative step, words equal those `by` later."""
    count, width = 0, STEP
    while True:
        if step > 0:
            a = words[place + count : place + count + width]
            b = words[place + count + by : place + count + by + width]
            equal = a[: len(b)] == b
        else:
            low = max(0, place - count - width + 1)
            equal = (words[low : place - count + 1] == words[low + by : place - count + 1 + by])[::-1]
        if not equal.all():
            return count + int(np.argmin(equal))
        if len(equal) < width:
            return count + len(equal)
        count, width = count + width, width * 2


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, t: int) -> list[tuple[int, int, int]]:
    """Start, end and period of the runs that proposals lie in, those too short left out."""
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    # Proposals of one distance that overlap by a period lie in one run.
    head = np.ones(len(at), bool)
    head[1:] = (period[1:] != period[:-1]) | (np.diff(at) > 2 * t)
    found = set()
    for place, q in zip(at[head].tolist(), period[head].tolist(), strict=True):
        start = place - _same(words, place - 1, q, -1) if place else 0
        end = place + q + _same(words, place, q, 1)
        if end - start >= EXPONENT * q:
            found.add((start, end, q))
    return list(found)


def runs(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of start, end and period of all runs in some texts, by start and then period.

    `words` has the hashes of the words of all texts, each text followed by one
    value that occurs nowhere else; `first` is the index of each text's first
    word, with the end of `words` as last.  Runs of less than LEAST_WORDS words
    are among them.
    """
    sizes = np.diff(first) - 1
    where, stretch = np.arange(len(words)), W.mix(words)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    found, t = [], 1
    while True:
        # A period of t needs a text of four times as many words.
        long = sizes[owner] >= EXPONENT * t
        if not long.all():
            where, stretch, owner = where[long], stretch[long], owner[long]
        if not len(where):
            break
        following = _ahead(stretch, t, np.uint64(0))
        context = W.mix(stretch * W.stream(21, 1)[0] + W.mix(following ^ np.uint64(t)))
        chosen = synchronising(stretch, _periodic(found, where, len(words), t), t)
        at, period = _proposals(chosen, context, where, t)
        found += _extended(words, at, period, t)
        stretch, t = context, 2 * t
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _periodic(found: list[tuple[int, int, int]], where: np.ndarray, n: int, t: int) -> np.ndarray | None:
    """Which stretches of t words have a period of t / DENSE at most: those inside runs of one."""
    inside = [(s, e - t + 1) for s, e, q in found if DENSE * q <= t <= e - s]
    if not inside:
        return None
    starts, ends = np.array(inside).T
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(edges)[where] > 0


def repeat_tails(count: np.ndarray, code: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The word that stands at each place of texts of `count` words, as its place in the text.

    In chosen texts the words from a certain one on are repetitions of the first of them; the
    `code` of a text tells where that begins and how long the part is.
    """
    size = np.maximum(count, 1)
    begin = code % size
    part = 1 + (count - begin) // (3 + code % 8)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin, part, chosen = (np.repeat(x, count) for x in (begin, part, chosen))
    return np.where(chosen & (place >= begin), begin + (place - begin) % part, place)


RUNS = "array<struct<start:long,length:long,period:long>>"


def find(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, tails: Column | None = None
) -> DataFrame:
    """The kept columns (all others than the text unless named) with `n_words`, `runs` and `collapsed`.

    Words are what blanks, tabs and line breaks of ASCII part.  `runs` has the start, length and
    period, in words, of all runs by start and then period; `collapsed` has the words that are in no
    run, or in the first period of all runs they are in, joined by one blank.  Texts with a value of
    `tails` are first made periodic as it tells (`repeat_tails`), a null one changes nothing.  A null
    or empty text has no words; repeated rows stay repeated; an empty table gives an empty one; kept
    columns called like a new one are left out.  Each text is worked on by itself, in slices of
    bounded size, so no key gathers rows.
    """
    kept = [c for c in (keep or docs.columns) if c != text and c.lower() not in ("n_words", "runs", "collapsed")]
    made = T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed string").fields
    schema = T.StructType([*(docs.schema[c] for c in kept), *made])
    body = F.col(text).cast("string").alias(W.fresh("_text", kept))
    code = (F.lit(None) if tails is None else tails).cast("long").alias(W.fresh("_tails", kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, len(kept)):
                data, at = W.buffers(pc.fill_null(part.column(len(kept)), ""))
                found = W.Runs(data, at, W.NOT_SPACE)
                codes = part.column(len(kept) + 1)
                chosen = codes.is_valid().to_numpy(zero_copy_only=False)
                place = repeat_tails(found.count, pc.fill_null(codes, 0).to_numpy(), chosen)
                columns = _results(data, found, np.repeat(found.first[:-1], found.count) + place)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *columns], names=schema.fieldNames())

    W.bound_batches(docs.sparkSession)
    return docs.select(*kept, body, code).mapInArrow(run, schema)


def _results(data: np.ndarray, found: W.Runs, place: np.ndarray) -> list:
    """The columns of `find` for texts whose words are those at `place` of the found ones."""
    n = len(found.count)
    first = found.first + np.arange(n + 1)
    words = np.empty(first[-1], np.uint64)
    border = np.zeros(first[-1], bool)
    border[first[1:] - 1] = True
    words[border] = W.mix(np.arange(n, dtype=np.uint64) + W.stream(22, 1)[0])
    words[~border] = found.hash[place]
    all_runs = runs(words, first)
    lengths = all_runs[:, 1] - all_runs[:, 0]
    all_runs = all_runs[lengths >= LEAST_WORDS]
    start, end, period = all_runs.T
    edges = np.bincount(start + period, minlength=len(words) + 1) - np.bincount(end, minlength=len(words) + 1)
    stays = (np.cumsum(edges)[: len(words)] == 0)[~border]
    owner = np.searchsorted(first, start, "right") - 1
    raw = data.tobytes()
    begins, ends = found.start[place].tolist(), found.end[place].tolist()
    collapsed = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        keeps = range(a, b) if stays[a:b].all() else (a + np.flatnonzero(stays[a:b])).tolist()
        collapsed.append(b" ".join([raw[begins[i] : ends[i]] for i in keeps]).decode())
    structs = pa.StructArray.from_arrays(
        [pa.array(start - first[owner]), pa.array(end - start), pa.array(period)], ["start", "length", "period"]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), structs)
    return [pa.array(found.count, pa.int64()), lists, pa.array(collapsed, pa.string())]


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and SHA-256 of runs and text."""
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", longest.alias("longest")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.expr("(1000 * longest.length) div -longest.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def tail_code(id: str) -> Column:
    """What `repeat_tails` goes by: a tenth of the CRC-32 of the id as text, for multiples of ten alone."""
    crc = F.crc32(F.col(id).cast("string").cast("binary"))
    return F.when(crc % 10 == 0, F.floor(crc / 10))
