"""Language identification by compression.

A text is compressed once per language, each time with a raw-content dictionary
of that language's text, a long one in pieces whose sizes are added up.  The
language whose dictionary makes it smallest wins; a narrow margin to the second
is a rejection.
"""

from __future__ import annotations

import functools
import pickle
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadpipe.llm import words as W

UNKNOWN = "und"
# Bounds of the training sample: documents and characters of each per language,
# and bytes of all dictionaries together, which is what the driver sends out.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 1000
DICTIONARY_BYTES = 1 << 17
TOTAL_BYTES = 1 << 25
LEVEL = 9
# Filler before each text, the same for all languages: a block that does not
# shrink is stored raw, which would hide the few matches of a short text.
FILLER = b"\n" * 256
LETTERS = re.compile(r"[^\W\d_]+")
# Bytes compressed at a time, each with the dictionary, all of a text: what a dictionary saves is
# bounded, so in one piece the lead would shrink with the text's length.
PIECE_BYTES = 1 << 16
# Least lead of the winner, as a share of the second's size.
MARGIN = 0.002


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """One dictionary per language, the most frequent one first.

    The order counts all labelled rows.  The dictionaries come from a bounded
    sample, the SAMPLE_DOCS different texts of the smallest hashes per language
    and from each the SAMPLE_CHARS characters in its middle.  A threshold on the
    hash, set from the language's number of rows, leaves about four times as
    many before they are put in order, however many rows or copies there are.
    Rows without a letter or language are left out.  Dictionaries share
    TOTAL_BYTES, so what the driver holds is bounded for any number of languages.
    """
    body = F.lower(F.col(text).cast("string"))
    name = F.col(lang).cast("string")
    usable = labelled.where(F.col(lang).isNotNull() & has_letter(body))
    counted = usable.groupBy(name.alias("lang")).agg(
        F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64(body)).alias("texts")
    )
    found = counted.orderBy(F.desc("n"), "lang").collect()
    ordered = [r.lang for r in found]
    rare = {r.lang: min(1.0, 4 * SAMPLE_DOCS / r.texts) for r in found}
    limits = {k: int(-(2.0**63) + share * (2.0**64 - 2048)) for k, share in rare.items() if share < 1}
    limit = F.lit(2**63 - 1)
    for one, most in limits.items():
        limit = F.when(name == one, F.lit(most)).otherwise(limit)
    middle = F.greatest(F.lit(1), ((F.length(body) - SAMPLE_CHARS) / 2).cast("int"))
    few = usable.where(F.xxhash64(body) <= limit).groupBy(name.alias("lang"), F.xxhash64(body).alias("order")).agg(
        F.min(F.substring(body, middle, F.lit(SAMPLE_CHARS))).alias("part")
    )
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    sample = few.withColumn("nth", nth).where(F.col("nth") <= SAMPLE_DOCS).drop("nth")
    size = min(DICTIONARY_BYTES, TOTAL_BYTES // max(len(ordered), 1))
    joined = (
        sample.groupBy("lang")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("order", "part"))), lambda p: p["part"]), " ").alias("all"))
        .select("lang", F.right("all", F.lit(size)).alias("content"))
    )
    contents = {r.lang: plain(r.content).encode()[-size:] for r in joined.collect()}
    return {name: contents[name] for name in ordered}


def plain(text: str) -> str:
    """Lower-case words of letters alone, with a blank on each side."""
    return f" {' '.join(LETTERS.findall(text.lower()))} "


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def pieces(data: bytes) -> list[bytes]:
    """The text in pieces of PIECE_BYTES of about equal length, cut after blanks where there are any."""
    parts = -(-len(data) // PIECE_BYTES)
    cuts = [0]
    for i in range(1, parts):
        at = i * len(data) // parts
        blank = data.rfind(b" ", cuts[-1], at)
        cuts.append(blank + 1 if blank > cuts[-1] else at)
    return [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True)]


@functools.lru_cache(maxsize=2)
def compressors(packed: bytes) -> tuple[list[str], list[zstandard.ZstdCompressor]]:
    """Languages in order and their compressors, built once per worker process."""
    contents = pickle.loads(packed)
    tools = []
    for content in contents.values():
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=raw))
    return list(contents), tools


def predict(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    text: str = "text",
    keep: list[str] | tuple[str, ...] = ("doc_id",),
    margin: float = MARGIN,
    fields: tuple[str, str, str] = ("lang_pred", "score", "accepted"),
) -> DataFrame:
    """The kept columns with `lang_pred`, `score` and `accepted` for each whole text.

    `score` is the lead of the best language, 1 - best size / second size, from 0
    (a tie, which the language first in order wins) to 1; 1 where there is one only.
    Not accepted are leads below `margin` and texts without a letter, null and
    empty ones among them, whose language is `und` and whose score is 0; without
    any dictionary so are all.  Repeated rows stay repeated.
    """
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(dictionaries))

    def run(texts: pa.Array) -> list:
        names, tools = compressors(packed.value)
        best, score = [], np.zeros(len(texts))
        for i, value in enumerate(texts.to_pylist()):
            if not names or not any(map(str.isalpha, value)):
                best.append(UNKNOWN)
                continue
            parts = [FILLER + part for part in pieces(plain(value).encode())]
            sizes = [sum(len(tool.compress(part)) for part in parts) for tool in tools]
            least = min(sizes)
            best.append(names[sizes.index(least)])
            rest = sorted(sizes)[1:]
            score[i] = 1 - least / rest[0] if rest else 1.0
        known = np.array([b != UNKNOWN for b in best], bool)
        return [pa.array(best, pa.string()), score, known & (score >= margin)]

    lang, points, sure = fields
    return W.map_texts(docs, run, f"{lang} string, {points} double, {sure} boolean", list(keep), text)


def held_out(id: str, parts: int, part: int) -> Column:
    """Rows whose crc32 of the id as text leaves `part` when divided by `parts`."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % parts == part


def keep_known(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """The documents whose language is accepted, all columns as they are."""
    fields = tuple(W.fresh(n, docs.columns) for n in ("_lang", "_score", "_accepted"))
    known = predict(docs, dictionaries, text, docs.columns, margin, fields)
    return known.where(fields[2]).select(*docs.columns)
