"""Fuzzy ratios as an Arrow UDF - the one place Spark has no expression for.

Scores are whole percents of matching characters, by the published rules of
token-sort, token-set and weighted ratios; letters beyond ASCII count as letters.  A candidate list lives in
one cell, so a row is scored where it is and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BEST = "struct<link:string,score:int>"


def prepare(text: str) -> str:
    """Lower case, anything but letters, digits and `_` a blank, ends trimmed."""
    return re.sub(r"\W", " ", text).lower().strip()


def ratio(a: str, b: str) -> int:
    if not a or not b:
        return 0
    return round(100 * SequenceMatcher(None, a, b).ratio())


def partial_ratio(a: str, b: str) -> int:
    """Best ratio of the shorter text with an equally long part of the longer one."""
    if not a or not b:
        return 0
    short, long = sorted((a, b), key=len)
    best = 0.0
    for block in SequenceMatcher(None, short, long).get_matching_blocks():
        start = max(0, block.b - block.a)
        part = SequenceMatcher(None, short, long[start : start + len(short)]).ratio()
        if part > 0.995:
            return 100
        best = max(best, part)
    return round(100 * best)


def token_sort_ratio(a: str, b: str, compare=ratio) -> int:
    a, b = (" ".join(sorted(prepare(x).split())) for x in (a, b))
    return compare(a, b)


def token_set_ratio(a: str, b: str, compare=ratio) -> int:
    left, right = set(prepare(a).split()), set(prepare(b).split())
    if not left or not right:
        return 0
    shared = " ".join(sorted(left & right))
    first = f"{shared} {' '.join(sorted(left - right))}".strip()
    second = f"{shared} {' '.join(sorted(right - left))}".strip()
    return max(compare(shared, first), compare(shared, second), compare(first, second))


def weighted_ratio(a: str, b: str) -> int:
    """Best of the ratios, the looser ones counting less."""
    a, b = prepare(a), prepare(b)
    if not a or not b:
        return 0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    if lengths < 1.5:
        scores = [ratio(a, b), 0.95 * token_sort_ratio(a, b), 0.95 * token_set_ratio(a, b)]
    else:
        scale = 0.6 if lengths > 8 else 0.9
        scores = [
            ratio(a, b),
            scale * partial_ratio(a, b),
            scale * 0.95 * token_sort_ratio(a, b, partial_ratio),
            scale * 0.95 * token_set_ratio(a, b, partial_ratio),
        ]
    return round(max(scores))


MODES = {
    "token_sort_ratio": token_sort_ratio,
    "token_set_ratio": token_set_ratio,
    "extractOne": weighted_ratio,
}


def best_of(name: str, links, compare) -> tuple[str | None, int | None]:
    """First link with the highest score; nothing to compare gives nothing."""
    best: tuple[str | None, int | None] = (None, None)
    for link in links:
        if link is None:
            continue
        score = compare(link, name)
        if best[1] is None or score > best[1]:
            best = (link, score)
    return best


def best_candidate(name: Column, links: Column, mode: str = "token_set_ratio") -> Column:
    """struct(link, score) of the best candidate link for a compact name."""
    compare = MODES[mode]

    @F.pandas_udf(BEST)
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        once = lru_cache(maxsize=100_000)(compare)  # for all batches of a task
        for names, lists in batches:
            rows = [
                (None, None) if n is None or ls is None else best_of(n, ls, once)
                for n, ls in zip(names, lists, strict=True)
            ]
            yield pd.DataFrame(rows, columns=["link", "score"]).astype({"score": "Int32"})

    return score(name, links)
