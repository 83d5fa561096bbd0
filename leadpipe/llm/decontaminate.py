"""Benchmark passages in documents, found by spaced seeds and native functions alone.

A seed is a mask over consecutive tokens that looks at some positions and
ignores the others, so a hit survives substituted words at the ignored ones.
Equal seed hashes of a benchmark item and a document put the two on a diagonal;
there their tokens are compared one by one.  Any stretch that is long enough and
of enough equal tokens decides; the one with the highest score is reported, if
it is such a stretch.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpipe.llm import words as W
from leadpipe.operators.relational import same_key
from leadpipe.session import scratch_path

# Ones are the positions a seed compares, by the least tokens of an item.  An item of that many up to
# the next number has the seeds of these masks; whatever one token in five of it is substituted, one of
# them hits, and so in any 13 to 25 tokens of a longer item.  A longer overlap has such a part.
MASKS = {
    13: ("110111", "11111"),
    10: ("10111", "1111"),
    8: ("1111",),
    5: ("111", "1011"),
    4: ("1111",),
    3: ("111",),
    2: ("11",),
    1: ("1",),
}
# An overlap has at least so many tokens, or the whole item, and so many of them equal.
MIN_TOKENS = 13
SIMILARITY = 0.8
# In the best stretch an equal token counts 1 and a substituted one takes as much away.
PENALTY = 3
# Rows of at most about 50 bytes each.
MAX_BROADCAST_ROWS = 1_000_000


# A letter of a script without blanks, with its marks, is a token.
UNSPACED = "([" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in W.UNSPACED) + r"&&\p{L}]\p{M}*)"


def tokens(text: str | Column) -> Column:
    """Hashes of the runs of letters, marks and digits, in lower case, and of single letters in scripts
    without blanks; none for a null text."""
    text = F.lower(F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit("")))
    spaced = F.when(text.rlike(r"[\x{e00}-\x{3ffff}]"), F.regexp_replace(text, UNSPACED, " $1 ")).otherwise(text)
    parts = F.split(spaced, r"[^\p{L}\p{M}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(tokens: str, masks: Sequence[str]) -> Column:
    """Seed hashes at all places under the first mask, then under the next, and so on; null where a
    mask reaches over the end."""
    held = F.col(tokens)
    places = F.when(F.size(held) > 0, F.sequence(F.lit(0), F.size(held) - 1)).otherwise(F.array().cast("array<int>"))

    def under(mask: str) -> Column:
        looked = [i for i, bit in enumerate(mask) if bit == "1"]
        hashed = lambda p: F.xxhash64(F.lit(mask), *[F.get(held, p + i) for i in looked])
        return F.transform(places, lambda p: F.when(p <= F.size(held) - len(mask), hashed(p)))

    return F.concat(*[under(mask) for mask in masks])


def _seeded(rows: DataFrame, key: str, place: str, masks: Sequence[str]) -> DataFrame:
    """One row per seed: the key, the place of the seed in the tokens, and its hash.

    A text without seeds gives one row with a null hash, which meets nothing: an
    inner generator would put a filter with a copy of the whole expression below
    itself, and the tokens would be computed anew for each place.
    """
    hashed = rows.select(key, F.size("tokens").alias("places"), seeds("tokens", masks).alias("seeds"))
    return hashed.select(key, "places", F.posexplode_outer("seeds").alias("nth", "seed")).select(
        key, (F.col("nth") % F.col("places")).alias(place), "seed"
    )


def _item_seeds(items: DataFrame) -> tuple[DataFrame, list[str]]:
    """The seeds of the items under the masks for their size, and all masks in use."""
    size, below, parts = F.size("tokens"), 1 << 31, []
    counted = items.agg(*[F.count_if(F.size("tokens") >= least).alias(str(least)) for least in MASKS]).first()
    masks, before = [], 0
    for least, own in MASKS.items():
        if counted[str(least)] > before:
            masks += [m for m in own if m not in masks]
            parts.append(_seeded(items.where((size >= least) & (size < below)), "item", "item_at", own))
        below, before = least, counted[str(least)]
    none = items.limit(0).select("item", F.lit(0).alias("item_at"), F.lit(0).cast("long").alias("seed"))
    return functools.reduce(DataFrame.union, parts, none), masks


def _small(df: DataFrame) -> DataFrame:
    """The rows, to be broadcast if they are few; else the join shuffles them."""
    return F.broadcast(df) if df.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else df


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def best_stretch(equal: Column) -> Column:
    """Start, length and equal tokens of the stretch with the highest score."""
    zero = F.lit(0)
    start = F.struct(
        *[zero.alias(n) for n in ("at", "run", "run_start", "run_equal", "best", "start", "length", "equal")]
    )

    def step(s: Column, same: Column) -> Column:
        gain = F.when(same, 1).otherwise(-PENALTY)
        anew = s["run"] <= 0
        run = F.when(anew, gain).otherwise(s["run"] + gain)
        run_start = F.when(anew, s["at"]).otherwise(s["run_start"])
        run_equal = F.when(anew, 0).otherwise(s["run_equal"]) + F.when(same, 1).otherwise(0)
        better = run > s["best"]
        pick = lambda new, old: F.when(better, new).otherwise(s[old]).alias(old)
        return F.struct(
            (s["at"] + 1).alias("at"),
            run.alias("run"),
            run_start.alias("run_start"),
            run_equal.alias("run_equal"),
            pick(run, "best"),
            pick(run_start, "start"),
            pick(s["at"] + 1 - run_start, "length"),
            pick(run_equal, "equal"),
        )

    return F.aggregate(equal, start, step, lambda s: F.struct(s["start"], s["length"], s["equal"]))


def long_stretch(equal: Column, least: str, similarity: float) -> Column:
    """Start, length and equal tokens of a stretch of at least `least` tokens, so many of them
    equal; of several ends the one with the most equal tokens.  Zeros if there is none.

    A sum has 1 - `similarity` for an equal token and -`similarity` for another.
    It is held against the least sum up to any place `least` or more tokens
    before, from where the stretch begins; `old` is the token by which those
    places go on.
    """
    delayed = F.slice(F.concat(F.array_repeat(F.lit(False), F.col(least)), equal), 1, F.size(equal))
    both = F.zip_with(equal, delayed, lambda new, old: F.struct(new.alias("new"), old.alias("old")))
    start = F.struct(
        *[F.lit(0).alias(n) for n in ("at", "same", "old_same", "low_at", "low_same", "start", "length", "equal")],
        *[F.lit(0.0).alias(n) for n in ("old_sum", "low")],
    )

    def step(s: Column, token: Column) -> Column:
        at = s["at"] + 1
        same = s["same"] + token["new"].cast("int")
        begin = at - F.col(least)
        old_same = s["old_same"] + F.when(begin > 0, token["old"].cast("int")).otherwise(0)
        old_sum = F.when(begin > 0, old_same - similarity * begin).otherwise(0.0)
        lower = old_sum < s["low"]
        low = F.least(old_sum, s["low"])
        low_at = F.when(lower, begin).otherwise(s["low_at"])
        low_same = F.when(lower, old_same).otherwise(s["low_same"])
        better = (begin >= 0) & (same - similarity * at - low >= -1e-9) & (same - low_same > s["equal"])
        pick = lambda new, old: F.when(better, new).otherwise(s[old]).alias(old)
        return F.struct(
            at.alias("at"),
            same.alias("same"),
            old_same.alias("old_same"),
            low_at.alias("low_at"),
            low_same.alias("low_same"),
            pick(low_at, "start"),
            pick(at - low_at, "length"),
            pick(same - low_same, "equal"),
            old_sum.alias("old_sum"),
            low.alias("low"),
        )

    return F.aggregate(both, start, step, lambda s: F.struct(s["start"], s["length"], s["equal"]))


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of document content and item on a diagonal where a seed agrees.

    `docs` has `content` and `tokens`, `items` `item` and `tokens`.  The
    diagonal is the place in the document less the place in the item.
    """
    seeded, masks = _item_seeds(items)
    wanted = _small(_saved(seeded.withColumnRenamed("seed", "item_seed").where("item_seed IS NOT NULL"), "seeds"))
    met = _seeded(docs, "content", "doc_at", masks or MASKS[MIN_TOKENS]).join(wanted, F.col("seed") == F.col("item_seed"))
    return met.select("content", "item", (F.col("doc_at") - F.col("item_at")).alias("diagonal")).distinct()


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    min_tokens: int = MIN_TOKENS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document and item that it holds: id, item, `start` and `length` of the best
    stretch in the document's tokens, `equal` tokens in it, and `item_tokens`.

    Documents of equal text are looked up as one, under a 64-bit hash of the
    text; a collision only adds pairs for the comparison to refuse.  Of several
    stretches the one with the most equal tokens is reported, then the first.
    Nulls and texts without tokens hold nothing, on either side; an item of fewer
    tokens than `min_tokens` has to be there whole, be it a single word.  Repeated rows of documents give repeated rows; items of the
    same id are one item with several texts.  Without documents or items there
    is no row.  Other columns are left out.
    """
    whole = docs.select(
        F.col(id).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("content"), tokens(text).alias("tokens")
    )
    parts = benchmark.select(
        F.struct(F.col(item).alias("id"), F.xxhash64(F.col(item_text).cast("string")).alias("text")).alias("item"),
        tokens(item_text).alias("tokens"),
    ).dropDuplicates(["item"])
    met = _saved(hits(whole.select("content", "tokens"), parts), "hits")
    places = _small(met.select(F.col("content").alias("found"), "item", "diagonal"))
    pairs = whole.join(places, same_key(F.col("content"), F.col("found"))).select("id", "item", "diagonal", "tokens")
    held = parts.select(F.col("item").alias("held"), F.col("tokens").alias("item_words"))
    held = _small(held)
    aligned = pairs.join(held, F.col("item") == F.col("held")).select(
        "id",
        "item",
        F.greatest("diagonal", F.lit(0)).alias("from"),
        F.size("item_words").alias("item_tokens"),
        F.slice("tokens", F.greatest("diagonal", F.lit(0)) + 1, F.size("item_words")).alias("x"),
        F.slice("item_words", F.greatest(-F.col("diagonal"), F.lit(0)) + 1, F.size("item_words")).alias("y"),
    )
    equal = F.zip_with("x", "y", lambda a, b: F.coalesce(a == b, F.lit(False)))
    aligned = aligned.withColumn("least", F.least(F.lit(min_tokens), F.col("item_tokens")))
    both = aligned.select(
        "id", "item", "item_tokens", "from", "least",
        best_stretch(equal).alias("best"), long_stretch(equal, "least", similarity).alias("long"),
    )
    enough = (F.col("best.length") >= F.col("least")) & (F.col("best.equal") >= similarity * F.col("best.length"))
    scored = both.withColumn("stretch", F.when(enough, F.col("best")).otherwise(F.col("long"))).select(
        "id", "item", "item_tokens", "least", (F.col("from") + F.col("stretch.start")).alias("start"), "stretch.length", "stretch.equal"
    )
    good = scored.where(
        (F.col("length") >= F.col("least"))
        & (F.col("equal") >= similarity * F.col("length"))
    )
    best = F.max_by(
        F.struct("start", "length", "equal", "item_tokens"), F.struct(F.col("equal"), -F.col("start"), -F.col("length"))
    )
    return (
        good.groupBy("id", F.col("item.id").alias("item"))
        .agg(best.alias("best"))
        .select(F.col("id").alias(id), F.col("item").alias(item), "best.*")
    )


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, all columns as they are.

    Rows without an id are never found to hold one.
    """
    held = W.fresh("_held", docs.columns)
    found = overlaps(docs, benchmark, id, text).select(F.col(id).alias(held)).distinct()
    return docs.join(_small(_saved(found, "held")), docs[id] == F.col(held), "left_anti")
