"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features count, they hold no text: densities of two lexicons learned from
labelled rows, how near their words are to the second person, capitals,
punctuation and obfuscated words.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadpipe.llm import words as W
from leadpipe.session import scratch_path

# Bounds of what is learned from: labelled rows, and words of both lexicons together.
SAMPLE_ROWS = 20_000
LEXICON_WORDS = 1_000
# A lexicon word is in so many toxic sample texts at least; its log odds tell the lexicon.
LEXICON_TEXTS = 5
STRONG, WEAK = 3.0, 1.5
# Of every so many sample rows one calibrates the lexicons and trees that the others made.
CALIBRATE_EVERY = 4
TREES = 30
DEPTH = 4
NEAR = 6

EDGE = "\"'()[]{}<>.,;:!?…«»“”‘’-_*#$%&|~`"
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)
UNMASK = str.maketrans("013457@$!", "oieastasi")
FEATURES = (
    "strong_density", "weak_density", "strong_count", "weak_count", "near_density", "near_count",
    "capital_rate", "shouted_rate", "exclamation_rate", "question_rate", "punctuation_rate",
    "obfuscated_rate", "masked_hits", "log_words",
)


def bare(word: str) -> str:
    return word.strip(EDGE).lower()


def unmasked(word: str) -> str:
    """The word a mixture of letters, digits and symbols may stand for."""
    return re.sub(r"[^\w]|_", "", word.lower().translate(UNMASK))


def features(text: str, strong: frozenset[str], weak: frozenset[str]) -> list[float]:
    """The values of FEATURES; all zero for a text without words."""
    shown = text.split()
    if not shown:
        return [0.0] * len(FEATURES)
    n = len(shown)
    strong_at, weak_at, person_at, mixed, masked, shouted = [], 0, [], 0, 0, 0
    for i, word in enumerate(shown):
        plain = bare(word)
        if plain in strong:
            strong_at.append(i)
        elif plain in weak:
            weak_at += 1
        elif plain and not plain.isalpha() and any(map(str.isalpha, plain)):
            mixed += 1
            if unmasked(plain) in strong:
                masked += 1
                strong_at.append(i)
        if plain in SECOND_PERSON:
            person_at.append(i)
        if len(plain) > 1 and word.isupper():
            shouted += 1
    near = 0
    if strong_at and person_at:
        after = np.searchsorted(person_at, strong_at)
        there = np.array([-(10**9), *person_at, 10**9])
        near = int((np.minimum(np.array(strong_at) - there[after], there[after + 1] - strong_at) <= NEAR).sum())
    letters = sum(map(str.isalpha, text)) or 1
    counts = {c: text.count(c) for c in "!?.,;:"}
    return [
        len(strong_at) / n,
        weak_at / n,
        math.log1p(len(strong_at)),
        math.log1p(weak_at),
        near / n,
        math.log1p(near),
        sum(map(str.isupper, text)) / letters,
        shouted / n,
        counts["!"] / n,
        counts["?"] / n,
        sum(counts.values()) / n,
        mixed / n,
        math.log1p(masked),
        math.log1p(n),
    ]


def featured(docs: DataFrame, lexicons: tuple[list[str], list[str]], keep: list[str], text: str, into: str) -> DataFrame:
    """The kept columns and the features of each whole text as an array."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(map(frozenset, lexicons)))

    def run(texts: pa.Array) -> list:
        return [pa.array([features(t, *sent.value) for t in texts.to_pylist()], pa.list_(pa.float64()))]

    return W.map_texts(docs, run, f"{into} array<double>", keep, text)


@dataclass
class Model:
    """Lexicons, trees and calibration; without trees `rate` is the score of every text."""

    lexicons: tuple[list[str], list[str]]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float


def sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, rows: int) -> DataFrame:
    """Text and label of at most `rows` labelled documents, those of the smallest id hashes.

    A threshold on the hash, set from the number of labels, leaves about four
    times as many ids, of which the smallest are taken, so no task sees more.
    """
    usable = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).select(
        F.col(id).alias("id"), F.col(label).cast("double").alias("label"), F.xxhash64(id).alias("order")
    )
    share = min(1.0, 4 * rows / max(usable.count(), 1))
    near = usable.where(F.col("order") <= int(-(2.0**63) + share * (2.0**64 - 2048)))
    chosen = near.orderBy("order", "id", "label").limit(rows)
    texts = docs.select(F.col(id).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # Two numbers and a hash for each of a bounded number of rows.
    return texts.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("id", "order", "label", "text")


def learn_lexicons(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Words that toxic texts of the sample hold far more often than others, strong and weak."""
    word = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")))
    counts = rows.select("label", word.alias("word")).where(F.length("word") > 1).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    totals = rows.select(F.sum("label"), F.sum(1 - F.col("label"))).first()
    toxic, clean = (float(t or 0) + 1 for t in totals)
    odds = F.log((F.col("toxic") + 0.5) / toxic) - F.log((F.col("clean") + 0.5) / clean)
    picked = (
        counts.where(F.col("toxic") >= LEXICON_TEXTS)
        .select("word", odds.alias("odds"))
        .where(F.col("odds") >= WEAK)
        .orderBy(F.desc("odds"), "word")
        .limit(LEXICON_WORDS)
        .collect()
    )
    return [r.word for r in picked if r.odds >= STRONG], [r.word for r in picked if r.odds < STRONG]


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from at most `rows` of the labelled documents given.

    Rows without id or label are left out.  Where the sample lacks one of the
    classes there is nothing to tell apart, and the model is the share of toxic
    rows, 0 without any row.  The same holds where the rows that grow the trees lack
    a class, or none is left to calibrate.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "labelled")
    sample(docs, labels, id, text, label, rows).write.parquet(path)
    held = spark.read.parquet(path)
    total, toxic = held.select(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    rate = toxic / total if total else 0.0
    if not 0 < rate < 1:
        return Model(([], []), None, None, rate)
    # Rows that calibrate teach no words either: their features are like those of unseen texts.
    parted = held.withColumn("calibrates", F.pmod(F.col("order"), F.lit(CALIBRATE_EVERY)) == 0)
    parts = {r.calibrates: (r.n, r.toxic) for r in parted.groupBy("calibrates").agg(
        F.count("*").alias("n"), F.sum("label").alias("toxic")).collect()}
    n, toxic = parts.get(False, (0, 0))
    if not 0 < toxic < n or True not in parts:
        return Model(([], []), None, None, rate)
    lexicons = learn_lexicons(parted.where("NOT calibrates"))
    path = scratch_path(spark, "featured")
    featured(parted.select("label", "calibrates", "text"), lexicons, ["label", "calibrates"], "text", "features").write.parquet(path)
    ready = spark.read.parquet(path).withColumn("features", array_to_vector("features"))
    grower = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=20, seed=7)
    trees = grower.fit(ready.where("NOT calibrates"))
    points = trees.transform(ready.where("calibrates")).select("label", _toxic().alias("points"))
    calibration = IsotonicRegression(featuresCol="points", predictionCol="score").fit(points)
    return Model(lexicons, trees, calibration, rate)


def _toxic() -> Column:
    return vector_to_array("probability")[1]


def score(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] | list[str] = ("doc_id",)
) -> DataFrame:
    """The kept columns with `score`, the calibrated probability of being toxic, and `predicted`,
    1 from 0.5 on.

    Every whole text is scored, a null one as an empty one; repeated rows stay
    repeated and an empty table gives an empty one; other columns are left out.
    """
    names = {c: f"kept_{i}" for i, c in enumerate(keep)}  # no clash with the model's columns
    rows = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(text).alias("text"))
    kept = [F.col(n).alias(c) for c, n in names.items()]
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(float(model.rate)))
    else:
        ready = featured(rows, model.lexicons, list(names.values()), "text", "features")
        ready = ready.withColumn("features", array_to_vector("features"))
        points = model.trees.transform(ready).select(*names.values(), _toxic().alias("points"))
        scored = model.calibration.transform(points)
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return scored.select(*kept, bounded.alias("score"), F.when(bounded >= 0.5, 1).otherwise(0).alias("predicted"))
