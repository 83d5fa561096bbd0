import random

import pytest
from pyspark.sql import functions as F

from leadpipe.llm import langid, toxicity

DRAW = random.Random(31)
CLEAN = "house river green water people bread table window garden music".split()
BAD = "dolt numbskull blockhead nincompoop".split()
DOCS = "doc_id long, text string"


def corpus(n=400):
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        said = DRAW.choices(CLEAN, k=DRAW.randint(5, 40))
        if toxic:
            for _ in range(DRAW.randint(1, 3)):
                said.insert(DRAW.randint(0, len(said)), f"you {DRAW.choice(BAD)}")
        docs.append((i, " ".join(said) + "."))
        if i % 10:
            labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus()
    docs = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = langid.held_out("doc_id", 5, 0)
    return toxicity.train(docs, labels.where(~out)), docs, labels


def test_held_out_rows_are_told(trained):
    model, docs, labels = trained
    assert set(BAD) <= set(model.lexicons[0])
    scored = toxicity.score(docs, model).join(labels, "doc_id").where(langid.held_out("doc_id", 5, 0)).collect()
    assert len(scored) > 40
    assert sum(r.predicted == r.toxic for r in scored) >= 0.97 * len(scored)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_the_end_of_a_long_text_and_obfuscation_count(trained, frame):
    model, _, _ = trained
    long = "house river " * 20_000
    texts = ["you d0lt, you numb$kull! you nincomp00p", long + " you dolt you blockhead" * 2000, long]
    rows = {r.doc_id: r.predicted for r in toxicity.score(frame(list(enumerate(texts)), DOCS), model).collect()}
    assert rows == {0: 1, 1: 1, 2: 0}


def test_edges(trained, edges, none):
    model, _, _ = trained
    rows = toxicity.score(edges, model, keep=["doc_id", "found"]).collect()
    assert len(rows) == 9 and all(r.predicted in (0, 1) for r in rows)
    empty = {r.score for r in rows if r.doc_id in (2, 3, 4)}
    assert len(empty) == 1
    assert toxicity.score(none, model).count() == 0


def test_one_class_or_none_gives_its_share(frame, edges):
    labels = frame([(1, 0), (5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    for some, rate in ((labels, 0.0), (labels.limit(0), 0.0), (labels.withColumn("toxic", F.lit(1)), 1.0)):
        model = toxicity.train(edges, some)
        assert model.trees is None
        assert {r.score for r in toxicity.score(edges, model).collect()} == {rate}


def test_rows_that_calibrate_teach_no_words(spark, frame):
    """A word of theirs alone is in no lexicon, however often toxic rows hold it."""
    docs, labels = corpus(200)
    orders = frame([(d,) for d, _ in docs], "doc_id long").select("doc_id", F.xxhash64("doc_id").alias("n")).collect()
    calibrates = {r.doc_id: r.n % toxicity.CALIBRATE_EVERY == 0 for r in orders}
    marked = [(d, f"{t} {'shown' if calibrates[d] else 'grown'}x" * (d % 4 == 0) or t) for d, t in docs]
    model = toxicity.train(frame(marked, DOCS), frame(labels, "doc_id long, quality int, toxic int"))
    words = {w for part in model.lexicons for w in part}
    assert "grownx" in words and "shownx" not in words


def test_a_part_of_one_class_gives_its_share(frame):
    """Two rows are too few to grow trees and to calibrate them."""
    docs = frame([(1, "you dolt"), (2, "green water")], DOCS)
    model = toxicity.train(docs, frame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert model.trees is None and model.rate == 0.5


def test_the_sample_is_bounded(trained):
    _, docs, labels = trained
    sample = toxicity.sample(docs, labels, "doc_id", "text", "toxic", 30)
    assert sample.count() == 30


def test_features():
    strong, weak = frozenset(["dolt"]), frozenset(["silly"])
    named = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, strong, weak), strict=True))
    f = named("You DOLT!! a silly a a a a a a dolt?")
    assert f["strong_density"] == 2 / 11 and f["weak_density"] == 1 / 11
    assert f["near_density"] == 1 / 11 and f["shouted_rate"] == 1 / 11
    assert f["exclamation_rate"] == 2 / 11 and f["question_rate"] == 1 / 11
    assert named("d0lt")["masked_hits"] > 0 and named("d0lt")["obfuscated_rate"] == 1
    assert set(named("").values()) == {0.0}
