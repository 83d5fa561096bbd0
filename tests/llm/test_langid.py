import random
import zlib

from pyspark.sql import functions as F

from leadpipe.llm import langid

WORDS = {
    "en": "the of and house water people with from this that would their river green".split(),
    "de": "der die und haus wasser leute mit von diese dass würde ihre fluss grün".split(),
    "fr": "le la et maison eau gens avec de ceci que voudrait leur rivière vert".split(),
}


def corpus(n, seed=1):
    draw = random.Random(seed)
    return [
        (i, " ".join(draw.choices(WORDS[lang], k=draw.randint(8, 40))).capitalize(), lang)
        for i, lang in enumerate(draw.choices(list(WORDS), [5, 3, 2], k=n))
    ]


def test_held_out_texts_are_told(frame):
    rows = corpus(300)
    docs = frame(rows, "doc_id long, text string, lang string")
    out = langid.held_out("doc_id", 4, 2)
    learned = langid.learn(docs.where(~out))
    assert list(learned) == ["en", "de", "fr"]
    found = langid.predict(docs.where(out), learned).join(docs, "doc_id").collect()
    assert {r.doc_id for r in found} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)


def test_the_end_of_a_text_counts(frame):
    docs = frame(corpus(200), "doc_id long, text string, lang string")
    learned = langid.learn(docs)
    text = "the house " * 3 + " ".join(random.Random(3).choices(WORDS["de"], k=400))
    (row,) = langid.predict(frame([(1, text)], "doc_id long, text string"), learned).collect()
    assert row.lang_pred == "de" and row.accepted


def test_the_lead_does_not_shrink_with_the_length(frame):
    draw = random.Random(5)
    own = {lang: ["".join(draw.choices("abcdefghijklmnop", k=7)) for _ in range(3000)] for lang in ("x", "y")}
    rows = [(i, " ".join(draw.choices(own[lang], k=60)), lang) for i, lang in enumerate(["x", "y"] * 200)]
    learned = langid.learn(frame(rows, "doc_id long, text string, lang string"))
    long = " ".join(draw.choices(own["x"], k=500_000))
    docs = frame([(1, long[:60_000]), (2, long)], "doc_id long, text string")
    short, whole = sorted(langid.predict(docs, learned).collect())
    assert (short.lang_pred, whole.lang_pred) == ("x", "x") and whole.accepted
    assert whole.score > 0.8 * short.score


def test_pieces_are_the_whole_text():
    for data in (b" a ", b"word " * 60_000, b"x" * 200_000):
        parts = langid.pieces(data)
        assert b"".join(parts) == data and all(parts)
        assert len(parts) == -(-len(data) // langid.PIECE_BYTES)


def test_ties_nulls_and_texts_without_letters(frame, edges, none):
    learned = langid.learn(frame(corpus(100), "doc_id long, text string, lang string"))
    rows = langid.predict(edges, learned).collect()
    assert len(rows) == 9
    unknown = {r.doc_id for r in rows if r.lang_pred == langid.UNKNOWN}
    assert unknown == {2, 3, 4, 6}
    assert not any(r.accepted or r.score for r in rows if r.doc_id in unknown)
    assert langid.predict(none, learned).count() == 0
    (tie,) = langid.predict(frame([(1, "q")], "doc_id long, text string"), learned).collect()
    assert (tie.lang_pred, tie.score, tie.accepted) == ("en", 0.0, False)
    same = {"x": learned["en"], "y": learned["en"]}
    (tie,) = langid.predict(frame([(1, "the house")], "doc_id long, text string"), same).collect()
    assert (tie.lang_pred, tie.accepted) == ("x", False)


def test_without_labels_nothing_is_accepted(edges):
    learned = langid.learn(edges.where("lang = 'xx'"))
    assert learned == {}
    assert langid.predict(edges, learned).where("accepted").count() == 0


def test_the_sample_is_bounded_and_distinct(frame, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 10)
    rows = corpus(500) + [(1000 + i, "the same text all over again", "en") for i in range(300)]
    learned = langid.learn(frame(rows, "doc_id long, text string, lang string"))
    assert set(learned) == set(WORDS)
    assert all(v.count(b"same text") <= 1 for v in learned.values())
    assert all(len(v) < 10 * 300 for v in learned.values())


def test_keep_known_keeps_rows_and_columns(frame, edges):
    learned = langid.learn(frame(corpus(100), "doc_id long, text string, lang string"))
    docs = edges.withColumn("text", F.when(F.col("doc_id") == 1, "The water of the river").otherwise(F.col("text")))
    kept = langid.keep_known(docs, learned)
    assert kept.columns == edges.columns
    assert kept.where(F.col("doc_id") == 1).count() == 2
    assert kept.where(F.col("doc_id").isin(2, 3, 4, 6)).isEmpty()
