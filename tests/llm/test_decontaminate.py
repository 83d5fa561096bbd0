import itertools
import random

import pytest
from pyspark.sql import functions as F

from test_words import words_by_hand

from leadpipe.llm import decontaminate

DRAW = random.Random(11)
VOCABULARY = ["".join(DRAW.choices("abcdefghijklmnop", k=6)) for _ in range(3000)]


def words(n):
    return DRAW.choices(VOCABULARY, k=n)


ITEM = words(40)


def found(frame, texts, items=None, **more):
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    bench = frame(items or [(1, " ".join(ITEM))], "item_id long, text string")
    rows = decontaminate.overlaps(docs, bench, **more).collect()
    return {(r.doc_id, r.item_id): (r.start, r.length, r.equal, r.item_tokens) for r in rows}


def test_exact_and_partial_passages(frame):
    around = [words(30) for _ in range(4)]
    texts = [
        " ".join(around[0] + ITEM + around[1]),
        " ".join(around[2]),
        " ".join(around[3] + ITEM[10:28]),
        "! ".join(w.upper() for w in ITEM),
        " ".join(ITEM[:10] + around[1]),
    ]
    hits = found(frame, texts)
    assert set(hits) == {(0, 1), (2, 1), (3, 1)}
    assert hits[0, 1] == (30, 40, 40, 40)
    assert hits[2, 1] == (30, 18, 18, 40)


def substituted(every, shift=0):
    return [words(1)[0] + "x" if i % every == shift else w for i, w in enumerate(ITEM)]


def test_substitutions_are_tolerated_down_to_the_similarity(frame):
    before, after = words(12), words(12)
    texts = [" ".join(before + substituted(k, 1) + after) for k in (20, 10, 7, 5, 3, 2)]
    hits = found(frame, texts)
    assert {d for d, _ in hits} == {0, 1, 2, 3}
    for start, length, equal, _ in hits.values():
        assert equal >= 0.8 * length and length >= 13


def test_against_brute_force(frame):
    items = [(i, " ".join(words(DRAW.randint(14, 60)))) for i in range(12)]
    texts, planted = [], set()
    for d in range(80):
        body = words(DRAW.randint(0, 120))
        if d % 3 == 0:
            item, text = DRAW.choice(items)
            part = [w if DRAW.random() > 0.06 else "zz" for w in text.split()]
            at = DRAW.randint(0, len(body))
            body[at:at] = part
            same = sum(a == b for a, b in zip(part, text.split(), strict=True))
            if same >= 0.8 * len(part):
                planted.add((d, item))
        texts.append(" ".join(body))
    assert set(found(frame, texts, items)) == planted


def test_any_stretch_that_is_long_enough_counts(frame):
    item = words(20)
    one = [w if i != 3 else "zz" for i, w in enumerate(item[:16])]
    three = [w if i not in (3, 7, 11) else "zz" for i, w in enumerate(item)]
    items = [(1, " ".join(item[:16])), (2, " ".join(item))]
    hits = found(frame, [" ".join(words(9) + one + words(9)), " ".join(words(9) + three + words(9))], items)
    assert {(0, 1), (0, 2), (1, 1), (1, 2)} == set(hits)
    assert all(length >= 13 and equal >= 0.8 * length for _, length, equal, _ in hits.values())


def test_stretches_against_brute_force(frame):
    rows = [
        (i, DRAW.randint(8, 13), [DRAW.random() > 0.2 for _ in range(DRAW.randint(0, 30))]) for i in range(600)
    ]
    stretch = decontaminate.long_stretch(F.col("equal"), "least", 0.8)
    for r in frame(rows, "id long, least int, equal array<boolean>").withColumn("s", stretch).collect():
        n = len(r.equal)
        good = any(
            5 * sum(r.equal[a:b]) >= 4 * (b - a) for a in range(n) for b in range(a + r.least, n + 1)
        )
        start, length, same = r.s
        assert good == (length >= r.least)
        assert same == sum(r.equal[start : start + length]) and 5 * same >= 4 * length


def least_masks(n):
    return next(masks for least, masks in sorted(decontaminate.MASKS.items(), reverse=True) if n >= least)


@pytest.mark.parametrize("n", range(1, 26))
def test_all_placements_of_substitutions_are_hit(n):
    """Whole items up to 12 tokens, any part of 13 to 25 of a longer one, one token in five substituted."""
    masks = [(int(m, 2), len(m)) for m in least_masks(n)]
    for places in itertools.combinations(range(n), n // 5):
        equal = (1 << n) - 1 - sum(1 << i for i in places)
        assert any((equal >> s) & mask == mask for mask, span in masks for s in range(n - span + 1)), places


def test_short_items_count_whole(frame):
    items = [
        (1, "one two three four five six seven eight nine ten"),
        (2, "too short"),
        (3, "the capital of france is paris"),
        (4, "zero"),
        (5, "日本の首都は東京です"),
    ]
    texts = [
        "zero one two three four five six seven eight nine ten eleven",
        "It is too short.",
        "We know: The capital of France is Paris! And the capital of spain is paris.",
        "the capital of spain is madrid too",
        "それで日本の首都は東京です、と言った",
        "too long, short too",
    ]
    assert set(found(frame, texts, items)) == {(0, 1), (0, 4), (1, 2), (2, 3), (4, 5)}


def test_against_all_diagonals(frame):
    """Short items with one token in five substituted, in words of several scripts."""
    pool = VOCABULARY[:300] + ["हिन्दी", "été", "слово"]
    items = [(i, " ".join(DRAW.choices(pool, k=DRAW.randint(5, 24)))) for i in range(25)]
    texts = []
    for _ in range(120):
        own = DRAW.choice(items)[1].split()
        for i in DRAW.sample(range(len(own)), DRAW.randint(0, len(own) // 4 + 1)):
            own[i] = "zz"
        texts.append("“" + " ".join(words(5) + own) + "” — " + " ".join(words(4)))
    expected = set()
    for d, text in enumerate(texts):
        a = words_by_hand(text)
        for item, other in items:
            b = words_by_hand(other)
            least = min(13, len(b))
            for diagonal in range(-len(b), len(a)):
                same = [0 <= diagonal + i < len(a) and a[diagonal + i] == w for i, w in enumerate(b)]
                if any(5 * sum(same[i:j]) >= 4 * (j - i) for i in range(len(b)) for j in range(i + least, len(b) + 1)):
                    expected.add((d, item))
    assert len(expected) > 60
    assert set(found(frame, texts, items)) == expected


def test_copies_and_the_join_without_broadcast(frame, monkeypatch):
    text = " ".join(words(5) + ITEM)
    expected = {(i, 1): (5, 40, 40, 40) for i in range(30)}
    assert found(frame, [text] * 30) == expected
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_ROWS", 0)
    assert found(frame, [text] * 30) == expected


def test_edges(edges, none, frame):
    bench = frame(
        [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, None), (None, ""), (1, "x")],
        "item_id long, text string",
    )
    hits = decontaminate.overlaps(edges, bench).collect()
    assert {(r.doc_id, r.item_id) for r in hits} == {(1, 1), (7, 1)}
    assert decontaminate.overlaps(none, bench).count() == 0
    assert decontaminate.overlaps(edges, bench.limit(0)).count() == 0
    kept = decontaminate.clean(edges, bench)
    assert kept.columns == edges.columns
    assert kept.count() == 6 and kept.where("doc_id IN (1, 7)").isEmpty()
    assert decontaminate.clean(none, bench).count() == 0


def test_no_python_and_no_second_evaluation(frame):
    docs = frame([(1, " ".join(ITEM))], "doc_id long, text string")
    seeded = decontaminate._seeded(docs.select("doc_id", decontaminate.tokens("text").alias("tokens")), "doc_id", "at", ("1011",))
    plan = seeded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1
    assert "Python" not in plan and "Arrow" not in plan
