import random
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from leadpipe.llm import neardup

DRAW = random.Random(23)
VOCABULARY = ["".join(DRAW.choices("abcdefghijklmnop", k=6)) for _ in range(3000)]


def words(n):
    return DRAW.choices(VOCABULARY, k=n)


def changed(text, n):
    out = list(text)
    for i in DRAW.sample(range(len(out)), n):
        out[i] = DRAW.choice(VOCABULARY)
    return out


def shingles(text):
    w = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def similarity(a, b):
    shared = (a & b).total()
    return shared / (a.total() + b.total() - shared)


def by_hand(docs):
    """Class ids from comparing every pair."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i, _ in docs}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and similarity(sets[i], sets[j]) >= neardup.SIMILARITY:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in root}


@pytest.fixture(scope="module")
def corpus():
    texts = []
    for _ in range(25):
        base = words(DRAW.choice([3, 8, 40, 150, 400]))
        texts.append(base)
        for _ in range(DRAW.randint(0, 4)):
            texts.append(changed(base, DRAW.choice([0, 0, 1, 2]) if len(base) >= 40 else 0))
    chain = words(200)
    for _ in range(6):  # neighbours are alike, the ends are not
        texts.append(chain)
        chain = changed(chain, 3)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def found(frame, docs):
    rows = neardup.classes(frame(docs, "doc_id long, text string")).collect()
    assert len(rows) == len(docs)
    return {r.doc_id: r.class_id for r in rows}


def test_classes_are_those_of_comparing_all_pairs(frame, corpus):
    assert found(frame, corpus) == by_hand(corpus)


def test_the_paths_without_broadcast_agree(frame, corpus, monkeypatch):
    monkeypatch.setattr(neardup, "MAX_BROADCAST_ROWS", 0)
    assert found(frame, corpus) == by_hand(corpus)


def test_a_large_group_and_its_pairs(frame, spark):
    base = words(60)
    docs = [(i, " ".join(base if i % 2 else changed(base, 1))) for i in range(300)]
    assert set(found(frame, docs).values()) == {0}
    plain = frame(docs, "id long, text string")
    with neardup.scratch_tables(spark) as save:
        signed = neardup._sign_all(plain, save)
        assert neardup.links(plain, signed, save, "id", "text").count() < 300 * 2 * neardup.BANDS


def test_only_stragglers_go_on(frame, spark):
    """However large a group, what goes on after the first pairs are the members outside its class."""
    template, strays = words(120), [words(18) for _ in range(6)]
    for n in (150, 300, 600):
        group = [changed(template, 1) for _ in range(n)]
        apart = [template[:102] + s for s in strays]
        docs = frame([(i, " ".join(t)) for i, t in enumerate(group + apart)], "id long, text string")
        with neardup.scratch_tables(spark) as save:
            signed = neardup._sign_all(docs, save)
            nodes = signed.selectExpr("content AS node", "id", "size", "explode(bands) AS band")
            met = nodes.join(nodes.groupBy("band").count().where("count > 1").withColumnRenamed("count", "n"), "band")
            sets = save(neardup.W.map_texts(docs, neardup._sets, "content binary, hashes array<long>", []), "sets")
            first = save(neardup._close(neardup._first_pairs(met, 0.8), sets, 0.8), "links")
            outsiders = neardup._outsiders(met, neardup.components(first, save))
            assert outsiders.count() <= 2 * len(strays)


def test_scratch_tables_go_but_for_what_the_rows_come_from(frame, corpus, tmp_path, monkeypatch):
    docs = frame(corpus[:40], "doc_id long, text string")
    monkeypatch.setattr(neardup, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    neardup.classes(docs)
    neardup.keep_one(docs)
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["classes", "contents", "dropped"]


def test_an_id_called_like_a_result(frame):
    rows = neardup.classes(frame([(1, "a b c"), (2, "A b, c")], "content long, text string"), id="content")
    assert rows.columns == ["content", "content_", "class_id", "n_links"]
    assert [r.class_id for r in rows.collect()] == [1, 1]


def test_pairs_inside_many_texts_on_one_template_are_found(frame):
    template = words(173)
    docs = []
    for i in range(180):
        own = words(30)
        docs.append((2 * i, " ".join(template + own)))
        if i % 3 == 0:
            docs.append((2 * i + 1, " ".join(template + own[:13] + words(17))))
    classes = by_hand(docs)
    assert len(set(classes.values())) == 180
    assert found(frame, docs) == classes


def test_the_same_without_broadcast(frame, monkeypatch):
    monkeypatch.setattr(neardup, "MAX_BROADCAST_ROWS", 0)
    test_pairs_inside_many_texts_on_one_template_are_found(frame)


def test_punctuation_and_case_make_copies(frame):
    docs = [(4, "One two, THREE four five six"), (2, "one two three four. five SIX!"), (3, "one two three four five")]
    assert found(frame, docs) == {4: 2, 2: 2, 3: 3}


def test_keep_one_keeps_the_smallest_id_of_each_class(frame, corpus):
    docs = [(i, t) for i, t in corpus] + [corpus[0]]
    kept = neardup.keep_one(frame([(i, t, "x") for i, t in docs], "doc_id long, text string, _content string"))
    assert kept.columns == ["doc_id", "text", "_content"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(by_hand(corpus).values()))


def test_edges(edges, none):
    rows = neardup.classes(edges).collect()
    assert len(rows) == 9
    assert {r.doc_id: r.class_id for r in rows} == {i: i for i in (1, 2, 3, 4, 5, 6, 7, None)}
    assert {r.content for r in rows if r.doc_id in (2, 3, 4)} == {None}
    kept = neardup.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert neardup.classes(none).count() == 0 and neardup.keep_one(none).count() == 0


def test_coordinates_agree_as_often_as_weighted_sets_are_alike():
    rng = np.random.default_rng(3)
    k = 4000
    elements = rng.integers(1, 2**63, 60, dtype=np.uint64)
    for _ in range(3):
        x, y = rng.uniform(0, 3, 60), rng.uniform(0, 3, 60)
        both = np.concatenate([elements, elements])
        drawn = neardup.signatures(both, np.concatenate([x, y]), np.array([0, 60, 120]), k, 12 * k)
        expected = np.minimum(x, y).sum() / np.maximum(x, y).sum()
        assert abs((drawn[0] == drawn[1]).mean() - expected) < 0.035


def test_signatures_do_not_depend_on_the_company_or_the_first_limit():
    rng = np.random.default_rng(4)
    elements, weights = rng.integers(1, 2**63, 30, dtype=np.uint64), rng.integers(1, 4, 30).astype(float)
    whole = neardup.signatures(elements, weights, np.array([0, 0, 10, 30]))
    alone = neardup.signatures(elements[10:], weights[10:], np.array([0, 20]), darts=20)
    assert (whole[2] == alone[0]).all()
    assert not whole[0].any() and whole[1].all()


def test_repeats_are_weights():
    values, first, _ = neardup.shingles(pa.array(["a b c d e f a b c d e f", "", "x"]))
    elements, weights, begin = neardup.weighted(values, first)
    assert list(np.diff(first)) == [8, 0, 1] and weights.sum() == 9
    assert sorted(weights[begin[0] : begin[1]]) == [1, 1, 1, 1, 2, 2]
