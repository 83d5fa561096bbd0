import random

import numpy as np
import pyarrow as pa

from leadpipe.llm import spans

DRAW = random.Random(5)


def sentence(n=9):
    return " ".join("".join(DRAW.choices("abcdefghij", k=5)) for _ in range(n)).capitalize() + "."


PASSAGE = " ".join(sentence() for _ in range(7))


def cleaned(frame, texts, ids=None):
    ids = ids or range(1, len(texts) + 1)
    rows = spans.remove(frame(list(zip(ids, texts, strict=True)), "doc_id long, text string")).collect()
    return {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in rows}


def test_a_repeated_passage_stays_in_the_first_document_only(frame):
    own = [" ".join(sentence() for _ in range(4)) for _ in range(4)]
    texts = [own[0], f"{own[1]} {PASSAGE} {sentence()}", f"{PASSAGE}\n{own[2]}", f"{own[3]}\n\n{PASSAGE}"]
    found = cleaned(frame, texts)
    assert [found[i][0] for i in (1, 2)] == texts[:2]
    assert found[3][0] == own[2]
    assert found[4][0] == own[3] + "\n\n"


def test_a_passage_inside_sentences_goes_but_for_its_ends(frame):
    words = PASSAGE.split()
    inner = " ".join(words[4:-3])
    texts = [f"{sentence()} {inner} {sentence()}", f"one two three {inner} four five six. {sentence()}"]
    found = cleaned(frame, texts)
    assert found[1][0] == texts[0]
    left = found[2][0].split()
    assert len([w for w in left if w in words]) < 20
    assert left[:3] == ["one", "two", "three"]


def test_a_long_sentence_is_found_wherever_it_starts(frame):
    passage = " ".join("".join(DRAW.choices("abcdefghij", k=5)) for _ in range(80))
    texts = [f"a b c d e f g {passage} h i j k.", f"x {passage} y z. {sentence()}"]
    found = cleaned(frame, texts)
    assert found[1][2] == 0
    assert len([w for w in found[2][0].split() if w in set(passage.split())]) < 30


def test_repeats_within_a_document(frame):
    found = cleaned(frame, [f"{PASSAGE} {sentence()} {PASSAGE}"])
    assert found[1][0].count(PASSAGE.split(".")[0]) == 1


def test_short_repeats_stay(frame):
    line = "All rights reserved. By us. 2020."
    texts = [f"{line} {sentence()} {line}", f"{sentence()}\n{line}"]
    assert [t for t, _, n in cleaned(frame, texts).values() if n == 0] == texts


def test_the_smallest_id_is_first_and_equal_ids_are_one(frame):
    found = cleaned(frame, [PASSAGE, PASSAGE], [7, -3])
    assert (found[-3][0], found[7][0]) == (PASSAGE, "")
    rows = spans.remove(frame([(1, PASSAGE), (1, PASSAGE)], "doc_id long, text string")).collect()
    assert [r.text for r in rows] == [PASSAGE] * 2


def test_rows_without_an_id_touch_nothing(frame):
    rows = spans.remove(frame([(None, PASSAGE), (2, PASSAGE), (None, PASSAGE)], "doc_id long, text string")).collect()
    assert [r.text for r in rows] == [PASSAGE] * 3


def test_edges(edges, none):
    rows = spans.remove(edges).collect()
    assert len(rows) == 9
    assert {r.doc_id: r.text for r in rows if r.doc_id in (2, 3)} == {2: None, 3: ""}
    (long,) = [r for r in rows if r.doc_id == 5]
    assert long.n_removed > 0.99 * long.n_sentences  # it says the same over and over
    assert spans.remove(none).count() == 0


def test_runs_are_the_shortest_from_and_up_to_each_sentence():
    texts = [" ".join(sentence(DRAW.randint(1, 10)) for _ in range(12)) for _ in range(5)] + ["", "One."]
    found = spans.Sentences(pa.array(texts))
    lengths = [len(found.data[a:b].tobytes().split()) for a, b in zip(found.start, found.stop, strict=True)]
    expected = set()
    for t in range(len(texts)):
        own = range(found.first[t], found.first[t + 1])
        good = [(i, j) for i in own for j in own if j - i + 1 >= spans.RUN_SENTENCES and sum(lengths[i : j + 1]) >= spans.RUN_WORDS]
        for i in own:
            expected |= set(sorted((p for p in good if p[0] == i), key=lambda p: p[1])[:1])
            expected |= set(sorted((p for p in good if p[1] == i), key=lambda p: -p[0])[:1])
    assert set(zip(found.run_from, found.run_to, strict=True)) == expected


def test_hashes_do_not_depend_on_the_place():
    alone, later = (spans.Sentences(pa.array([t])) for t in (PASSAGE, f"{sentence()} {PASSAGE}"))
    assert set(alone.run_hash) <= set(later.run_hash)


def kept_by_hand(texts):
    """Texts without the sentences of runs met before, from all runs of all sentences."""
    parts = []
    for t in texts:
        if not t.strip():
            parts.append(([], [], t))
            continue
        found = spans.Sentences(pa.array([t]))
        raw = found.data.tobytes()
        own = [raw[a:b].decode() for a, b in zip(found.start, found.stop, strict=True)]
        parts.append((own, list(zip(found.run_from.tolist(), found.run_to.tolist(), strict=True)), raw[: found.start[0]].decode()))
    seen, out = {}, []
    for i, (own, runs, _) in enumerate(parts):
        for a, b in runs:
            seen.setdefault("".join("".join(own[a : b + 1]).split()), (i, a))
    for i, (own, runs, lead) in enumerate(parts):
        gone = set()
        for a, b in runs:
            if seen["".join("".join(own[a : b + 1]).split())] != (i, a):
                gone.update(range(a, b + 1))
        out.append(lead + "".join(s for k, s in enumerate(own) if k not in gone))
    return out


HAN = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏"


def han(n=12, stop="。"):
    return "".join(DRAW.choices(HAN, k=n)) + stop


def test_whole_results_against_all_runs(frame):
    pool = [sentence(DRAW.randint(2, 14)) for _ in range(25)] + [han(DRAW.randint(3, 20)) for _ in range(15)]
    texts = []
    for _ in range(60):
        a = DRAW.randrange(30)
        texts.append("".join(s + DRAW.choice(["", " ", "\n"]) if s[-1] == "。" else s + " " for s in pool[a : a + DRAW.randrange(12)]))
    found = cleaned(frame, texts)
    assert [found[i][0] for i in range(1, 61)] == kept_by_hand(texts)


def test_sentences_of_other_scripts_end(frame):
    for text, count in (
        ("他说：“你好。”然后走了！真的？「是。」好", 5),
        ("Is it … so? “Yes.” He went.", 4),
        ("यह एक वाक्य है। और एक।", 2),
        ("هل هذا صحيح؟ نعم۔", 2),
    ):
        found = spans.Sentences(pa.array([text]))
        assert np.diff(found.first).tolist() == [count], text
    passage = "".join(han() for _ in range(25))
    found = cleaned(frame, [passage, han() + passage + han(), "x"])
    assert found[1][2] == 0 and found[2][2] >= 25 and len(found[2][0]) < 40


def test_texts_of_plain_scripts_are_not_decoded(monkeypatch):
    """Where no script is without blanks, only the ends of words are looked at."""
    texts = pa.array(["Größe zählt (nicht.) Ça va bien! Ну да? " * 5, "one two (three.) four\nfive"])
    expected = [c.to_pylist() for c in spans._hashes(texts)]
    monkeypatch.setattr(spans.W, "characters", None)
    assert [c.to_pylist() for c in spans._hashes(texts)] == expected and expected[0][0]


def test_last_characters_of_words():
    alphabet = "ab.é\"”’」。😀"
    rng = np.random.default_rng(5)
    words = ["".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(1, 5))) for _ in range(300)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    start, code = spans._up_to(data, np.cumsum([len(w.encode()) for w in words]))
    assert code.tolist() == [ord(w[-1]) for w in words]
    assert start.tolist() == [len("".join(words[: i + 1])[:-1].encode()) for i in range(len(words))]
