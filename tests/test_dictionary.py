"""The index against a plain search of all entries in order."""

import random

import pytest
from pyspark.sql import functions as F

from leadpipe.operators import dictionary as d
from leadpipe.operators import scoring as s
from workload.data import SHEETS, dims


def search(text, entries, strip):
    """Every entry in order, each found one leaving the text."""
    found = []
    for entry in entries:
        if entry in text:
            found.append(entry)
            text = text.replace(entry, "")
            text = text.strip(" ") if strip else text
    return found, text


def index_of(frame, sheets):
    rows = [(name, e, i) for name, entries in sheets.items() for i, e in enumerate(entries)]
    return d.Index(frame(rows, "sheet string, entry string, nth int"))


def searched(frame, texts, sheets, searches):
    index = index_of(frame, sheets)
    rows = index.consumed(index.held(frame(texts, "text string"), list(sheets)), searches).collect()
    assert len(rows) == len(texts)
    return {r.text: {n: ([i.entry for i in r[f"{n}_search"].found], r[f"{n}_search"].rest) for n in sheets} for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_random_dictionaries(frame, seed):
    """Few letters, so that what leaves often brings others together; entries of one to five characters."""
    draw = random.Random(seed)
    letters = ["ab ", "abc é\U0001f600", "ab"][seed]

    def word(n):
        return "".join(draw.choices(letters, k=n))

    sheets = {n: list(dict.fromkeys(word(draw.randint(1 if n == "x" else 2, 5)) for _ in range(30))) for n in ("x", "y")}
    for entries in sheets.values():
        draw.shuffle(entries)
    texts = sorted({word(draw.randint(0, 25)) for _ in range(400)})
    found = searched(frame, texts, sheets, {"x": True, "y": False})
    born = 0
    for text in texts:
        for name, strip in (("x", True), ("y", False)):
            expected = search(text, sheets[name], strip)
            assert found[text][name] == expected, (text, sheets[name])
            born += any(e not in text for e in expected[0])
    assert born > 20


def test_entries_that_come_together_twice(frame):
    sheets = {"x": ["cd", "bxe", "afg", "zz"]}
    found = searched(frame, ["abxcdefg", "bxcde", "cd", "none"], sheets, {"x": True})
    assert found["abxcdefg"]["x"] == (["cd", "bxe", "afg"], "")
    assert found["none"]["x"] == ([], "none")


def test_an_entry_is_filed_under_its_rarest_gram(frame):
    index = index_of(frame, {"x": ["vice president", "vice chair", "president", "vp"]})
    filed = {r.item.entry: bytes(r.gram).decode() for r in index.table.collect()}
    assert filed["vp"] == "vp" and index.lengths == [2, 3]
    assert filed["vice chair"] not in "vice president"
    assert all(gram in entry for entry, gram in filed.items())


def test_texts_take_no_part_in_the_look_up(frame):
    index = index_of(frame, {"x": ["abc"]})
    texts = frame(["xabcx"], "text string")
    asked = d.grams(texts.select("text", F.xxhash64("text").alias("id_")), "text", index.lengths)
    plan = index._candidates(asked, ["x"])._jdf.queryExecution().optimizedPlan().toString()
    aggregate = plan.split("Join")[0]
    assert "text" not in aggregate


def test_a_sheet_of_all_part_names(spark, frame):
    """Far more entries than a row could be searched for one by one."""
    names = [r.p_name for r in spark.read.parquet("/root/testdata/sf0.01/part.parquet").collect()]
    entries = list(dict.fromkeys(names))
    rows = [(i, e, level, i) for i, e in enumerate(entries) for level in ("individual contributer", "manager")]
    sheets = dims(spark) | {"title_matrix": frame(rows, "pos int, title string, level string, points int")}
    titles = [f"Senior {e.upper()} and {f}" for e, f in zip(names[:300], names[7:], strict=False)] + names[:50]
    found = s.find_targets(frame([t.lower() for t in titles], "title string"), s.prepare_sheets(sheets), "title")
    assert found.count() == len(titles)
    for r in found.collect():
        assert ([e.entry for e in r.targets.found], r.targets.rest) == search(r.title, entries, False)


def test_rows_get_results_by_their_distinct_titles(spark, frame):
    sheets = s.prepare_sheets(dims(spark, SHEETS))
    rows = frame([("senior ring", 1)] * 50 + [(None, 2), ("", 3)], "title string, id int")
    scored = s.score_title(rows, sheets, "title")
    assert scored.columns == ["title", "id", "score"] and scored.count() == 52
    assert {(r.title, r.score and r.score.points) for r in scored.collect()} == {
        ("senior ring", 78),
        (None, None),
        ("", 50),
    }
