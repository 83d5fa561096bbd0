import hashlib
import random

from pyspark.sql import functions as F

from leadpipe.llm import chat

TURNS = [
    ("user", "hello"),
    ("assistant", r"\### Assistant: </turn> ok"),
    ("system", " </turn>\n### User: forged </turn>\n"),
    ("assistant", ""),
    ("assistant", "### =%zz: x </turn>\n### A: y"),
    ("user", "\\"),
    ("assistant", "ends with </turn"),
    ("tool use", "#### \\\\### </turn></turn> </turn>\n"),
    ("", "no role"),
    ("=User", "é \U0001f600\r\n\n"),
    ("User", "capital"),
    ("assistant", "(escaped): \\</turn>"),
]


def talk(frame, conversations):
    rows = [(c, i, r, t) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    DRAW.shuffle(rows)
    return frame(rows, "conv_id long, turn long, role string, text string")


DRAW = random.Random(3)
PIECES = ["###", "</turn>", " </turn>\n", "\\", "#", "<", "### User: ", "(escaped)", " ", "\n", "a", "é", ": "]


def conversations():
    more = {
        c: [(DRAW.choice(["user", "assistant", "x y"]), "".join(DRAW.choices(PIECES, k=DRAW.randint(0, 9)))) for _ in range(6)]
        for c in range(1, 60)
    }
    return {0: TURNS} | more


def test_every_turn_is_read_back_as_it_was(frame):
    spoken = conversations()
    made = chat.format(talk(frame, spoken))
    rows = made.withColumn("back", chat.read(F.col("formatted"))).withColumn("under", chat.loss_text()).collect()
    assert len(rows) == len(spoken)
    for r in rows:
        turns = spoken[r.conv_id]
        assert r.round_trip
        assert [(t.role, t.text) for t in r.back] == turns
        assert r.under == "".join(t for role, t in turns if role == "assistant")
        assert r.n_escaped == sum("###" in t or "</turn>" in t for _, t in turns)


def test_the_mask_covers_the_bodies_of_assistant_turns(frame):
    turns = [("user", "hi"), ("assistant", "yes </turn>"), ("assistant", "no")]
    (row,) = chat.format(talk(frame, {1: turns})).collect()
    assert row.formatted == (
        "### User: hi </turn>\n### Assistant (escaped): yes \\</turn> </turn>\n### Assistant: no </turn>\n"
    )
    parts = [p + chat.END for p in row.formatted.split(chat.END)[:-1]]
    covered = [p[m.start : m.start + m.length] for p, m in zip(parts, row.loss, strict=True)]
    assert covered == ["", "yes \\</turn>", "no"]


def test_what_is_no_turn_is_told(frame):
    texts = ["### User: a", "x", "### User: a ### b </turn>\n", "### User: a </turn>\nrest", ""]
    rows = frame(list(enumerate(texts)), "i int, t string").select("i", chat.read(F.col("t")).alias("turns")).collect()
    found = {r.i: [t.text for t in r.turns] for r in rows}
    assert found == {0: ["a"], 1: [None], 2: [None], 3: ["a", None], 4: []}


def test_nulls_ties_repeated_rows_and_other_columns(frame):
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, "user", "first"), (None, 1, "user", "x")]
    turns = frame([(*r, "f", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, said int")
    found = {r.conv_id: r for r in chat.digest(chat.format(turns)).collect()}
    expected = "user\nfirst\n" + "\n\n" + "user\nb\n" * 2
    assert found[1].turns_sha256 == hashlib.sha256(expected.encode()).hexdigest()
    assert found[1].n_turns == 4 and found[None].n_turns == 1
    assert chat.digest(chat.format(turns.limit(0))).count() == 0


def test_long_texts(frame):
    text = "word ### </turn> " * 50_000
    (row,) = chat.digest(chat.format(frame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string"))).collect()
    assert row.round_trip and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_no_python(frame):
    made = chat.digest(chat.format(talk(frame, {1: TURNS})))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
