import pytest

LONG = "Alpha beta gamma delta, epsilon zeta eta theta iota. " * 6000


@pytest.fixture
def edges(frame):
    """Nulls, empty and very long texts, ties, repeated rows, and columns called like results."""
    rows = [
        (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "a"),
        (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \n\t ", "de", "b"),
        (5, LONG, "en", "b"),
        (6, "!!! ??? 123", None, "c"),
        (None, "Etwas ganz anderes ohne Nummer steht hier in der Zeile.", "de", "c"),
        (7, "éè \U0001f600 x\u0000y", "fr", "d"),
    ]
    clashing = "text_ string, n_words long, score double, found string, content string, tokens string, id long"
    return frame(
        [(*r, "x", 5, 0.5, "f", "c", "t", 9) for r in rows],
        f"doc_id long, text string, lang string, source string, {clashing}",
    )


@pytest.fixture
def none(edges):
    """The same columns without a row."""
    return edges.limit(0)
