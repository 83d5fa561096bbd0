import re
from collections import Counter

from leadpipe.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measurements_are_those_counted_by_hand(frame):
    texts = [
        None,
        "",
        " \n\t",
        "one",
        "a b c d e a b c d e",
        "a a a a a a",
        "x y z\nx y z\n\n \nx y z ",
        "# * $ é é | <b>",
        "a b c d e f. a b c d e f. " * 50,
    ]
    book = quality.ledger(frame(list(enumerate(texts)), "doc_id long, text string"))
    columns = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    found = {r.doc_id: tuple(r[c] for c in columns) for r in book.collect()}
    assert found == {i: by_hand(t) for i, t in enumerate(texts)}


def test_edges(edges, none):
    rows = quality.ledger(edges).collect()
    assert len(rows) == 9
    assert {r.failed & quality.bit("few_words") for r in rows if r.n_words == 0} == {1}
    assert quality.ledger(none).count() == 0


def test_policies_and_ablations_agree_with_counting(frame, spark):
    rules = quality.POLICIES["v2"]
    failed = [0, 1, 2, 3, 8, 8, 10, 0, 18]
    book = frame([(i, f) for i, f in enumerate(failed)], "doc_id long, failed long")
    assert book.where(quality.passes("v2")).count() == 2
    assert book.where(quality.passes("base")).count() == 4
    found = {r.rule: (r.fail, r["only"], r.kept_without) for r in quality.ablations(book, "v2").collect()}
    mask = quality.mask("v2")
    for rule in rules:
        bit = quality.bit(rule)
        assert found[rule] == (
            sum(bool(f & bit) for f in failed),
            sum(f & mask == bit for f in failed),
            sum(f & mask & ~bit == 0 for f in failed),
        )
