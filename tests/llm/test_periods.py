import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from leadpipe.llm import periods


def by_hand(words):
    """All runs of a list by comparing it with itself moved by each period."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(6, 4 * q):
                found.setdefault((start, end + q), q)  # the smallest period comes first
            start = max(end, start) + 1
    runs = [(s, e - s, q) for (s, e), q in found.items()]
    # A longer stretch of a multiple of a smaller period is the same stretch, so starts and ends tell.
    return sorted(runs, key=lambda r: (r[0], r[2]))


def changed(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def row_by_hand(doc_id, text):
    words = changed(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = by_hand(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        len(runs),
        *(best or (None, None, None)),
        best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
    )


def values(row):
    return (row.n_runs, row.start, row.length, row.period, row.exponent_milli, row.runs_sha256, row.collapsed_sha256)


def of_lists(texts):
    """The runs that the operator finds in lists of small numbers."""
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    words = np.concatenate([np.append(np.array(t, np.uint64), np.uint64(10**6 + i)) for i, t in enumerate(texts)])
    found = [[] for _ in texts]
    for start, end, period in periods.runs(words, first).tolist():
        if end - start >= 6:
            i = int(np.searchsorted(first, start, "right")) - 1
            found[i].append((start - int(first[i]), end - start, period))
    return found


def test_all_short_sequences():
    texts = [list(t) for n in range(12) for t in itertools.product((0, 1), repeat=n)]
    assert of_lists(texts) == [by_hand(t) for t in texts]


def periodic(draw, depth):
    """Repetitions of repetitions, now and then disturbed."""
    if depth == 0:
        return [draw.randrange(3) for _ in range(draw.randrange(1, 8))]
    part = periodic(draw, depth - 1)
    times = draw.randrange(1, 9)
    made = part * times + part[: draw.randrange(len(part) + 1)]
    if draw.random() < 0.4:
        made[draw.randrange(len(made))] = draw.randrange(4)
    return made + periodic(draw, depth - 1) if draw.random() < 0.5 else made


@pytest.mark.parametrize("seed", range(6))
def test_nested_repetitions(seed):
    draw = random.Random(seed)
    texts = [periodic(draw, draw.randrange(1, 4))[:900] for _ in range(60)]
    expected = [by_hand(t) for t in texts]
    assert sum(map(len, expected)) > 50
    assert of_lists(texts) == expected


def test_known_sequences():
    fibonacci, morse = [0], [0]
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    fibonacci = b
    while len(morse) < 1024:
        morse += [1 - x for x in morse]
    texts = [fibonacci, morse, [0] * 3000, [0, 1] * 700, [], [5], list(range(50)) * 9]
    assert of_lists(texts) == [by_hand(t) for t in texts]


def test_positions_depend_on_what_follows_alone():
    draw = random.Random(1)
    words = np.array([draw.randrange(4) for _ in range(4000)], np.uint64)
    stretch, t = periods.W.mix(words), 1
    for _ in range(4):
        chosen = set(periods.synchronising(stretch, None, t).tolist())
        by_context = {}
        for i in range(len(words) - 2 * t):
            by_context.setdefault(tuple(words[i : i + 2 * t].tolist()), set()).add(i in chosen)
        assert all(len(told) == 1 for told in by_context.values())
        # And one is chosen among any t places.
        assert all(chosen.intersection(range(i, i + t)) for i in range(len(words) - 3 * t))
        stretch = periods.W.mix(stretch * np.uint64(5) + periods.W.mix(periods._ahead(stretch, t, np.uint64(0)) ^ np.uint64(t)))
        t *= 2


def test_edges(edges, none):
    source = edges.withColumnsRenamed({"n_words": "runs", "content": "collapsed"})
    found = periods.find(source, tails=periods.tail_code("doc_id"))
    assert found.columns.count("runs") == 1
    rows = {r.doc_id: values(r) for r in periods.digests(found).collect()}
    texts = {r.doc_id: r.text for r in edges.collect()}
    assert {i: row_by_hand(i, t) for i, t in texts.items() if i != 5} == {i: r for i, r in rows.items() if i != 5}
    assert rows[5][0] == 1 and rows[5][3] == 9
    assert found.count() == 9 and periods.digests(periods.find(none)).count() == 0


def test_a_changed_text_and_its_parts(frame):
    text = "a b  c\td\n" * 5 + "x y z"
    docs = frame([(i, text) for i in range(40)], "doc_id long, text string")
    rows = periods.digests(periods.find(docs, tails=periods.tail_code("doc_id"))).collect()
    assert {r.doc_id: values(r) for r in rows} == {i: row_by_hand(i, text) for i in range(40)}
    plain = periods.find(docs.limit(1)).first()
    assert plain.runs[0].asDict() == {"start": 0, "length": 20, "period": 4}
    assert plain.collapsed == "a b c d x y z" and plain.n_words == 23
