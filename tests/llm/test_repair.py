import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from leadpipe.llm import repair

GRAMMAR = re.compile("(s?(ua)+)?")


def damage_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        names = [" " if x is None else str(x) for x in (conv, turn)]
        chance = zlib.crc32(":".join(names).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if chance == 0:
            continue
        if chance == 1:
            text = ""
        if chance == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if chance == 4 else role, text)] * (2 if chance == 3 else 1)
    return out


def best_by_hand(rows):
    """Cheapest edits of (role, kind of fault) rows, by trying all that cost no more than the best."""
    n = len(rows)
    heap, done = [(0, "", 0, "")], {}
    while heap:
        cost, edits, at, state = heapq.heappop(heap)
        # Of a place and a state of the grammar, the first one popped is the cheapest and least.
        if (at, state) in done:
            continue
        done[at, state] = cost
        if at == n and state in ("", "a"):
            return cost, edits
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for initial in follow:
            if initial in "ua":
                heapq.heappush(heap, (cost + 3, edits + "I", at, initial))
        if at < n:
            role, fault = rows[at]
            heapq.heappush(heap, (cost + 4, edits + "D", at + 1, state))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                for initial in follow:
                    if role[:1] == initial:
                        heapq.heappush(heap, (cost + more, edits + "K", at + 1, initial))
                    if initial in "ua":
                        heapq.heappush(heap, (cost + 3 + more, edits + "R", at + 1, initial))
    raise AssertionError


def by_hand(rows):
    """The results for one conversation's rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        if not body:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append(None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = {r[1] for r in rows if r[1] is not None}
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    cost, audit = best_by_hand([(r[2], f) for r, f in zip(rows, faults, strict=True)])
    kept, emitted = iter(rows), []
    for edit in audit:
        row = None if edit == "I" else next(kept)
        if edit != "D":
            emitted.append((edit, row))
    out = []
    for left, (edit, row) in zip(range(len(emitted), 0, -1), emitted, strict=True):
        role = row[2] if edit == "K" else "assistant" if left % 2 else "user"
        out.append((role, row[3] if row else ""))
    assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in out))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in repair.FAULTS),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    ), out


def values(row):
    return (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit, row.repaired_sha256)


def test_cheapest_of_all_short_kinds():
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    told = {k: (names[k], None) for k in names} | {k.upper(): (names[k], "truncated") for k in names}
    told["x"] = ("user", "blank")
    for n in range(4):
        for kinds in itertools.product(told, repeat=n):
            assert repair.cheapest("".join(kinds)) == best_by_hand([told[k] for k in kinds]), kinds
    draw = random.Random(2)
    for _ in range(300):
        kinds = "".join(draw.choice("suauauaoxSUAO") for _ in range(draw.randrange(4, 40)))
        assert repair.cheapest(kinds) == best_by_hand([told[k] for k in kinds]), kinds


@pytest.mark.parametrize("seed", range(5))
def test_auction_finds_shortest_paths(seed):
    draw = random.Random(seed)
    n = 30
    graph = {i: [(draw.randrange(1, 9), "", draw.randrange(n)) for _ in range(3)] + [(20, "", n)] for i in range(n)}
    price, settled = dict.fromkeys(range(n + 1), 0), {n}
    for origin in range(n):
        repair.auction(graph, price, settled, origin)
    lengths = dict.fromkeys(range(n), 10**6) | {n: 0}
    for _ in range(n):
        for i, ways in graph.items():
            lengths[i] = min(lengths[i], *(c + lengths[j] for c, _, j in ways))
    assert price == lengths
    # Prices are duals: no arc allows less, and some arc of each node is tight.
    assert all(min(c + price[j] for c, _, j in ways) == price[i] for i, ways in graph.items())


def test_long_conversations_take_a_step_per_row():
    cost, audit = repair.cheapest("ua" * 100_000 + "x" * 50_000 + "uA" * 50_000)
    assert (cost, len(audit)) == (4 * 50_000 + 3 * 50_000, 350_000)
    assert repair._layer.cache_info().currsize < 2000


ROWS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "user", "Hello?"),
    (1, 2, "assistant", "Yes."),
    (1, 2, "assistant", "Yes."),
    (1, 5, "user", " \t\n"),
    (1, 6, "user", "Bye"),
    (2, None, "user", "No turn."),
    (2, None, None, None),
    (2, 3, "tool", "é! \x0b"),
    (2, 3, "User", "Capital."),
    (3, 0, "assistant", "Alone…"),
    (4, 7, "user", ""),
    (None, 1, "user", "Nobody's."),
    (None, 1, "assistant", "Right."),
    (None, 0, "", "Empty role."),
    (5, 0, "sage", "Kept for its initial."),
    (5, 1, "user", "a: b\nc."),
]


def compare(turns, plans, rows, convs):
    found = {r.conv_id: values(r) for r in repair.digests(turns, plans).collect()}
    talks = {c: [r for r in rows if r[0] == c] for c in convs}
    expected = {c: by_hand([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in talks[c]]) for c in talks}
    assert found == {c: e[0] for c, e in expected.items()}
    out = {}
    for r in sorted(repair.repaired(turns, plans).collect(), key=lambda r: r.nth):
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    assert out == {c: e[1] for c, e in expected.items() if e[1]}


def test_rows_against_plain_loops(frame):
    turns = frame([(*r, 7, "x") for r in ROWS], "conv_id long, turn long, role string, text string, cost long, audit string")
    others = frame([(1,), (9,)], "conv_id long")
    compare(turns, repair.plan(turns, others), ROWS, {r[0] for r in ROWS} | {9})
    none = turns.limit(0)
    assert repair.plan(none).count() == 0 and repair.repaired(none, repair.plan(none)).count() == 0
    assert [values(r)[:7] for r in repair.digests(none, repair.plan(none, others)).collect()] == [(0,) * 6 + ("",)] * 2


@pytest.mark.parametrize("seed", range(2))
def test_random_damage(frame, seed):
    draw = random.Random(seed)
    texts = ["One.", "Two!", "Three?", "Four", "", " ", "Five. \n", None]
    rows = [
        (draw.randrange(60), draw.choice([*range(9), None]), draw.choice(["user", "assistant", "system", "tool", None]), draw.choice(texts))
        for _ in range(500)
    ]
    turns = frame(rows, "conv_id long, turn long, role string, text string")
    bad = repair.damaged(turns)
    assert sorted(map(tuple, bad.collect()), key=str) == sorted(damage_by_hand(rows), key=str)
    compare(bad, repair.saved(repair.plan(bad, turns)), damage_by_hand(rows), {r[0] for r in rows})
