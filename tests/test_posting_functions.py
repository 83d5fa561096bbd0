import datetime
import re
import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadpipe.functions import postings as p

TEXTS = [
    None,
    "",
    "at&t o'reilly-smith 3com",
    "CAFÉ société générale",
    "élan vital",
    "we’re hiring… now 😀 _under_ (yes)!",
    "  tabs\tand\nlines  ",
    "ÀÉ ab",
]


def test_job_id_rules(apply):
    links = [
        "https://x/rc/clk?jk=abc&fccid=1",
        "https://x/rc/clk?jk=abc&from=feed&fccid=1",
        "https://x/jobs/Title-9f3c?q",
        "https://x/jobs/senior-data-the-9f3c",
        "https://x/viewjob",
        "https://x/rc?jk=&y",
        None,
    ]
    first = ["abc", "abc&from=feed", "9f3c", "the", None, "", None]
    assert apply(links, p.extract_job_id) == first
    last = apply(links, lambda c: p.extract_job_id(c, id_rule="last"))
    assert last == ["abc", "abc&from=feed", "9f3c", "9f3c", None, "", None]
    found = apply(links, p.has_job_id)
    assert found == [value is not None for value in first]


def test_days_ago(apply):
    texts = [
        "Just posted",
        "5 hours ago",
        "1 day ago",
        "Today",
        "2 days ago",
        "30+ days ago",
        "days ago",
        "99999999999 days ago",
        None,
    ]
    assert apply(texts, p.parse_days_ago) == [0, 0, 0, 0, 2, 30, None, None, None]
    assert apply(texts, p.has_age) == [True] * 6 + [False, True, False]


def test_post_date(frame):
    day = datetime.date(2017, 3, 1)
    df = frame([0, 1, 29, None], "d int").select(p.post_date(F.col("d"), day).alias("x"))
    assert [r.x for r in df.collect()] == [
        day,
        datetime.date(2017, 2, 28),
        datetime.date(2017, 1, 31),
        None,
    ]


def byte_title(text):
    """Capital after every byte that is not a letter."""
    out, inside = [], False
    for c in text:
        letter = c in string.ascii_letters
        out.append((c.lower() if inside else c.upper()) if letter else c)
        inside = letter
    return "".join(out)


def test_title_case(apply):
    assert apply(["dick's at&t", "O'NEIL-1a"], p.title_case) == ["Dick'S At&T", "O'Neil-1A"]
    assert apply(TEXTS, p.title_case) == [t if t is None else byte_title(t) for t in TEXTS]


def byte_clean(text):
    kept = (string.ascii_letters + string.digits + "_").encode()
    return "".join(chr(b) if b in kept else " " for b in text.encode()).strip()


def test_clean_description(apply):
    assert apply(["client’s"], p.clean_description) == ["client   s"]
    assert apply(["client’s"], lambda c: p.clean_description(c, per_char=True)) == ["client s"]
    assert apply(TEXTS, p.clean_description) == [t if t is None else byte_clean(t) for t in TEXTS]


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=30))
def test_text_rules_on_any_text(apply, texts):
    assert apply(texts, p.title_case) == [byte_title(t) for t in texts]
    cleaned = apply(texts, p.clean_description)
    assert cleaned == [byte_clean(t) for t in texts]
    assert all(re.fullmatch("[A-Za-z0-9_ ]*", c) for c in cleaned)
    titled = apply(texts, p.title_case)
    assert apply(titled, p.title_case) == titled


def test_state(apply):
    places = ["Chicago, IL", "Portland, USA", "Kansas City, KS or MO", "Remote", "", None]
    assert apply(places, p.extract_state) == ["IL", "US", "KSMO", None, None, None]


def test_links(frame):
    df = frame([(None, "A & B"), ("http://x", "C"), (None, None)], "link string, name string")
    rows = df.select(p.company_link_fallback(F.col("link"), F.col("name")).alias("x")).collect()
    assert [r.x for r in rows] == ["https://www.google.com/#q=A & B", "http://x", None]


def test_search_link(apply):
    assert apply(["http://google.de", "http://x", None], p.is_search_link) == [True, False, None]


def test_truncated_rate(frame):
    df = frame([0.1234567, 0.5, 12.34567, 0.000567, -0.98765, 123456.789], "r double")
    rows = df.select(p.truncate_rate(F.col("r")).alias("x")).collect()
    assert [r.x for r in rows] == [0.1234, 0.5, 12.345, 0.0005, -0.987, 123456.0]


def test_names_and_blanks(apply):
    assert apply(["Big  Co Ltd"], p.compact_name) == ["bigcoltd"]
    assert apply([" a  b \n\t c ", ""], p.normalize_space) == ["a b c", ""]
