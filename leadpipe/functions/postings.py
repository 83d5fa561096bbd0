"""Scalar expressions that turn raw posting fields into clean ones."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on.
SEARCH_PREFIX = "https://www.google.com/#q="
SEARCH_MARKER = "google"
AGE_MARKER = "days ago"
MAX_AGE_DAYS = 30
KEYED_ID = r"jk=([^\n]*)&"
DASHED_ID = r"-([a-z0-9]+)"

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(text, _UPPER, _LOWER)


def ascii_upper(text: Column) -> Column:
    return F.translate(text, _LOWER, _UPPER)


def extract_job_id(link: Column, id_rule: str = "second") -> Column:
    """Posting id from its link; NULL where the link holds none.

    `jk=` up to the last `&` wins.  Otherwise the dashed lower-case words
    count: a single one is the id, of several the second one is
    (`id_rule="last"` takes the last instead).
    """
    if id_rule not in ("second", "last"):
        raise ValueError(f"unknown id_rule {id_rule!r}")

    def pick(pattern: str) -> Column:
        # The last of the first two matches; each list is built only once.
        words = F.regexp_extract_all(link, F.lit(pattern), F.lit(1))
        candidates = words if id_rule == "last" else F.slice(words, 1, 2)
        return F.try_element_at(candidates, F.lit(-1))

    # Most links are told to have no key by a search for three bytes.
    keyed = F.when(F.contains(link, F.lit("jk=")), pick(KEYED_ID))
    return F.coalesce(keyed, pick(DASHED_ID))


def has_job_id(link: Column) -> Column:
    """Whether the link holds an id, without extracting it."""
    return F.coalesce(link.rlike(f"{KEYED_ID}|{DASHED_ID}"), F.lit(False))


def parse_days_ago(age_text: Column) -> Column:
    """First number of an `n days ago` text, 0 for any other text."""
    number = F.regexp_extract(age_text, "[0-9]+", 0).try_cast("int")
    return F.when(F.contains(age_text, F.lit(AGE_MARKER)), number).when(
        age_text.isNotNull(), F.lit(0)
    )


def has_age(age_text: Column) -> Column:
    """Whether an age can be told: not `days ago` without a number, not null."""
    named = F.contains(age_text, F.lit(AGE_MARKER))
    return F.coalesce(~named | age_text.rlike("[0-9]"), F.lit(False))


def post_date(days_ago: Column, as_of: datetime.date | Column) -> Column:
    """Posting date: the run date minus the age in days."""
    return F.date_sub(as_of if isinstance(as_of, Column) else F.lit(as_of), days_ago)


def title_case(text: Column) -> Column:
    """Capital after every character that is not a-z, small letters elsewhere.

    Differs from `initcap`, which looks at blanks only: `at&t` -> `At&T`.
    Case is ASCII case, as for byte strings.
    """
    runs = F.regexp_extract_all(ascii_lower(text), F.lit("([a-z]+|[^a-z]+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs,
            lambda run: F.concat(ascii_upper(F.left(run, F.lit(1))), F.substr(run, F.lit(2))),
        ),
        "",
    )


def clean_description(text: Column, per_char: bool = False) -> Column:
    """Every UTF-8 byte outside [A-Za-z0-9_] becomes one blank, ends trimmed.

    Reading the bytes as Latin-1 gives one character per byte, so a single
    replacement does it.  `per_char=True` writes one blank per character.
    """
    units = text if per_char else F.decode(text.cast("binary"), "ISO-8859-1")
    return F.trim(F.regexp_replace(units, r"\W", " "))


def extract_state(location: Column) -> Column:
    """All pairs of capitals in a location, joined; NULL if there is none."""
    pairs = F.regexp_extract_all(location, F.lit("([A-Z][A-Z])"), F.lit(1))
    return F.nullif(F.array_join(pairs, ""), F.lit(""))


def company_link_fallback(link: Column, account: Column) -> Column:
    """The link, or a search for the account name where the link is null."""
    return F.coalesce(link, F.concat(F.lit(SEARCH_PREFIX), account))


def is_search_link(link: Column) -> Column:
    return F.contains(link, F.lit(SEARCH_MARKER))


def truncate_rate(rate: Column) -> Column:
    """The number its first six characters spell (four decimals below 10)."""
    return F.substring(F.format_string("%.12f", rate), 1, 6).cast("double")


def compact_name(name: Column) -> Column:
    """Lower-case name without blanks, used for matching."""
    return ascii_lower(F.replace(name, F.lit(" "), F.lit("")))


# Everything Unicode text splitting treats as blank.
BLANKS = r"[\h\v\x1c-\x1f]+"


def normalize_space(text: Column) -> Column:
    """Runs of blanks become one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))
