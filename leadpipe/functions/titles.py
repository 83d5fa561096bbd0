"""Title cleaning and the title-scoring rule as native column expressions.

The entries a title holds arrive as array columns in lookup order.  An entry
carries its own points, so a match needs no second lookup.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on (spelling as in the scoring sheets).
DEFAULT_LEVEL = "individual contributer"
BASE_POINTS = 50
JUNK_TITLES = ["none", "mrs", "mr", "other", "intern", "unknown", "no longer with"]
JUNK_PHRASE = "no longer with"
TOKEN_DELIMITERS = r"[,./& -]"
MIN_TOKEN = r"^[a-z]{2,}$"

LEVELS = "array<struct<entry:string,level:string,rank:int,points:int>>"
TARGETS = "array<struct<entry:string,points:map<string,int>>>"
KEYWORDS = "array<struct<entry:string,points:int>>"
SCORE = "struct<title_level:string,new_title:string,points:int>"


def squash_title(title: Column) -> Column:
    """Lower case, every run outside [A-Za-z0-9] one blank, ends kept."""
    return F.lower(F.regexp_replace(title, r"[\W_]+", " "))


def title_tokens(title: Column) -> Column:
    """Alphabetic tokens of two or more letters."""
    return filter_tokens(F.split(squash_title(F.lower(title)), TOKEN_DELIMITERS))


def filter_tokens(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t.rlike(MIN_TOKEN))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def typed(items: Column, kind: str) -> Column:
    """Dictionary items as entries of LEVELS, TARGETS or KEYWORDS."""
    made = {
        LEVELS: lambda i: F.struct(i["entry"], i["level"], i["rank"], i["points"]),
        TARGETS: lambda i: F.struct(i["entry"], F.map_from_entries(i["by_level"])),
        KEYWORDS: lambda i: F.struct(i["entry"], i["points"]),
    }[kind]
    return F.transform(items, made).cast(kind)


def equal_entries(text: Column, entries: Column) -> Column:
    """The entries equal to a text: none or one."""
    return F.filter(entries, lambda e: e["entry"] == text)


def found_keywords(text: Column, held: Column, searched: Column) -> Column:
    """Keywords of a text in order of discovery, from those it holds and those a search found.

    A text with `and` anywhere is cut there: a piece that is a keyword counts
    whole, otherwise those of its words that are keywords.  Any other text is
    searched for the keywords, longest first.
    """

    def of_piece(piece: Column) -> Column:
        words = F.split(piece, " ")
        return let(
            equal_entries(piece, held),
            lambda whole: F.when(F.size(whole) > 0, whole).otherwise(
                F.flatten(F.transform(words, lambda w: equal_entries(w, held)))
            ),
        )

    pieces = F.transform(F.split(text, "and"), lambda p: F.trim(p))
    return F.when(F.contains(text, F.lit("and")), F.flatten(F.transform(pieces, of_piece))).otherwise(searched)


def entry_names(found: Column) -> Column:
    return F.transform(found, lambda e: e["entry"])


def canonical_levels(found: Column) -> Column:
    """Distinct canonical names of the found levels."""
    return F.array_distinct(F.transform(found, lambda e: e["level"]))


def best_level(found: Column) -> Column:
    """Best-ranked level as struct(rank, level, points); unranked ones do not count."""
    ranked = F.filter(found, lambda e: e["rank"].isNotNull())
    return F.array_min(
        F.transform(
            ranked,
            lambda e: F.struct(
                e["rank"].alias("rank"), e["level"].alias("level"), e["points"].alias("points")
            ),
        )
    )


def best_target(found: Column, level: Column) -> Column:
    """Target with the most points at a level as struct(points, pos, entry); first wins."""
    return F.array_max(
        F.transform(
            found,
            lambda e, i: F.struct(
                F.try_element_at(e["points"], level).alias("points"),
                (-i).alias("pos"),
                e["entry"].alias("entry"),
            ),
        )
    )


def keyword_total(found: Column) -> Column:
    """Base points plus those of every found keyword, repeats included."""
    return F.aggregate(found, F.lit(BASE_POINTS), lambda acc, e: acc + e["points"])


def score(title: Column, exact: Column, level: Column, target: Column, keywords: Column) -> Column:
    """Score of a cleaned title: struct(title_level, new_title, points).

    `exact` is the target the title equals, `target` the best one found at the
    best `level` found, `keywords` are those of a title without any; each may be null.
    """
    default = F.lit(DEFAULT_LEVEL)

    def of(at: Column, name: Column, points: Column) -> Column:
        return F.struct(
            at.alias("title_level"), name.alias("new_title"), points.cast("int").alias("points")
        ).cast(SCORE)

    own = F.when(level.isNull(), F.lit(0)).otherwise(level["points"])
    name = F.when(F.size(keywords) > 0, F.array_join(entry_names(keywords), " "))
    return (
        F.when(exact.isNotNull(), of(default, title, F.try_element_at(exact["points"], default)))
        .when(target.isNotNull(), of(F.coalesce(level["level"], default), target["entry"], target["points"]))
        .otherwise(of(level["level"], name, keyword_total(keywords) + own))
    )
