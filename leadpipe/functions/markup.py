"""HTML fields: links, text blocks and headings.

Pages stay string columns and are read whole.  A page is cut into tags and text,
and one fold over its block-level tags with a stack of open elements tells where
each element ends, end tags that are left out included.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadpipe.functions.postings import normalize_space

# Fixed values the results depend on.
LINK_PATTERN = r"(http.*|https.*.com|www.*.com)"
HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
INVISIBLE = r"(?is)<!--.*?-->|<script(?:\s[^>]*)?>.*?</script\s*>|<style(?:\s[^>]*)?>.*?</style\s*>"
BLOCKS = (
    "p li ul ol dl dt dd div table thead tbody tr td th section article main aside nav header footer "
    "form blockquote pre h1 h2 h3 h4 h5 h6 hr body html"
).split()
TAG = r"<[/!?A-Za-z][^>]*>"
TAG_OR_TEXT = rf"{TAG}|[^<]+|<"
# Elements whose end tag may be left out: what else a start tag ends, and what bounds it.
IMPLIED_ENDS = {"li": (["li"], ["ul", "ol"]), "dd": (["dd", "dt"], ["dl"]), "dt": (["dd", "dt"], ["dl"])}
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
ENTITY_OR_TEXT = rf"({ENTITY}|[^&]+|&)"
NAMED_ENTITIES = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | {"&apos;": "'"}


def unescape(text: Column) -> Column:
    """Resolve named and numeric entities in one pass; unknown ones stay."""
    named = F.from_json(F.lit(json.dumps(NAMED_ENTITIES)), "map<string,string>")

    def numeric(piece: Column) -> Column:
        body = F.substr(piece, F.lit(3), F.char_length(piece) - 3)
        code = F.when(
            F.lower(F.left(body, F.lit(1))) == "x", F.conv(F.substr(body, F.lit(2)), 16, 10)
        ).otherwise(body)
        code = code.cast("int")
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def resolve(piece: Column) -> Column:
        value = (
            F.when(F.startswith(piece, F.lit("&#")), numeric(piece))
            .when(F.startswith(piece, F.lit("&")), F.try_element_at(named, piece))
            .otherwise(piece)
        )
        return F.coalesce(value, piece)

    pieces = F.regexp_extract_all(text, F.lit(ENTITY_OR_TEXT), F.lit(1))
    return F.when(
        F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, resolve), "")
    ).otherwise(text)


def plain_text(html: Column) -> Column:
    return normalize_space(unescape(F.regexp_replace(html, TAG, "")))


def element_pattern(tag: str) -> str:
    if not tag.isalnum():
        raise ValueError(f"not a tag name: {tag!r}")
    return rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"


def hrefs(html: Column) -> Column:
    """Link targets, quoted ones whole."""

    def target(value: Column) -> Column:
        quoted = value.startswith('"') | value.startswith("'")
        return unescape(F.when(quoted, F.substr(value, F.lit(2), F.char_length(value) - 2)).otherwise(value))

    return F.transform(F.regexp_extract_all(html, F.lit(HREF), F.lit(1)), target)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tokens(html: Column) -> Column:
    """Tags and stretches of text in document order, without comments, scripts and styles."""
    return F.regexp_extract_all(F.regexp_replace(html, INVISIBLE, ""), F.lit(TAG_OR_TEXT), F.lit(0))


def tag_name(token: Column) -> Column:
    """Name of a tag in small letters, with a slash for an end tag; empty for text."""
    return F.lower(F.regexp_extract(token, r"^<(/?[A-Za-z][A-Za-z0-9]*)(?:[\s/][^>]*)?>$", 1))


def _named(tag: str) -> str:
    if not tag.isalnum():
        raise ValueError(f"not a tag name: {tag!r}")
    return tag.lower()


def elements(pieces: Column, *wanted: str) -> Column:
    """Where each wanted element starts and ends among the tokens, in document order.

    `at` is the place of its start tag, `to` of the token that ends it: its end
    tag, that of an element around it, or a tag that implies the end.  An
    element that nothing ends goes to the end of the page.
    """
    known = sorted({*BLOCKS, *map(_named, wanted)})
    opened = "array<struct<name:string,at:int>>"
    found = "array<struct<at:int,to:int>>"

    def ended(popped: Column, to: Column) -> Column:
        own = F.filter(popped, lambda e: e["name"].isin(*wanted))
        return F.transform(own, lambda e: F.struct(e["at"].alias("at"), to.alias("to")))

    def from_end(inner: Column, names: list[str]) -> Column:
        """Place of the innermost open element of these names, counted from the end; null without."""
        places = [F.nullif(F.array_position(inner, n), F.lit(0)) for n in names]
        return F.least(*places) if len(places) > 1 else places[0]

    def depth(stack: Column, name: Column) -> Column:
        """How many open elements stay when a tag comes."""

        def kept(inner: Column) -> Column:
            paragraph = F.when(F.get(inner, F.lit(0)) == "p", 1).otherwise(0)
            ends = paragraph.cast("bigint")
            for tag, (closes, bounds) in IMPLIED_ENDS.items():
                own, bound = from_end(inner, closes), from_end(inner, bounds)
                implied = own.isNotNull() & (bound.isNull() | (own < bound))
                ends = F.when((name == tag) & implied, own).otherwise(ends)
            explicit = F.array_position(inner, F.substr(name, F.lit(2), F.char_length(name)))
            return F.size(stack) - F.when(name.startswith("/"), explicit).otherwise(ends)

        return let(F.reverse(F.transform(stack, lambda e: e["name"])), kept).cast("int")

    def step(state: Column, tag: Column) -> Column:
        stack, name, at = state["stack"], tag["name"], tag["at"]

        def moved(keep: Column) -> Column:
            rest = F.slice(stack, F.lit(1), keep)
            pushed = F.array(F.struct(name.alias("name"), at.alias("at")))
            opens = ~name.startswith("/") & (name != "hr")
            popped = F.slice(stack, keep + 1, F.size(stack) - keep)
            return F.struct(
                F.when(opens, F.concat(rest, pushed)).otherwise(rest).alias("stack"),
                F.concat(state["done"], ended(popped, at)).alias("done"),
            )

        return let(depth(stack, name), moved)

    tags = F.filter(
        F.transform(pieces, lambda t, i: F.struct(i.alias("at"), tag_name(t).alias("name"))),
        lambda t: F.ltrim(t["name"], F.lit("/")).isin(*known),
    )
    start = F.struct(F.array().cast(opened).alias("stack"), F.array().cast(found).alias("done"))
    finish = lambda s: F.array_sort(F.concat(s["done"], ended(s["stack"], F.size(pieces))))
    return F.aggregate(tags, start, step, finish)


def contents(html: Column, *wanted: str) -> Column:
    """Markup inside each wanted element, in the order of their start tags; nested ones also by
    themselves."""

    def inside(pieces: Column) -> Column:
        return F.transform(
            elements(pieces, *wanted),
            lambda e: F.array_join(F.slice(pieces, e["at"] + 2, e["to"] - e["at"] - 1), ""),
        )

    return let(tokens(html), inside)


def hrefs_in(html: Column, container: str = "dd") -> Column:
    """All link targets inside the container elements, in document order."""
    return F.flatten(F.transform(contents(html, container), hrefs))


def outside_links(targets: Column, pattern: str = LINK_PATTERN) -> Column:
    """The parts of link targets that look like web addresses."""
    return F.flatten(
        F.transform(targets, lambda a: F.regexp_extract_all(a, F.lit(pattern), F.lit(1)))
    )


def sidebar_link(html: Column, css_class: str, container: str = "dd") -> Column:
    """First link in a container inside the first element of a class; NULL without one."""
    classed = (
        r"(?is)^<[a-z][^>]*?\sclass\s*=\s*"
        rf"""(?:"(?:[^"]*\s)?{re.escape(css_class)}(?:\s[^"]*)?"|'(?:[^']*\s)?{re.escape(css_class)}(?:\s[^']*)?')"""
    )

    def inside(pieces: Column) -> Column:
        start = F.array_position(F.transform(pieces, lambda t: t.rlike(classed)), True).cast("int")
        name = tag_name(F.get(pieces, start - 1))
        rest = F.slice(pieces, start + 1, F.size(pieces))

        def walk(state: Column, token: Column) -> Column:
            tag = tag_name(token)
            change = F.when(tag == name, 1).when(tag == F.concat(F.lit("/"), name), -1).otherwise(0)
            open = state["depth"] > 0
            return F.struct(
                F.when(open, state["depth"] + change).otherwise(0).alias("depth"),
                F.when(open, state["length"] + 1).otherwise(state["length"]).alias("length"),
            )

        begin = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"))
        length = F.aggregate(rest, begin, walk, lambda s: s["length"])
        return F.when(start > 0, F.array_join(F.slice(rest, F.lit(1), length), ""))

    return F.get(hrefs_in(let(tokens(html), inside), container), F.lit(0))


def page_text(html: Column) -> Column:
    """Whole text of every `p` and `li` in document order, nested blocks included, blanks collapsed."""
    return F.transform(contents(html, "p", "li"), plain_text)


def first_heading(html: Column, tag: str = "h2") -> Column:
    """Text of the first heading, NULL without one."""
    visible = F.regexp_replace(html, INVISIBLE, "")
    return plain_text(F.get(F.regexp_extract_all(visible, F.lit(element_pattern(tag)), F.lit(1)), F.lit(0)))


def headed_divs(html: Column, tag: str = "h2") -> Column:
    """Number of `div` elements that contain a heading, nested ones included.

    Walks over the div and heading tags with one flag per open div.
    """
    element_pattern(tag)
    visible = F.regexp_replace(html, INVISIBLE, "")
    tags = F.regexp_extract_all(visible, F.lit(rf"(?i)<(/?div|{tag})(?:\s[^>]*)?>"), F.lit(1))

    def state(flags: Column, headed: Column) -> Column:
        return F.struct(flags.alias("flags"), headed.alias("headed"))

    def step(acc: Column, name: Column) -> Column:
        flags, headed = acc["flags"], acc["headed"]
        inner = F.try_element_at(flags, F.lit(-1))
        return (
            F.when(F.lower(name) == "div", state(F.array_append(flags, F.lit(0)), headed))
            .when(
                F.lower(name) == "/div",
                state(
                    F.slice(flags, F.lit(1), F.greatest(F.size(flags) - 1, F.lit(0))),
                    headed + F.coalesce(inner, F.lit(0)),
                ),
            )
            .otherwise(state(F.transform(flags, lambda _: F.lit(1)), headed))
        )

    walked = F.aggregate(tags, state(F.array().cast("array<int>"), F.lit(0)), step)
    unclosed = F.aggregate(walked["flags"], F.lit(0), lambda a, f: a + f)
    return walked["headed"] + unclosed
