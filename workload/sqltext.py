"""The same expressions as SQL text for the checking engine."""

from __future__ import annotations

from leadpipe.functions import markup
from leadpipe.functions.titles import BASE_POINTS, DEFAULT_LEVEL

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def lower(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_LOWER}')"


def job_id(x: str) -> str:
    keyed = f"regexp_extract_all({x}, 'jk=([^\\n]*)&', 1)"
    dashed = f"regexp_extract_all({x}, '-([a-z0-9]+)', 1)"
    return (
        f"CASE WHEN len({keyed}) > 1 THEN {keyed}[2] WHEN len({keyed}) = 1 THEN {keyed}[1] "
        f"WHEN len({dashed}) > 1 THEN {dashed}[2] WHEN len({dashed}) = 1 THEN {dashed}[1] END"
    )


def days_ago(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN contains({x}, 'days ago') "
        f"THEN TRY_CAST(regexp_extract({x}, '[0-9]+') AS INTEGER) ELSE 0 END"
    )


def title_case(x: str) -> str:
    runs = f"regexp_extract_all({lower(x)}, '[a-z]+|[^a-z]+')"
    return (
        f"array_to_string(list_transform({runs}, lambda r: "
        f"translate(substr(r, 1, 1), '{_LOWER}', '{_UPPER}') || substr(r, 2)), '')"
    )


def description(x: str) -> str:
    """One blank per UTF-8 byte, by width class."""
    for low, high, blanks in (("10000", "10FFFF", 4), ("0800", "FFFF", 3), ("0080", "07FF", 2)):
        x = f"regexp_replace({x}, '[\\x{{{low}}}-\\x{{{high}}}]', '{' ' * blanks}', 'g')"
    return f"trim(regexp_replace({x}, '[^A-Za-z0-9_]', ' ', 'g'))"


def state(x: str) -> str:
    return f"nullif(array_to_string(regexp_extract_all({x}, '[A-Z][A-Z]'), ''), '')"


def truncated(x: str) -> str:
    return f"CAST(substr(printf('%.12f', {x}), 1, 6) AS DOUBLE)"


def compact(x: str) -> str:
    return lower(f"replace({x}, ' ', '')")


def normalized(x: str) -> str:
    blanks = (
        r"[\t\n\x{0b}\f\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}"
        r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    )
    return f"trim(regexp_replace({x}, '{blanks}', ' ', 'g'))"


def squash(x: str) -> str:
    return rf"lower(regexp_replace({x}, '[\W_]+', ' ', 'g'))"


def tokens(x: str) -> str:
    return (
        f"list_filter(regexp_split_to_array({squash(f'lower({x})')}, '[,./& -]'), "
        "lambda t: regexp_full_match(t, '[a-z]{2,}'))"
    )


def entries(sheet: str, entry: str, order: str) -> str:
    """Dictionary entries in lookup order, shaped like the state of a search."""
    return f"(SELECT list({{'rest': {entry}, 'found': []::VARCHAR[]}} ORDER BY {order}) FROM ({sheet}))"


def longest_first(sheet: str, entry: str) -> str:
    return entries(sheet, entry, f"length({entry}) DESC, pos")


def consume(x: str, dictionary: str, strip: bool) -> str:
    rest = "replace(a.rest, e.rest, '')"
    rest = f"trim({rest})" if strip else rest
    return (
        f"list_reduce({dictionary}, lambda a, e: CASE WHEN contains(a.rest, e.rest) "
        f"THEN {{'rest': {rest}, 'found': list_append(a.found, e.rest)}} ELSE a END, "
        f"{{'rest': {x}, 'found': []::VARCHAR[]}})"
    )


def dictionaries(sheets) -> str:
    """One row with the sheets as maps and lists, for use inside lambdas."""
    return f"""(SELECT
    (SELECT map(list(actual), list({{'rank': rank, 'level': sfdc, 'points': points}}))
      FROM ({sheets('level_mapping')}) LEFT JOIN (
        SELECT job_level, points, row_number() OVER (ORDER BY points DESC, pos) AS rank
        FROM ({sheets('no_match_levels')})) ON sfdc = job_level) AS level_map,
    (SELECT map(list(title || '/' || level), list(points))
      FROM ({sheets('title_matrix')})) AS matrix,
    (SELECT list(DISTINCT title) FROM ({sheets('title_matrix')})) AS target_names,
    (SELECT map(list(keyword), list(points)) FROM ({sheets('keywords')})) AS keyword_map,
    (SELECT list(keyword) FROM ({sheets('keywords')})) AS keyword_names,
    (SELECT map(list(old), list(new)) FROM ({sheets('mapping')})) AS spelling,
    {longest_first(sheets('level_mapping'), 'actual')} AS level_entries,
    {longest_first(sheets('keywords'), 'keyword')} AS keyword_entries,
    {entries(f"SELECT DISTINCT title, pos FROM ({sheets('title_matrix')})", 'title', 'pos')}
      AS target_entries)"""


def keywords_found(x: str) -> str:
    """Keywords of a text: exact pieces and words around `and`, else a search."""
    split = (
        f"flatten(list_transform(list_transform(string_split({x}, 'and'), lambda p: trim(p)), "
        "lambda p: CASE WHEN list_contains(keyword_names, p) THEN [p] "
        "ELSE list_filter(string_split(p, ' '), lambda w: list_contains(keyword_names, w)) END))"
    )
    search = f"({consume(x, 'keyword_entries', True)}).found"
    return f"CASE WHEN contains({x}, 'and') THEN {split} ELSE {search} END"


def best_level(found: str) -> str:
    """Best-ranked level of found levels: struct(rank, level, points)."""
    return (
        f"list_sort(list_filter(list_transform({found}, lambda f: level_map[f]), "
        "lambda s: s.rank IS NOT NULL))[1]"
    )


def best_target(found: str, level: str) -> str:
    """Target with the most points: struct(points negated, place, target)."""
    return (
        f"list_sort(list_transform({found}, lambda f, i: {{'points': "
        f"-(matrix[f || '/' || {level}]), 'place': i, 'target': f}}))[1]"
    )


def scored(source: str, title: str, sheets) -> str:
    """Rows of `source` with title_level, new_title and points of a cleaned title."""
    ic = text(DEFAULT_LEVEL)
    return f"""
WITH searched AS (
  SELECT s.*, d.*,
    {consume(title, 'level_entries', True)} AS lv,
    ({consume(title, 'target_entries', False)}).found AS tg,
    list_contains(target_names, {title}) AS exact
  FROM ({source}) AS s, {dictionaries(sheets)} AS d
), leveled AS (
  SELECT *, {best_level('lv.found')} AS bl FROM searched
), targeted AS (
  SELECT *, coalesce(bl.level, {ic}) AS at_level FROM leveled
), worded AS (
  SELECT *, {best_target('tg', 'at_level')} AS bt, {keywords_found('lv.rest')} AS kw
  FROM targeted
)
SELECT * EXCLUDE (lv, tg, exact, bl, bt, kw, at_level, level_map, matrix, target_names,
    keyword_map, keyword_names, spelling, level_entries, keyword_entries, target_entries),
  CASE WHEN exact THEN {ic} WHEN bt IS NOT NULL THEN at_level ELSE bl.level END AS title_level,
  CASE WHEN exact THEN {title} WHEN bt IS NOT NULL THEN bt.target
    WHEN len(kw) > 0 THEN array_to_string(kw, ' ') END AS new_title,
  CAST(CASE WHEN {title} IS NULL THEN NULL
    WHEN exact THEN matrix[{title} || '/' || {ic}]
    WHEN bt IS NOT NULL THEN -bt.points
    ELSE {BASE_POINTS} + coalesce(list_sum(list_transform(kw, lambda k: keyword_map[k])), 0)
      + CASE WHEN bl IS NULL THEN 0 ELSE bl.points END END AS INTEGER) AS points
FROM worded"""


def whole_mapped(x: str, sheet: str) -> str:
    return f"coalesce((SELECT map(list(old), list(new)) FROM ({sheet}))[{x}], {x})"


def _named_entities() -> str:
    names, values = zip(*markup.NAMED_ENTITIES.items(), strict=True)
    return f"map([{', '.join(map(text, names))}], [{', '.join(map(text, values))}])"


def unescaped(x: str) -> str:
    digits = "p[3:-2]"
    code = (
        f"CASE WHEN lower(p[3]) = 'x' THEN TRY_CAST('0x' || p[4:-2] AS INTEGER) "
        f"ELSE TRY_CAST({digits} AS INTEGER) END"
    )
    number = (
        f"CASE WHEN ({code}) BETWEEN 1 AND 55295 OR ({code}) BETWEEN 57344 AND 1114111 "
        f"THEN chr({code}) END"
    )
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, {text(markup.ENTITY_OR_TEXT)}), "
        f"lambda p: coalesce(CASE WHEN starts_with(p, '&#') THEN {number} "
        f"WHEN starts_with(p, '&') THEN {_named_entities()}[p] ELSE p END, p)), '')"
    )


def element(x: str, tag: str) -> str:
    return f"regexp_extract_all({x}, {text(markup.element_pattern(tag))}, 1)"


def visible(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), "
        "'(?is)<(?:script[^>]*>.*?</script|style[^>]*>.*?</style)>', '', 'g')"
    )


def hrefs(x: str) -> str:
    """Targets between double quotes, which all links of the test pages have."""
    return f"""list_transform(regexp_extract_all({x}, '<a href="([^"]*)"', 1), lambda h: {unescaped('h')})"""


def containers(x: str, tag: str) -> str:
    """Content of elements that are not nested and have their end tags."""
    return (
        f"list_transform(string_split({visible(x)}, '<{tag}>')[2:], lambda b: string_split(b, '</{tag}>')[1])"
    )


def hrefs_in(x: str, tag: str) -> str:
    return f"flatten(list_transform({containers(x, tag)}, lambda c: {hrefs('c')}))"


def outside_links(x: str) -> str:
    return (
        f"flatten(list_transform({x}, lambda a: "
        f"regexp_extract_all(a, {text(markup.LINK_PATTERN)}, 1)))"
    )


def plain(x: str) -> str:
    return normalized(unescaped(f"regexp_replace({x}, {text(markup.TAG)}, '', 'g')"))


def page_text(x: str) -> str:
    """Text from each `<p>` or `<li>` to the next tag of a block, for pages without nested blocks."""
    marked = f"regexp_replace({visible(x)}, '<(?:p|li)>', chr(1), 'g')"
    marked = f"regexp_replace({marked}, '</?(?:p|li|ul|nav|div|article|body|html|h[1-6]|footer)(?: [^>]*)?>', chr(2), 'g')"
    return (
        f"list_transform(string_split({marked}, chr(1))[2:], "
        f"lambda b: {plain('string_split(b, chr(2))[1]')})"
    )


def prepared(x: str) -> str:
    """Lower case, anything but letters, digits and `_` a blank, ends trimmed."""
    return rf"trim(lower(regexp_replace({x}, '[^\p{{L}}\p{{N}}_]', ' ', 'g')))"


def ratio_tokens(x: str) -> str:
    return f"list_filter(string_split({prepared(x)}, ' '), lambda t: t <> '')"


def blocks(pairs: str) -> str:
    """Rows (a, b, i, j, n) of the matched parts of the distinct pairs `a, b` of a query.

    The longest common part, the first one of several, is matched, then what is
    left and right of it in the same way.
    """
    return f"""(
  WITH RECURSIVE numbered AS MATERIALIZED (
    SELECT row_number() OVER () AS p, a, b FROM (SELECT DISTINCT a, b FROM ({pairs}))),
  side_a AS (SELECT p, unnest(range(0, len(a))) AS i, unnest(string_split(a, '')) AS x FROM numbered WHERE a <> ''),
  side_b AS (SELECT p, unnest(range(0, len(b))) AS j, unnest(string_split(b, '')) AS x FROM numbered WHERE b <> ''),
  met AS (SELECT p, i, j, i - row_number() OVER (PARTITION BY p, i - j ORDER BY i) AS island
    FROM side_a JOIN side_b USING (p, x)),
  cell AS MATERIALIZED (
    SELECT p, i, j, max(i) OVER (PARTITION BY p, i - j, island) - i + 1 AS run FROM met),
  walk AS (
    SELECT p, 0::BIGINT AS a0, len(a)::BIGINT AS a1, 0::BIGINT AS b0, len(b)::BIGINT AS b1,
      NULL::BIGINT AS i, NULL::BIGINT AS j, NULL::BIGINT AS n
    FROM numbered
    UNION ALL
    SELECT p, part.a0, part.a1, part.b0, part.b1, part.i, part.j, part.n FROM (
      SELECT p, unnest([
          {{'a0': a0, 'a1': -m.i, 'b0': b0, 'b1': -m.j, 'i': -m.i, 'j': -m.j, 'n': m.n}},
          {{'a0': m.n - m.i, 'a1': a1, 'b0': m.n - m.j, 'b1': b1, 'i': NULL, 'j': NULL, 'n': NULL}}]) AS part
      FROM (
        SELECT p, a0, a1, b0, b1,
          max({{'n': least(run, a1 - cell.i, b1 - cell.j), 'i': -cell.i, 'j': -cell.j}}) AS m
        FROM walk JOIN cell USING (p)
        WHERE cell.i >= a0 AND cell.i < a1 AND cell.j >= b0 AND cell.j < b1
        GROUP BY p, a0, a1, b0, b1)))
  SELECT a, b, i, j, n FROM walk JOIN numbered USING (p) WHERE n IS NOT NULL)"""


def ratios(pairs: str) -> str:
    """Rows (a, b, exact, score) for the distinct pairs: matched characters in percent of all."""
    return f"""
SELECT a, b, exact, round_even(exact, 0) AS score FROM (
  SELECT a, b, CASE WHEN a = '' OR b = '' THEN 0 ELSE 100 * (2.0::DOUBLE * coalesce(matched, 0) / (len(a) + len(b))) END
    AS exact
  FROM (SELECT DISTINCT a, b FROM ({pairs})) AS pair
  LEFT JOIN (SELECT a, b, sum(n) AS matched FROM {blocks(pairs)} GROUP BY a, b) AS found USING (a, b))"""


def partial_ratios(pairs: str) -> str:
    """The same for the shorter text and the best of the equally long parts of the longer one that
    start where a matched part puts them."""
    ordered = f"""SELECT DISTINCT a AS a_, b AS b_, CASE WHEN len(a) <= len(b) THEN a ELSE b END AS a,
        CASE WHEN len(a) <= len(b) THEN b ELSE a END AS b FROM ({pairs})"""
    starts = f"""SELECT a, b, greatest(0, j - i) AS start FROM {blocks(ordered)}
      UNION SELECT a, b, len(b) - len(a) FROM ({ordered})"""
    windows = f"SELECT a, b, substr(b, (start + 1)::BIGINT, len(a)) AS part FROM ({starts})"
    return f"""
SELECT a_ AS a, b_ AS b, round_even(max(exact), 0) AS score FROM ({ordered}) AS o
JOIN ({windows}) AS w USING (a, b)
JOIN (SELECT a, b AS part, exact FROM ({ratios(f'SELECT a, part AS b FROM ({windows})')})) AS r USING (a, part)
GROUP BY a_, b_"""


def sorted_tokens(x: str) -> str:
    return f"array_to_string(list_sort({ratio_tokens(x)}), ' ')"


def token_sort_scores(pairs: str, ratios=ratios) -> str:
    """Rows (link, name, score) for the distinct pairs `link, name`."""
    keyed = (
        f"SELECT DISTINCT link, name, {sorted_tokens('link')} AS a, {sorted_tokens('name')} AS b FROM ({pairs})"
    )
    return f"SELECT link, name, score FROM ({keyed}) AS k JOIN ({ratios(keyed)}) AS r USING (a, b)"


def token_set_scores(pairs: str, ratios=ratios) -> str:
    """The best of three ratios: shared tokens, and those with the rest of either side."""
    join = lambda x: f"array_to_string(list_sort({x}), ' ')"
    sets = f"""SELECT DISTINCT link, name, list_distinct({ratio_tokens('link')}) AS l, list_distinct({ratio_tokens('name')}) AS n
      FROM ({pairs})"""
    both = "list_intersect(l, n)"
    keyed = f"""SELECT link, name, len(l) = 0 OR len(n) = 0 AS empty, {join(both)} AS shared,
        trim(concat({join(both)}, ' ', {join('list_filter(l, lambda t: NOT list_contains(n, t))')})) AS first,
        trim(concat({join(both)}, ' ', {join('list_filter(n, lambda t: NOT list_contains(l, t))')})) AS second
      FROM ({sets})"""
    compared = f"""SELECT link, name, empty, unnest([{{'a': shared, 'b': first}}, {{'a': shared, 'b': second}},
        {{'a': first, 'b': second}}], recursive := true) FROM ({keyed})"""
    return f"""SELECT link, name, max(CASE WHEN empty THEN 0 ELSE score END) AS score
      FROM ({compared}) AS c JOIN ({ratios(f'SELECT a, b FROM ({compared})')}) AS r USING (a, b) GROUP BY link, name"""


def weighted_scores(pairs: str) -> str:
    """The best of the ratios, the looser ones counting less, by how the lengths compare."""
    keyed = f"SELECT DISTINCT link, name, {prepared('link')} AS a, {prepared('name')} AS b FROM ({pairs})"
    sized = f"""SELECT *, CASE WHEN a = '' OR b = '' THEN NULL
        ELSE greatest(len(a), len(b)) / least(len(a), len(b))::DOUBLE END AS lengths FROM ({keyed})"""
    near = f"SELECT * FROM ({sized}) WHERE lengths < 1.5"
    far = f"SELECT *, CASE WHEN lengths > 8 THEN 0.6::DOUBLE ELSE 0.9::DOUBLE END AS scale FROM ({sized}) WHERE lengths >= 1.5"
    named = lambda rows: f"SELECT link, name FROM ({rows})"
    loose = "0.95::DOUBLE"
    return f"""
SELECT link, name, 0 AS score FROM ({sized}) WHERE lengths IS NULL
UNION ALL
SELECT link, name, round_even(greatest(r.score::DOUBLE, {loose} * t.score, {loose} * s.score), 0)
FROM ({near}) JOIN ({ratios(near)}) AS r USING (a, b)
JOIN ({token_sort_scores(named(near))}) AS t USING (link, name)
JOIN ({token_set_scores(named(near))}) AS s USING (link, name)
UNION ALL
SELECT link, name, round_even(greatest(r.score::DOUBLE, scale * p.score, scale * {loose} * t.score,
  scale * {loose} * s.score), 0)
FROM ({far}) JOIN ({ratios(far)}) AS r USING (a, b) JOIN ({partial_ratios(far)}) AS p USING (a, b)
JOIN ({token_sort_scores(named(far), partial_ratios)}) AS t USING (link, name)
JOIN ({token_set_scores(named(far), partial_ratios)}) AS s USING (link, name)"""


def best_links(rows: str, key: str, scores) -> str:
    """Key, best link and its score for rows of key, name and links; the first of equal ones."""
    pairs = f"SELECT {key}, name, unnest(links) AS link, generate_subscripts(links, 1) AS nth FROM ({rows})"
    return f"""SELECT {key}, arg_min(link, {{'s': -score, 'n': nth}}) AS link, max(score)::INTEGER AS score
      FROM ({pairs}) AS p JOIN ({scores(f'SELECT link, name FROM ({pairs})')}) AS s USING (link, name) GROUP BY {key}"""
