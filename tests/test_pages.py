import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from leadpipe.functions import markup
from leadpipe.operators import pages


def test_links_in_containers(apply):
    html = [
        "<dd><a href='http://a.com'>x</a></dd><DD><A class=c HREF=\"/rel\">y</A></DD><a href='/out'>z</a>",
        "<dl><dd>no link</dd></dl>",
        '<dd><a data-href="no" href="www.b.com/x?p=1&amp;q=2">b</a><a>none</a></dd>',
        None,
    ]
    assert apply(html, markup.hrefs_in) == [
        ["http://a.com", "/rel"],
        [],
        ["www.b.com/x?p=1&q=2"],
        None,
    ]


def test_containers_without_end_tags_and_comments(apply):
    html = [
        "<dl><dd><a href=/1>a</a><dt>t<a href=/no></a><dd><a href=/2></a><a href=/3></a></dl><a href=/no>",
        "<!-- <dd><a href=/no></a></dd> --><dd>x<!-- <a href=/no> --><a href='/4'></a></dd>",
    ]
    assert apply(html, markup.hrefs_in) == [["/1", "/2", "/3"], ["/4"]]


def test_outside_links(frame):
    df = frame(
        [(["/x?u=http://a.b/c", "www.c.com.org", "ftp://d", "https://e"],), ([],)],
        "a array<string>",
    )
    rows = df.select(markup.outside_links(F.col("a")).alias("x")).collect()
    assert [r.x for r in rows] == [["http://a.b/c", "www.c.com", "https://e"], []]


def test_company_links(frame):
    companies = frame(
        [
            (1, "http://site/1", "A"),
            (2, "http://site/2", "B"),
            (3, "http://site/3", "C"),
            (4, "https://www.google.com/#q=D", "D"),
        ],
        "n int, CompanyLink string, AccountName string",
    )
    fetched = frame(
        [
            (7, "http://site/1", "<dd><a href='http://a.com'>a</a><a href='www.a.com'>b</a></dd>"),
            (8, "http://site/1", "<dd><a href='http://late.com'>a</a></dd>"),
            (9, "http://site/2", "<p><a href='http://b.com'>not in a list</a></p>"),
        ],
        "page_id bigint, url string, html string",
    )
    rows = pages.company_links(companies, fetched).collect()
    assert {r.n: r.links for r in rows} == {
        1: ["http://a.com", "www.a.com"],
        2: ["https://www.google.com/#q=B"],
        3: ["https://www.google.com/#q=C"],
        4: ["https://www.google.com/#q=D"],
    }


def test_sidebar_link(apply):
    html = [
        "<dd><a href='/early'></a></dd><dl class='big side box'><dd><a href='/s'></a></dd></dl>",
        "<dl class='sidebar'><dd><a href='/no'></a></dd></dl>",
        "<dl class='side'><dt>x</dt></dl>",
    ]
    assert apply(html, lambda c: markup.sidebar_link(c, "side")) == ["/s", None, None]


def test_page_text(apply):
    html = [
        "<p>one <b>t</b>wo<p>open<li>A &amp;amp; B</li></ul>tail<p>  x\n y </p>",
        "<script>var t='<p>no</p>'</script><!-- <li>no</li> --><pre>no</pre><p class='c'>yes</p>",
        "<div>none</div>",
    ]
    assert apply(html, markup.page_text) == [
        ["one two", "open", "A &amp; B", "x y"],
        ["yes"],
        [],
    ]


def test_entities(apply):
    texts = [
        "a &amp; b &copy; &eacute;&#8217;&#x1F600; &#38;lt; &amp;lt;",
        "&unknown; & &; &#0; &#xD800; &#9999999; AT&T &#x;",
        "none",
        "&",
        "",
        None,
    ]
    assert apply(texts, markup.unescape) == [
        "a & b © é’😀 &lt; &lt;",
        texts[1],
        "none",
        "&",
        "",
        None,
    ]


NESTED = [
    "<li>a<div>b</div>c</li>",
    "<li><div>only</div></li>",
    "<li><h3>Title</h3>body</li>",
    "<ul><li>one<ul><li>two</li><li>three</ul>four</li><li>five</ul><p>six<div>no</div>no",
    "<ol><li>a<p>b<p>c</ol><p>d <b>e</b> <i>f<li>g",
    "<div><p>a</div>no<p>b</p>no</p><li>c<hr>d</li>",
    "<table><tr><td><p>x<td><li>y</table>no",
    "<li>a<!-- </li> --><script>'</li>'</script>b</li></li>no",
]


def test_blocks_hold_all_their_text(apply):
    assert apply(NESTED, markup.page_text) == [
        ["abc"],
        ["only"],
        ["Titlebody"],
        ["onetwothreefour", "two", "three", "five", "six"],
        ["abc", "b", "c", "d e f", "g"],
        ["a", "b", "cd"],
        ["x", "y"],
        ["ab"],
    ]


def test_links_are_whole(apply):
    html = [
        """<dd><a href="it's here/a b">x</a><a class='>' href='say "hi"'>y</a><a href=/z?a=1&apos;>z</a></dd>""",
        "<dd>a<dl><dd><a href='/in'></a></dd></dl><a href='/out'></a></dd>",
    ]
    found = apply(html, markup.hrefs_in)
    assert found[0][0] == "it's here/a b" and found[0][-1] == "/z?a=1'"
    assert found[1] == ["/in", "/out", "/in"]


def test_sidebar_link_is_inside_its_element(apply):
    html = [
        "<div class='s'><div>x</div></div><dd><a href='/no'></a></dd>",
        "<!-- <div class='s'><dd><a href='/no'></a></dd></div> --><p class=s>x",
        "<div class='a s b'><div></div><dd><a href='/yes'></a></dd></div>",
        "<div class='s.x'><dd><a href='/dot'></a></dd></div>",
    ]
    assert apply(html, lambda c: markup.sidebar_link(c, "s")) == [None, None, "/yes", None]
    assert apply(html[3:], lambda c: markup.sidebar_link(c, "s.x")) == ["/dot"]
    assert apply(["<div class='sax'><dd><a href='/no'></a></dd></div>"], lambda c: markup.sidebar_link(c, "s.x")) == [None]


class Blocks(HTMLParser):
    """Whole text of p and li elements of a page with all its end tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.open, self.hidden = [], [], False

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li"):
            self.open.append(len(self.blocks))
            self.blocks.append("")
        self.hidden = tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("p", "li"):
            self.open.pop()
        self.hidden = False

    def handle_data(self, data):
        if not self.hidden:
            for i in self.open:
                self.blocks[i] += data


def markup_of(draw, depth=0):
    """Well-formed markup of nested lists, blocks and text."""
    out = []
    for _ in range(draw.randint(1, 4)):
        kind = draw.choice(["text", "li", "div", "p", "b", "h3", "script"])
        if kind == "text" or depth > 4:
            out.append(draw.choice(["one &amp; two", " x ", "&eacute;t&eacute;", "a < b", "\n"]))
        elif kind == "li":
            items = "".join(f"<li class='c'>{markup_of(draw, depth + 1)}</li>" for _ in range(draw.randint(1, 3)))
            out.append(f"<ul>{items}</ul>")
        elif kind in ("p", "b"):
            out.append(f"<{kind}>text {draw.randint(0, 9)}</{kind}>")
        elif kind == "script":
            out.append("<script>var x = '<p>';</script><!-- <li> -->")
        else:
            out.append(f"<{kind}>{markup_of(draw, depth + 1)}</{kind}>")
    return "".join(out)


def test_page_text_against_a_parser(apply):
    draw = random.Random(7)
    html = [markup_of(draw) for _ in range(60)]
    found = apply(html, markup.page_text)
    for text, blocks in zip(html, found, strict=True):
        parser = Blocks()
        parser.feed(text)
        parser.close()
        assert blocks == [" ".join(b.split()) for b in parser.blocks], text


def test_heading(apply):
    html = ["<h1>a</h1><H2 id=x>b <i>c</i></H2><h2>d</h2>", "<p>none</p>", "<!-- <h2>old</h2> --><h2>new</h2>"]
    assert apply(html, markup.first_heading) == ["b c", None, "new"]
    assert apply(html, lambda c: markup.first_heading(c, "h1")) == ["a", None, None]


def test_headed_divs(apply):
    html = [
        "<div><div><h2>a</h2></div><div>b</div></div>",
        "<h2>a</h2><div>b</div></div><div class=x>c<H2 id=1>d</H2>",
        "<!-- <div><h2></h2></div> --><p>x</p>",
    ]
    assert apply(html, markup.headed_divs) == [2, 1, 0]
