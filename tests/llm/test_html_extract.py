import time
from html.parser import HTMLParser

import pytest

from hourstar.llm.html_extract import BLOCK, in_order, main_text, measure, parse
from hourstar.llm.queries import op5_html_extraction

SF_DIR = "/root/testdata/sf0.01"


class Article(HTMLParser):
    """The article element's blocks, by another parser."""

    def __init__(self):
        super().__init__()
        self.inside, self.out, self.line = False, [], []

    def end_block(self):
        text = " ".join("".join(self.line).split())
        if self.inside and text:
            self.out.append(text)
        self.line = []

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "p", "h1"):
            self.end_block()
        if tag == "br":
            self.line.append(" ")
        self.inside |= tag == "article"

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1"):
            self.end_block()
        self.inside &= tag != "article"

    def handle_data(self, data):
        self.line.append(data)


def test_query_over_the_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = op5_html_extraction(spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for r in rows:
        parser = Article()
        parser.feed(pages[r.page_id].html)
        assert r.text == "\n".join(parser.out) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
        assert r.text


LOREM = "A long enough sentence of running text, with commas and all that, to stand for an article. " * 3
PAGE = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar"><header><a href=/>Site</a> name</header>
<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav><div class="cookie-notice">We use cookies. {LOREM}</div>
<div id=content>%s</div><div class="sidebar"><p>{LOREM}</p></div><form>Name <input></form>
<section id="comments"><article><p>First! {LOREM}</p></article></section><aside>{LOREM}</aside>
<footer>&copy; Site</footer><script>if (a < b) document.write("<p>no</p>")</script></body></html>"""


@pytest.mark.parametrize(("inner", "text"), [
    (f"<h1>Title &amp; more</h1><p>{LOREM}</p><p>x</p>", f"Title & more\n{LOREM.strip()}\nx"),
    (f"<main><h1>T</h1><div><p>{LOREM}<p>B <b>bo</b>ld&nbsp;c<br>d</div></main>", f"T\n{LOREM.strip()}\nB bold c d"),
    (f"<article><header><h1>T</h1></header><p>{LOREM}</p><div class='share-buttons'>Share</div><footer>By me</footer></article>", f"T\n{LOREM.strip()}"),
    (f"<article><p>a<!-- no --> b</p><ul><li>one<li>two</ul><table><tr><td>c<td>d</table><p>{LOREM}", f"a b\none\ntwo\nc\nd\n{LOREM.strip()}"),
])
def test_boilerplate_goes_and_the_article_stays(inner, text):
    assert main_text(PAGE % inner) == text


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("  ", ""), ("plain text only", "plain text only"), ("<p>a<p>b", "a\nb"), ("<p>cut off <b", "cut off"),
    ("<script>never closed <p>x", ""), ("<p title='a>b'>c</p>", "c"), ("<p title='never closed>c</p>", "c"), ("a < b and <3 c", "a < b and <3 c"),
    ("<p>&amp;lt; &#233; &eacute;</p>", "&lt; é é"), ("<div hidden>no</div><p>yes</p>", "yes"), ("</p></div>x", "x"),
])
def test_awkward_pages(page, text):
    assert main_text(page) == text


def test_long_and_deep_pages_take_linear_time():
    assert len(main_text("<p>" + "word " * 400_000)) == 400_000 * 5 - 1
    assert main_text("<div>" * 20_000 + "x") == "x"
    assert main_text("<a \"" * 20_000 + "x") is not None
    assert main_text("<" * 200_000).count("<") == 200_000


def test_empty_table(spark):
    from hourstar.llm.html_extract import extract

    pages = spark.createDataFrame([(1, None, "u"), (1, "<p>x", "u"), (None, "<p>x", None)], "page_id long, html string, text string")
    for clash in ("text", "n_chars"):
        with pytest.raises(ValueError, match="rename the columns"):
            extract(pages.withColumn("n_chars", pages.page_id), keep=["page_id", clash])
    rows = extract(pages.withColumnRenamed("text", "url"), keep=["page_id", "url"])
    assert rows.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text) for r in rows.collect()) == [(0, "x"), (1, ""), (1, "x")]
    assert extract(pages.limit(0), keep=["page_id"]).count() == 0


def test_depth_does_not_change_what_is_kept():
    body = f"<h2>Heading</h2><div><p>{LOREM}</p><p>{LOREM}</p></div><h2>End</h2>loose"
    wanted = f"Heading\n{LOREM.strip()}\n{LOREM.strip()}\nEnd\nloose"
    for depth in (3, 450, 600, 3_000):
        assert main_text("<div>" * depth + body) == wanted
    unclosed = "".join(f"<div><h3>Part {k}</h3><p>{LOREM}</p>" for k in range(700))
    assert main_text(unclosed).count("Part ") == 700


def test_what_stands_beside_an_article_is_kept():
    page = f"<body><main><h1>Title</h1><article><p>{LOREM}</p></article><article><p>Second. {LOREM}</p></article></main></body>"
    assert main_text(page) == f"Title\n{LOREM.strip()}\nSecond. {LOREM.strip()}"
    first = f"<p>{LOREM}</p>" * 4
    page = f"<body><div><article>{first}</article><p>x</p><article><p>Second. {LOREM}</p></article></div></body>"
    assert main_text(page) == "\n".join([LOREM.strip()] * 4 + [f"Second. {LOREM.strip()}"])


def test_long_attribute_values_are_attributes():
    for quote, other in ("\"'", "'\""):
        value = f"<p class={other}ad{other} hidden>no</p> display:none > " * 200
        assert main_text(f"<div data-x={quote}{value}{quote}>yes</div><p>more") == "yes\nmore"
    assert main_text("<p title=\"" + "x" * 9_000 + ">c</p>") == "c"
    assert main_text("<a '" + "<b \"" * 20_000 + "x") is not None
    assert main_text("<div style='color:red;display: none'>no</div><div HIDDEN=''>no</div><p>yes") == "yes"


@pytest.mark.parametrize(("page", "text"), [
    ("<html><head><title>t</title><meta x><p>a<p>b", "a\nb"), ("<head><link><script>no</script>text", "text"),
    ("<head><style>p{}</style> <div>a</div></head><body>b", "a\nb"), ("<head><svg>no</svg></head>c", "c"), ("<head> </head>d", "d"),
])
def test_open_head_ends_where_the_text_begins(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("tags", [{"article": "section"}, {"article": "div"}, {"article": "font"}])
def test_density_finds_the_text_without_an_article_tag(tags):
    """What the tag encloses is found where it has another name, on every page of the table."""
    import duckdb

    for (page,) in duckdb.sql(f"SELECT html FROM '{SF_DIR}/pages.parquet'").fetchall():
        parser = Article()
        parser.feed(page)
        for tag, other in tags.items():
            page = page.replace(f"<{tag}>", f"<{other}>").replace(f"</{tag}>", f"</{other}>")
        assert "article" not in page and main_text(page) == "\n".join(parser.out)


def plain_totals(node, densities):
    """Density sums from the definition, by recursion."""
    def holds(n):
        return n.tag in BLOCK or any(holds(c) for c in n.children if not isinstance(c, str))

    return sum(densities[id(c)] for c in node.children if not isinstance(c, str) and holds(c))


def test_density_sums_against_their_definition():
    page = PAGE % f"<div><p>{LOREM}<a href=x>link</a><p><span><b>{LOREM}</b></span><span><div>in</div></span></div><p>{LOREM} {LOREM}"
    nodes = in_order(parse(page))
    measure(nodes)
    densities = {id(n): n.density for n in nodes}
    for node in nodes:
        assert node.total == pytest.approx(plain_totals(node, densities))
        inner = [c for c in node.children if not isinstance(c, str)]
        assert node.tags == sum(1 + c.tags for c in inner)
        links = [n for n in nodes if n.tag == "a" and node in ancestors(n)]
        assert node.link_chars == sum(n.chars for n in links)
    assert max(nodes, key=lambda n: n.total).tag in ("div", "body")


def ancestors(node):
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out


def test_unmatched_end_tags_take_linear_time():
    for start in ("", "<i><div>", "<body>"):
        seconds = []
        for n in (20_000, 80_000):
            page = start + "<b>" * n + "</i>" * n + "<body>" * n + "<li>" * 50 + "x"
            begun = time.process_time()
            assert main_text(page) == "x"
            seconds.append(time.process_time() - begun)
        assert seconds[1] < 12 * seconds[0] + 1


def test_formulas_are_text():
    assert main_text(f"<p>{LOREM}<math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math>") == LOREM.strip() + " x+1"


@pytest.mark.parametrize(("page", "text"), [
    ("<table><tr><td>a<table><tr><td>b</table>c<td>d</table>e", "a\nb\nc\nd\ne"), ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", "a\nb\nc\nd"),
    ("<b><p>a</b>b</p>c", "ab\nc"), ("<p>a<b>b</p>c</b>d", "ab\ncd"), ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"),
])
def test_open_elements_are_closed_as_far_as_their_scope(page, text):
    assert main_text(page) == text
