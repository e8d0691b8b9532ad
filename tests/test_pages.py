from html.parser import HTMLParser

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quotewire.functions.html import TEXT, _NodeTable, html_nodes, text_of
from quotewire.operators import pages
from quotewire.plans.inputs import SITE


def page(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id int, html string")


CELLS = "<td>1</td><td>2</td><td>3</td>"
PRICE = '<td><fin-streamer data-field="regularMarketPrice">{}</fin-streamer></td>'
SYMBOL = '<td><span class="symbol">{}</span></td>'


def quotes(spark, html):
    return pages.parse_quote_row(pages.extract_quote_rows(page(spark, html)), SITE)


def test_text_skips_scripts_and_decodes(spark):
    html = '<p>a &amp; b<script>x</script><b>c</b><!-- no --></p><p>d'
    df = page(spark, html).select(text_of(html_nodes(F.col("html"))))
    assert df.first()[0] == "a & bcd"


class Events(HTMLParser):
    """Start tags with attributes, and text outside scripts and styles, in order."""

    def __init__(self):
        super().__init__()
        self.seen, self.hidden = [], False

    def handle_starttag(self, tag, attrs):
        self.hidden = tag in ("script", "style")
        if not self.hidden:
            self.seen.append((tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        self.hidden = False

    def handle_data(self, data):
        if not self.hidden:
            joined = self.seen and self.seen[-1][0] == TEXT
            self.seen[-1 if joined else len(self.seen):] = [(TEXT, (self.seen[-1][1] if joined else "") + data)]


def listed(html):
    table = _NodeTable()
    table.add_page(html)
    out, ends = [], table.attr_ends
    for i, tag in enumerate(table.tag):
        if tag != TEXT:
            out.append((tag, dict(zip(table.keys[ends[i]:ends[i + 1]], table.values[ends[i]:ends[i + 1]]))))
        elif out and out[-1][0] == TEXT:
            out[-1] = (TEXT, out[-1][1] + table.text[i])
        else:
            out.append((TEXT, table.text[i]))
    return out


PIECES = [
    '<a href="x>y" b=\'q"r\' c=d e>t</a>', "<A HREF=/x/y>1 &lt; 2 &amp;amp; &eacute;&#233;</A>", "a < b > c", "<br/><img src=x />z",
    "x<!-- <b> -->y<!DOCTYPE html>z", "<script>if (a<b) '<p>'</script>s<style>p{}</style>", "<x-y data-a = '1'>t</x-y>", "<p\n class='a\nb'\n>t",
    '<p title=5">one</p>', "<i x=it's y=2>t</i>", '<a b=c"d"e f>t</a>', "<b it's>t</b>", '<u "q" r=1>t</u>',
]


@pytest.mark.parametrize("html", [*PIECES, "".join(PIECES)])
def test_nodes_agree_with_the_standard_parser(html):
    parser = Events()
    parser.feed(html)
    parser.close()
    assert listed(html) == parser.seen


def test_tags_that_do_not_close_take_linear_time():
    import time

    def seconds(html):
        start = time.perf_counter()
        listed(html)
        return time.perf_counter() - start

    for piece in ('<a b="x ', "<a b='x ", "<a b=", "<a ", "<!x ", "<script ", "<script>", "</a "):
        assert seconds(piece * 40_000) < 3
    assert listed("one<p>two<a href='x") == [(TEXT, "one"), ("p", {}), (TEXT, "two")]


def test_given_pages_agree_with_the_standard_parser():
    path = "/root/testdata/sf0.01/pages.parquet"
    for (html,) in duckdb.sql(f"SELECT html FROM '{path}'").fetchall():
        parser = Events()
        parser.feed(html)
        parser.close()
        assert listed(html) == parser.seen


def test_nesting():
    table = _NodeTable()
    table.add_page("<div><p>a<p>b<br>c</div></i><span>d")
    tree = list(zip(table.tag, table.pos, table.last))
    assert tree == [
        ("div", 0, 6), ("p", 1, 2), (TEXT, 2, 2), ("p", 3, 6), (TEXT, 4, 4), ("br", 5, 5), (TEXT, 6, 6),
        ("span", 7, 8), (TEXT, 8, 8),
    ]


def test_null_and_empty_pages(spark):
    df = page(spark, None, "")
    assert pages.extract_quote_rows(df).count() == 0
    assert pages.extract_story_items(df, SITE).count() == 0
    got = pages.extract_article(df, SITE).first()
    assert (got["title"], got["author"], got["body"], got["publish_date_utc"]) == (
        "", SITE.name, "", None
    )


def test_marked_rows_win_over_class_rows(spark):
    html = (
        f'<tr class="row">{SYMBOL.format("A")}{PRICE.format("1")}{CELLS}</tr>'
        f'<tr data-testid="data-table-v2-row">{SYMBOL.format("B x")}{PRICE.format("$1,000.5")}{CELLS}</tr>'
        f'<tr data-testid="data-table-v2-row">{SYMBOL.format("C")}</tr>'
    )
    got = quotes(spark, html).collect()
    assert [(r["symbol"], r["price"], r["name"]) for r in got] == [("B", 1000.5, "N/A")]


def test_quote_fields(spark):
    def stream(field, inner):
        return f'<td><fin-streamer data-field="{field}">{inner}</fin-streamer></td>'

    html = '<table><tr class="my-row">' + "".join([
        SYMBOL.format("btc-usd "), '<td data-testid-cell="companyshortname.raw">x<div class="companyName">Bit &amp; Co</div></td>',
        stream("regularMarketPrice", "5"),
        stream("regularMarketChange", 'no <span class="txt-negative">-1.5</span>'),
        stream("regularMarketChangePercent", "+2.5%"),
        stream("regularMarketVolume", ""),
        stream("marketCap", "1.2T"),
        '<td data-testid-cell="peratio.lasttwelvemonths">--</td>',
        stream("fiftyTwoWeekChangePercent", "12%"),
        '<td data-testid-cell="fiftyTwoWeekRange"><div class="labels"><span>1</span></div></td>',
    ]) + "</tr></table>"
    r = quotes(spark, html).first()
    assert (r["symbol"], r["name"], r["price"]) == ("btc-usd", "Bit & Co", 5.0)
    assert (r["change_amount"], r["change_percent"]) == (-1.5, 2.5)
    assert (r["volume"], r["market_cap"], r["pe_ratio"]) == ("N/A", "1.2T", 0.0)
    # no coloured span: the 52-week change has no fallback; one label: no range
    assert (r["week52_change"], r["week52_range"]) == (0.0, "N/A")
    assert r["url"] == "https://quotes.example.com/quote/btc-usd/"


def test_rows_without_symbol_or_price_are_dropped(spark):
    html = "".join(
        f'<tr class="row">{s}{p}{CELLS}</tr>' for s, p in [
            ("<td></td>", PRICE.format("1")), (SYMBOL.format("A"), "<td></td>"),
            (SYMBOL.format(" "), PRICE.format("1")), (SYMBOL.format("N/A"), PRICE.format("1")),
            (SYMBOL.format("A"), PRICE.format(" ")),
        ]
    )
    assert quotes(spark, html).count() == 0


def story(*parts):
    return f'<section data-testid="storyitem">{"".join(parts)}</section>'


def test_stories(spark):
    html = "".join([
        story("<h3>One &lt;1&gt;</h3>", '<a href="/a">x</a>', '<div class="publishing">Wire • 2h ago • x</div>'),
        story('<a href="/b">x</a>'),
        story("<h3>No link</h3>", "<a>x</a>"),
        story("<h3>Four</h3>", '<a href="https://else.example.org/d">x</a>', '<time class="a">2h</time>'),
        story("<h3>Five</h3>", '<a href="//cdn.example.org/e">x</a>'),
    ])
    got = rows(
        pages.extract_story_items(page(spark, html), SITE),
        "story_no", "headline", "url", "publisher", "published_text",
    )
    assert got == [
        (0, "One <1>", "https://news.example.com/a", "Wire", "2h ago"),
        (3, "Four", "https://else.example.org/d", SITE.name, None),
        (4, "Five", "https://cdn.example.org/e", SITE.name, None),
    ]
    few = pages.extract_story_items(page(spark, html), SITE, max_per_page=3)
    assert rows(few, "story_no") == [(0,)]


def test_symbols(spark):
    html = (
        '<span class="ticker-wrapper"><b><span class="u-symbol">eth-usd x</span></b></span>'
        '<span class="ticker-wrapper"><span>none</span></span><span class="symbol">OUT</span>'
        '<fin-streamer data-symbol=" es_f "></fin-streamer><fin-streamer data-symbol="N/A"></fin-streamer>'
    )
    got = pages.extract_symbols_html(page(spark, html)).first()["stock_symbols"]
    assert got == ["ES", "ES_F", "ETH", "ETH-USD"]


def test_article_and_unclosed_paragraphs(spark):
    html = (
        '<h1 data-testid="hero-header-title"> A  title </h1><time>March 5, 2024</time>'
        '<div data-testid="author-profile">By Me</div>'
        '<div data-testid="article-body"><p>one<p>two <i>x</i></p><script>no</script> not in a paragraph</div><p>out</p>'
    )
    r = pages.extract_article(page(spark, html), SITE).first()
    assert (r["title"], r["author"], r["body"]) == ("A title", "By Me", "one two x")
    assert r["publish_date_iso"] == "2024-03-04T16:00:00+00:00"


def test_posts_and_chunks(spark):
    stories = spark.createDataFrame(
        [("u1", "Head 1", "Wire", ["A"]), ("u2", "Head 2", "Wire", [])],
        "url string, headline string, publisher string, stock_symbols array<string>",
    )
    articles = spark.createDataFrame(
        [("u1", "Me", 86400, "old"), ("u1", "Me", 172800, "Body http://x !")],
        "url string, author string, publish_date_utc long, body string",
    )
    posts = pages.build_posts(stories, articles, SITE, F.timestamp_seconds(F.lit(0)))
    got = rows(posts, "url", "created_iso", "author", "text_raw")
    assert got == [
        ("u1", "1970-01-03T00:00:00+00:00", "Me", "Body http://x !"),
        ("u2", "1970-01-01T00:00:00+00:00", SITE.name, "Head 2"),
    ]
    ids = [r[0] for r in posts.select("post_id").collect()]
    assert len(set(ids)) == 2 and ids == [r[0] for r in posts.select("post_id").collect()]
    chunk = pages.build_chunks(posts, SITE).where("url_count = 1").first()
    assert (chunk["date_bucket"], chunk["token_count"], chunk["emoji_count"]) == ("1970-01-03", 3, 2)


def test_addresses_are_resolved_as_browsers_do(spark):
    from urllib.parse import urljoin

    hrefs = ["/x/y", "x/y", "../x", "./x?q=1", "../../x/", "/../x", "?q=1", "#part", "//cdn.example.com/x", "https://a.b/c", "mailto:a@b"]
    base = "https://news.example.com"
    df = spark.createDataFrame([(h,) for h in hrefs], "href string")
    got = df.select("href", pages.absolute_url(F.col("href"), base).alias("url")).collect()
    assert {r["href"]: r["url"] for r in got} == {h: urljoin(base, h) for h in hrefs}


def test_pages_reach_python_in_batches_of_bounded_bytes(spark):
    """A task's memory for nodes does not grow with its pages."""
    import pyarrow as pa

    def size(part: pa.Array) -> pa.Array:
        return pa.array([part.nbytes] * len(part), pa.int64())

    df = spark.range(600, numPartitions=1).select(F.repeat(F.lit("<tr><td>x</td></tr>"), 2000).alias("html"))
    most = df.select(F.arrow_udf(size, "bigint")("html").alias("n")).agg(F.max("n")).first()[0]
    assert most < 3 * 2**20
