"""Queries of page extraction.

The given pages are articles without markers. Quote tables, story lists and marked
articles are pages that Spark writes from the part and documents tables, at most 25
rows to a page, so that what is extracted can be checked against those tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewire.operators import pages
from quotewire.plans.catalog import query, rounded
from quotewire.plans.inputs import EPOCH_2024, SITE, Inputs
from quotewire.plans.scalar_queries import OTHER_SQL, SPACE_SQL

ROWS_PER_PAGE = 25
STORIES_PER_PAGE = 20


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def _html(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _pages(rows: DataFrame, page: Column, key: str, head: str, tail: str) -> DataFrame:
    """Pages of consecutive rows: (page_no, html)."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(key), F.col("row_html"))))
    body = F.array_join(F.transform(parts, lambda p: p["row_html"]), "\n")
    return rows.groupBy(page.cast("long").alias("page_no")).agg(
        F.concat(F.lit(head), body, F.lit(tail)).alias("html")
    )


# --- quote tables ---------------------------------------------------------------------


def quote_pages(t: Inputs) -> DataFrame:
    """Quote tables of the parts.

    Every fifth page marks its rows by class only; every tenth row has too few cells;
    every eleventh lacks a symbol; changes are in a coloured span or bare by turns.
    """
    key = F.col("p_partkey")
    page = F.floor(key / ROWS_PER_PAGE)
    change = (key % 21 - 10).cast("string")

    def streamer(field: str, inner: Column) -> Column:
        return _html(f'<td><fin-streamer class="v" data-field="{field}">', inner, "</fin-streamer></td>")

    span = _html('<span class="txt-positive up">', change, ".50</span>")
    bare = F.when(key % 2 == 0, span).otherwise(_html(" ", change, ".50 "))
    percent = F.when(
        key % 2 == 0, _html('<span class="txt-negative">(', change, ".25%)</span>")
    ).otherwise(_html("+1,0", F.lpad((key % 100).cast("string"), 2, "0"), "%"))
    name = F.when(
        key % 3 == 0, _html('<div class="lt companyName x">', _escaped(F.col("p_name")), "</div><i>Inc</i>")
    ).otherwise(_html(" ", _escaped(F.col("p_name")), " "))
    cells = _html(
        '<td><a href="#"><span class="symbol yf">', F.when(key % 11 == 0, " ")
        .otherwise(_html(" P", key.cast("string"), " extra ")), "</span></a></td>",
        '<td data-testid-cell="companyshortname.raw">', name, "</td>",
        streamer("regularMarketPrice", F.format_string("%,.2f", F.col("p_retailprice") * 10)),
        streamer("regularMarketChange", bare),
        streamer("regularMarketChangePercent", percent),
        streamer("regularMarketVolume", _html(key.cast("string"), ".5M")),
        streamer("marketCap", F.when(key % 4 == 0, "").otherwise(_html(key.cast("string"), "B"))),
        '<td data-testid-cell="peratio.lasttwelvemonths">',
        F.when(key % 7 == 0, "--").otherwise(F.col("p_size").cast("string")), "</td>",
        streamer("fiftyTwoWeekChangePercent", F.when(
            key % 2 == 0, _html('<span class="txt-positive">', F.col("p_size").cast("string"), "%</span>")
        ).otherwise("12%")),
        '<td data-testid-cell="fiftyTwoWeekRange"><div class="labels"><span>', key.cast("string"),
        "</span> <span>", (key + 5).cast("string"), "</span></div></td>",
    )
    short = _html('<td><span class="symbol">X</span></td><td>', key.cast("string"), "</td>")
    mark = F.when(page % 5 == 0, '<tr class="row yf">').otherwise(
        '<tr class="row yf" data-testid="data-table-v2-row">'
    )
    rows = t.table("part").select(
        key, page.alias("page"), _html(mark, F.when(key % 10 == 0, short).otherwise(cells), "</tr>")
        .alias("row_html"),
    )
    head = '<html><script>var r="<tr>";</script><body><table><tr><th>Symbol</th></tr>'
    return _pages(rows, F.col("page"), "p_partkey", head, "</table></body></html>")


_SHOWN = """SELECT *, p_partkey // 25 AS page_no, 'P' || p_partkey AS symbol,
    row_number() OVER (PARTITION BY p_partkey // 25 ORDER BY p_partkey) - 1 AS row_no FROM part"""


@query(
    "extract_quote_rows",
    f"""SELECT page_no, row_no, 1 + CAST(p_partkey % 11 <> 0 AS BIGINT) AS lit_up
    FROM ({_SHOWN}) WHERE p_partkey % 10 <> 0""",
)
def extract_quote_rows(t: Inputs) -> DataFrame:
    rows = pages.extract_quote_rows(quote_pages(t))
    symbol = F.exists("nodes", lambda n: n["text"].contains("extra"))
    return rows.select("page_no", "row_no", F.when(symbol, 2).otherwise(1).alias("lit_up"))


@query(
    "parse_quote_row",
    rounded(
        f"""SELECT page_no, row_no, symbol, trim(p_name) AS name,
            round(p_retailprice * 10, 2) AS price,
            CASE WHEN c < 0 THEN c - 0.5 WHEN c = 0 THEN 0.5 ELSE c + 0.5 END AS change_amount,
            CASE WHEN p_partkey % 2 = 0 THEN 0.0 ELSE 1000.0 + p_partkey % 100 END AS change_percent,
            p_partkey || '.5M' AS volume,
            CASE WHEN p_partkey % 4 = 0 THEN 'N/A' ELSE p_partkey || 'B' END AS market_cap,
            CASE WHEN p_partkey % 7 = 0 THEN 0.0 ELSE p_size END AS pe_ratio,
            CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 0.0 END AS week52_change,
            p_partkey || ' - ' || (p_partkey + 5) AS week52_range,
            'https://quotes.example.com/quote/' || symbol || '/' AS url
        FROM (SELECT *, p_partkey % 21 - 10 AS c FROM ({_SHOWN}))
        WHERE p_partkey % 10 <> 0 AND p_partkey % 11 <> 0""",
        "price", "change_amount", "change_percent", "pe_ratio", "week52_change",
    ),
)
def parse_quote_row(t: Inputs) -> DataFrame:
    rows = pages.extract_quote_rows(quote_pages(t))
    return pages.parse_quote_row(rows, SITE).drop("timestamp")


# --- story lists ----------------------------------------------------------------------


def _story_html() -> Column:
    key = F.col("doc_id")
    n = key.cast("string")
    tickers = F.when(key % 4 == 0, "").otherwise(_html(
        '<span class="ticker-wrapper a"><span class="b"><span class="c symbol">btc', (key % 10).cast("string"),
        '-usd  </span></span></span><span class="ticker-wrapper"><i>none</i></span>',
        '<fin-streamer data-symbol="es', (key % 7).cast("string"), '_f"></fin-streamer>',
        '<fin-streamer data-symbol="--"></fin-streamer>',
    ))
    headline = F.when(key % 9 == 0, "").otherwise(
        _html("<h3>", _escaped(F.substring("text", 1, 60)), "</h3>")
    )
    href = (
        F.when(key % 3 == 0, _html("/story-", n, ".html"))
        .when(key % 3 == 1, _html("https://other.example.org/", n))
        .otherwise(_html("story-", n))
    )
    info = F.when(
        key % 2 == 0,
        _html('<div class="Publishing">', F.col("source"), " • ", n, " minutes ago</div>"),
    ).otherwise(_html('<div class="timestamp">', n, " minutes ago</div>"))
    return _html(
        '<section data-testid="storyitem">', headline, '<a href="', href, '">more</a>', info,
        tickers, "</section>",
    )


def story_pages(t: Inputs) -> DataFrame:
    """Story lists of the documents; every ninth story has no headline."""
    rows = t.table("documents").select("doc_id", _story_html().alias("row_html"))
    return _pages(
        rows, F.floor(F.col("doc_id") / STORIES_PER_PAGE), "doc_id",
        "<html><body><section><h3>Latest</h3></section>", "</body></html>",
    )


_STORIES = f"""
    SELECT doc_id // {STORIES_PER_PAGE} AS page_no, row_number() OVER (
            PARTITION BY doc_id // {STORIES_PER_PAGE} ORDER BY doc_id) - 1 AS story_no,
        trim(regexp_replace(substr(text, 1, 60), '[{SPACE_SQL}]+', ' ', 'g')) AS headline,
        CASE doc_id % 3 WHEN 0 THEN 'https://news.example.com/story-' || doc_id || '.html'
            WHEN 1 THEN 'https://other.example.org/' || doc_id
            ELSE 'https://news.example.com/story-' || doc_id END AS url,
        CASE WHEN doc_id % 2 = 0 THEN source ELSE 'Example Wire' END AS publisher,
        CASE WHEN doc_id % 2 = 0 THEN doc_id || ' minutes ago' END AS published_text,
        CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'BTC' || doc_id % 10 || ',BTC' || doc_id % 10
            || '-USD,ES' || doc_id % 7 || ',ES' || doc_id % 7 || '_F' END AS stock_symbols,
        doc_id FROM documents"""


@query(
    "extract_story_items",
    f"SELECT * EXCLUDE (doc_id) FROM ({_STORIES}) WHERE story_no < 15 AND doc_id % 9 <> 0",
)
def extract_story_items(t: Inputs) -> DataFrame:
    return pages.extract_story_items(story_pages(t), SITE, max_per_page=15)


@query("extract_symbols_html", f"SELECT doc_id, stock_symbols FROM ({_STORIES})")
def extract_symbols_html(t: Inputs) -> DataFrame:
    sections = t.table("documents").select("doc_id", _story_html().alias("html"))
    return pages.extract_symbols_html(sections).drop("html")


# --- articles -------------------------------------------------------------------------


def article_pages(t: Inputs) -> DataFrame:
    """Marked article pages of the documents, a paragraph to a line; every sixth has no
    body, every seventh no date."""
    key = F.col("doc_id")
    n = key.cast("string")
    created = F.timestamp_seconds(F.lit(EPOCH_2024) + key % 30 * 86400 + key % 24 * 3600)
    date = F.date_format(created, "EEE, MMMM d, yyyy 'at' h:mm a")
    paragraphs = F.array_join(
        F.transform(F.split("text", "\n"), lambda p: _html("<p>", _escaped(p), "</p>")), "\n<br/>"
    )
    html = _html(
        '<html><head><title>t</title></head><body><h1>Site</h1><h1 data-testid="hero-header-title">',
        _escaped(F.substring("text", 1, 60)), "</h1>",
        F.when(key % 7 == 0, "").otherwise(_html("<time>", date, "</time>")),
        F.when(key % 2 == 0, _html('<div data-testid="author-profile"> by  <b>', F.col("lang"), "</b></div>"))
        .otherwise(""),
        F.when(key % 6 == 0, "").otherwise(
            _html('<div class="x" data-testid="article-body"><div>', paragraphs, "</div></div>")
        ),
        "<p>Footer</p></body></html>",
    )
    url = (
        F.when(key % 3 == 0, _html("https://news.example.com/story-", n, ".html"))
        .when(key % 3 == 1, _html("https://other.example.org/", n))
        .otherwise(_html("https://news.example.com/story-", n))
    )
    return t.table("documents").select(url.alias("url"), html.alias("html"))


_ARTICLES = f"""
        SELECT CASE doc_id % 3 WHEN 0 THEN 'https://news.example.com/story-' || doc_id || '.html'
                WHEN 1 THEN 'https://other.example.org/' || doc_id
                ELSE 'https://news.example.com/story-' || doc_id END AS url,
            trim(regexp_replace(substr(text, 1, 60), '[{SPACE_SQL}]+', ' ', 'g')) AS title,
            CASE WHEN doc_id % 2 = 0 THEN 'by ' || lang ELSE 'Example Wire' END AS author,
            CASE WHEN doc_id % 6 = 0 THEN ''
                ELSE trim(regexp_replace(text, '[{SPACE_SQL}]+', ' ', 'g')) END AS body,
            CASE WHEN doc_id % 7 <> 0 THEN utc END AS publish_date_utc, doc_id
        FROM (SELECT *, {EPOCH_2024} + doc_id % 30 * 86400 + doc_id % 24 * 3600 - 8 * 3600 AS utc
            FROM documents)"""


_ISO = "strftime(make_timestamp({0} * 1000000), '%Y-%m-%dT%H:%M:%S+00:00')"


@query(
    "extract_article_marked",
    f"""SELECT * EXCLUDE (doc_id), {_ISO.format("publish_date_utc")} AS publish_date_iso
    FROM ({_ARTICLES})""",
)
def extract_article_marked(t: Inputs) -> DataFrame:
    return pages.extract_article(article_pages(t), SITE)


# Headings, bodies and paragraphs of the given pages carry no marker attributes.
LANDED = pages.ArticleMarkers(title=("h1", None, None), body=("article", None, None))
# The two entities that occur; HTML reads them without the semicolon too, as in a cut title.
_ENTITIES = "regexp_replace(regexp_replace({0}, '&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"


def _text_sql(html: str) -> str:
    """Text of an HTML fragment, in SQL."""
    text = _ENTITIES.format(f"regexp_replace({html}, '<[^>]*>', '', 'g')")
    return f"trim(regexp_replace({text}, '[{SPACE_SQL}]+', ' ', 'g'))"


@query(
    "extract_article",
    f"""SELECT page_id, url, {_text_sql("title")} AS title, 'Example Wire' AS author,
        CAST(NULL AS VARCHAR) AS publish_date_iso, CAST(NULL AS BIGINT) AS publish_date_utc,
        {_text_sql("regexp_replace(body, '</?p>', ' ', 'g')")} AS body
    FROM (SELECT *, regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS title,
        regexp_extract(html, '<article>.*?(<p>.*)</article>', 1, 's') AS body FROM pages)""",
)
def extract_article(t: Inputs) -> DataFrame:
    return pages.extract_article(t.table("pages"), SITE, LANDED)


def _built_posts(t: Inputs) -> DataFrame:
    stories = pages.extract_story_items(story_pages(t), SITE)
    articles = pages.extract_article(article_pages(t), SITE)
    fetched = F.timestamp_seconds(F.lit(EPOCH_2024))
    return pages.build_posts(stories, articles, SITE, fetched)


_POSTS = f"""
    SELECT sha256(url) AS post_id, created_utc, {_ISO.format("created_utc")} AS created_iso,
        'finance' AS subreddit, author, 0 AS score, 0 AS num_comments,
        CASE WHEN body = '' THEN headline ELSE body END AS text_raw, url, 'Example Wire' AS source,
        'article' AS type, headline, publisher, stock_symbols,
        '{SITE.quotes_url}' AS most_active_stocks_url
    FROM (SELECT s.*, a.author, a.body, coalesce(a.publish_date_utc, {EPOCH_2024}) AS created_utc
        FROM ({_STORIES}) s JOIN ({_ARTICLES}) a USING (doc_id) WHERE doc_id % 9 <> 0)"""


@query("build_posts", _POSTS)
def build_posts(t: Inputs) -> DataFrame:
    return _built_posts(t)


@query(
    "build_chunks",
    f"""SELECT post_id, CAST(NULL AS VARCHAR) AS parent_id, 0 AS chunk_idx, 1 AS chunk_total,
        created_utc AS timestamp_utc, substr(created_iso, 1, 10) AS date_bucket, source,
        'example_wire' AS platform, author, stock_symbols AS tickers, stock_symbols,
        len(regexp_extract_all(text_raw, 'https?://')) AS url_count,
        len(regexp_extract_all(text_raw, '{OTHER_SQL}')) AS emoji_count,
        len(regexp_extract_all(text_raw, '[^{SPACE_SQL}]+')) AS token_count, text_raw AS clean_text,
        'en' AS lang, most_active_stocks_url FROM ({_POSTS})""",
)
def build_chunks(t: Inputs) -> DataFrame:
    return pages.build_chunks(_built_posts(t), SITE)
