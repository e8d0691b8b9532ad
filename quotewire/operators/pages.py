"""Rows out of landed HTML pages: quote tables, story lists and articles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewire.functions.common import let
from quotewire.functions.dates import date_bucket, now_utc, parse_publish_date
from quotewire.functions.html import (
    descend,
    each,
    first,
    has_attr,
    has_class,
    html_nodes,
    text_of,
)
from quotewire.functions.numbers import safe_float
from quotewire.functions.symbols import base_symbol
from quotewire.functions.text import clean_text, strip, symbol_char_count, token_count, url_count
from quotewire.operators.keyed import lookup_join, pick_last

# Markers in the pages and the texts that stand for "no value".
QUOTE_ROW = ("data-testid", "data-table-v2-row")
NAME_CELL = ("data-testid-cell", "companyshortname.raw")
PE_CELL = ("data-testid-cell", "peratio.lasttwelvemonths")
RANGE_CELL = ("data-testid-cell", "fiftyTwoWeekRange")
STORY = ("data-testid", "storyitem")
MISSING = "N/A"
NO_SYMBOL = ("N/A", "--", "")
NO_RATIO = ("--", "-", "N/A")


@dataclass(frozen=True)
class Site:
    """What a crawl knows about the site it landed pages from."""

    name: str
    platform: str
    quote_base_url: str = ""
    article_base_url: str = ""
    quotes_url: str | None = None


@dataclass(frozen=True)
class ArticleMarkers:
    """Where an article page keeps its parts: (tag, attribute, value)."""

    title: tuple[str, str | None, str | None] = ("h1", "data-testid", "hero-header-title")
    time: tuple[str, str | None, str | None] = ("time", None, None)
    author: tuple[str, str | None, str | None] = ("div", "data-testid", "author-profile")
    body: tuple[str, str | None, str | None] = ("div", "data-testid", "article-body")


def _is(tag: str, attr: str | None = None, value: str | None = None):
    if attr is None:
        return lambda n: n["tag"] == tag
    return lambda n: (n["tag"] == tag) & has_attr(n, attr, value)


# --- quote tables ---------------------------------------------------------------------


def extract_quote_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per table row with at least five cells: page columns, row_no, nodes.

    Rows carry the marker attribute; a page without any falls back to rows whose
    class contains 'row'.
    """
    cells = F.size(F.filter("nodes", lambda n: n["tag"].isin("td", "th")))
    whole = lambda row: F.struct(row.alias("nodes"))
    marked = each(F.col("_nodes"), _is("tr", *QUOTE_ROW), whole)
    by_class = each(F.col("_nodes"), lambda n: (n["tag"] == "tr") & has_class(n, "row"), whole)
    keys = [c for c in pages.columns if c != html]
    return (
        pages.select(*keys, html_nodes(F.col(html)).alias("_nodes"))
        .withColumn("_rows", let(marked, lambda m: F.when(F.size(m) > 0, m).otherwise(by_class)))
        # the outer form, as the plain one would work out the rows a second time to filter them
        .select(*keys, F.posexplode_outer("_rows").alias("row_no", "_row"))
        .where("row_no IS NOT NULL")
        .select(*keys, "row_no", "_row.nodes")
        .where(cells >= 5)
    )


def _streamer(nodes: Column, field: str) -> Column:
    return descend(nodes, _is("fin-streamer", "data-field", field))


def _coloured(nodes: Column) -> Column:
    """Text of the first span coloured as a rise or fall, or NULL."""
    return text_of(descend(nodes, lambda n: (n["tag"] == "span")
                           & (has_class(n, "txt-positive") | has_class(n, "txt-negative"))))


def _coloured_or_plain(nodes: Column) -> Column:
    return let(nodes, lambda ns: F.coalesce(_coloured(ns), text_of(ns)))


def _or_missing(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(MISSING))


def parse_quote_row(rows: DataFrame, site: Site) -> DataFrame:
    """Quote columns of every extracted row; rows without symbol or price are dropped."""
    n = F.col("nodes")
    keys = [c for c in rows.columns if c != "nodes"]

    def name(cell: Column) -> Column:
        div = descend(cell, lambda x: (x["tag"] == "div") & has_class(x, "companyName"))
        return F.coalesce(text_of(div), text_of(cell))

    symbol = text_of(descend(n, lambda x: (x["tag"] == "span") & has_class(x, "symbol")))
    range_labels = descend(
        descend(n, _is("td", *RANGE_CELL)), lambda x: (x["tag"] == "div") & has_class(x, "labels")
    )
    texts = rows.select(
        *keys,
        F.nullif(F.split_part(symbol, F.lit(" "), F.lit(1)), F.lit("")).alias("symbol"),
        F.coalesce(let(descend(n, _is("td", *NAME_CELL)), name), F.lit(MISSING)).alias("name"),
        F.nullif(text_of(_streamer(n, "regularMarketPrice")), F.lit("")).alias("price"),
        _coloured_or_plain(_streamer(n, "regularMarketChange")).alias("change_amount"),
        _coloured_or_plain(_streamer(n, "regularMarketChangePercent")).alias("change_percent"),
        _or_missing(text_of(_streamer(n, "regularMarketVolume"))).alias("volume"),
        _or_missing(text_of(_streamer(n, "marketCap"))).alias("market_cap"),
        text_of(descend(n, _is("td", *PE_CELL))).alias("pe_ratio"),
        _coloured(_streamer(n, "fiftyTwoWeekChangePercent")).alias("week52_change"),
        each(range_labels, _is("span"), text_of).alias("_range"),
    ).where("symbol != 'N/A' AND price != 'N/A'")
    return texts.select(
        *keys, "symbol", "name",
        safe_float(F.col("price")).alias("price"),
        safe_float(F.col("change_amount")).alias("change_amount"),
        safe_float(F.replace("change_percent", F.lit("%"), F.lit(""))).alias("change_percent"),
        "volume", "market_cap",
        safe_float(F.when(~F.col("pe_ratio").isin(*NO_RATIO), F.col("pe_ratio"))).alias("pe_ratio"),
        safe_float(F.replace("week52_change", F.lit("%"), F.lit(""))).alias("week52_change"),
        F.when(F.size("_range") >= 2, F.concat_ws(" - ", F.col("_range")[0], F.col("_range")[1]))
        .otherwise(MISSING).alias("week52_range"),
        now_utc().alias("timestamp"),
        F.concat(F.lit(f"{site.quote_base_url}/quote/"), "symbol", F.lit("/")).alias("url"),
    )


# --- story lists ----------------------------------------------------------------------


def _section_symbols(nodes: Column) -> Column:
    """Sorted distinct base and full symbols named in a story section."""

    def wrapped(wrapper: Column) -> Column:
        span = descend(wrapper, lambda n: (n["tag"] == "span") & has_class(n, "symbol"))
        return F.upper(F.split_part(text_of(span), F.lit(" "), F.lit(1)))

    in_wrappers = each(nodes, lambda n: (n["tag"] == "span") & has_class(n, "ticker-wrapper"), wrapped)
    in_streamers = F.transform(
        F.filter(nodes, _is("fin-streamer", "data-symbol")),
        lambda s: F.upper(strip(s["attrs"]["data-symbol"])),
    )
    full = F.filter(
        F.concat(in_wrappers, in_streamers), lambda s: s.isNotNull() & ~s.isin(*NO_SYMBOL)
    )
    both = let(full, lambda f: F.concat(f, F.transform(f, lambda s: base_symbol(s, "-_"))))
    return F.array_sort(F.array_distinct(both))


def absolute_url(href: Column, base: str) -> Column:
    """``href`` resolved against ``base``, the address of a site without a path.

    Dot steps at the start of a path lead nowhere above the root, so they go.
    """
    root = base.rstrip("/")
    scheme = root.split(":", 1)[0]
    path = F.regexp_replace(href, r"^/?(\.{1,2}(/|$))+", "")
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(f"{scheme}:"), href))
        .when(href == "", F.lit(base))
        .when(href.startswith("?") | href.startswith("#"), F.concat(F.lit(base), href))
        .when(path.startswith("/"), F.concat(F.lit(root), path))
        .otherwise(F.concat(F.lit(f"{root}/"), path))
    )


def extract_story_items(
    pages: DataFrame, site: Site, max_per_page: int | None = None, html: str = "html"
) -> DataFrame:
    """One row per story section: page columns, story_no, headline, url, publisher,
    published_text, stock_symbols.

    ``max_per_page`` keeps the first sections of each page, counted before those
    without headline or link are dropped.
    """
    sections = each(
        F.col("_nodes"), _is("section", *STORY), lambda nodes: F.struct(nodes.alias("nodes"))
    )
    n = F.col("_section.nodes")
    info = descend(
        n, lambda x: F.coalesce(x["attrs"]["class"].rlike("(?i)publishing|time"), F.lit(False))
    )
    link = first(n, _is("a", "href"))["attrs"]["href"]
    keys = [c for c in pages.columns if c != html]
    stories = (
        pages.select(*keys, html_nodes(F.col(html)).alias("_nodes"))
        .select(*keys, F.posexplode_outer(sections).alias("story_no", "_section"))
        .where("story_no IS NOT NULL")
    )
    if max_per_page is not None:
        stories = stories.where(F.col("story_no") < max_per_page)
    return (
        stories.select(
            *keys, "story_no",
            text_of(descend(n, _is("h3"))).alias("headline"),
            absolute_url(strip(link), site.article_base_url).alias("url"),
            F.split(text_of(info), "•").alias("_info"),
            _section_symbols(n).alias("stock_symbols"),
        )
        .where("headline IS NOT NULL AND url IS NOT NULL")
        .withColumn("_dated", F.coalesce(F.size("_info") >= 2, F.lit(False)))
        .select(
            *keys, "story_no", "headline", "url",
            F.when(F.col("_dated"), strip(F.col("_info")[0])).otherwise(site.name).alias("publisher"),
            F.when(F.col("_dated"), strip(F.col("_info")[1])).alias("published_text"),
            "stock_symbols",
        )
    )


def extract_symbols_html(
    sections: DataFrame, html: str = "html", out: str = "stock_symbols"
) -> DataFrame:
    """Adds the sorted symbols named in a column of story-section HTML."""
    return (
        sections.withColumn("_nodes", html_nodes(F.col(html)))
        .withColumn(out, _section_symbols(F.col("_nodes")))
        .drop("_nodes")
    )


# --- articles -------------------------------------------------------------------------


def extract_article(
    pages: DataFrame, site: Site, markers: ArticleMarkers = ArticleMarkers(), html: str = "html"
) -> DataFrame:
    """Title, author, publish date (ISO text and epoch seconds) and body of each page.

    Missing parts give '' (author: the site's name, dates: NULL).
    """
    n = F.col("_nodes")

    def part(marker: tuple[str, str | None, str | None]) -> Column:
        return descend(n, _is(*marker))

    paragraphs = each(part(markers.body), _is("p"), text_of)
    keys = [c for c in pages.columns if c != html]
    return (
        pages.select(*keys, html_nodes(F.col(html)).alias("_nodes"))
        .select(
            *keys,
            F.coalesce(text_of(part(markers.title)), F.lit("")).alias("title"),
            F.coalesce(text_of(part(markers.author)), F.lit(site.name)).alias("author"),
            F.nullif(text_of(part(markers.time)), F.lit("")).alias("_time"),
            clean_text(F.array_join(paragraphs, " ")).alias("body"),
        )
        .withColumn("_published", parse_publish_date(F.col("_time")))
        .drop("_time")
        .withColumn("publish_date_iso", _iso(F.col("_published")))
        .withColumn("publish_date_utc", F.unix_seconds("_published"))
        .drop("_published")
    )


def _iso(time: Column) -> Column:
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def build_posts(
    stories: DataFrame, articles: DataFrame, site: Site, fetched_at: Column | None = None
) -> DataFrame:
    """Post rows: each story with its article page, joined on ``url``.

    A story without article keeps its headline as text and ``fetched_at`` (default:
    now) as time. The id is a hash of the URL, so a rerun gives the same one.
    """
    fetched = F.current_timestamp() if fetched_at is None else fetched_at
    created = F.coalesce("publish_date_utc", F.unix_seconds(fetched))
    article = pick_last(
        articles.select("url", "author", "publish_date_utc", "body"),
        ["url"], ["publish_date_utc"],
    )
    joined = lookup_join(stories, article, "url", how="left")
    return joined.select(
        F.sha2("url", 256).alias("post_id"),
        created.alias("created_utc"),
        _iso(F.timestamp_seconds(created)).alias("created_iso"),
        F.lit("finance").alias("subreddit"),
        F.coalesce("author", F.lit(site.name)).alias("author"),
        F.lit(0).alias("score"),
        F.lit(0).alias("num_comments"),
        F.coalesce(F.nullif("body", F.lit("")), "headline").alias("text_raw"),
        "url",
        F.lit(site.name).alias("source"),
        F.lit("article").alias("type"),
        "headline",
        "publisher",
        "stock_symbols",
        F.lit(site.quotes_url).cast("string").alias("most_active_stocks_url"),
    )


def build_chunks(posts: DataFrame, site: Site, lang: str = "en") -> DataFrame:
    """One chunk row per post, with text measures."""
    text = F.col("text_raw")
    return posts.select(
        "post_id",
        F.lit(None).cast("string").alias("parent_id"),
        F.lit(0).alias("chunk_idx"),
        F.lit(1).alias("chunk_total"),
        F.col("created_utc").alias("timestamp_utc"),
        date_bucket(F.col("created_utc")).alias("date_bucket"),
        "source",
        F.lit(site.platform).alias("platform"),
        "author",
        F.col("stock_symbols").alias("tickers"),
        "stock_symbols",
        url_count(text).alias("url_count"),
        symbol_char_count(text).alias("emoji_count"),
        token_count(text).alias("token_count"),
        text.alias("clean_text"),
        F.lit(lang).alias("lang"),
        "most_active_stocks_url",
    )
