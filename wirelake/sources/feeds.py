"""Feeds and sitemaps as rows. Input: ``documents(feed_url, feed_domain, body)``.

Bytes land as files (``spark.read.format("binaryFile")``); ``functions.text.decode_bytes``
turns them into text with the declared character set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.functions import dates, html, text, urls

# Marks of news sitemap addresses, and the names of standard sitemaps' post pages.
SITEMAP_MARKS = ("/sitemap/", "sitemap-news", "news-sitemap", "sitemap_news", "news.xml", "/noticias/sitemap.xml", "/noticia/sitemap.xml", "/news/sitemap.xml")
POST_PAGE = r"(?i)^(?:wp-sitemap-posts-post-(\d+)|post-sitemap(\d*))\.xml$"
NON_ARTICLE = ("category", "tag", "tags", "colunista", "dados", "autor", "author", "page", "search", "busca", "feed", "amp", "print", "rss")

_RSS = "channel struct<item: array<struct<title: string, link: string, pubDate: string, description: string, `content:encoded`: string, source: string>>>"
_ATOM = "entry array<struct<title: string, link: array<struct<_href: string, _rel: string>>, published: string, updated: string, summary: string, content: string>>"
_NEWS = "url array<struct<loc: string, lastmod: string, `news:news`: struct<`news:title`: string, `news:publication_date`: string>>>"
_INDEX = "sitemap array<struct<loc: string, lastmod: string>>"


def is_sitemap(url):
    """Whether a feed address is a news sitemap, by its marks; others are read as RSS or Atom."""
    return F.lower(url).rlike("|".join(m.replace(".", r"\.") for m in SITEMAP_MARKS))


def rss_entries(documents: DataFrame) -> DataFrame:
    """RSS and Atom documents to entries, in document order; an unreadable one gives none."""
    rss = documents.filter(F.col("body").rlike("<(?:rss|rdf:RDF)\\b")).select("feed_url", "feed_domain", F.posexplode(F.from_xml("body", _RSS)["channel"]["item"]).alias("pos", "e"))
    atom = documents.filter(F.col("body").rlike("<feed\\b")).select("feed_url", "feed_domain", F.posexplode(F.from_xml("body", _ATOM)["entry"]).alias("pos", "e"))
    a = rss.select("feed_url", "feed_domain", "pos", F.col("e.title").alias("title"), F.col("e.link").alias("link"), F.col("e.pubDate").alias("published"), F.lit(None).cast("string").alias("updated"), F.col("e.description").alias("summary"), F.col("e.content:encoded").alias("content"), F.col("e.source").alias("source"))
    alternate = F.filter("e.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    b = atom.select("feed_url", "feed_domain", "pos", F.col("e.title").alias("title"), F.get(alternate, F.lit(0))["_href"].alias("link"), F.col("e.published").alias("published"), F.col("e.updated").alias("updated"), F.col("e.summary").alias("summary"), F.col("e.content").alias("content"), F.lit(None).cast("string").alias("source"))
    return a.unionByName(b)


def entries_to_items(entries: DataFrame, aggregators: list[str], language: dict[str, str] | None = None) -> DataFrame:
    """Feed entries to item rows: link needed, redirect unwrapped, thin summary replaced by the lede."""
    link = urls.normalize(urls.unwrap_redirect(F.trim("link")))
    lede = F.left(F.array_join(text.prose(html.html_paragraphs(F.coalesce("content", F.lit("")))), " "), F.lit(text.LEDE_MAX))
    aggregated = F.col("feed_domain").isin(*aggregators) if aggregators else F.lit(False)
    langs = F.create_map(*[F.lit(x) for kv in language.items() for x in kv]) if language else None
    rows = entries.filter(~text.is_blank(F.col("link"))).withColumn("lede", lede).withColumn("summary", F.coalesce("summary", F.lit("")))
    thin = (text.visible_length(F.col("summary")) < text.SNIPPET_MIN) & (F.length("lede") > text.visible_length(F.col("summary")))
    return rows.select(
        link.alias("url"),
        F.when(aggregated, text.title_base(F.coalesce("title", F.lit("")))).otherwise(F.coalesce("title", F.lit(""))).alias("title"),
        F.when(thin, F.col("lede")).otherwise(F.col("summary")).alias("summary"),
        dates.parse_entry(F.col("published"), F.col("updated")).alias("published_at"),
        urls.host(link).alias("source_domain"),
        "feed_domain",
        F.lit("").alias("title_hint"),
        F.lit(None).cast("timestamp").alias("published_hint"),
        (F.try_element_at(langs, F.col("feed_domain")) if langs is not None else F.lit(None).cast("string")).alias("source_lang"),
        "feed_url",
        "pos",
    )


def sitemap_entries(documents: DataFrame) -> DataFrame:
    """``feed_url, feed_domain, pos, url, lastmod, title, published`` of url sets, news ones too."""
    e = documents.filter(F.col("body").contains("<urlset")).select("feed_url", "feed_domain", F.posexplode(F.from_xml("body", _NEWS)["url"]).alias("pos", "u"))
    return e.filter(~text.is_blank(F.col("u.loc"))).select(
        "feed_url", "feed_domain", "pos", F.trim("u.loc").alias("url"), dates.parse_iso(F.col("u.lastmod")).alias("lastmod"), F.col("u.news:news.news:title").alias("title"), dates.parse_iso(F.col("u.news:news.news:publication_date")).alias("published")
    )


def post_page(documents: DataFrame) -> DataFrame:
    """The newest post page of each sitemap index (the highest page number) and what the index claims.

    ``feed_url, page_url, page_no, index_claim, error``: an index without post page is an error.
    """
    s = documents.filter(F.col("body").contains("<sitemapindex")).select("feed_url", F.explode_outer(F.from_xml("body", _INDEX)["sitemap"]).alias("s"))
    name = F.regexp_extract(F.regexp_replace(urls.path(F.trim("s.loc")), "/+$", ""), "([^/]*)$", 1)
    no = F.when(name.rlike(POST_PAGE), F.coalesce(F.nullif(F.regexp_extract(name, POST_PAGE, 1), F.lit("")), F.nullif(F.regexp_extract(name, POST_PAGE, 2), F.lit("")), F.lit("1")).cast("int"))
    p = s.select("feed_url", F.trim("s.loc").alias("loc"), no.alias("no"), F.when(no.isNotNull(), dates.parse_iso(F.col("s.lastmod"))).alias("lastmod"))
    best = p.groupBy("feed_url").agg(F.max_by("loc", "no").alias("page_url"), F.max("no").alias("page_no"), F.max("lastmod").alias("index_claim"))
    return best.withColumn("error", F.when(F.col("page_no").isNull(), F.lit("no post page in the sitemap index"))).withColumn("page_url", F.when(F.col("page_no").isNotNull(), F.col("page_url")))


def without_copies(entries: DataFrame) -> DataFrame:
    """Without ``/slug-N`` where ``/slug`` (of three hyphens or more) is in the same sitemap."""
    p = F.regexp_replace(urls.path(F.col("url")), "/+$", "")
    e = entries.withColumn("path", p).withColumn("base", F.when(p.rlike(r"-\d{1,2}$"), F.regexp_replace(p, r"-\d{1,2}$", "")))
    e = e.withColumn("base", F.when(F.regexp_count(F.regexp_extract("base", "([^/]*)$", 1), F.lit("-")) >= 3, F.col("base")))
    have = e.select(F.col("feed_url").alias("f2"), F.col("path").alias("p2")).distinct()
    return e.join(have, (F.col("feed_url") == F.col("f2")) & (F.col("base") == F.col("p2")), "left_anti").drop("path", "base")


def fresh_sitemap_items(entries: DataFrame, as_of, hours: int = 96) -> DataFrame:
    """Item rows of entries no older than ``hours``; titles and summaries come later."""
    when = F.coalesce("published", "lastmod")
    kept = without_copies(entries).filter(dates.within_window(when, as_of, hours))
    return kept.select(urls.normalize(F.col("url")).alias("url"), F.coalesce("title", F.lit("")).alias("title"), F.lit("").alias("summary"), when.alias("published_at"), urls.host(F.col("url")).alias("source_domain"), "feed_domain", F.lit("").alias("title_hint"), F.lit(None).cast("timestamp").alias("published_hint"), F.lit(None).cast("string").alias("source_lang"), "feed_url", "pos")


def stale_page_report(pages: DataFrame, entries: DataFrame, slack_hours: int = 48) -> DataFrame:
    """Chosen pages whose newest entry is far older than the index claims."""
    newest = entries.groupBy("feed_url").agg(F.max("lastmod").alias("newest")).withColumnRenamed("feed_url", "page_url")
    far = F.col("newest").isNull() | (F.col("newest") < F.col("index_claim") - dates.hours(slack_hours))
    return pages.join(newest, "page_url", "left").filter(F.col("index_claim").isNotNull() & far)


def listing_items(pages: DataFrame) -> DataFrame:
    """Article links of listing pages ``(feed_url, feed_domain, body)``, one row per link.

    Same host, at least two path segments, none before the last that marks a list,
    and a slug of four hyphens or more; hints of repeated links: the first non-empty.
    """
    x = pages.select("feed_url", "feed_domain", F.explode(html.page_links("body")).alias("l"))
    u = urls.absolutise(F.col("l.href"), F.col("feed_url"))
    x = x.withColumn("url", urls.normalize(u)).filter(F.col("url").isNotNull() & (urls.host(F.col("url")) == urls.host(F.col("feed_url"))))
    segs = urls.segments(urls.path(F.col("url")))
    listed = F.arrays_overlap(F.slice(segs, 1, F.greatest(F.size(segs) - 1, F.lit(0))), F.array(*[F.lit(s) for s in NON_ARTICLE]))
    x = x.filter((F.size(segs) >= 2) & ~listed & (F.regexp_count(F.element_at(segs, -1), F.lit("-")) >= 4))

    def first(c: str):
        return F.min_by(F.nullif(F.col(c), F.lit("")), F.when(F.col(c) != "", F.col("l.pos")))

    return x.groupBy("feed_url", "feed_domain", "url").agg(F.min("l.pos").alias("pos"), F.coalesce(first("l.title_hint"), F.lit("")).alias("title_hint"), dates.parse_iso(first("l.date_hint")).alias("published_hint"))
