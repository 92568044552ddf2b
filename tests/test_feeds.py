from datetime import datetime

from pyspark.sql import functions as F

from wirelake.operators import dedupe
from wirelake.sources import feeds, search

RSS = """<?xml version="1.0"?><rss xmlns:content="c"><channel><item><title>Título - Fonte</title><link>https://www.a.example/x/?utm_source=r</link><pubDate>Ter, 26 Mai 2026 09:50:56 -0300</pubDate>
<description><![CDATA[<img src="x">curto]]></description><content:encoded><![CDATA[<p>Um parágrafo com bem mais de quarenta caracteres de texto.</p><p>curto</p><p>Outro parágrafo com bem mais de quarenta caracteres de texto.</p>]]></content:encoded></item>
<item><title>sem link</title></item></channel></rss>"""
ATOM = """<feed><entry><title>A</title><link href="https://b.example/y" rel="alternate"/><updated>2026-05-01T00:00:00Z</updated><summary>s</summary></entry><entry><title>B</title><link href="https://b.example/z"/></entry></feed>"""
INDEX = """<sitemapindex><sitemap><loc>https://a.example/post-sitemap.xml</loc><lastmod>2026-05-31T00:00:00Z</lastmod></sitemap><sitemap><loc>https://a.example/post-sitemap10.xml</loc></sitemap>
<sitemap><loc>https://a.example/post-sitemap2.xml</loc></sitemap><sitemap><loc>https://a.example/page-sitemap99.xml</loc></sitemap></sitemapindex>"""
URLSET = """<urlset xmlns:news="n"><url><loc>https://a.example/um-dois-tres-quatro</loc><lastmod>2026-05-31T00:00:00Z</lastmod></url><url><loc>https://a.example/um-dois-tres-quatro-2</loc><lastmod>2026-05-31T00:00:00Z</lastmod></url>
<url><loc>https://a.example/curto-2</loc><lastmod>2026-05-31T00:00:00Z</lastmod></url><url><loc>https://a.example/curto</loc><lastmod>2020-05-31</lastmod></url>
<url><loc>https://a.example/n</loc><news:news><news:title>N</news:title><news:publication_date>2026-05-31T12:00:00Z</news:publication_date></news:news></url></urlset>"""
LIST = """<div><div><a href="/noticias/um-dois-tres-quatro-cinco">Ler notícia</a></div><div><a href="/noticias/um-dois-tres-quatro-cinco">Cai oferta de gás no porto 29/07/2026</a></div></div>
<a href="https://other.example/noticias/um-dois-tres-quatro-cinco">x</a><a href="/tag/noticias/um-dois-tres-quatro-cinco">y</a><a href="/noticias/curto">z</a><a href="#top">t</a>"""


def docs(spark, *bodies):
    return spark.createDataFrame([("https://a.example/f", "a.example", b) for b in bodies], "feed_url string, feed_domain string, body string")


def test_rss_and_atom(spark):
    e = feeds.rss_entries(docs(spark, RSS, ATOM, "<rss>broken", None))
    got = {r.title: r for r in feeds.entries_to_items(e, ["a.example"], {"a.example": "en"}).collect()}
    assert set(got) == {"Título", "A", "B"}
    t = got["Título"]
    assert t.url == "https://a.example/x" and t.published_at == datetime(2026, 5, 26, 12, 50, 56) and t.source_lang == "en"
    assert t.summary.startswith("Um parágrafo") and "Outro" in t.summary and "curto" not in t.summary
    assert got["A"].published_at == datetime(2026, 5, 1) and got["B"].published_at is None


def test_sitemaps(spark):
    now = F.lit("2026-06-01 00:00:00").cast("timestamp")
    p = feeds.post_page(docs(spark, INDEX)).collect()[0]
    assert (p.page_url, p.page_no, p.index_claim, p.error) == ("https://a.example/post-sitemap10.xml", 10, datetime(2026, 5, 31), None)
    bad = feeds.post_page(docs(spark, INDEX.replace("post-sitemap", "tag-sitemap"))).collect()[0]
    assert bad.page_url is None and bad.error
    e = feeds.sitemap_entries(docs(spark, URLSET))
    got = {r.url.rsplit("/", 1)[1]: r for r in feeds.fresh_sitemap_items(e, now).collect()}
    assert set(got) == {"um-dois-tres-quatro", "curto-2", "n"} and got["n"].title == "N"
    pages = feeds.post_page(docs(spark, INDEX)).withColumn("page_url", F.lit("https://a.example/f"))
    assert feeds.stale_page_report(pages, e.filter("url like '%/curto'")).count() == 1
    assert feeds.stale_page_report(pages, e).count() == 0
    assert [r[0] for r in spark.createDataFrame([("https://a/sitemap-news.xml",), ("https://a/feed",), ("https://a/wp-sitemap.xml",), ("https://a/news.xml",)], "u string").select(feeds.is_sitemap(F.col("u"))).collect()] == [True, False, False, True]


def test_listing(spark):
    got = feeds.listing_items(docs(spark, LIST, None)).collect()
    assert [(r.url, r.title_hint, r.published_hint) for r in got] == [("https://a.example/noticias/um-dois-tres-quatro-cinco", "Cai oferta de gás no porto", datetime(2026, 7, 29))]


def test_one_per_url(spark):
    df = spark.createDataFrame([("u", None, 1), ("u", datetime(2026, 1, 1), 2), ("u", datetime(2026, 1, 2), 3), ("v", None, 4)], "url string, published_at timestamp, seq long")
    assert {r.seq for r in dedupe.prefer_dated(df).collect()} == {2, 4}


def test_queries(spark):
    kw = spark.createDataFrame([("gás natural",), ("OIL",), ("pipeline",)], "keyword string")
    assert search.keyword_queries(kw, 24).orderBy("keyword").collect()[1].query_url == "https://news.google.com/rss/search?q=when%3A24h+%22g%C3%A1s+natural%22&hl=pt-BR&gl=BR&ceid=BR:pt"
    pr = spark.createDataFrame([("en", "pipeline", 1), ("en", "oil", 2), ("ru", "нефт", 1)], "lang string, term string, priority int")
    got = {r.lang: r.terms for r in search.terms_by_language(kw, pr).collect()}
    assert got == {"en": ["pipeline", "OIL"], "ru": ["OIL", "gás natural", "pipeline"]}
    sites = spark.createDataFrame([("b.example/news", ["a", "b c"], "en", "US", "US:en")], "domain string, terms array<string>, hl string, gl string, ceid string")
    u = search.site_queries(sites, 72).collect()[0].query_url
    assert u == "https://news.google.com/rss/search?q=site%3Ab.example%2Fnews+when%3A3d+%28%22a%22+OR+%22b+c%22%29&hl=en&gl=US&ceid=US:en"
    assert spark.createDataFrame([(u,)], "u string").select(search.query_language(F.col("u"), {"en": "en"})).collect()[0][0] == "en"
