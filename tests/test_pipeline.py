from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wirelake.config import LangConfig, MatchConfig, RunConfig
from wirelake.functions import html
from wirelake.functions.match import compile_matcher
from wirelake.operators import enrich, health, route, translate
from wirelake.plans import pipeline

NOW = datetime(2026, 6, 1)
ITEM = "url string, title string, summary string, published_at timestamp, source_domain string, feed_domain string, title_hint string, published_hint timestamp, source_lang string, seq long"
CFG = RunConfig(match=MatchConfig(("petróleo", "diesel"), frozenset(("diesel",)), 24), topical_feeds=frozenset(("topic.example",)), recent_only_feeds=frozenset(("topic.example",)))


def now():
    return F.lit("2026-06-01 00:00:00").cast("timestamp")


def item(seq, title="", summary="", age=1, feed="f.example", url=None, hint=None, lang=None, **k):
    at = None if age is None else NOW - timedelta(hours=age)
    h = None if hint is None else NOW - timedelta(hours=hint)
    return (url or f"https://s.example/x/{seq}", title, summary, at, "s.example", feed, k.get("title_hint", ""), h, lang, seq)


def routes(spark, data):
    df = spark.createDataFrame(data, ITEM)
    got = route.route(df, compile_matcher(CFG.match), CFG, now()).collect()
    return {r.seq: (r.route, r.matched) for r in got}


def test_routes(spark):
    got = routes(
        spark,
        [
            item(1, "Petróleo sobe", "diesel"),
            item(2, "Nada", "o diesel sobe"),
            item(3, "Nada", "biodiesel"),
            item(4, "Petróleo", age=25),
            item(5, "Petróleo", age=-5),
            item(6, "Nada", "x", age=None),
            item(7, "Petróleo", age=None, hint=47),
            item(8, "Petróleo", age=None, hint=49),
            item(9, url="https://s.example/petróleo/a-b", age=None),
            item(10, url="https://s.example/petróleo/a-b"),
            item(11, url="https://s.example/x/preço-do-petróleo/"),
            item(12, "Nada", feed="topic.example"),
            item(13, "Nada", "Corpo. Leia também: diesel"),
            item(14, None, None, age=None, url=None),
        ],
    )
    assert got == {
        1: ("title", ["petróleo"]), 2: ("summary", ["diesel"]), 3: ("lede", ["#lede"]), 5: ("title", ["petróleo"]), 7: ("title", ["petróleo"]),
        9: ("url", ["petróleo"]), 11: ("url", ["petróleo"]), 12: ("topic", ["#topic"]), 13: ("lede", ["#lede"]),
    }


def test_validate(spark):
    df = spark.createDataFrame(
        [item(1, "Petróleo"), item(2, feed="topic.example", age=None), item(3, feed="topic.example", age=None, title_hint="Dica"), item(4, "x", age=None), item(5, "Petróleo", age=-1), item(6, "sem termo"), item(7, url="https://news.google.com/a")], ITEM
    )
    df = df.withColumn("matched", F.when(F.col("seq") == 6, F.array(F.lit("petróleo"))).otherwise(F.array().cast("array<string>"))).withColumn("snippet", F.when(F.col("seq") == 3, "corpo").otherwise(""))
    df = df.withColumn("published", F.col("published_at")).withColumn("resolved_url", F.col("url")).withColumn("resolved_domain", F.col("source_domain")).withColumn("ext_title", F.lit(None).cast("string"))
    names = spark.createDataFrame([("s.example", "Site"), ("s.example", "Site")], "domain string, source_name string")
    got = {r.seq: r for r in route.validate(df, compile_matcher(CFG.match), CFG, now(), {"petróleo": "oil"}, names).collect()}
    assert len(got) == 7
    assert got[1].drop_reason is None and got[1].matched_keywords == ["oil"] and got[1].source_name == "Site"
    assert got[2].drop_reason == "blind" and got[4].drop_reason == "undated" and got[7].drop_reason == "wrapper"
    assert got[3].published_is_approx and got[3].published_at == NOW and got[3].matched_keywords == ["#topic"]
    assert got[5].published_at == NOW and got[5].published_is_approx
    assert got[6].matched_keywords == ["oil"]


PAGE = """<html><head><meta property="og:title" content="Manchete"><meta name="description" content="Descrição"><script type="application/ld+json">[{"datePublished":"2026-05-31T10:00:00Z"}]</script></head>
<body><nav><p>menu</p></nav><div class="entry-content"><script>var t="</p>"</script><p>Primeiro parágrafo sobre petróleo com texto bastante.<p><b>Segundo</b> parágrafo do corpo do artigo aqui.</p><p><a href="x">Só link</a></p><aside><p>x</p></aside></div></body></html>"""


def test_extract():
    p = html.extract(PAGE, None)
    assert p["title"] == "Manchete" and p["description"] == "Descrição" and p["dates"] == ["2026-05-31T10:00:00Z"]
    assert p["paragraphs"] == ["Primeiro parágrafo sobre petróleo com texto bastante.", "Segundo parágrafo do corpo do artigo aqui."]
    br = '<section class="x paywall-carregando"><div>um<br>dois<br/><br>três</div></section>'
    assert html.extract(br, "br:section[class*=paywall]")["paragraphs"] == ["um", "dois", "três"]
    js = '<script id="__NEXT_DATA__">{"props":{"post":{"content":"<p>a</p><p>b</p><p>c</p>"}}}</script><article><p>z</p></article>'
    assert html.extract(js, "json:props.post.content")["paragraphs"] == ["a", "b", "c"]
    assert html.extract(js.replace("{", "", 1), "json:props.post.content")["paragraphs"] == ["z"]
    assert html.extract(None)["paragraphs"] == [] and html.extract("")["title"] == ""


def test_enrich_and_rescue(spark):
    df = spark.createDataFrame([item(1, "Título"), item(2, "", age=None), item(3, "Sem página")], ITEM)
    df = enrich.resolve_wrappers(df, None, CFG.wrapper_prefix)
    pages = spark.createDataFrame([("https://s.example/x/1", PAGE), ("https://s.example/x/2", PAGE), ("https://s.example/x/2", PAGE)], "url string, html string")
    got = {r.seq: r for r in enrich.enrich(df, pages, None, CFG).collect()}
    assert got[1].snippet.startswith("Primeiro") and got[1].ext_title is None
    assert got[2].ext_title == "Manchete" and got[2].published == datetime(2026, 5, 31, 10)
    assert got[3].snippet == ""
    early = {r.seq: r.snippet for r in enrich.enrich(df, pages, None, CFG, need_snippet=False).collect()}
    assert early[1] == ""
    res = enrich.lede_rescue(df, pages, None, compile_matcher(CFG.match), CFG).collect()
    assert {r.seq for r in res} == {1, 2} and res[0].matched == ["petróleo"]


def test_translate(spark):
    df = spark.createDataFrame([("a", "т", "с", "ru", 1), ("b", "т", "", "ru", 2), ("c", "t", "s", "pt", 3), ("d", "t", "s", None, 4), ("e", "bad", "s", "zh", 5), ("f", "т", "с", "ru", 6)], "url string, title string, snippet string, source_lang string, seq long")
    done = spark.createDataFrame([("f",)], "url string")

    def tr(t, lang):
        if t == "bad":
            raise RuntimeError
        return f"{lang}:{t}"

    got = {r.url: r for r in translate.translate(df, tr, done, cap=3).collect()}
    assert got["a"].title_en == "ru:т" and got["a"].snippet_en == "ru:с" and got["b"].snippet_en is None
    assert got["c"].title_original is None and got["d"].title_en is None
    assert got["e"].title_en is None and got["e"].snippet_en == "zh-CN:s" and got["f"].title_en is None and got["f"].title_original == "т"


def test_health(spark):
    n = spark.createDataFrame([("a", "u", NOW - timedelta(hours=50)), ("b", "u", NOW - timedelta(hours=50)), ("c", "u", None), ("agg", "u", NOW - timedelta(hours=500)), ("d", "u", NOW - timedelta(hours=60))], "domain string, feed_url string, newest timestamp")
    b = spark.createDataFrame([("b", 72)], "domain string, stale_hours int")
    assert [r.domain for r in health.stale_feeds(n, b, now(), ["agg"]).collect()] == ["d", "a"]
    p = spark.createDataFrame([(True, 1.0, None), (True, 2.0, None), (True, 3.0, None), (False, None, "HTTP 429")], "ok boolean, seconds double, message string")
    r = health.probe(p).collect()[0]
    assert r.ok == 3 and r.mean_s == 2.0 and r.blocked == 1 and not r.passes
    d = spark.createDataFrame([("a", None, None, None), ("b", "<p>", [], ""), ("c", "x", ["p"], "s")], "url string, html string, paragraphs array<string>, snippet string")
    assert [x.verdict for x in health.diagnosis(d).orderBy("url").collect()] == ["FETCH", "EXTRACTOR", "OK"]


def test_run(spark):
    cfg = RunConfig(match=CFG.match, languages=(LangConfig("ru", "ru", "RU", "RU:ru", (("нефт", "oil"),)),))
    data = [item(1, "Petróleo sobe"), item(2, "Нефть", lang="ru"), item(3, "Nada"), item(4, "Petróleo", url="https://s.example/x/1?utm_source=z")]
    stored = spark.createDataFrame([("https://old.example/1", NOW, "old", None, None, None, None)], "url string, published_at timestamp, snippet string, source_lang string, title_original string, title_en string, snippet_en string")
    pages = spark.createDataFrame([("https://s.example/x/3", PAGE), ("https://s.example/x/1", PAGE)], "url string, html string")
    reg = spark.createDataFrame([("s.example", "Site")], "domain string, source_name string")
    r = pipeline.run(spark.createDataFrame(data, ITEM), stored, pages, reg, cfg, now(), translator=lambda t, lang: t.upper())
    got = {x.url: x for x in r.table.collect()}
    assert set(got) == {"https://old.example/1", "https://s.example/x/1", "https://s.example/x/2", "https://s.example/x/3"}
    assert got["https://s.example/x/2"].matched_keywords == ["oil"] and got["https://s.example/x/2"].title_en == "НЕФТЬ"
    assert got["https://s.example/x/1"].snippet.startswith("Primeiro") and got["https://s.example/x/3"].matched_keywords == ["petróleo"]
    again = pipeline.run(spark.createDataFrame(data, ITEM), r.table, pages, reg, cfg, now()).table
    assert {x.url: x.snippet for x in again.collect()} == {u: x.snippet for u, x in got.items()}
    assert {x.drop_reason for x in r.counters().collect()} == {None}


def test_profile_with_rescued_and_times(spark):
    from pyspark.sql import functions as F

    from wirelake.operators import health

    items = spark.createDataFrame([("a", None, "text"), ("a", None, ""), ("b", None, None)], "source_domain string, published_at timestamp, summary string")
    routed = spark.createDataFrame([("a", "lede"), ("a", "title")], "source_domain string, route string")
    rescued = routed.filter("route = 'lede'")
    times = spark.createDataFrame([("a", 10.0), ("a", 30.0)], "source_domain string, ms double")
    got = {r.source_domain: (r.items, r.passed, r.near, r.no_body, r.rescued, r.ms) for r in health.yield_profile(items, routed, F.current_timestamp(), 24, rescued=rescued, timings=times).collect()}
    assert got == {"a": (2, 1, 1, 1, 1, 20.0), "b": (1, 0, 0, 1, 0, None)}


def test_collect_tells_what_went_wrong(spark):
    from wirelake.sources import registry

    rss = spark.createDataFrame([("a", "https://a/feed"), ("a", "https://a/news.xml"), ("b", "https://b/feed"), ("b", "https://b/feed"), ("c", None)], "domain string, url string")
    listings = spark.createDataFrame([("d", "https://d/")], "domain string, url string")
    t = registry.tasks(rss, listings=listings)
    assert {(r.kind, r.url) for r in t.collect()} == {("rss", "https://a/feed"), ("news_sitemap", "https://a/news.xml"), ("rss", "https://b/feed"), ("listing", "https://d/")}
    items = spark.createDataFrame([("https://a/feed", None)] * 2, "feed_url string, published_at timestamp")
    went = spark.createDataFrame([("https://b/feed", "read timed out", 9.0)], "url string, err string, ms double")
    got = {r.url: (r.n_items, r.err) for r in registry.collect(t, items, went).collect()}
    assert got == {"https://a/feed": (2, None), "https://a/news.xml": (0, "no entries"), "https://b/feed": (-1, "read timed out"), "https://d/": (0, None)}
