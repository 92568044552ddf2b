from datetime import datetime, timezone
from urllib.parse import parse_qsl, urlencode, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from wirelake.config import MatchConfig
from wirelake.functions import dates, match, text, urls


def col(spark, f, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(f(F.col("v")).alias("o")).collect()]


def norm(url):
    p = urlparse(url)
    host = p.netloc.lower().removeprefix("www.")
    q = [(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k.lower() not in urls.TRACKING]
    return urlunparse((p.scheme, host, p.path.rstrip("/") or p.path, p.params, urlencode(q), ""))


URLS = ["https://www.A.example/b/c/?utm_source=x&q=1#top", "http://a.example/", "https://a.example", "https://a.example/x?a=&b=%20c+d&REF=1", "https://a.example/á/b?é=*~", "https://a.example/p//", "https://a.example/p?x=1&x=2"]


def test_normalize(spark):
    assert col(spark, urls.normalize, URLS) == [norm(u) for u in URLS]
    assert col(spark, urls.normalize, [None, "", "no url"]) == [None, "", "no url"]


def test_url_parts(spark):
    assert col(spark, urls.host, ["https://www.X.example:80/a", None]) == ["x.example:80", None]
    assert col(spark, urls.slug_title, ["https://a.example/x/pre%C3%A7o-do-g%C3%A1s/", "https://a.example/x/a+b-c"]) == ["Preço do gás", "A+b c"]
    assert col(spark, urls.unwrap_redirect, ["https://redir.a.example/r/*https://b.example/x", "https://redir.a.example/?url=https%3A%2F%2Fb.example%2Fy", "https://a.example/*https://c"]) == ["https://b.example/x", "https://b.example/y", "https://a.example/*https://c"]
    base = F.lit("https://a.example/list/p.html")
    assert col(spark, lambda c: urls.absolutise(c, base), ["//b.example/x", "/y", "z", "#top", "mailto:x", "https://q.example/"]) == ["https://b.example/x", "https://a.example/y", "https://a.example/list/z", None, None, "https://q.example/"]
    assert col(spark, urls.feed_label, ["https://n.example/rss?q=site%3Ab.example+when", "https://b.example/feed/"]) == ["b.example", "b.example/feed"]


def test_text(spark):
    long = "palavra " * 60
    out = col(spark, text.truncate, ["short", long, "x" * 400, None])
    assert out[0] == "short" and out[1].endswith("palavra...") and len(out[1]) <= 363 and out[2] == "x" * 360 + "..." and out[3] is None
    assert col(spark, text.title_base, ["A - B - Fonte", " - Fonte", "A", "A - " + "x" * 70]) == ["A - B", " - Fonte", "A", "A - " + "x" * 70]
    assert col(spark, text.strip_footer, ['Texto. O post <a href="u">X</a> apareceu primeiro em <a href="v">Y</a>.', "Texto <b>x</b>. O post X apareceu primeiro em Y."]) == ["Texto.", "Texto  x ."]
    assert col(spark, text.strip_related, ["Corpo. LEIA TAMBÉM: posto"]) == ["Corpo. "]
    assert col(spark, text.is_blank, [None, "", " \n\t ", "x"]) == [True, True, True, False]
    assert col(spark, lambda c: text.clean_title(c, ["Posto em Foco", "Foco"]), ["Título | Posto em Foco - Foco", "Foco", "Posto em Foco"]) == ["Título", "Foco", "Posto em Foco"]
    assert col(spark, lambda c: text.clean_paragraphs(F.split(c, "\n")), ["Um  dois .\nUm dois.\nLeia mais\n\nTrês\nUm dois."]) == [["Um dois.", "Três", "Um dois."]]
    assert col(spark, lambda c: text.join_capped(F.split(c, ","), 2), ["c,a,b", "a"]) == ["a, b (+1 more)", "a"]
    assert col(spark, text.error_class, ["HTTP 429 too many", "Read timed out", "boom", None]) == ["block", "timeout", "error", None]


def test_dates(spark):
    at = lambda *a: datetime(*a)
    got = col(spark, dates.parse_rfc822, ["Ter, 26 Mai 2026 09:50:56 -0300", "Tue, 26 May 2026 09:50:56 GMT", "Ter, 26 Xxx 2026 09:50:56 -0300", None])
    assert got == [at(2026, 5, 26, 12, 50, 56), at(2026, 5, 26, 9, 50, 56), None, None]
    assert col(spark, dates.parse_listing, ["Cai oferta 29/07/2026", "a 01/01/2026 b 02/01/2026", "x"]) == [at(2026, 7, 29), None, None]
    assert col(spark, lambda c: dates.when_clause(c), [24, 48, 72, 50], "int") == ["when:24h", "when:48h", "when:3d", "when:2d"]
    now = F.lit("2026-06-01 00:00:00").cast("timestamp")
    ts = lambda c: c.cast("timestamp")
    assert col(spark, lambda c: dates.in_window_flag(ts(c), now, 24), ["2026-05-31 00:00:00", "2026-05-30 23:59:59", "2027-01-01 00:00:00", None]) == [True, False, True, False]
    assert col(spark, lambda c: dates.clamp_future(ts(c), now), ["2026-06-01 00:04:00", "2026-06-01 00:06:00"]) == [at(2026, 6, 1, 0, 4), at(2026, 6, 1)]


def hits(spark, texts, keywords, exact=()):
    m = match.compile_matcher(MatchConfig(tuple(keywords), frozenset(exact)))
    return col(spark, m.hits, texts)


def test_match(spark):
    assert hits(spark, ["O PETRÓLEO e o petroleo"], ["Petróleo"]) == [["Petróleo"]]
    assert hits(spark, ["gás natural e gás"], ["gás", "gás natural"]) == [["gás natural", "gás"]]
    assert hits(spark, ["posto pós-posto impostos", "impostos"], ["posto"], ["posto"]) == [["posto"], []]
    assert hits(spark, ["biodiesel"], ["diesel"], ["diesel"]) == [[]]
    assert hits(spark, ["Нефть и газ", "原油价格"], ["нефт", "原油"]) == [["нефт"], ["原油"]]
    assert hits(spark, ["b then a, exact x-y"], ["b"], ["x-y", "a"]) == [["b", "a", "x-y"]]
    assert hits(spark, [None, ""], ["a"]) == [[], []]
    assert hits(spark, ["a"], []) == [[]]
    assert hits(spark, ["(a+b) \\E c"], ["(a+b)"]) == [["(a+b)"]]


def test_canonical_and_union(spark):
    assert col(spark, lambda c: match.canonical(F.split(c, ","), {"غاز": "gas", "حقل غاز": "gas"}), ["غاز,حقل غاز,#topic"]) == [["gas", "#topic"]]
    kw = spark.createDataFrame([("a", "substring"), ("a", "exact"), ("B", "substring"), (None, "exact"), (" ", "exact")], "keyword string, match_type string")
    assert [tuple(r) for r in match.keyword_union(kw).collect()] == [("B", "substring"), ("a", "exact")]
    assert [tuple(r) for r in match.keyword_union(kw.drop("match_type")).collect()] == [("B", "substring"), ("a", "substring")]
    assert match.config_from(kw.limit(0)).keywords
    with pytest.raises(ValueError):
        match.config_from(kw, limit=1)


def test_small_helpers(spark, tmp_path):
    from wirelake.config import FALLBACK_KEYWORDS
    from wirelake.sources import tables

    assert match.provenance(MatchConfig(FALLBACK_KEYWORDS)) == "FALLBACK" and match.provenance(MatchConfig(("x",))) == "LIVE"
    df = spark.createDataFrame([(200, "Bem-vindo"), (403, ""), (200, "Faça seu LOGIN"), (None, None)], "s int, b string")
    assert [r[0] for r in df.select(text.looks_logged_out(F.col("s"), F.col("b"), ("seu login",))).collect()] == [False, True, True, False]
    spark.createDataFrame([("a",)], "keyword string").write.parquet(str(tmp_path / "k"))
    got = tables.read_keywords(spark, str(tmp_path / "none"), str(tmp_path / "k"))
    assert [tuple(r) for r in got.collect()] == [("a", "substring")] and tables.read_keywords(spark).count() == 0
    rows = spark.createDataFrame([("u", "d", "2026-01-02", " "), ("v", "e", "2026-01-03", None), ("w", "d", "2025-01-03", ""), ("x", "d", "2026-01-04", "t")], "url string, domain string, published_at string, snippet string").withColumn("published_at", F.col("published_at").cast("timestamp"))
    since = F.lit("2026-01-01").cast("timestamp")
    assert [r.url for r in tables.empty_rows(rows, since).collect()] == ["v", "u"]
    assert [r.url for r in tables.empty_rows(rows, since, "d", 5).collect()] == ["u"]
    assert [r.url for r in tables.lookup(rows, rows.filter("url = 'x'"), "snippet").collect()] == ["x"]
    raw = spark.createDataFrame([(bytearray("ação".encode("latin-1")), "ISO-8859-1"), (bytearray("ação".encode()), None)], "b binary, c string")
    assert [r[0] for r in raw.select(text.decode_bytes(F.col("b"), F.col("c"))).collect()] == ["ação", "ação"]


def test_western_bytes_have_their_quotes(spark):
    raw = spark.createDataFrame([(bytearray("“sim” – não…".encode("cp1252")), "ISO-8859-1"), (bytearray("“sim” – não…".encode("cp1252")), "windows-1252")], "b binary, c string")
    assert {r[0] for r in raw.select(text.decode_bytes(F.col("b"), F.col("c"))).collect()} == {"“sim” – não…"}


def test_all_noise_paragraphs_go(spark):
    noise = ["por Joao Silva", "© 2024 bloomberg", "Economia | Brasil", "receba as notícias do dia", "Assine já", "» veja", "Você atingiu o limite"]
    df = spark.createDataFrame([(noise + ["O texto fica."],)], "p array<string>")
    assert df.select(text.clean_paragraphs(F.col("p"))).collect()[0][0] == ["O texto fica."]
