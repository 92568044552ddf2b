"""Named queries over the test tables, and the SQL each must agree with.

Timestamps are given as microseconds since 1970 and arrays as text, so that values
compare alike in both engines. "Now" is ``AS_OF`` throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wirelake.config import LANGUAGES, MatchConfig, RunConfig
from wirelake.functions import dates, html, match, text, urls
from wirelake.operators import chunking, dedupe, enrich, fair, health, merge, route, timestamps, translate
from wirelake.plans import pipeline
from wirelake.session import table
from wirelake.sources import extractors, feeds, registry, search, tables
from wirelake.streaming import stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

AS_OF_US = 1_781_481_600_000_000  # 2026-06-15T00:00:00Z
AS_OF = "make_timestamp(2026,6,15,0,0,0.0)"
HOURS = 24 * 60
AGGREGATORS = ["newsradar.example", "aggregator-one.example"]


def as_of():
    return F.timestamp_micros(F.lit(AS_OF_US))


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def hint_day(written):
    """The day of a listing's hint as the scan reads it: an ISO date at its start, else its only dd/mm/yyyy."""
    iso = F.try_to_timestamp(F.regexp_extract(F.coalesce(written, F.lit("")), r"^\s*(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd"))
    return F.coalesce(F.to_timestamp(iso), dates.parse_listing(written))


def items(spark: SparkSession, d: str) -> DataFrame:
    """Raw items with ``seq``; the day of the written hint as instant, the text as ``hint_text``."""
    t = table(spark, d, "raw_items").withColumn("seq", F.col("item_id"))
    return t.withColumn("hint_text", F.col("published_hint")).withColumn("published_hint", hint_day(F.col("published_hint")))


def dated_items(spark: SparkSession, d: str) -> DataFrame:
    """``items`` with the day of every hint that names one, in whatever form it is written.

    ISO days stay as written; other forms are read by the timestamp resolver and cut to
    the day in the zone of the site.
    """
    t, registry = items(spark, d), table(spark, d, "source_registry")
    values = t.select(F.lit("raw_items").alias("rec_table"), F.col("item_id").cast("bigint").alias("rec_id"), F.lit("published_hint").alias("rec_field"), F.col("source_domain").alias("src"), F.col("hint_text").alias("val"))
    read = timestamps.resolve(values, registry).filter("utc_us is not null").groupBy("rec_id").agg(F.min("utc_us").alias("_us"))
    zone = registry.select(F.col("domain").alias("_site"), F.col("zone_id").alias("_zone")).dropDuplicates(["_site"])
    t = t.join(read, F.col("item_id") == F.col("rec_id"), "left").join(zone, F.col("source_domain") == F.col("_site"), "left")
    day = F.date_trunc("day", F.from_utc_timestamp(F.timestamp_micros("_us"), F.coalesce("_zone", F.lit("UTC"))))
    return t.withColumn("published_hint", F.coalesce("published_hint", day)).drop("rec_id", "_us", "_site", "_zone")


# SQL fragments shared by several queries
HOST = r"regexp_replace(lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"
PATH = r"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
QUERYPART = r"regexp_extract({u}, '^[^?#]*\?([^#]*)', 1)"
TRACK = "'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', 'gclid', 'mc_cid', 'mc_eid', 'ref', 'ref_src', '__twitter_impression'"


def norm_sql(u: str) -> str:
    q = rf"""array_to_string(list_transform(list_filter(string_split({QUERYPART.format(u=u)}, '&'), lambda p: p <> '' AND lower(url_decode(replace(string_split(p, '=')[1], '+', ' '))) NOT IN ({TRACK})),
      lambda p: replace(url_encode(url_decode(replace(string_split(p, '=')[1], '+', ' '))), '%20', '+') || '=' || replace(url_encode(url_decode(replace(CASE WHEN contains(p, '=') THEN p[strpos(p, '=')+1:] ELSE '' END, '+', ' '))), '%20', '+')), '&')"""
    path = PATH.format(u=u)
    return rf"""(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) || '://' || {HOST.format(u=u)}
      || CASE WHEN regexp_replace({path}, '/+$', '') = '' THEN {path} ELSE regexp_replace({path}, '/+$', '') END
      || CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END)"""


IN_WINDOW = f"epoch_us(published_at) >= {AS_OF_US - HOURS * 3_600_000_000}"
# the keyword table: spelling by lower case, pattern of the substring terms (longest first), patterns of the exact ones;
# all texts are searched as one, so that a pattern is compiled once: MARK stands before each and holds its key
MARK = r"\x{F8FF}\d+\x{F8FE}"
KW = rf"""k AS (SELECT lower(keyword) AS lk, min(keyword) AS sp, bool_or(match_type = 'exact') AS ex FROM keywords WHERE trim(keyword) <> '' GROUP BY 1),
p AS (SELECT '(?i)(?:{MARK}|' || string_agg(regexp_escape(lk), '|' ORDER BY length(lk) DESC, lk) || ')' AS pat FROM k WHERE NOT ex),
e AS (SELECT lk, sp, '(?i)(?:{MARK}|[^\p{{L}}\p{{N}}\p{{M}}_]' || regexp_escape(lk) || '[^\p{{L}}\p{{N}}\p{{M}}_])' AS epat FROM k WHERE ex)"""


def _big(src: str, key: str, txt: str) -> str:
    return f"(SELECT string_agg(chr(63743) || {key} || chr(63742) || chr(10) || coalesce({txt}, '') || chr(10), '') AS big FROM {src})"


def hits_sql(src: str, key: str, txt: str) -> str:
    """Rows (key, keyword) of all hits of the keyword table in ``txt`` of ``src``; needs ``KW``."""

    def attributed(pattern: str, more: str, of: str) -> str:
        found = f"SELECT unnest(l) AS h, generate_subscripts(l, 1) AS i{more} FROM (SELECT regexp_extract_all(big, {pattern}) AS l{more} FROM {of}, {_big(src, key, txt)})"
        part = f"PARTITION BY {more[2:]} " if more else ""
        return f"SELECT h{more}, max_by(h, i) FILTER (h[1] = chr(63743)) OVER ({part}ORDER BY i) AS mark FROM ({found})"

    return f"""SELECT DISTINCT mark[2:-2]::BIGINT AS {key}, sp AS keyword FROM ({attributed('pat', '', 'p')}) x JOIN k ON lower(h) = lk
    UNION SELECT mark[2:-2]::BIGINT AS {key}, sp AS keyword FROM ({attributed('epat', ', sp', 'e')}) y WHERE h[1] <> chr(63743)"""


def table_matcher(spark: SparkSession, d: str) -> match.Matcher:
    return match.compile_matcher(table_config(spark, d))


def table_config(spark: SparkSession, d: str) -> MatchConfig:
    return match.config_from(table(spark, d, "keywords"), HOURS)


def run_config(spark: SparkSession, d: str, **more) -> RunConfig:
    return RunConfig(match=table_config(spark, d), languages=LANGUAGES, **more)


# --- keywords -----------------------------------------------------------------
@query("kw_config_union", "SELECT keyword, CASE WHEN max(match_type = 'exact') THEN 'exact' ELSE 'substring' END AS match_type FROM keywords WHERE trim(keyword) <> '' GROUP BY keyword")
def kw_config_union(spark, d):
    return match.keyword_union(table(spark, d, "keywords"))


@query("kw_match_title", f"WITH {KW} {hits_sql('raw_items', 'item_id', 'title')}")
def kw_match_title(spark, d):
    return items(spark, d).select("item_id", F.explode(table_matcher(spark, d).hits(F.col("title"))).alias("keyword"))


@query("kw_match_documents", f"WITH {KW} {hits_sql('documents', 'doc_id', 'text')}")
def kw_match_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(table_matcher(spark, d).hits(F.col("text"))).alias("keyword"))


@query(
    "kw_match_order",
    f"""WITH {KW}, big AS (FROM {_big('articles', 'article_id', 'title')}),
    x AS (SELECT unnest(l) AS h, generate_subscripts(l, 1) AS i FROM (SELECT regexp_extract_all(big, pat) AS l FROM big, p)),
    y AS (SELECT h, i, max_by(h, i) FILTER (h[1] = chr(63743)) OVER (ORDER BY i) AS mark FROM x),
    z AS (SELECT mark[2:-2]::BIGINT AS article_id, lower(h) AS lk, min(i) AS i FROM y WHERE h[1] <> chr(63743) GROUP BY 1, 2)
    SELECT article_id, coalesce(hits, '') AS hits FROM articles LEFT JOIN (SELECT article_id, string_agg(sp, '|' ORDER BY i) AS hits FROM z JOIN k USING (lk) GROUP BY 1) USING (article_id)""",
)
def kw_match_order(spark, d):
    m = table_matcher(spark, d)
    return table(spark, d, "articles").select("article_id", F.array_join(match.Matcher(m.substring, None, m.spelling).hits(F.col("title")), "|").alias("hits"))


@query("kw_match_table", f"WITH {KW}, t AS (SELECT item_id, concat_ws(chr(32) || chr(10) || chr(32), title, summary) AS x FROM raw_items) {hits_sql('t', 'item_id', 'x')}")
def kw_match_table(spark, d):
    """All hits of the keyword table's terms in titles and summaries."""
    m = table_matcher(spark, d)
    return items(spark, d).select("item_id", F.explode(m.hits(F.concat_ws(" \n ", "title", "summary"))).alias("keyword"))


NATIVE = {n: c for lang in LANGUAGES for n, c in lang.terms}
_NATIVE_PAT = "(?i)(?:" + "|".join(sorted((n.lower() for n in NATIVE), key=lambda k: (-len(k), k))) + ")"
_native_sql = "(VALUES " + ", ".join(f"('{n}', '{c}')" for n, c in NATIVE.items()) + ") AS v(term, concept)"


@query(
    "kw_canonical",
    f"""SELECT DISTINCT item_id, concept FROM (SELECT item_id, unnest(regexp_extract_all(title, '{_NATIVE_PAT}')) AS h FROM raw_items) x JOIN {_native_sql} ON lower(h) = lower(term)""",
)
def kw_canonical(spark, d):
    m = match.compile_matcher(MatchConfig(tuple(NATIVE)))
    return items(spark, d).select("item_id", F.explode(match.canonical(m.hits(F.col("title")), NATIVE)).alias("concept"))


@query(
    "kw_by_source",
    f"WITH {KW}, h AS ({hits_sql('raw_items', 'item_id', 'title')}) SELECT source_domain, keyword, count(*) AS n FROM h JOIN raw_items USING (item_id) GROUP BY 1, 2",
)
def kw_by_source(spark, d):
    hit = items(spark, d).select("source_domain", F.explode(table_matcher(spark, d).hits(F.col("title"))).alias("keyword"))
    return hit.groupBy("source_domain", "keyword").agg(F.count(F.lit(1)).alias("n"))


# --- urls ---------------------------------------------------------------------
@query("url_normalize", f"SELECT item_id, {norm_sql('url')} AS url_key FROM raw_items")
def url_normalize(spark, d):
    return items(spark, d).select("item_id", urls.normalize(F.col("url")).alias("url_key"))


@query("url_host", f"SELECT item_id, {HOST.format(u='url')} AS host, len(list_filter(string_split({PATH.format(u='url')}, '/'), lambda s: s <> ''))::INT AS n_segments FROM raw_items")
def url_host(spark, d):
    return items(spark, d).select("item_id", urls.host(F.col("url")).alias("host"), F.size(urls.segments(urls.path(F.col("url")))).alias("n_segments"))


SLUG = r"regexp_extract(regexp_replace(" + PATH.format(u="url") + r", '/+$', ''), '([^/]*)$', 1)"


@query("url_slug_title", f"SELECT item_id, CASE WHEN s = '' THEN url ELSE upper(s[1]) || s[2:] END AS title FROM (SELECT item_id, url, trim(replace(url_decode({SLUG}), '-', ' ')) AS s FROM raw_items)")
def url_slug_title(spark, d):
    return items(spark, d).select("item_id", urls.slug_title(F.col("url")).alias("title"))


@query("url_dedupe_first", f"SELECT item_id FROM raw_items QUALIFY row_number() OVER (PARTITION BY {norm_sql('url')} ORDER BY item_id) = 1")
def url_dedupe_first(spark, d):
    return dedupe.first_by_url(items(spark, d)).select("item_id")


@query("url_weight", "SELECT item_id, (length(url_encode(url)) + 3)::INT AS weight FROM raw_items")
def url_weight(spark, d):
    return items(spark, d).select("item_id", urls.encoded_weight(F.col("url")).alias("weight"))


@query("url_known_in_articles", f"SELECT item_id FROM raw_items WHERE {norm_sql('url')} IN (SELECT {norm_sql('url')} FROM articles)")
def url_known_in_articles(spark, d):
    a = table(spark, d, "articles").select(urls.normalize(F.col("url")).alias("url_key"))
    return items(spark, d).withColumn("url_key", urls.normalize(F.col("url"))).join(a, "url_key", "left_semi").select("item_id")


# --- dates --------------------------------------------------------------------
@query("window_filter", f"SELECT item_id FROM raw_items WHERE {IN_WINDOW}")
def window_filter(spark, d):
    return items(spark, d).filter(dates.within_window(F.col("published_at"), as_of(), HOURS)).select("item_id")


HINT = r"coalesce(try_strptime(regexp_extract(published_hint, '^\s*(\d{4}-\d{2}-\d{2})', 1), '%Y-%m-%d'), CASE WHEN len(regexp_extract_all(published_hint, '\b\d{2}/\d{2}/\d{4}\b')) = 1 THEN try_strptime(regexp_extract(published_hint, '\b\d{2}/\d{2}/\d{4}\b'), '%d/%m/%Y') END)"


@query("hint_window", f"SELECT item_id, epoch_us({HINT}) AS hint_us FROM raw_items WHERE published_at IS NULL AND epoch_us({HINT}) >= {AS_OF_US - (HOURS + 24) * 3_600_000_000}")
def hint_window(spark, d):
    h = items(spark, d).filter("published_at is null").filter(dates.within_window(F.col("published_hint"), as_of(), HOURS + 24))
    return h.select("item_id", F.unix_micros("published_hint").alias("hint_us"))


@query("future_clamp", f"SELECT item_id, CASE WHEN epoch_us(published_at) > {AS_OF_US + 300_000_000} THEN {AS_OF_US} ELSE epoch_us(published_at) END AS at_us FROM raw_items WHERE published_at IS NOT NULL")
def future_clamp(spark, d):
    return items(spark, d).filter("published_at is not null").select("item_id", F.unix_micros(dates.clamp_future(F.col("published_at"), as_of())).alias("at_us"))


@query("age_hours", f"SELECT scan_id, round(({AS_OF_US} - epoch_us(newest)) / 3.6e9, 4) AS age_h FROM feed_scans WHERE newest IS NOT NULL")
def age_hours(spark, d):
    return table(spark, d, "feed_scans").filter("newest is not null").select("scan_id", F.round(dates.age_hours(F.col("newest"), as_of()), 4).alias("age_h"))


@query("date_iso_parse", "SELECT url, epoch_us(try_cast(published_at AS TIMESTAMPTZ)) AS at_us FROM stored_articles WHERE published_at IS NOT NULL")
def date_iso_parse(spark, d):
    return table(spark, d, "stored_articles").filter("published_at is not null").select("url", F.unix_micros(dates.parse_iso(F.col("published_at"))).alias("at_us"))


_pt = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in (dates.PT_MONTHS | dates.EN_MONTHS).items()) + "}"
RFC = r"(?i)^\s*(?:\p{L}{3,},?\s+)?(\d{1,2})\s+(\p{L}{3})\p{L}*\s+(\d{4})\s+(\d{2}:\d{2}:\d{2})\s*([+-]\d{4}|GMT|UTC|Z)\s*$"


@query(
    "date_rfc822_parse",
    rf"""SELECT article_id, epoch_us(try_strptime(regexp_extract(published_at, '{RFC}', 3) || '-' || coalesce({_pt}[lower(regexp_extract(published_at, '{RFC}', 2))], '00') || '-' || regexp_extract(published_at, '{RFC}', 1) || ' ' || regexp_extract(published_at, '{RFC}', 4)
    || CASE WHEN regexp_extract(published_at, '{RFC}', 5) ~ '^[+-].*' THEN regexp_extract(published_at, '{RFC}', 5) ELSE '+0000' END, '%Y-%m-%d %H:%M:%S%z')) AS at_us
    FROM articles WHERE regexp_matches(published_at, '{RFC}')""",
)
def date_rfc822_parse(spark, d):
    a = table(spark, d, "articles").select("article_id", dates.parse_rfc822(F.col("published_at")).alias("t"))
    return a.filter("t is not null").select("article_id", F.unix_micros("t").alias("at_us"))


@query("date_listing_parse", r"SELECT item_id, epoch_us(try_strptime(regexp_extract(published_hint, '\b(\d{2}/\d{2}/\d{4})\b', 1), '%d/%m/%Y')) AS at_us FROM raw_items WHERE len(regexp_extract_all(published_hint, '\b(\d{2}/\d{2}/\d{4})\b')) = 1")
def date_listing_parse(spark, d):
    t = items(spark, d).filter(F.regexp_count("hint_text", F.lit(r"\b\d{2}/\d{2}/\d{4}\b")) == 1)
    return t.select("item_id", F.unix_micros(dates.parse_listing(F.col("hint_text"))).alias("at_us"))


@query("p3_found")
def p3_found(spark, d):
    return timestamps.p3_found(table(spark, d, "articles"), table(spark, d, "raw_items"), table(spark, d, "source_registry"))


@query("p3_order")
def p3_order(spark, d):
    """Instants as the order of the records alone gives them, where the registry's order of day and month is withheld."""
    return timestamps.p3_order(table(spark, d, "articles"), table(spark, d, "raw_items"), table(spark, d, "source_registry"))


# --- text ---------------------------------------------------------------------
@query("text_strip_tags", r"SELECT item_id, trim(regexp_replace(summary, '<[^>]+>', ' ', 'g')) AS plain FROM raw_items WHERE summary IS NOT NULL")
def text_strip_tags(spark, d):
    return items(spark, d).filter("summary is not null").select("item_id", F.trim(text.strip_tags(F.col("summary"))).alias("plain"))


_trunc = """CASE WHEN length(t) <= 360 THEN t ELSE regexp_replace(CASE WHEN strpos(t[:360], ' ') > 0 AND 360 - strpos(reverse(t[:360]), ' ') > 216 THEN t[:360 - strpos(reverse(t[:360]), ' ')] ELSE t[:360] END, '[ ,;:.\\-]+$', '') || '...' END""".replace("\\\\", "\\")


@query("text_truncate", f"SELECT article_id, {_trunc} AS short FROM (SELECT article_id, snippet AS t FROM articles WHERE snippet IS NOT NULL)")
def text_truncate(spark, d):
    return table(spark, d, "articles").filter("snippet is not null").select("article_id", text.truncate(F.col("snippet")).alias("short"))


@query("text_title_base", r"SELECT item_id, CASE WHEN trim(regexp_extract(title, '(?s)^(.*) - (.*)$', 1)) <> '' AND length(regexp_extract(title, '(?s)^(.*) - (.*)$', 2)) < 60 THEN trim(regexp_extract(title, '(?s)^(.*) - (.*)$', 1)) ELSE title END AS title FROM raw_items WHERE title IS NOT NULL")
def text_title_base(spark, d):
    return items(spark, d).filter("title is not null").select("item_id", text.title_base(F.col("title")).alias("title"))


@query(
    "text_clean_title",
    r"""WITH n AS (SELECT '(?i)(?:\s*[|–-]\s*(?:' || string_agg(regexp_escape(source_name), '|' ORDER BY length(source_name) DESC) || '))+\s*$' AS pat FROM source_registry)
    SELECT article_id, CASE WHEN x = '' THEN t ELSE x END AS title FROM (SELECT article_id, t, trim(regexp_replace(t, pat, '')) AS x FROM (SELECT article_id, trim(regexp_replace(title, '[\s\p{Z}]+', ' ', 'g')) AS t FROM articles WHERE title IS NOT NULL), n)""",
)
def text_clean_title(spark, d):
    names = text.site_names(table(spark, d, "source_registry"))
    return table(spark, d, "articles").filter("title is not null").select("article_id", text.clean_title(F.col("title"), names).alias("title"))


# what is no text of an article, as the SQL states it
_noise = r"""(?i)^\s*leia\s+(tamb[eé]m|mais|tudo\s+sobre)\b|^\s*leia\s+a\s+(reportagem|mat[eé]ria)\s+completa\b|^\s*continua\s+(ap[oó]s|depois)\s+(a|da)\s+publicidade
|^\s*assine\b|^\s*assinar\b|^\s*publicidade\s*$|^\s*propaganda\s*$|^\s*anuncio\s*$|^\s*newsletter\b|^\s*siga\s+o\s+|^\s*siga\s+a\s+|^\s*assista\b
|^\s*foto:\s|^\s*imagem:\s|^\s*cr[eé]dito:\s|^\s*compartilhe\b|^\s*veja\s+(tamb[eé]m|mais)\b|^\s*saiba\s+mais\b
|^\s*por\s+[A-ZÁÉÍÓÚÂÊÔÃÕÇ][0-9A-Z_a-zÀ-ÿ.\-]+(\s+[A-ZÁÉÍÓÚÂÊÔÃÕÇ][0-9A-Z_a-zÀ-ÿ.\-]+){0,3}\s*$
|j[aá]\s+[eé]\s+assinante\b|fa[cç]a\s+seu\s+login\b|continue\s+lendo\b|nosso\s+conte[uú]do\s+[eé]\s+exclusivo|conte[uú]do\s+exclusivo\s+para\s+assinantes
|voc[eê]\s+atingiu\s+o\s+limite|tr[eê]s\s+mat[eé]rias\s+por\s+m[eê]s|apoie\s+o\s+jornalismo|acesse\s+sem\s+limites
|acompanhe\s+os\s+mercados\s+com\s+nossas\s+ferramentas|tenha\s+acesso\s+a\s+informa[cç][aã]o\s+relevante|voc[eê]\s+pode\s+ler\s+nosso\s+conte[uú]do\s+exclusivo
|cadastro\s+gratuito|assine\s+as?\s+newsletters?\b|receba\s+as?\s+not[ií]cias\s+do\s+dia|em\s+primeira\s+m[aã]o\s+no\s+e-?mail
|^\s*[⟶→➔➜►▸‣»]\s*|^\s*[©®]?\s*\d{4}\s+bloomberg\b|^\s*todos\s+os\s+direitos\s+reservados
|^\s*[\p{L}\p{N}\p{M}_][\p{L}\p{N}\p{M}_\s&''-]{1,40}\s*\|\s*[\p{L}\p{N}\p{M}_][\p{L}\p{N}\p{M}_\s&''-]{1,40}\s*$""".replace("\n", "")


@query(
    "text_clean_paragraphs",
    rf"""WITH a AS (SELECT article_id, list_filter(list_transform(string_split(snippet, chr(10)), lambda p: regexp_replace(trim(regexp_replace(p, '[\s\p{{Z}}]+', ' ', 'g')), '\s+([.,;:!?])', '\1', 'g')), lambda p: p <> '' AND NOT regexp_matches(p, '{_noise}')) AS l FROM articles WHERE snippet IS NOT NULL)
    SELECT article_id, array_to_string(list_filter(l, lambda p, i: i = 1 OR p <> l[i - 1]), '|') AS paragraphs FROM a""",
)
def text_clean_paragraphs(spark, d):
    a = table(spark, d, "articles").filter("snippet is not null")
    return a.select("article_id", F.array_join(text.clean_paragraphs(F.split("snippet", "\n", -1)), "|").alias("paragraphs"))


_STRIP = r"'^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'"
_FOOT = (
    r"(?i)O\s+post\s+[\s\S]+?apareceu\s+primeiro\s+em\s+[\s\S]+?</a>\s*\.",
    r"(?is)O\s+post\s+.+?\s+apareceu\s+primeiro\s+em\s+[^.<]+\.",
    r"(?i)\b(?:leia\s+tamb[eé]m|veja\s+tamb[eé]m|saiba\s+mais|leia\s+mais|veja\s+mais|confira\s+tamb[eé]m|mais\s+not[ií]cias|not[ií]cias\s+relacionadas|mat[eé]rias\s+relacionadas)\b",
)


@query(
    "text_strip_related",
    f"""WITH f AS (SELECT item_id, summary AS s, regexp_replace(summary, '{_FOOT[0]}', ' ', 'g') AS c FROM raw_items WHERE summary IS NOT NULL),
    t AS (SELECT item_id, CASE WHEN c <> s THEN regexp_replace(c, {_STRIP}) ELSE regexp_replace(regexp_replace(regexp_replace(s, '<[^>]+>', ' ', 'g'), '{_FOOT[1]}', ' ', 'g'), {_STRIP}) END AS t FROM f)
    SELECT item_id, CASE WHEN regexp_matches(t, '{_FOOT[2]}') THEN t[:strpos(t, regexp_extract(t, '{_FOOT[2]}')) - 1] ELSE t END AS kept FROM t""",
)
def text_strip_related(spark, d):
    return items(spark, d).filter("summary is not null").select("item_id", text.strip_related(F.col("summary")).alias("kept"))


@query("text_blank", r"SELECT article_id FROM articles WHERE regexp_replace(coalesce(snippet, ''), '[\s\p{Z}]+', '', 'g') = ''")
def text_blank(spark, d):
    return table(spark, d, "articles").filter(text.is_blank(F.col("snippet"))).select("article_id")


# --- routing ------------------------------------------------------------------
ROUTE = f"""{KW},
i AS (SELECT *, {HINT} AS hint, coalesce(title, '') AS ti, coalesce(summary, '') AS su FROM raw_items
  WHERE (published_at IS NULL OR {IN_WINDOW}) AND (published_at IS NOT NULL OR {HINT} IS NULL OR epoch_us({HINT}) >= {AS_OF_US - (HOURS + 24) * 3_600_000_000})),
s AS (SELECT *, CASE WHEN strpos(lower(su), 'leia') + strpos(lower(su), 'mais') > 0 AND regexp_matches(x, mk) THEN x[:strpos(x, regexp_extract(x, mk)) - 1] ELSE x END AS sx FROM
  (SELECT *, regexp_replace(su, '<[^>]+>', ' ', 'g') AS x, '(?i)\\b(?:leia\\s+tamb[eé]m|veja\\s+tamb[eé]m|saiba\\s+mais|leia\\s+mais|veja\\s+mais|confira\\s+tamb[eé]m|mais\\s+not[ií]cias)\\b' AS mk,
    CASE WHEN published_at IS NULL THEN translate({PATH.format(u='url')}, '-/', '  ') ELSE replace({SLUG}, '-', ' ') END AS ux FROM i)),
ht AS (SELECT DISTINCT item_id FROM ({hits_sql('s', 'item_id', 'ti')})),
hs AS (SELECT DISTINCT item_id FROM ({hits_sql('s', 'item_id', 'sx')})),
hu AS (SELECT DISTINCT item_id FROM ({hits_sql('s', 'item_id', 'ux')})),
r AS (SELECT s.*, CASE WHEN ti = '' AND su = '' THEN CASE WHEN item_id IN (FROM hu) THEN 'url' END
   WHEN item_id IN (FROM ht) THEN 'title' WHEN item_id IN (FROM hs) THEN 'summary' WHEN ti <> '' AND published_at IS NOT NULL THEN 'lede' END AS route FROM s)""".replace("\\\\", "\\")


def routed(spark, d):
    """Routed by the terms of the keyword table, with hints as the scan reads them."""
    cfg = run_config(spark, d)
    return route.route(items(spark, d), match.compile_matcher(cfg.match), cfg, as_of())


def routed_by_table(spark, d, cfg: RunConfig):
    """Routed by the terms of the keyword table and by hints in any form."""
    return route.route(dated_items(spark, d), match.compile_matcher(cfg.match), cfg, as_of())


@query("route_items", f"WITH {ROUTE} SELECT item_id, route FROM r WHERE route IS NOT NULL")
def route_items(spark, d):
    return routed(spark, d).select("item_id", "route")


@query(
    "source_yield_profile",
    f"""WITH {ROUTE}, b AS (SELECT source_domain, count(*) FILTER (route <> 'lede') AS passed, count(*) FILTER (route = 'lede') AS near FROM r WHERE route IS NOT NULL GROUP BY 1)
    SELECT source_domain, count(*) AS items, round((epoch_us(max(published_at)) - epoch_us(min(published_at))) / 3.6e9, 3) AS span_h, count(*) FILTER (published_at IS NULL OR {IN_WINDOW}) AS fresh,
      coalesce(max(passed), 0) AS passed, coalesce(max(near), 0) AS near, count(*) FILTER (regexp_replace(coalesce(summary, ''), '[\\s\\p{{Z}}]+', '', 'g') = '') AS no_body
    FROM raw_items LEFT JOIN b USING (source_domain) GROUP BY source_domain""".replace("\\\\", "\\"),
)
def source_yield_profile(spark, d):
    return health.yield_profile(items(spark, d), routed(spark, d), as_of(), HOURS)


@query("validate_articles")
def validate_articles(spark, d):
    """Routed items judged with the feed's own summary as snippet."""
    cfg = run_config(spark, d)
    e = routed_by_table(spark, d, cfg).filter("route <> 'lede'").withColumn("snippet", text.snippet_from_text(html.html_text("summary")))
    e = e.withColumn("published", F.col("published_at")).withColumn("resolved_url", F.col("url")).withColumn("resolved_domain", F.col("source_domain")).withColumn("ext_title", F.lit(None).cast("string"))
    v = route.validate(e, match.compile_matcher(cfg.match), cfg, as_of(), NATIVE, table(spark, d, "source_registry"))
    return v.select("url", "source_name", "title", "seq", F.unix_micros("published_at").alias("published_us"), F.array_join("matched_keywords", "|").alias("keywords"), "published_is_approx", "drop_reason")


@query("pipeline_run")
def pipeline_run(spark, d):
    pages = items(spark, d).groupBy("url").agg(F.max(F.concat(F.lit("<html><body><article>"), F.coalesce("summary", F.lit("")), F.lit("</article></body></html>"))).alias("html"))
    stored = table(spark, d, "stored_articles").withColumn("published_at", dates.parse_iso(F.col("published_at")))
    r = pipeline.run(dated_items(spark, d), stored, pages, table(spark, d, "source_registry"), run_config(spark, d), as_of(), extractors=extractors.extractor_rows(spark), translator=lambda t, lang: f"[{lang}] {t}")
    return r.table.select("url", "domain", "title", "snippet", F.unix_micros("published_at").alias("published_us"), F.array_join("matched_keywords", "|").alias("keywords"), "source_lang", "title_en")


# --- fair budgets -------------------------------------------------------------
def _empty(spark, d):
    """Items without body, as candidates; ``url`` is the item, so that it is unique."""
    return items(spark, d).filter(text.is_blank(F.col("summary"))).select("item_id", F.col("item_id").alias("url"), F.col("source_domain").alias("domain"), "published_at", "seq")


EMPTY = r"empty AS (SELECT item_id, source_domain AS domain, epoch_us(published_at) AS t, item_id AS seq FROM raw_items WHERE regexp_replace(coalesce(summary, ''), '[\s\p{Z}]+', '', 'g') = '')"
RR = """rr AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY t {dir}, seq) AS r, {agg}(t) OVER (PARTITION BY domain) AS head, min(seq) OVER (PARTITION BY domain) AS first FROM e0)"""
E0 = "e0 AS (SELECT item_id, domain, coalesce(t, -4611686018427387904) AS t, seq FROM empty)"


@query("cap_two_level", f"WITH {EMPTY}, x AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY seq) AS rn FROM empty) SELECT item_id FROM x WHERE rn <= 8 ORDER BY seq LIMIT 40")
def cap_two_level(spark, d):
    return fair.two_level_cap(_empty(spark, d), 40, 8).select("item_id")


@query("cap_per_domain", f"WITH {EMPTY} SELECT item_id FROM empty QUALIFY row_number() OVER (PARTITION BY domain ORDER BY seq) <= 20")
def cap_per_domain(spark, d):
    return fair.per_key_cap(_empty(spark, d), 20).select("item_id")


@query(
    "cap_mixed",
    """WITH x AS (SELECT item_id, source_domain AS domain, published_at, row_number() OVER (PARTITION BY source_domain ORDER BY item_id) AS rn FROM raw_items),
    y AS (SELECT *, row_number() OVER (PARTITION BY domain, published_at IS NULL AND rn > 20 ORDER BY item_id) AS ln FROM x)
    SELECT item_id FROM y WHERE rn <= 20 OR (published_at IS NULL AND rn > 20 AND ln <= 20)""",
)
def cap_mixed(spark, d):
    return fair.mixed_cap(items(spark, d), 20, 40, key="source_domain").select("item_id")


@query("round_robin", f"WITH {EMPTY}, {E0}, {RR.format(dir='DESC', agg='max')} SELECT item_id, row_number() OVER (ORDER BY r, head DESC, first) AS pos FROM rr ORDER BY pos LIMIT 300")
def round_robin(spark, d):
    top = fair.round_robin(_empty(spark, d), most_per_key=300).orderBy(*fair.RR_ORDER).limit(300)
    return top.select("item_id", F.row_number().over(Window.orderBy(*fair.RR_ORDER)).cast("bigint").alias("pos"))


@query(
    "interleave_backfill",
    f"""WITH {EMPTY}, {E0}, {RR.format(dir='DESC', agg='max')}, ss AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY t, seq) AS r, min(t) OVER (PARTITION BY domain) AS head, min(seq) OVER (PARTITION BY domain) AS first FROM e0),
    f AS (SELECT item_id, 2 * row_number() OVER (ORDER BY r, head DESC, first) - 2 AS pos FROM rr), s AS (SELECT item_id, 2 * row_number() OVER (ORDER BY r, head, first) - 1 AS pos FROM ss)
    SELECT item_id FROM (FROM f UNION ALL FROM s) GROUP BY item_id ORDER BY min(pos) LIMIT 180""",
)
def interleave_backfill(spark, d):
    return fair.interleave(_empty(spark, d), 180).select("item_id")


@query("repair_pick", f"WITH {EMPTY}, {E0}, {RR.format(dir='DESC', agg='max')} SELECT item_id FROM rr WHERE r <= 40 ORDER BY r, head DESC, first LIMIT 400")
def repair_pick(spark, d):
    return fair.repair_pick(_empty(spark, d), 400, 40).select("item_id")


@query("top_recent", "SELECT item_id, epoch_us(published_at) AS at_us FROM raw_items WHERE source_domain = 'correio-do-barril.example' ORDER BY published_at DESC NULLS LAST, item_id LIMIT 15")
def top_recent(spark, d):
    t = tables.top_recent(items(spark, d), "correio-do-barril.example", 15, key="source_domain", tie="item_id")
    return t.select("item_id", F.unix_micros("published_at").alias("at_us"))


# --- joins, dedupe, merge -----------------------------------------------------
@query("dedupe_prefer_dated", "SELECT item_id FROM raw_items QUALIFY row_number() OVER (PARTITION BY url ORDER BY published_at IS NULL, item_id) = 1")
def dedupe_prefer_dated(spark, d):
    return dedupe.prefer_dated(items(spark, d)).select("item_id")


@query("dedupe_last_wins", "SELECT item_id FROM raw_items QUALIFY row_number() OVER (PARTITION BY url ORDER BY collected_at DESC NULLS LAST, item_id DESC) = 1")
def dedupe_last_wins(spark, d):
    return dedupe.last_by_key(items(spark, d), "url", "collected_at", "item_id").select("item_id")


@query("anti_known", "SELECT DISTINCT url FROM articles WHERE url NOT IN (SELECT url FROM stored_articles WHERE trim(snippet) <> '')")
def anti_known(spark, d):
    known = table(spark, d, "stored_articles").filter("trim(snippet) <> ''")
    return table(spark, d, "articles").select("url").distinct().join(known, "url", "left_anti")


@query("semi_known", "SELECT article_id FROM articles WHERE url IN (SELECT url FROM stored_articles)")
def semi_known(spark, d):
    return table(spark, d, "articles").join(table(spark, d, "stored_articles"), "url", "left_semi").select("article_id")


@query("left_default_name", f"SELECT item_id, coalesce(source_name, {HOST.format(u='url')}) AS source_name, coalesce(stale_hours, 48)::INT AS stale_hours FROM raw_items LEFT JOIN source_registry ON feed_domain = domain")
def left_default_name(spark, d):
    r = table(spark, d, "source_registry").select("domain", F.col("source_name").alias("n"), "stale_hours")
    j = items(spark, d).join(r, F.col("feed_domain") == F.col("domain"), "left")
    return j.select("item_id", F.coalesce("n", urls.host(F.col("url"))).alias("source_name"), F.coalesce("stale_hours", F.lit(48)).alias("stale_hours"))


@query(
    "self_anti_dup_slug",
    f"""WITH p AS (SELECT item_id, source_domain, regexp_replace({PATH.format(u='url')}, '/+$', '') AS path FROM raw_items),
    b AS (SELECT *, CASE WHEN regexp_matches(path, '-\\d{{1,2}}$') THEN regexp_replace(path, '-\\d{{1,2}}$', '') END AS base FROM p)
    SELECT item_id FROM b WHERE NOT (base IS NOT NULL AND len(regexp_extract_all(regexp_extract(base, '([^/]*)$', 1), '-')) >= 3 AND (source_domain, base) IN (SELECT (source_domain, path) FROM p))""".replace("\\\\", "\\"),
)
def self_anti_dup_slug(spark, d):
    e = items(spark, d).withColumn("feed_url", F.col("source_domain"))
    return feeds.without_copies(e).select("item_id")


def _new_rows(spark, d):
    """Articles as a batch of pushed rows, dates as written; ``article_id`` is their order."""
    return table(spark, d, "articles").withColumn("found_at", F.lit(0)).withColumn("seq", F.col("article_id"))


NEW = "new AS (SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY url ORDER BY article_id DESC) = 1)"
BLANK = r"regexp_replace(coalesce({c}, ''), '[\s\p{{Z}}]+', '', 'g') = ''"


def _overlay(c: str) -> str:
    risk = f"coalesce(s.source_lang IS NOT NULL AND lower(trim(s.source_lang)) NOT IN ('', 'pt', 'en') AND ({BLANK.format(c='s.title_en')} OR {BLANK.format(c='s.snippet_en')}), false)"
    return f"CASE WHEN s.url IS NULL THEN t.{c} WHEN {risk} THEN coalesce(CASE WHEN NOT {BLANK.format(c='s.' + c)} THEN s.{c} END, CASE WHEN NOT {BLANK.format(c='t.' + c)} THEN t.{c} END, s.{c}) ELSE s.{c} END AS {c}"


@query(
    "merge_write_once",
    f"""WITH {NEW} SELECT coalesce(s.url, t.url) AS url, s.title,
      CASE WHEN s.url IS NULL THEN t.published_at WHEN coalesce(s.published_is_approx, false) THEN coalesce(t.published_at, s.published_at) ELSE s.published_at END AS published_at,
      CASE WHEN s.url IS NULL THEN t.snippet ELSE coalesce(CASE WHEN NOT {BLANK.format(c='s.snippet')} THEN s.snippet END, t.snippet, '') END AS snippet,
      {_overlay('source_lang')}, {_overlay('title_original')}, {_overlay('title_en')}, {_overlay('snippet_en')}
    FROM new s FULL OUTER JOIN stored_articles t ON s.url = t.url""",
)
def merge_write_once(spark, d):
    m = merge.merge(_new_rows(spark, d), table(spark, d, "stored_articles"))
    return m.select("url", "title", "published_at", "snippet", *merge.OVERLAY)


@query("merge_deferred", f"WITH {NEW} SELECT url FROM new s WHERE coalesce(published_is_approx, false) OR (source_lang IS NOT NULL AND lower(trim(source_lang)) NOT IN ('', 'pt', 'en') AND {BLANK.format(c='title_en')})")
def merge_deferred(spark, d):
    one = dedupe.last_by_key(_new_rows(spark, d), "url", "found_at", "seq")
    return merge.deferred(one, dates_ok=False, overlays_ok=False).select("url")


@query("merge_snippet_only", f"SELECT t.url, coalesce(n.s, t.snippet) AS snippet, t.title_en FROM stored_articles t LEFT JOIN (SELECT url, max(snippet) AS s FROM articles WHERE NOT {BLANK.format(c='snippet')} GROUP BY url) n ON t.url = n.url")
def merge_snippet_only(spark, d):
    return merge.merge_snippets(table(spark, d, "stored_articles"), table(spark, d, "articles").select("url", "snippet")).select("url", "snippet", "title_en")


# --- search queries -----------------------------------------------------------
@query(
    "search_site_queries",
    """WITH t AS (SELECT list(keyword ORDER BY keyword)[:12] AS l FROM (SELECT DISTINCT keyword FROM keywords))
    SELECT domain, 'https://news.google.com/rss/search?q=' || replace(url_encode('site:' || domain || ' when:' || CASE WHEN stale_hours <= 48 THEN stale_hours::VARCHAR || 'h' ELSE greatest(1, stale_hours // 24)::INT::VARCHAR || 'd' END || ' ("' || array_to_string(l, '" OR "') || '")'), '%20', '+')
      || '&hl=pt-BR&gl=BR&ceid=BR:pt' AS query_url FROM source_registry, t""",
)
def search_site_queries(spark, d):
    kw = match.keyword_union(table(spark, d, "keywords")).agg(F.slice(F.sort_array(F.collect_set("keyword")), 1, 12).alias("terms"))
    sites = table(spark, d, "source_registry").select("domain", "stale_hours").join(F.broadcast(kw))
    return search.site_queries(sites.withColumns({"hl": F.lit("pt-BR"), "gl": F.lit("BR"), "ceid": F.lit("BR:pt")}), F.col("stale_hours"))


@query("search_keyword_queries", """SELECT DISTINCT keyword, 'https://news.google.com/rss/search?q=' || replace(url_encode('when:3d "' || keyword || '"'), '%20', '+') || '&hl=pt-BR&gl=BR&ceid=BR:pt' AS query_url FROM keywords""")
def search_keyword_queries(spark, d):
    return search.keyword_queries(match.keyword_union(table(spark, d, "keywords")), 72)


_native = ", ".join(f"('{x.code}', '{x.hl}', '{x.gl}', '{x.ceid}', {[t for t, _ in x.terms][:12]})" for x in LANGUAGES)


@query(
    "search_language_sites",
    f"""WITH lang AS (SELECT * FROM (VALUES {_native}) AS v(lang, hl, gl, ceid, native)),
    live AS (SELECT lower(keyword) AS lk, max(keyword) AS keyword FROM keywords WHERE trim(keyword) <> '' GROUP BY 1),
    own AS (SELECT list(keyword ORDER BY list_position(native, lk_term))[:12] AS l FROM (SELECT keyword, native, list_filter(native, lambda t: lower(t) = lk)[1] AS lk_term FROM live, lang WHERE lang = 'en') WHERE lk_term IS NOT NULL),
    every AS (SELECT list(keyword ORDER BY keyword) AS l FROM live),
    t AS (SELECT lang, hl, gl, ceid, CASE WHEN lang = 'en' THEN coalesce((SELECT l FROM own), (SELECT l FROM every)) ELSE native END AS l FROM lang)
    SELECT t.lang, domain, 'https://news.google.com/rss/search?q=' || replace(url_encode('site:' || domain || ' when:3d ("' || array_to_string(l, '" OR "') || '")'), '%20', '+') || '&hl=' || hl || '&gl=' || gl || '&ceid=' || ceid AS query_url
    FROM source_registry JOIN t ON t.lang = main_lang""",
)
def search_language_sites(spark, d):
    sites = table(spark, d, "source_registry").select(F.col("main_lang").alias("lang"), "domain")
    return search.language_queries(LANGUAGES, sites, match.keyword_union(table(spark, d, "keywords")), 72)


# --- health -------------------------------------------------------------------
AGG = "'" + "','".join(AGGREGATORS) + "'"
LATEST = "latest AS (SELECT * FROM feed_scans QUALIFY row_number() OVER (PARTITION BY domain, feed_url ORDER BY scanned_at DESC NULLS LAST, scan_id DESC) = 1)"


@query("feed_counts", "SELECT feed_domain, feed_url, count(*) AS n_items, epoch_us(max(published_at)) AS newest_us FROM raw_items GROUP BY 1, 2")
def feed_counts(spark, d):
    return health.feed_counts(items(spark, d)).select("feed_domain", "feed_url", "n_items", F.unix_micros("newest").alias("newest_us"))


@query("feed_summary", f"SELECT coalesce(sum(n_items) FILTER (n_items > 0), 0)::BIGINT AS items, count(*) FILTER (n_items = 0 AND domain NOT IN ({AGG})) AS zero_sites, count(*) FILTER (n_items = 0 AND domain IN ({AGG})) AS zero_aggregators, count(*) FILTER (n_items = -1) AS timed_out, count(*) FILTER (trim(coalesce(err, '')) <> '') AS errored FROM feed_scans")
def feed_summary(spark, d):
    return health.feed_summary(table(spark, d, "feed_scans"), AGGREGATORS)


@query("feed_latest", f"WITH {LATEST} SELECT scan_id, domain FROM latest")
def feed_latest(spark, d):
    return health.latest_scan(table(spark, d, "feed_scans")).select("scan_id", "domain")


@query(
    "feed_stale",
    f"""WITH n AS (SELECT domain, feed_url, max(newest) AS newest FROM feed_scans WHERE domain NOT IN ({AGG}) GROUP BY 1, 2)
    SELECT n.domain, n.feed_url, coalesce(stale_hours, 48)::DOUBLE AS budget_h, round(({AS_OF_US} - epoch_us(newest)) / 3.6e9, 4) AS age_h FROM n LEFT JOIN source_registry r ON n.domain = r.domain
    WHERE newest IS NOT NULL AND ({AS_OF_US} - epoch_us(newest)) / 3.6e9 > coalesce(stale_hours, 48)""",
)
def feed_stale(spark, d):
    n = table(spark, d, "feed_scans").groupBy("domain", "feed_url").agg(F.max("newest").alias("newest"))
    return health.stale_feeds(n, table(spark, d, "source_registry"), as_of(), AGGREGATORS).select("domain", "feed_url", "budget_h", F.round("age_h", 4).alias("age_h"))


@query(
    "label_capped",
    f"""SELECT array_to_string(list_sort(l)[:15], ', ') || CASE WHEN len(l) > 15 THEN ' (+' || (len(l) - 15)::VARCHAR || ' more)' ELSE '' END AS labels
    FROM (SELECT list(DISTINCT {HOST.format(u='feed_url')} || regexp_replace({PATH.format(u='feed_url')}, '/+$', '')) AS l FROM feed_scans WHERE n_items = 0)""",
)
def label_capped(spark, d):
    return health.capped_labels(table(spark, d, "feed_scans"))


@query("error_classes", "SELECT scan_id, CASE WHEN regexp_matches(lower(err), '429|too many|blocked|captcha|denied|403') THEN 'block' WHEN regexp_matches(lower(err), 'timeout|timed out') THEN 'timeout' ELSE 'error' END AS kind FROM feed_scans WHERE coalesce(err, '') <> ''")
def error_classes(spark, d):
    return table(spark, d, "feed_scans").filter("coalesce(err, '') <> ''").select("scan_id", text.error_class(F.col("err")).alias("kind"))


@query("site_verdicts", f"SELECT domain, count(*) FILTER (NOT {BLANK.format(c='snippet')}) AS ok, count(*) FILTER ({BLANK.format(c='snippet')}) AS fail FROM articles GROUP BY domain ORDER BY count(*) DESC, domain LIMIT 25")
def site_verdicts(spark, d):
    return health.verdicts(table(spark, d, "articles"), ~text.is_blank(F.col("snippet")))


@query("distinct_sites", "SELECT count(DISTINCT domain) AS sites, count(DISTINCT domain) FILTER (trim(coalesce(snippet, '')) = '') AS sites_with_blank FROM articles")
def distinct_sites(spark, d):
    return table(spark, d, "articles").agg(F.countDistinct("domain").alias("sites"), F.countDistinct(F.when(F.trim(F.coalesce("snippet", F.lit(""))) == "", F.col("domain"))).alias("sites_with_blank"))


# --- extraction ---------------------------------------------------------------
def _xml(c):
    """Text as the content of an element; signs that XML has no form for are left out."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]", "")
    return F.replace(F.replace(F.replace(plain, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _documents(rows, element, kind: str):
    """Documents of some hundred elements each: ``feed_url, feed_domain, body``."""
    part = F.floor(F.col("item_id") / 200)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", element.alias("x")))), lambda e: e.x), "\n")
    head, tail = {"rss": ("<rss><channel>", "</channel></rss>"), "news": ("<urlset>", "</urlset>")}[kind]
    return rows.groupBy("feed_url", "feed_domain", part.alias("part")).agg(F.concat(F.lit(head), body, F.lit(tail)).alias("body"))


_SQUEEZE = r"trim(regexp_replace(regexp_replace(coalesce({c}, ''), '[\x00-\x08\x0B\x0C\x0E-\x1F\x{{FFFE}}\x{{FFFF}}]', '', 'g'), '[\s\p{{Z}}]+', ' ', 'g'))"


@query(
    "feed_rss_items",
    rf"""SELECT feed_url, {norm_sql('url')} AS url, {_SQUEEZE.format(c='title')} AS title, (epoch_us(published_at) // 1000000) * 1000000 AS published_us, {HOST.format(u='url')} AS source_domain FROM raw_items WHERE trim(coalesce(url, '')) <> ''""",
)
def feed_rss_items(spark, d):
    """Every raw item written as an entry of an RSS document and read back as an item row."""
    e = F.concat(F.lit("<item><title>"), _xml(F.col("title")), F.lit("</title><link>"), _xml(F.col("url")), F.lit("</link><pubDate>"), F.coalesce(F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss Z"), F.lit("")), F.lit("</pubDate></item>"))
    got = feeds.entries_to_items(feeds.rss_entries(_documents(items(spark, d), e, "rss")), [])
    return got.select("feed_url", "url", text.collapse(F.col("title")).alias("title"), F.unix_micros("published_at").alias("published_us"), "source_domain")


@query(
    "sitemap_news_items",
    rf"""SELECT feed_url, trim(url) AS url, {_SQUEEZE.format(c='title')} AS title, (epoch_us(published_at) // 1000000) * 1000000 AS published_us FROM raw_items WHERE trim(coalesce(url, '')) <> ''""",
)
def sitemap_news_items(spark, d):
    """Every raw item written as an entry of a news sitemap and read back."""
    at = F.coalesce(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))
    e = F.concat(F.lit("<url><loc>"), _xml(F.col("url")), F.lit("</loc><news:news><news:title>"), _xml(F.col("title")), F.lit("</news:title><news:publication_date>"), at, F.lit("</news:publication_date></news:news></url>"))
    docs = _documents(items(spark, d), e, "news").withColumn("body", F.replace("body", F.lit("<urlset>"), F.lit('<urlset xmlns:news="n">')))
    got = feeds.sitemap_entries(docs)
    return got.select("feed_url", "url", text.collapse(F.coalesce("title", F.lit(""))).alias("title"), F.unix_micros("published").alias("published_us"))


def _html(c):
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


FAMILIES = ("globo", "agenciainfra", "gazetadopovo", "jornaldocomercio", "jota", "generic")
BODIES = {
    "globo": ("<article><div class='mc-article-body'>", "</div></article>"),
    "agenciainfra": ("<article></article><div class='elementor-widget-theme-post-content'><div class='elementor-widget-container'>", "</div></div>"),
    "gazetadopovo": ("<article>menu</article><div class='x__postBodyContainer'>", "</div>"),
    "jornaldocomercio": ("<article></article><section class='paywall-carregando x'><div>", "</div></section>"),
    "jota": ('<script id="__NEXT_DATA__">{"props": {"pageProps": {"post": {"content": "', '"}}}}</script>'),
    "generic": ("<div itemprop='articleBody'>", "</div>"),
}


@query(
    "page_extract",
    r"""WITH l AS (SELECT article_id, title, list_filter(list_transform(string_split(coalesce(snippet, ''), chr(10)), lambda x: trim(regexp_replace(x, '[\s\p{Z}\x1C-\x1F\x{85}]+', ' ', 'g'))), lambda x: x <> '') AS l FROM articles)
    SELECT article_id, trim(regexp_replace(coalesce(title, ''), '[\s\p{Z}\x1C-\x1F\x{85}]+', ' ', 'g')) AS title, array_to_string(l, '|') AS paragraphs FROM l""",
)
def page_extract(spark, d):
    """Every article written as a page of one of six kinds of site and extracted by that site's row."""
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"[\s\p{Z}\x1C-\x1F\x{85}]+", " "))
    lines = F.filter(F.split(F.coalesce("snippet", F.lit("")), "\n", -1), lambda x: squeeze(x) != "")
    family = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), (F.pmod(F.col("article_id"), F.lit(len(FAMILIES))) + 1).cast("int"))
    paragraphs = F.concat(F.lit("<p>"), F.array_join(F.transform(lines, _html), "</p><p>"), F.lit("</p>"))
    broken = F.array_join(F.transform(lines, _html), "<br>")
    quoted = F.regexp_replace(F.to_json(F.struct(paragraphs.alias("x"))), r'^\{"x":"|"\}$', "")
    body = F.when(family == "jornaldocomercio", broken).when(family == "jota", F.replace(quoted, F.lit("</"), F.lit("<\\/"))).otherwise(paragraphs)
    wrap = [F.element_at(F.create_map(*[F.lit(x) for k, v in BODIES.items() for x in (k, v[i])]), family) for i in (0, 1)]
    head = F.concat(F.lit('<html><head><meta property="og:title" content="'), F.replace(_html(F.col("title")), F.lit('"'), F.lit("&quot;")), F.lit('"></head><body>'))
    pages = table(spark, d, "articles").select("article_id", family.alias("family"), F.concat(head, wrap[0], body, wrap[1], F.lit("</body></html>")).alias("html"))
    spec = F.element_at(F.create_map(*[F.lit(x) for k in FAMILIES for x in (k, extractors.SELECTORS[k])]), F.col("family"))
    got = pages.select("article_id", html.extract_page("html", spec).alias("p"))
    return got.select("article_id", squeeze(F.col("p.title")).alias("title"), F.array_join(F.transform("p.paragraphs", squeeze), "|").alias("paragraphs"))


@query("registry_tasks", """SELECT DISTINCT CASE WHEN regexp_matches(lower(feed_url), '/sitemap/|sitemap-news|news-sitemap|sitemap_news|news\\.xml|/noticias/sitemap\\.xml|/noticia/sitemap\\.xml|/news/sitemap\\.xml') THEN 'news_sitemap' ELSE 'rss' END AS kind, domain, feed_url AS url FROM source_registry WHERE trim(coalesce(feed_url, '')) <> ''""")
def registry_tasks(spark, d):
    return registry.tasks(table(spark, d, "source_registry").select("domain", F.col("feed_url").alias("url")))


@query(
    "collect_health",
    """WITH t AS (SELECT DISTINCT domain, feed_url FROM source_registry WHERE trim(coalesce(feed_url, '')) <> ''), g AS (SELECT feed_url, count(*) AS n, max(published_at) AS newest FROM raw_items GROUP BY 1),
    o AS (SELECT feed_url, max(err) AS err FROM feed_scans GROUP BY 1)
    SELECT domain, t.feed_url AS url, CASE WHEN coalesce(n, 0) = 0 AND regexp_matches(lower(coalesce(err, '')), 'timeout|timed out') AND NOT regexp_matches(lower(coalesce(err, '')), '429|too many|blocked|captcha|denied|403') THEN -1 ELSE coalesce(n, 0) END::BIGINT AS n_items,
      epoch_us(newest) AS newest_us, CASE WHEN coalesce(n, 0) = 0 AND trim(coalesce(err, '')) = '' THEN 'no entries' ELSE err END AS err
    FROM t LEFT JOIN g USING (feed_url) LEFT JOIN o USING (feed_url)""",
)
def collect_health(spark, d):
    t = registry.tasks(table(spark, d, "source_registry").select("domain", F.col("feed_url").alias("url")))
    outcomes = table(spark, d, "feed_scans").select(F.col("feed_url").alias("url"), "err", F.lit(None).cast("double").alias("ms"))
    return registry.collect(t, items(spark, d), outcomes).select("domain", "url", "n_items", F.unix_micros("newest").alias("newest_us"), "err")


@query(
    "error_lines",
    """WITH e AS (SELECT CASE WHEN regexp_matches(lower(err), '429|too many|blocked|captcha|denied|403') THEN 'block' WHEN regexp_matches(lower(err), 'timeout|timed out') THEN 'timeout' ELSE 'error' END AS kind, concat_ws(': ', domain, err) AS line FROM feed_scans WHERE trim(coalesce(err, '')) <> ''),
    f AS (SELECT kind, line FROM (SELECT DISTINCT kind, line FROM e) QUALIFY row_number() OVER (PARTITION BY kind ORDER BY line) <= 10)
    SELECT kind, n, lines FROM (SELECT kind, count(*) AS n FROM e GROUP BY 1) JOIN (SELECT kind, string_agg(line, ' | ' ORDER BY line) AS lines FROM f GROUP BY 1) USING (kind)""",
)
def error_lines(spark, d):
    return health.error_lines(table(spark, d, "feed_scans"))


@query("html_paragraphs")
def html_paragraphs(spark, d):
    t = items(spark, d).filter(F.col("summary").rlike("(?i)<p[ >]"))
    return t.select("item_id", F.array_join(html.html_paragraphs("summary"), "|").alias("paragraphs"))


@query("html_title", r"SELECT item_id, trim(regexp_replace(coalesce(nullif(regexp_extract(summary, '(?s)<h1>([^<]*)</h1>', 1), ''), regexp_extract(summary, '(?s)<title>([^<]*)</title>', 1)), '[\s\p{Z}]+', ' ', 'g')) AS title FROM raw_items WHERE regexp_matches(summary, '<h1>[^<>&]+</h1>') OR regexp_matches(summary, '<title>[^<>&]+</title>') AND NOT regexp_matches(summary, '<h1')")
def html_title(spark, d):
    t = items(spark, d).filter(F.col("summary").rlike("<h1>[^<>&]+</h1>") | F.col("summary").rlike("<title>[^<>&]+</title>") & ~F.col("summary").rlike("<h1"))
    return t.select("item_id", text.collapse(html.extract_page("summary", F.lit(None).cast("string"))["title"]).alias("title"))


@query("html_links")
def html_links(spark, d):
    t = items(spark, d).filter(F.col("summary").contains("<a "))
    pages = t.select(F.concat(F.lit("https://"), "source_domain", F.lit("/list/")).alias("feed_url"), "feed_domain", F.col("summary").alias("body"))
    return feeds.listing_items(pages).select("feed_url", "url", "title_hint")


@query("json_path_get", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_valid(props)")
def json_path_get(spark, d):
    return table(spark, d, "events").filter(F.get_json_object("props", "$").isNotNull()).select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("backfill_stage")
def backfill_stage(spark, d):
    a = table(spark, d, "articles").withColumn("seq", F.col("article_id")).withColumn("published_at", dates.parse_iso(F.col("published_at")))
    one = dedupe.last_by_key(a, "url", "found_at", "seq")
    pages = items(spark, d).groupBy("url").agg(F.max(F.concat(F.lit("<article>"), "summary", F.lit("</article>"))).alias("html"))
    known = table(spark, d, "stored_articles").filter("trim(snippet) <> ''").select("url")
    return enrich.backfill(one, known, pages, None, run_config(spark, d)).select("url", "snippet")


@query(
    "translate_stage",
    """WITH o AS (SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY url ORDER BY article_id DESC) = 1),
    f AS (SELECT url FROM o WHERE source_lang IS NOT NULL AND trim(source_lang) <> '' AND lower(source_lang) NOT IN ('en', 'pt') AND url NOT IN (SELECT url FROM stored_articles WHERE title_en IS NOT NULL) AND title <> '' ORDER BY article_id LIMIT 40)
    SELECT url, CASE WHEN source_lang IS NOT NULL AND trim(source_lang) <> '' AND lower(source_lang) NOT IN ('en', 'pt') THEN title ELSE title_original END AS title_original,
      CASE WHEN url IN (FROM f) THEN 'EN:' || title ELSE title_en END AS title_en FROM o""",
)
def translate_stage(spark, d):
    a = table(spark, d, "articles").withColumn("seq", F.col("article_id")).withColumn("_z", F.lit(0))
    one = dedupe.last_by_key(a, "url", "_z", "seq")
    done = table(spark, d, "stored_articles").filter("title_en is not null").select("url")
    return translate.translate(one, lambda t, lang: "EN:" + t, done, 40).select("url", "title_original", "title_en")


@query("foreign_rows", "SELECT article_id FROM articles WHERE source_lang IS NOT NULL AND trim(source_lang) <> '' AND lower(source_lang) NOT IN ('en', 'pt')")
def foreign_rows(spark, d):
    return table(spark, d, "articles").filter(translate.is_foreign(F.col("source_lang"))).select("article_id")


@query("lookup_snippets", "SELECT url, snippet FROM stored_articles WHERE url IN (SELECT url FROM raw_items)")
def lookup_snippets(spark, d):
    return tables.lookup(table(spark, d, "stored_articles"), items(spark, d), "snippet")


@query("url_chunks")
def url_chunks(spark, d):
    return chunking.chunk_urls(table(spark, d, "stored_articles")).select("url", "lane", "chunk")


@query("lede_rescue_stage")
def lede_rescue_stage(spark, d):
    cfg = run_config(spark, d)
    near = routed_by_table(spark, d, cfg).filter("route = 'lede'")
    pages = table(spark, d, "articles").groupBy("url").agg(F.max(F.concat(F.lit("<article><p>"), F.replace(F.coalesce("snippet", F.lit("")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p></article>"))).alias("html"))
    got = enrich.lede_rescue(enrich.resolve_wrappers(near, None, cfg.wrapper_prefix), pages, None, match.compile_matcher(cfg.match), cfg)
    return got.select("item_id", F.array_join("matched", "|").alias("keywords"))


_terms_sql = "(VALUES " + ", ".join(f"('{lang.code}', '{t}', {i})" for lang in LANGUAGES for i, (t, _) in enumerate(lang.terms)) + ") AS v(lang, term, priority)"


@query(
    "search_language_terms",
    f"""WITH live AS (SELECT lower(keyword) AS k, max(keyword) AS keyword FROM keywords GROUP BY 1), every AS (SELECT list(keyword ORDER BY keyword) AS l FROM live),
    own AS (SELECT lang, list(keyword ORDER BY priority)[:12] AS l FROM {_terms_sql} JOIN live ON lower(term) = k GROUP BY lang)
    SELECT x.lang, array_to_string(coalesce(own.l, every.l), '|') AS terms FROM (SELECT DISTINCT lang FROM {_terms_sql}) x LEFT JOIN own ON own.lang = x.lang, every""",
)
def search_language_terms(spark, d):
    pr = spark.createDataFrame([(lang.code, t, i) for lang in LANGUAGES for i, (t, _) in enumerate(lang.terms)], "lang string, term string, priority int")
    t = search.terms_by_language(match.keyword_union(table(spark, d, "keywords")), pr)
    return t.select("lang", F.array_join("terms", "|").alias("terms"))


# --- streams ------------------------------------------------------------------
@query("stream_dedupe", f"SELECT DISTINCT {norm_sql('url')} AS url_key FROM raw_items")
def stream_dedupe(spark, d):
    s = stream.distinct_urls(stream.read_items(spark, f"{d}/raw_items.parquet"))
    return stream.to_table(s.select("url_key"), ["url_key"])


@query("stream_merge", "SELECT url, item_id FROM raw_items QUALIFY row_number() OVER (PARTITION BY url ORDER BY collected_at DESC NULLS LAST, item_id DESC) = 1")
def stream_merge(spark, d):
    s = stream.read_items(spark, f"{d}/raw_items.parquet").select("url", F.struct("collected_at", "item_id").alias("at"), "item_id")
    return stream.to_table(s, ["url"], "at").select("url", "item_id")


@query("stream_window_count", "SELECT (epoch_us(collected_at) // 86400000000) * 86400000000 AS day_us, source_domain, count(*) AS n FROM raw_items WHERE collected_at IS NOT NULL GROUP BY 1, 2")
def stream_window_count(spark, d):
    s = stream.counts_per_window(stream.read_items(spark, f"{d}/raw_items.parquet").filter("collected_at is not null"))
    t = stream.to_table(s, ["start", "source_domain"], mode="update")
    return t.select(F.unix_micros("start").alias("day_us"), "source_domain", "n")


@query("stream_fresh", f"SELECT item_id FROM raw_items WHERE (published_at IS NULL OR {IN_WINDOW}) AND (published_at IS NOT NULL OR {HINT} IS NULL OR epoch_us({HINT}) >= {AS_OF_US - (HOURS + 24) * 3_600_000_000})")
def stream_fresh(spark, d):
    s = stream.read_items(spark, f"{d}/raw_items.parquet")
    s = s.withColumn("published_hint", hint_day(F.col("published_hint")))
    return stream.to_table(stream.fresh(s, as_of(), HOURS).select("item_id"), ["item_id"])
