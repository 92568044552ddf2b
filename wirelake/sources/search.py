"""Search-feed addresses from keywords, sites and languages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirelake.config import LangConfig
from wirelake.functions import dates, urls

BASE = "https://news.google.com/rss/search?q="


def or_block(terms: Column, cap: int | None = None) -> Column:
    """``("a" OR "b")`` of the first ``cap`` terms."""
    t = F.slice(terms, 1, cap) if cap else terms
    return F.concat(F.lit("("), F.array_join(F.transform(t, lambda k: F.concat(F.lit('"'), k, F.lit('"'))), " OR "), F.lit(")"))


def address(q: Column, hl: Column, gl: Column, ceid: Column) -> Column:
    return F.concat(F.lit(BASE), urls.form_encode(q), F.lit("&hl="), hl, F.lit("&gl="), gl, F.lit("&ceid="), ceid)


def keyword_queries(keywords: DataFrame, hours: int, hl: str = "pt-BR", gl: str = "BR", ceid: str = "BR:pt") -> DataFrame:
    """One address per keyword: ``when:W "keyword"``."""
    q = F.concat(dates.when_clause(F.lit(hours)), F.lit(' "'), F.col("keyword"), F.lit('"'))
    return keywords.select("keyword", address(q, F.lit(hl), F.lit(gl), F.lit(ceid)).alias("query_url"))


def site_queries(sites: DataFrame, hours: int | Column, cap: int = 12) -> DataFrame:
    """One address per site: ``site:D when:W (terms)``; sites(domain, terms, hl, gl, ceid).

    The time operand stands before the terms, as long queries are cut at their end.
    """
    q = F.concat(F.lit("site:"), F.col("domain"), F.lit(" "), dates.when_clause(hours if isinstance(hours, Column) else F.lit(hours)), F.lit(" "), or_block(F.col("terms"), cap))
    return sites.select("domain", address(q, F.col("hl"), F.col("gl"), F.col("ceid")).alias("query_url"))


def terms_by_language(keywords: DataFrame, priority: DataFrame, cap: int = 12) -> DataFrame:
    """Live keywords that are on a language's priority list, in its order; all live ones if none is."""
    live = keywords.select(F.lower("keyword").alias("k"), "keyword").groupBy("k").agg(F.max("keyword").alias("keyword"))
    w = Window.partitionBy("lang").orderBy("priority")
    hit = priority.join(live, F.lower("term") == F.col("k")).withColumn("n", F.row_number().over(w)).filter(F.col("n") <= cap)
    own = hit.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "keyword"))), lambda x: x.keyword).alias("terms"))
    every = live.agg(F.sort_array(F.collect_list("keyword")).alias("all_terms"))
    return priority.select("lang").distinct().join(own, "lang", "left").join(F.broadcast(every)).select("lang", F.coalesce("terms", "all_terms").alias("terms"))


def language_queries(languages: list[LangConfig], sites: DataFrame, keywords: DataFrame, hours: int) -> DataFrame:
    """``lang, domain, query_url``: for each site ``(lang, domain)`` the address in its language.

    English asks for the live keywords on its priority list (all live ones if none is);
    other languages for the first ``cap`` of their native terms.
    """
    spark = sites.sparkSession
    rows = [(x.code, x.hl, x.gl, x.ceid, [t for t, _ in x.terms][: x.cap]) for x in languages]
    locale = spark.createDataFrame(rows, "lang string, hl string, gl string, ceid string, native array<string>")
    english = [(x.code, t, i) for x in languages if x.code == "en" for i, (t, _) in enumerate(x.terms)]
    live = terms_by_language(keywords, spark.createDataFrame(english, "lang string, term string, priority int"))
    terms = locale.join(live, "lang", "left").select("lang", "hl", "gl", "ceid", F.coalesce("terms", "native").alias("terms"))
    s = sites.select("lang", "domain").join(terms, "lang")
    q = F.concat(F.lit("site:"), F.col("domain"), F.lit(" "), dates.when_clause(F.lit(hours)), F.lit(" "), or_block(F.col("terms")))
    return s.select("lang", "domain", address(q, F.col("hl"), F.col("gl"), F.col("ceid")).alias("query_url"))


def query_language(query_url: Column, by_locale: dict[str, str]) -> Column:
    """The language of a search address by its ``hl`` parameter."""
    m = F.create_map(*[F.lit(x) for kv in by_locale.items() for x in kv])
    return F.try_element_at(m, urls.query_param(query_url, "hl"))
