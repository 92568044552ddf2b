"""Enrichment from fetched pages, which arrive as a table ``pages(url, html)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.config import RunConfig
from wirelake.functions import dates, html, text
from wirelake.functions.match import Matcher
from wirelake.operators import fair


def resolve_wrappers(items: DataFrame, resolved: DataFrame | None, prefix: str) -> DataFrame:
    """With ``resolved_url``, ``resolved_domain``: wrapper links by the table ``resolved(url, target, domain)``."""
    d = items
    if resolved is not None:
        r = resolved.select(F.col("url").alias("_u"), F.col("target").alias("_t"), F.col("domain").alias("_d")).dropDuplicates(["_u"])
        d = d.join(r, (F.col("url") == F.col("_u")) & F.startswith(F.col("url"), F.lit(prefix)), "left")
    else:
        d = d.withColumn("_t", F.lit(None).cast("string")).withColumn("_d", F.lit(None).cast("string"))
    return d.withColumn("resolved_url", F.coalesce("_t", "url")).withColumn("resolved_domain", F.coalesce("_d", "source_domain")).drop("_t", "_d", "_u")


def enrich(items: DataFrame, pages: DataFrame, extractors: DataFrame | None, config: RunConfig, need_snippet: bool = True) -> DataFrame:
    """Adds ``snippet``, ``published`` and ``ext_title``.

    Rows that are complete without their page don't reach the parser: they are
    split off before the join. Snippets: the feed's, the page's first three
    paragraphs, its description, its first prose.
    """
    base = items.withColumn("_feed", text.snippet_from_text(html.html_text("summary")))
    titled = F.coalesce("title", F.lit("")) != ""
    done = titled & F.col("published_at").isNotNull()
    if need_snippet:
        done = done & (F.col("_feed") != "")
    done = done | F.startswith(F.col("resolved_url"), F.lit(config.wrapper_prefix))
    base = base.withColumn("_done", F.coalesce(done, F.lit(False)))
    none = F.lit(None).cast("string")
    early = base.filter("_done").withColumn("snippet", F.col("_feed")).withColumn("published", F.col("published_at")).withColumn("ext_title", none)
    p = pages.select(F.col("url").alias("_pu"), "html").dropDuplicates(["_pu"])
    late = base.filter("not _done").join(p, F.col("resolved_url") == F.col("_pu"), "left")
    if extractors is not None:
        e = extractors.select(F.col("domain").alias("_ed"), "spec").dropDuplicates(["_ed"])
        late = late.join(e, F.col("resolved_domain") == F.col("_ed"), "left").drop("_ed")
    else:
        late = late.withColumn("spec", none)
    late = late.withColumn("_page", F.when(F.col("html").isNotNull(), html.extract_page("html", "spec")))
    body = text.clean_snippet(F.array_join(F.slice(text.clean_paragraphs(F.col("_page.paragraphs")), 1, 3), " "))
    prose = text.clean_snippet(F.array_join(text.prose(F.col("_page.paragraphs")), " "))
    ladder = F.coalesce(*[F.nullif(c, F.lit("")) for c in (F.col("_feed"), body, text.clean_snippet(F.col("_page.description")), prose)], F.lit(""))
    written = F.get(F.filter(F.transform("_page.dates", dates.parse_iso), lambda t: t.isNotNull()), F.lit(0))
    late = late.withColumn("snippet", ladder).withColumn("published", F.coalesce("published_at", written)).withColumn("ext_title", F.when(~titled, F.col("_page.title")))
    drop = ("_feed", "_done", "_pu", "html", "spec", "_page")
    return early.drop(*drop).unionByName(late.drop(*drop))


def lede_rescue(near: DataFrame, pages: DataFrame, extractors: DataFrame | None, matcher: Matcher, config: RunConfig) -> DataFrame:
    """Near misses whose first paragraphs hold a keyword: capped, enriched, matched again."""
    picked = fair.two_level_cap(near, config.caps.lede_total, config.caps.lede_per_domain, key="source_domain")
    e = enrich(picked, pages, extractors, config)
    e = e.withColumn("matched", matcher.hits(F.concat_ws(" \n ", "title", "snippet")))
    return e.filter((F.size("matched") > 0) & (F.col("snippet") != ""))


def backfill(articles: DataFrame, known: DataFrame | None, pages: DataFrame, extractors: DataFrame | None, config: RunConfig) -> DataFrame:
    """Articles with snippets fetched for some of those without; nothing else changes."""
    c = config.caps
    empty = articles.filter(text.is_blank(F.col("snippet")))
    pick = fair.backfill_pick(empty, known, c.backfill_lookup, c.backfill_total, c.backfill_per_domain)
    asked = pick.select("url", "title", F.lit("").alias("summary"), "published_at", F.col("domain").alias("source_domain"), F.col("url").alias("resolved_url"), F.col("domain").alias("resolved_domain"))
    got = enrich(asked, pages, extractors, config).filter("snippet <> ''").groupBy("url").agg(F.max("snippet").alias("_new"))
    return articles.join(got, "url", "left").withColumn("snippet", F.coalesce("_new", "snippet")).drop("_new")


def repair(stored: DataFrame, pages: DataFrame, extractors: DataFrame | None, config: RunConfig, since) -> DataFrame:
    """The repair job: ``url, snippet`` found for stored rows without text since a time."""
    empty = stored.filter(text.is_blank(F.col("snippet")) & (F.col("published_at") > since)).withColumn("seq", F.xxhash64("url"))
    pick = fair.repair_pick(empty, config.caps.repair_total, config.caps.repair_per_domain)
    asked = pick.select("url", F.lit("x").alias("title"), F.lit("").alias("summary"), "published_at", F.col("domain").alias("source_domain"), F.col("url").alias("resolved_url"), F.col("domain").alias("resolved_domain"))
    return enrich(asked, pages, extractors, config).filter("snippet <> ''").select("url", "snippet")
