"""Cheap routing of collected items, and the final check before they are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.config import RunConfig
from wirelake.functions import dates, text, urls
from wirelake.functions.match import Matcher, canonical

TOPIC, LEDE = "#topic", "#lede"


def _once(d: DataFrame, **columns: Column) -> DataFrame:
    """With more columns, each worked out once a row: the optimiser copies no expression through ``inline``."""
    return d.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def route(items: DataFrame, matcher: Matcher, config: RunConfig, as_of: Column, rescue: bool = True) -> DataFrame:
    """Items with ``route`` (topic, url, title, summary, lede) and ``matched``; others are dropped.

    The window comes first, as a plain filter that reaches the scan. Summary terms
    count only where the title has none.
    """
    hours = config.match.window_hours
    in_time = F.col("published_at").isNull() | dates.within_window(F.col("published_at"), as_of, hours)
    hint_ok = F.col("published_at").isNotNull() | F.col("published_hint").isNull() | dates.within_window(F.col("published_hint"), as_of, hours + config.hint_slack_hours)
    title, summary = F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit(""))
    topical = F.col("feed_domain").isin(*config.topical_feeds) if config.topical_feeds else F.lit(False)
    bare = (title == "") & (summary == "")
    path_text = F.translate(urls.path(F.col("url")), "-/", "  ")
    slug_text = F.translate(urls.slug(F.col("url")), "-", " ")
    url_hits = matcher.hits(F.when(F.col("published_at").isNull(), path_text).otherwise(slug_text))
    d = items.filter(in_time & hint_ok)
    d = _once(d, _t=F.when(~topical & ~bare, matcher.hits(title)), _u=F.when(~topical & bare, url_hits))
    d = _once(d, _s=F.when(F.size("_t") == 0, matcher.hits(text.strip_related(summary))))
    can_rescue = F.lit(rescue) & (title != "") & F.col("published_at").isNotNull()
    d = d.withColumn(
        "route",
        F.when(topical, "topic").when(F.size("_u") > 0, "url").when(bare, None).when(F.size("_t") > 0, "title").when(F.size("_s") > 0, "summary").when(can_rescue, "lede"),
    ).filter(F.col("route").isNotNull())
    marks = F.when(F.col("route") == "topic", F.array(F.lit(TOPIC))).when(F.col("route") == "lede", F.array(F.lit(LEDE)))
    return d.withColumn("matched", F.coalesce(marks, F.when(F.col("route") == "url", F.col("_u")).when(F.col("route") == "title", F.col("_t")).otherwise(F.col("_s")))).drop("_t", "_u", "_s")


def validate(enriched: DataFrame, matcher: Matcher, config: RunConfig, as_of: Column, to_concept: dict[str, str], names: DataFrame) -> DataFrame:
    """Article rows with ``drop_reason`` (NULL: kept).

    ``enriched``: item columns, ``matched``, ``snippet``, ``published``, ``resolved_url``,
    ``resolved_domain``, ``ext_title``. ``names(domain, source_name)``: one row per site.
    """
    topic = F.col("feed_domain").isin(*config.topical_feeds) if config.topical_feeds else F.lit(False)
    recent = F.col("feed_domain").isin(*config.recent_only_feeds) if config.recent_only_feeds else F.lit(False)
    snippet = F.coalesce("snippet", F.lit(""))
    real_title = F.coalesce(*[F.nullif(F.coalesce(c, F.lit("")), F.lit("")) for c in ("title", "ext_title", "title_hint")])
    d = enriched.withColumn("_topic", topic).withColumn("_real", real_title).withColumn("_snip", snippet)
    stamped = F.col("published").isNull() & F.col("published_hint").isNull() & recent & F.col("_real").isNotNull()
    d = d.withColumn("_stamped", stamped).withColumn("_date", F.coalesce("published", "published_hint", F.when(stamped, as_of)))
    future = F.col("_date") > as_of + F.make_dt_interval(mins=F.lit(5))
    title = F.coalesce("_real", urls.slug_title(F.col("resolved_url")))
    d = d.withColumn("_title", title).withColumn("_hits", matcher.hits(F.concat_ws(" \n ", "_title", "_snip")))
    keep_old = F.lit(config.headlines_only) & (F.size(F.coalesce("matched", F.array().cast("array<string>"))) > 0)
    final = F.when(F.size("_hits") > 0, F.col("_hits")).when(F.col("_topic"), F.array(F.lit(TOPIC))).when(keep_old, F.col("matched"))
    reason = (
        F.when(F.col("_topic") & (F.col("_snip") == "") & (F.coalesce("ext_title", F.lit("")) == ""), "blind")
        .when(F.col("_date").isNull(), "undated")
        .when(~dates.in_window_flag(F.col("_date"), as_of, config.match.window_hours), "window")
        .when(F.startswith(F.col("resolved_url"), F.lit(config.wrapper_prefix)), "wrapper")
        .when((F.col("_snip") == "") & ~F.col("_topic") & ~F.lit(config.headlines_only), "no_snippet")
        .when(final.isNull(), "no_keyword")
    )
    n = names.select(F.col("domain").alias("_d"), F.col("source_name").alias("_name")).dropDuplicates(["_d"])
    d = d.withColumn("drop_reason", reason).withColumn("_final", final).join(n, F.col("resolved_domain") == F.col("_d"), "left")
    return d.select(
        urls.normalize(F.col("resolved_url")).alias("url"),
        F.col("resolved_domain").alias("domain"),
        F.coalesce("_name", "resolved_domain").alias("source_name"),
        F.col("_title").alias("title"),
        F.col("_snip").alias("snippet"),
        F.when(future, as_of).otherwise(F.col("_date")).alias("published_at"),
        as_of.alias("found_at"),
        canonical(F.col("_final"), to_concept).alias("matched_keywords"),
        (F.col("_stamped") | F.coalesce(future, F.lit(False))).alias("published_is_approx"),
        "source_lang",
        "seq",
        "drop_reason",
    )
