"""The tasks of a scan, from tables of addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.functions import text
from wirelake.sources import feeds


def tasks(rss: DataFrame, standard: DataFrame | None = None, listings: DataFrame | None = None, queries: DataFrame | None = None) -> DataFrame:
    """``kind, domain, url`` of everything to fetch, each address once.

    ``rss(domain, url)`` holds feeds and news sitemaps, told apart by their marks;
    ``standard`` sitemaps, ``listings`` and search ``queries`` have the same columns.
    """
    kind = F.when(feeds.is_sitemap(F.col("url")), "news_sitemap").otherwise("rss")
    out = rss.select(kind.alias("kind"), "domain", "url")
    for name, more in (("sitemap", standard), ("listing", listings), ("search", queries)):
        if more is not None:
            out = out.unionByName(more.select(F.lit(name).alias("kind"), "domain", "url"))
    return out.filter(~text.is_blank(F.col("url"))).distinct()


def collect(tasks: DataFrame, items: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per task: ``kind, domain, url, n_items, newest, err, ms``.

    ``items(feed_url, published_at)`` are what the tasks brought, ``outcomes(url, err, ms)``
    how they went. A task without items has 0, one that timed out -1; a feed without
    entries and without error says so.
    """
    got = items.groupBy("feed_url").agg(F.count(F.lit(1)).alias("_n"), F.max("published_at").alias("newest"))
    went = outcomes.groupBy(F.col("url").alias("_url")).agg(F.max("err").alias("err"), F.max("ms").alias("ms"))
    d = tasks.join(got, F.col("url") == F.col("feed_url"), "left").join(went, F.col("url") == F.col("_url"), "left")
    late = text.error_class(F.col("err")) == "timeout"
    n = F.coalesce("_n", F.lit(0))
    err = F.when((n == 0) & text.is_blank(F.col("err")) & F.col("kind").isin("rss", "news_sitemap"), "no entries").otherwise(F.col("err"))
    return d.select("kind", "domain", "url", F.when(F.coalesce(late, F.lit(False)) & (n == 0), -1).otherwise(n).cast("bigint").alias("n_items"), "newest", err.alias("err"), "ms")
