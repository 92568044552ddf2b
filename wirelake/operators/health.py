"""Feed health, staleness and yield."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirelake.functions import dates, text, urls

TIMED_OUT = -1


def latest_scan(scans: DataFrame) -> DataFrame:
    """The last scan of each feed; equal times by scan id."""
    from wirelake.operators.dedupe import last_by_key

    return last_by_key(scans.withColumn("_k", F.struct("domain", "feed_url")), "_k", "scanned_at", "scan_id").drop("_k")


def feed_counts(items: DataFrame) -> DataFrame:
    """Per feed: items and newest real date."""
    return items.groupBy("feed_domain", "feed_url").agg(F.count(F.lit(1)).alias("n_items"), F.max("published_at").alias("newest"))


def feed_summary(scans: DataFrame, aggregators: list[str]) -> DataFrame:
    """One row: items, feeds without items (sites, aggregators), timed out, with errors."""
    agg = F.col("domain").isin(*aggregators) if aggregators else F.lit(False)
    return scans.agg(
        F.coalesce(F.sum(F.when(F.col("n_items") > 0, F.col("n_items"))), F.lit(0)).alias("items"),
        F.count_if((F.col("n_items") == 0) & ~agg).alias("zero_sites"),
        F.count_if((F.col("n_items") == 0) & agg).alias("zero_aggregators"),
        F.count_if(F.col("n_items") == TIMED_OUT).alias("timed_out"),
        F.count_if(~text.is_blank(F.col("err"))).alias("errored"),
    )


def stale_feeds(newest: DataFrame, budgets: DataFrame, as_of: Column, aggregators: list[str], default_hours: float = 48.0) -> DataFrame:
    """Feeds whose newest date is older than their site's budget, oldest first.

    Undated feeds and aggregators aren't reported. newest(domain, feed_url, newest).
    """
    b = budgets.select(F.col("domain").alias("_d"), F.col("stale_hours").cast("double").alias("_h")).dropDuplicates(["_d"])
    d = newest.filter(F.col("newest").isNotNull())
    if aggregators:
        d = d.filter(~F.col("domain").isin(*aggregators))
    d = d.join(b, F.col("domain") == F.col("_d"), "left").withColumn("budget_h", F.coalesce("_h", F.lit(default_hours))).withColumn("age_h", dates.age_hours(F.col("newest"), as_of))
    return d.filter(F.col("age_h") > F.col("budget_h")).select("domain", "feed_url", "newest", "budget_h", "age_h").orderBy(F.desc("age_h"), "domain", "feed_url")


def yield_profile(items: DataFrame, routed: DataFrame, as_of: Column, hours: int, key: str = "source_domain", rescued: DataFrame | None = None, timings: DataFrame | None = None) -> DataFrame:
    """Per source: items, span of dates in hours, fresh (undated count), passed, near misses, without body.

    With ``rescued`` (near misses whose lede matched) also ``rescued``, with
    ``timings(key, ms)`` also ``ms``, the mean time of its requests.
    """
    fresh = F.col("published_at").isNull() | dates.within_window(F.col("published_at"), as_of, hours)
    span = (F.unix_micros(F.max("published_at")) - F.unix_micros(F.min("published_at"))) / 3.6e9
    a = items.groupBy(key).agg(F.count(F.lit(1)).alias("items"), F.round(span, 3).alias("span_h"), F.count_if(fresh).alias("fresh"), F.count_if(text.is_blank(F.col("summary"))).alias("no_body"))
    b = routed.groupBy(key).agg(F.count_if(F.col("route") != "lede").alias("passed"), F.count_if(F.col("route") == "lede").alias("near"))
    out = a.join(b, key, "left")
    columns = [F.col(key), F.col("items"), F.col("span_h"), F.col("fresh"), F.coalesce("passed", F.lit(0)).alias("passed"), F.coalesce("near", F.lit(0)).alias("near"), F.col("no_body")]
    if rescued is not None:
        out = out.join(rescued.groupBy(key).agg(F.count(F.lit(1)).alias("_r")), key, "left")
        columns.append(F.coalesce("_r", F.lit(0)).alias("rescued"))
    if timings is not None:
        out = out.join(timings.groupBy(key).agg(F.avg("ms").alias("ms")), key, "left")
        columns.append(F.col("ms"))
    return out.select(*columns)


def error_lines(scans: DataFrame, n: int = 10) -> DataFrame:
    """Per kind of failure: how many scans, and their first ``n`` lines ``domain: message`` in order, once each."""
    d = scans.filter(~text.is_blank(F.col("err"))).select(text.error_class(F.col("err")).alias("kind"), F.concat_ws(": ", "domain", "err").alias("line"))
    per = d.groupBy("kind", "line").agg(F.count(F.lit(1)).alias("c"))
    k = F.row_number().over(Window.partitionBy("kind").orderBy("line"))
    first = per.withColumn("k", k).filter(F.col("k") <= n).groupBy("kind").agg(F.array_join(F.array_sort(F.collect_list("line")), " | ").alias("lines"))
    return per.groupBy("kind").agg(F.sum("c").alias("n")).join(first, "kind").select("kind", "n", "lines")


def verdicts(rows: DataFrame, ok: Column, key: str = "domain", n: int = 25) -> DataFrame:
    """Per site filled and unfilled, the sites with most attempts first."""
    d = rows.groupBy(key).agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("fail"))
    return d.orderBy(F.desc(F.col("ok") + F.col("fail")), key).limit(n)


def probe(results: DataFrame) -> DataFrame:
    """Translation probe results(ok, seconds, message): successes, mean latency, blocks, gate."""
    d = results.withColumn("kind", text.error_class(F.col("message")))
    a = d.agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok"), F.avg(F.when(F.col("ok"), F.col("seconds"))).alias("mean_s"), F.count_if(F.col("kind") == "block").alias("blocked"))
    return a.withColumn("passes", (F.col("ok") >= F.ceil(F.col("n") * 0.75)) & (F.col("blocked") == 0))


def capped_labels(feeds: DataFrame, n: int = 15) -> DataFrame:
    """One line with the labels of feeds without items."""
    return feeds.filter("n_items = 0").agg(text.join_capped(F.collect_set(urls.feed_label(F.col("feed_url"))), n).alias("labels"))


def diagnosis(pages: DataFrame) -> DataFrame:
    """Extraction verdict of ``pages(url, html, paragraphs, snippet)``: FETCH, EXTRACTOR or OK."""
    return pages.select(
        "url",
        F.when(text.is_blank(F.col("html")), "FETCH").when(F.size(F.coalesce("paragraphs", F.array().cast("array<string>"))) == 0, "EXTRACTOR").when(text.is_blank(F.col("snippet")), "EXTRACTOR").otherwise("OK").alias("verdict"),
    )
