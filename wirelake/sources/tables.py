"""Reading the pipeline's own tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYWORDS = "keyword string, match_type string"


def read_keywords(spark: SparkSession, *paths: str) -> DataFrame:
    """Keywords of all paths that can be read; an empty table if none can.

    Files without ``match_type`` hold substring terms.
    """
    out = spark.createDataFrame([], KEYWORDS)
    for p in paths:
        try:
            df = spark.read.parquet(p)
        except AnalysisException:
            continue
        kind = F.col("match_type") if "match_type" in df.columns else F.lit("substring")
        out = out.unionByName(df.select(F.col("keyword").cast("string"), kind.cast("string").alias("match_type")))
    return out


def empty_rows(table: DataFrame, since, domain: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows without snippet since a time, the newest first."""
    from wirelake.functions.text import is_blank

    d = table.filter((F.col("published_at") > since) & is_blank(F.col("snippet")))
    if domain:
        d = d.filter(F.col("domain") == domain)
    d = d.orderBy(F.desc("published_at"), "url")
    return d.limit(limit) if limit else d


def lookup(table: DataFrame, keys: DataFrame, *columns: str, key: str = "url") -> DataFrame:
    """The stored columns of the keys that are there; a join, so no request size matters."""
    return table.select(key, *columns).join(keys.select(key).distinct(), key, "left_semi")


def top_recent(table: DataFrame, site: str, n: int, key: str = "domain", date: str = "published_at", tie: str = "url") -> DataFrame:
    """The newest ``n`` rows of a site; undated ones last."""
    return table.filter(F.col(key) == site).orderBy(F.desc_nulls_last(date), tie).limit(n)
