"""One row per key: first, first dated, or last.

Rows without a key are no copies of each other: all are kept, and not brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirelake.functions import urls


def _one(df: DataFrame, key: Column, *order: Column, stored: Column | None = None) -> DataFrame:
    """``stored`` is the column that ``key`` is made of: a scan can skip its non-NULL rows."""
    none = (key if stored is None else stored).isNull()
    keyed = df.filter(~none).withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")
    return keyed.unionByName(df.filter(none))


def first_by_url(items: DataFrame, seq: str = "seq") -> DataFrame:
    """The first row of each normalised URL."""
    return _one(items.withColumn("url_key", urls.normalize(F.col("url"))), F.col("url_key"), F.col(seq), stored=F.col("url"))


def prefer_dated(items: DataFrame, seq: str = "seq", date: str = "published_at", url: str = "url") -> DataFrame:
    return _one(items, F.col(url), F.col(date).isNull(), F.col(seq))


def last_by_key(rows: DataFrame, key: str, time: str, seq: str) -> DataFrame:
    """The row with the latest time, the later one of equals."""
    return _one(rows, F.col(key), F.col(time).desc_nulls_last(), F.col(seq).desc())
