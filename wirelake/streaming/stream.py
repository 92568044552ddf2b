"""The same transforms over file streams.

The scanner keeps no state of its own: the keyed table is the state, the checkpoint
holds source offsets, and a repeated batch merges to the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wirelake.functions import dates, urls
from wirelake.operators import merge as m
from wirelake.operators.dedupe import last_by_key
from wirelake.session import discard, materialize, run_folder


def read_items(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """Item files as a stream, with the schema of the files that are there."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    return (r.option("maxFilesPerTrigger", per_batch) if per_batch else r).parquet(path + "*")


def fresh(stream: DataFrame, as_of, hours: int, slack: int = 24) -> DataFrame:
    """Items in the window; undated ones by their hint, with a day more."""
    own = F.col("published_at").isNull() | dates.within_window(F.col("published_at"), as_of, hours)
    hint = F.col("published_at").isNotNull() | F.col("published_hint").isNull() | dates.within_window(F.col("published_hint"), as_of, hours + slack)
    return stream.filter(own & hint)


def distinct_urls(stream: DataFrame, time: str = "collected_at", delay: str = "30 days") -> DataFrame:
    """The first row of each normalised URL within the watermark."""
    t = stream.withColumn("url_key", urls.normalize(F.col("url"))).withColumn(time, F.col(time).cast("timestamp"))
    return t.withWatermark(time, delay).dropDuplicatesWithinWatermark(["url_key"])


def counts_per_window(stream: DataFrame, time: str = "collected_at", width: str = "1 day", key: str = "source_domain", delay: str = "400 days") -> DataFrame:
    t = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return t.groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


BUCKETS = 64


def upsert(folder: str, key: list[str], change: Callable[[DataFrame, DataFrame | None], DataFrame], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of a keyed table in ``buckets`` folders by the key's hash.

    A batch rewrites only the buckets its keys fall into, each as a version with the
    batch's number, so a batch that runs again replaces its own; versions older than the
    one before the last are removed, as no reader is two batches behind.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # the batch is read twice; a written copy costs less than its sources
        new = materialize(batch.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")), "batch")
        touched = sorted(r[0] for r in new.select("_b").distinct().collect())
        if not touched:
            return
        have = m.bucket_versions(spark, folder, before=number)
        old = [f"{folder}/b={b}/v={have[b][-1]:08d}" for b in touched if b in have]
        rows = change(new.drop("_b"), spark.read.parquet(*old) if old else None)
        rows = rows.withColumn("b", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        m.write_buckets(spark, rows, folder, number)
        m.expire(spark, folder, {b: v for b, v in have.items() if b in touched})
        discard(new)

    return write


def replace_by_key(keys: list[str], time: str | None = None) -> Callable[[DataFrame, DataFrame | None], DataFrame]:
    """New rows in the place of old ones with the same key; with ``time``, the later one stays."""

    def change(new: DataFrame, old: DataFrame | None) -> DataFrame:
        if old is None:
            rows = new
        elif time:
            rows = new.unionByName(old)
        else:
            return old.join(new, keys, "left_anti").unionByName(new)
        return last_by_key(rows.withColumn("_k", F.struct(*keys)), "_k", time or keys[0], keys[0]).drop("_k")

    return change


def write_once(seq: str = "seq") -> Callable[[DataFrame, DataFrame | None], DataFrame]:
    """The merge of article rows that keeps stored dates and overlays (``operators.merge``)."""

    def change(new: DataFrame, old: DataFrame | None) -> DataFrame:
        stored = old if old is not None else new.select(*[c for c in m.PERSISTED if c in new.columns]).limit(0)
        return m.merge(new, stored, seq=seq)

    return change


def run_now(stream: DataFrame, write: Callable[[DataFrame, int], None], folder: str, mode: str = "append") -> StreamingQuery:
    """All data that is there, then the query ends."""
    q = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", folder).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_every(stream: DataFrame, write: Callable[[DataFrame, int], None], folder: str, seconds: int = 300, mode: str = "append") -> StreamingQuery:
    """A batch every ``seconds``; end it with ``stop()``."""
    return stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", folder).trigger(processingTime=f"{seconds} seconds").start()


def to_table(stream: DataFrame, keys: list[str], time: str | None = None, mode: str = "append", change: Callable | None = None) -> DataFrame:
    """Runs the stream to its present end and gives the keyed table."""
    spark = stream.sparkSession
    base = f"{run_folder(spark)}/stream-{uuid.uuid4().hex}"
    run_now(stream, upsert(base + "/table", keys, change or replace_by_key(keys, time)), base + "/offsets", mode)
    found = m.read_buckets(spark, base + "/table")
    return found if found is not None else spark.createDataFrame([], stream.schema)
