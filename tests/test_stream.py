from pyspark.sql import functions as F

from wirelake.operators import merge
from wirelake.session import shared_dir
from wirelake.streaming import stream


def write(spark, folder, n, rows):
    spark.createDataFrame(rows, "url string, v long, collected_at timestamp").coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_over_batches(spark, tmp_path):
    from datetime import datetime, timedelta

    t0 = datetime(2026, 1, 1)
    src = "file://" + str(tmp_path / "in")
    for k in range(3):
        write(spark, src, k, [(f"u{i % 4}", 10 * k + i, t0 + timedelta(hours=i)) for i in range(6)])
    s = stream.read_items(spark, src, per_batch=1).select("url", F.struct("v").alias("at"), "v")
    got = {r.url: r.v for r in stream.to_table(s, ["url"], "at").collect()}
    want = {r.url: r.v for r in spark.read.parquet(src).groupBy("url").agg(F.max("v").alias("v")).collect()}
    assert got == want
    c = stream.counts_per_window(stream.read_items(spark, src, per_batch=1), key="url")
    n = {(r.url): r.n for r in stream.to_table(c, ["start", "url"], mode="update").collect()}
    assert n == {r.url: r["count"] for r in spark.read.parquet(src).groupBy("url").count().collect()}
    d = stream.distinct_urls(stream.read_items(spark, src, per_batch=1))
    assert stream.to_table(d.select("url"), ["url"]).count() == 4


def test_repeated_batch_is_idempotent(spark, tmp_path):
    folder = "file://" + str(tmp_path / "t")
    w = stream.upsert(folder, ["k"], stream.replace_by_key(["k"]))
    a = spark.createDataFrame([(1, "a")], "k long, v string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k long, v string")
    for df, n in ((a, 0), (b, 1), (b, 1)):
        w(df, n)
    assert {(r.k, r.v) for r in merge.read_buckets(spark, folder).collect()} == {(1, "b"), (2, "b")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    folder = "file://" + str(tmp_path / "t")
    w = stream.upsert(folder, ["k"], stream.replace_by_key(["k"]), buckets=4)
    w(spark.createDataFrame([(i, "a") for i in range(40)], "k long, v string"), 0)
    for n in (1, 2, 3):
        w(spark.createDataFrame([(7, f"n{n}")], "k long, v string"), n)
    have = merge.bucket_versions(spark, folder)
    assert sorted(have) == [0, 1, 2, 3] and sorted(map(len, have.values())) == [1, 1, 1, 2]  # the last and the one before
    got = {r.k: r.v for r in merge.read_buckets(spark, folder).collect()}
    assert got == {**{i: "a" for i in range(40)}, 7: "n3"}


def test_stream_merges_write_once(spark, tmp_path):
    """Three batches as a stream give the table that three merges give."""
    schema = "url string, snippet string, published_at string, published_is_approx boolean, source_lang string, title_en string, snippet_en string, title_original string, found_at long, seq long"
    batches = [
        [("u", "text", "2026-01-01", False, "ru", "title", "body", None, 0, 1), ("v", "", None, None, None, None, None, None, 0, 2)],
        [("u", " ", "2026-02-02", True, "ru", None, None, None, 1, 3), ("w", "x", "2026-03-03", True, None, None, None, None, 1, 4)],
        [("v", "later", "2026-04-04", False, None, None, None, None, 2, 5)],
    ]
    src = "file://" + str(tmp_path / "in")
    for rows in batches:
        more = {"domain": F.lit("d"), "source_name": F.lit("n"), "title": F.lit("t"), "matched_keywords": F.array(F.lit("k"))}
        spark.createDataFrame(rows, schema).withColumns(more).coalesce(1).write.mode("append").parquet(src)
    got = {r.url: (r.snippet, r.published_at, r.title_en) for r in stream.to_table(stream.read_items(spark, src, per_batch=1), ["url"], change=stream.write_once()).collect()}
    assert got == {"u": ("text", "2026-01-01", "title"), "v": ("later", "2026-04-04", None), "w": ("x", "2026-03-03", None)}


def test_shared_dir(spark):
    stated = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (stated or shared_dir(spark)).rstrip("/")
