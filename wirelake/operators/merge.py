"""The write-once merge of new rows into the article table.

- a date that is only approximate never replaces a stored one; a real one does
- overlay columns keep what is stored where a row at risk brings a blank
- a blank snippet never erases a stored one; a new row gets the empty string
- all other columns take the new value
- one row per key and batch: the last
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelake.functions.text import is_blank, nonblank
from wirelake.operators.dedupe import last_by_key

OVERLAY = ("source_lang", "title_original", "title_en", "snippet_en")
PERSISTED = ("url", "domain", "source_name", "title", "snippet", "published_at", "found_at", "matched_keywords", *OVERLAY)


def at_risk(lang, title_en, snippet_en):
    """A foreign row that lacks part of its overlay: a stored one must not be lost to it."""
    foreign = lang.isNotNull() & ~F.lower(F.trim(lang)).isin("", "pt", "en")
    return F.coalesce(foreign & (is_blank(title_en) | is_blank(snippet_en)), F.lit(False))


def deferred(new: DataFrame, dates_ok: bool = True, overlays_ok: bool = True) -> DataFrame:
    """Rows that must wait because the stored values couldn't be looked up."""
    wait = F.lit(False)
    if not dates_ok:
        wait = wait | F.coalesce("published_is_approx", F.lit(False))
    if not overlays_ok:
        wait = wait | (at_risk(F.col("source_lang"), F.col("title_en"), F.col("snippet_en")) & is_blank(F.col("title_en")))
    return new.filter(wait)


def merge(new: DataFrame, stored: DataFrame, dates_ok: bool = True, overlays_ok: bool = True, seq: str = "seq") -> DataFrame:
    """The table after the merge; ``stored`` has the persisted columns it has (missing ones are NULL)."""
    one = last_by_key(new.filter("url is not null"), "url", "found_at", seq)  # a keyed table has no rows without key
    if not (dates_ok and overlays_ok):
        one = one.join(deferred(one, dates_ok, overlays_ok).select("url"), "url", "left_anti")
    have = [c for c in PERSISTED if c in stored.columns]
    both = one.alias("s").join(stored.select(*have).alias("t"), "url", "full_outer")
    is_new = F.col("s." + seq).isNotNull()

    def old(c: str):
        return F.col("t." + c) if c in have else F.lit(None).cast(dict(one.dtypes)[c])

    out = [F.col("url")]
    for c in PERSISTED[1:]:
        s, t = F.col("s." + c), old(c)
        if c == "published_at":
            v = F.when(F.coalesce("s.published_is_approx", F.lit(False)), F.coalesce(t, s)).otherwise(s)
        elif c == "snippet":
            v = F.coalesce(nonblank(s), t, F.lit(""))
        elif c in OVERLAY:
            v = F.when(at_risk(F.col("s.source_lang"), F.col("s.title_en"), F.col("s.snippet_en")), F.coalesce(nonblank(s), nonblank(t), s)).otherwise(s)
        else:
            v = s
        out.append(F.when(is_new, v).otherwise(t).alias(c))
    return both.select(*out)


def merge_snippets(stored: DataFrame, found: DataFrame) -> DataFrame:
    """The repair path: only ``snippet`` changes, where ``found(url, snippet)`` has text."""
    new = found.filter(~is_blank(F.col("snippet"))).groupBy("url").agg(F.max("snippet").alias("_s"))
    return stored.join(new, "url", "left").withColumn("snippet", F.coalesce("_s", "snippet")).drop("_s")


def write_table(spark: SparkSession, df: DataFrame, folder: str, version: int) -> str:
    """A new version of the table beside the old ones; readers take the newest complete one."""
    path = f"{folder}/v={version:08d}"
    df.write.mode("overwrite").parquet(path)
    return path


def newest_version(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """The newest version that was written to its end."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return None
    found = []
    for st in fs.listStatus(base):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return (max(found), f"{folder}/v={max(found):08d}") if found else None


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(base)]
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))


def bucket_versions(spark: SparkSession, folder: str, before: int | None = None) -> dict[int, list[int]]:
    """The versions of each bucket of a table; complete ones only, with ``before`` those of earlier batches.

    A batch is complete once its mark stands beside the buckets.
    """
    done = {n for n in _numbers(spark, f"{folder}/_done", "n=") if before is None or n < before}
    out = {b: [v for v in _numbers(spark, f"{folder}/b={b}", "v=") if v in done] for b in _numbers(spark, folder, "b=")}
    return {b: v for b, v in out.items() if v}


def write_buckets(spark: SparkSession, rows: DataFrame, folder: str, number: int) -> None:
    """``rows`` with bucket ``b`` as version ``number`` of their buckets."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = jvm.org.apache.hadoop.fs.Path
    stage = path(f"{folder}/_stage")
    rows.repartition("b").write.mode("overwrite").partitionBy("b").parquet(stage.toString())
    for st in fs.listStatus(stage):
        name = st.getPath().getName()
        if name.startswith("b="):
            target = path(f"{folder}/{name}/v={number:08d}")
            fs.mkdirs(target.getParent())
            fs.delete(target, True)  # of a lost run of the same batch
            fs.rename(st.getPath(), target)
    fs.delete(stage, True)
    fs.mkdirs(path(f"{folder}/_done/n={number:08d}"))


def expire(spark: SparkSession, folder: str, versions: dict[int, list[int]]) -> None:
    """Removes all but the last of the given versions of each bucket."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for b, found in versions.items():
        for v in found[:-1]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{folder}/b={b}/v={v:08d}"), True)


def read_buckets(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest version of all buckets as one table."""
    found = bucket_versions(spark, folder)
    return spark.read.parquet(*[f"{folder}/b={b}/v={v[-1]:08d}" for b, v in sorted(found.items())]) if found else None
