"""Budgets shared fairly among sites, as window expressions.

Each is the closed form of a greedy walk along an ordered list. Sites rank their
own rows first, so a global limit only sees what a site may contribute at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rank(df: DataFrame, key: str, *order: Column, name: str = "_rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def two_level_cap(df: DataFrame, total: int, per_key: int, key: str = "domain", seq: str = "seq") -> DataFrame:
    """Rows in order while their key has room and the total isn't reached."""
    return _rank(df, key, F.col(seq)).filter(F.col("_rn") <= per_key).drop("_rn").orderBy(seq).limit(total)


def per_key_cap(df: DataFrame, n: int, key: str = "domain", seq: str = "seq") -> DataFrame:
    return _rank(df, key, F.col(seq)).filter(F.col("_rn") <= n).drop("_rn")


def mixed_cap(df: DataFrame, dated: int, undated: int, key: str = "domain", seq: str = "seq", date: str = "published_at") -> DataFrame:
    """A shared counter per key: dated rows enter below ``dated``, undated ones below ``undated``.

    What enters is among a key's first ``dated`` rows or its first ``undated`` undated
    ones, so both ranks stop early and no key is ranked as a whole.
    """
    first = _rank(df, key, F.col(seq)).filter(F.col("_rn") <= dated)
    # an undated row of rank r among the undated is at place r or later: the later places are
    # those behind the key's first rows, of which it needs the number of undated ones
    inside = first.filter(F.col(date).isNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_in"))
    none = _rank(df.filter(F.col(date).isNull()), key, F.col(seq)).filter(F.col("_rn") <= undated)
    late = none.join(inside, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_ln", F.col("_rn") - F.coalesce("_in", F.lit(0))).filter((F.col("_ln") > 0) & (F.col("_ln") <= undated - dated))
    return first.drop("_rn").unionByName(late.drop("_rn", "_in", "_ln", "_key"))


def _day(date: str, oldest_first: bool) -> Column:
    day = F.coalesce(F.unix_micros(date), F.lit(-(2**62)))
    return day if oldest_first else -day


def round_robin(df: DataFrame, key: str = "domain", date: str = "published_at", seq: str = "seq", oldest_first: bool = False, most_per_key: int | None = None) -> DataFrame:
    """With ``rr_round``, ``rr_head``, ``rr_first``: order by them for one row of each key in turn.

    Inside a key by date (none is oldest); the key with the newest (or oldest)
    head opens each round; ties in input order. Heads come from an aggregation over all
    rows, and only the first ``most_per_key`` rows of a key are ranked.
    """
    d = df.withColumn("_day", _day(date, oldest_first))
    heads = d.groupBy(F.col(key).alias("_key")).agg(F.min("_day").alias("rr_head"), F.min(seq).alias("rr_first"))
    ranked = d.withColumn("rr_round", F.row_number().over(Window.partitionBy(key).orderBy("_day", seq)))
    if most_per_key:
        ranked = ranked.filter(F.col("rr_round") <= most_per_key)
    return ranked.join(heads, F.col(key).eqNullSafe(F.col("_key"))).drop("_day", "_key")


RR_ORDER = ("rr_round", "rr_head", "rr_first")


def interleave(df: DataFrame, limit: int, key: str = "domain", date: str = "published_at", seq: str = "seq", url: str = "url") -> DataFrame:
    """The first ``limit`` rows of the fresh and the stale pass in turn, each row once, with ``pos``.

    A row beyond place ``limit`` of its site in both passes can't be among the first
    ``limit``, so sites are cut before rows meet in one ordered list.
    """
    fresh = round_robin(df, key, date, seq, most_per_key=limit).orderBy(*RR_ORDER).limit(limit).drop(*RR_ORDER)
    stale = round_robin(df, key, date, seq, oldest_first=True, most_per_key=limit).withColumnsRenamed({c: "s_" + c for c in RR_ORDER}).orderBy("s_rr_round", "s_rr_head", "s_rr_first").limit(limit)
    f = round_robin(fresh, key, date, seq)
    f = f.withColumn("pos", 2 * F.row_number().over(Window.orderBy(*RR_ORDER)) - 2).drop(*RR_ORDER)
    s = stale.withColumn("pos", 2 * F.row_number().over(Window.orderBy("s_rr_round", "s_rr_head", "s_rr_first")) - 1).drop("s_rr_round", "s_rr_head", "s_rr_first")
    both = f.unionByName(s)
    first = both.withColumn("_n", F.row_number().over(Window.partitionBy(url).orderBy("pos"))).filter("_n = 1").drop("_n")
    return first.orderBy("pos").limit(limit)


def backfill_pick(empty: DataFrame, known: DataFrame | None, lookup: int, total: int, per_key: int) -> DataFrame:
    """Rows without snippet to fetch: interleaved head, those with stored text away, capped.

    ``known`` None means the lookup failed: then only the first ``per_key`` rows are taken.
    """
    if known is None:
        return two_level_cap(interleave(empty, per_key), total, per_key, seq="pos")
    head = interleave(empty, lookup)
    return two_level_cap(head.join(known.select("url").distinct(), "url", "left_anti"), total, per_key, seq="pos")


def repair_pick(empty: DataFrame, total: int, per_key: int) -> DataFrame:
    """Rows of the repair job: round-robin order, capped per site and in total."""
    rows = round_robin(empty, most_per_key=per_key)
    return rows.orderBy(*RR_ORDER).limit(total)
