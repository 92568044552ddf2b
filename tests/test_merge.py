from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wirelake.operators import dedupe, merge

NEW = "url string, domain string, source_name string, title string, snippet string, published_at timestamp, found_at timestamp, matched_keywords array<string>, published_is_approx boolean, source_lang string, title_original string, title_en string, snippet_en string, seq long, t string"
OLD = "url string, published_at timestamp, snippet string, source_lang string, title_original string, title_en string, snippet_en string"
D1, D2 = datetime(2026, 1, 1), datetime(2026, 2, 2)


def new(spark, **k):
    base = dict(url="u", domain="d", source_name="s", title="T", snippet="new", published_at=D2, found_at=D2, matched_keywords=["k"], published_is_approx=False, source_lang=None, title_original=None, title_en=None, snippet_en=None, seq=1, t="clash")
    base.update(k)
    return spark.createDataFrame([tuple(base.values())], NEW)


def old(spark, **k):
    base = dict(url="u", published_at=D1, snippet="old", source_lang="ru", title_original="О", title_en="O", snippet_en="S")
    base.update(k)
    return spark.createDataFrame([tuple(base.values())], OLD)


def one(df):
    return df.collect()[0].asDict()


@pytest.mark.parametrize(
    "incoming,stored,expected",
    [
        (dict(published_is_approx=True), {}, dict(published_at=D1)),
        (dict(published_is_approx=True), dict(published_at=None), dict(published_at=D2)),
        ({}, {}, dict(published_at=D2, snippet="new", title="T", title_en=None)),
        (dict(source_lang="ru"), {}, dict(title_en="O", snippet_en="S", source_lang="ru")),
        (dict(source_lang="ru", title_en="New"), {}, dict(title_en="New", snippet_en="S")),
        (dict(source_lang="ru", title_en="New", snippet_en="N"), {}, dict(title_en="New", snippet_en="N", title_original=None)),
        (dict(source_lang="pt"), {}, dict(title_en=None, title_original=None)),
        (dict(snippet=" \n"), {}, dict(snippet="old")),
        (dict(snippet=None), dict(snippet=None), dict(snippet="")),
        (dict(url="v", snippet=" "), {}, None),
    ],
)
def test_truth_table(spark, incoming, stored, expected):
    got = merge.merge(new(spark, **incoming), old(spark, **stored))
    if expected is None:
        rows = {r.url: r for r in got.collect()}
        assert rows["v"].snippet == "" and rows["u"].snippet == "old" and rows["u"].title is None
    else:
        row = one(got)
        assert {k: row[k] for k in expected} == expected


def test_failed_lookups_defer(spark):
    a = new(spark, published_is_approx=True)
    assert one(merge.merge(a, old(spark), dates_ok=False))["snippet"] == "old"
    f = new(spark, source_lang="ru")
    assert one(merge.merge(f, old(spark), overlays_ok=False))["snippet"] == "old"
    t = new(spark, source_lang="ru", title_en="E")
    assert one(merge.merge(t, old(spark), overlays_ok=False))["snippet"] == "new"


def test_last_row_wins_and_empty_tables(spark):
    both = new(spark, title="first", seq=1).union(new(spark, title="second", seq=2))
    assert one(merge.merge(both, old(spark)))["title"] == "second"
    assert merge.merge(both.limit(0), old(spark)).count() == 1
    assert merge.merge(both, old(spark).limit(0)).count() == 1


def test_snippet_repair(spark):
    f = spark.createDataFrame([("u", "x"), ("u", "y"), ("w", "z"), (None, "q")], "url string, snippet string")
    assert one(merge.merge_snippets(old(spark), f))["snippet"] == "y"
    assert one(merge.merge_snippets(old(spark), f.limit(0)))["snippet"] == "old"


def test_dedupe(spark):
    df = spark.createDataFrame([("https://www.a.example/x?utm_source=1", None, 1), ("https://a.example/x", D1, 2), (None, D1, 3), (None, None, 4)], "url string, published_at timestamp, seq long")
    assert {r.seq for r in dedupe.first_by_url(df).collect()} == {1, 3, 4}
    same = df.withColumn("url", F.lit("x"))
    assert [r.seq for r in dedupe.prefer_dated(same).collect()] == [2]
    assert [r.seq for r in dedupe.last_by_key(same, "url", "published_at", "seq").collect()] == [3]


def test_versions(spark, tmp_path):
    folder = "file://" + str(tmp_path)
    assert merge.newest_version(spark, folder + "/none") is None
    for v in (0, 1):
        merge.write_table(spark, spark.range(v + 1), folder, v)
    (tmp_path / "v=00000009").mkdir()
    n, path = merge.newest_version(spark, folder)
    assert n == 1 and spark.read.parquet(path).count() == 2
