import os
from datetime import datetime

import pytest

from wirelake.plans import catalog

ITEM = "item_id long, url string, title string, summary string, published_at timestamp, source_domain string, feed_domain string, title_hint string, published_hint string, source_lang string, feed_url string, collected_at timestamp"


@pytest.fixture
def folder(spark, data, tmp_path):
    """The test tables with other raw items."""

    def make(*rows):
        for f in os.listdir(data):
            if f != "raw_items.parquet":
                os.symlink(f"{data}/{f}", tmp_path / f)
        full = [(i, f"https://s.example/x/{i}", title, "texto", at, "s.example", "f.example", "", hint, None, "f", None) for i, title, at, hint in rows]
        spark.createDataFrame(full, ITEM).write.parquet(f"{tmp_path}/raw_items.parquet")
        return str(tmp_path)

    return make


def test_terms_come_from_the_table(spark, folder):
    at = datetime(2026, 6, 14)
    d = folder((1, "Preço do barril hoje", at, None), (2, "A tancagem cresce", at, None), (3, "Nada disso", at, None))
    got = {r.seq: (r.keywords, r.drop_reason) for r in catalog.QUERIES["validate_articles"](spark, d).collect()}
    assert got == {1: ("barril", None), 2: ("tancagem", None)}
    stored = {r.url: r.keywords for r in catalog.QUERIES["pipeline_run"](spark, d).collect()}
    assert stored["https://s.example/x/1"] == "barril" and stored["https://s.example/x/2"] == "tancagem"


def test_hints_in_any_form(spark, folder):
    fresh = ["14/06/2026", "14 de junho de 2026", "Sun, 14 Jun 2026 09:30:14 UTC", "2026-06-14"]
    old = ["15/01/2025", "15 de janeiro de 2025"]
    d = folder(*[(i, "Preço do diesel", None, h) for i, h in enumerate(fresh + old + [None, "ontem"])])
    day = 1_781_395_200_000_000  # 2026-06-14
    got = {r.seq: (r.published_us, r.drop_reason) for r in catalog.QUERIES["validate_articles"](spark, d).collect()}
    assert got == {**{i: (day, None) for i in range(4)}, 6: (None, "undated"), 7: (None, "undated")}
    kept = {r.url[-1]: r.published_us for r in catalog.QUERIES["pipeline_run"](spark, d).collect() if "//s.example/x/" in r.url}
    assert kept == {str(i): day for i in range(4)}
