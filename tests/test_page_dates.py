from test_pipeline import CFG, ITEM, item

from wirelake.operators import enrich


def test_date_after_unreadable_ones(spark):
    df = enrich.resolve_wrappers(spark.createDataFrame([item(1, "x", age=None)], ITEM), None, "w:")
    times = "".join(f'<time datetime="em breve {i}">x</time>' for i in range(6)) + '<time datetime="2026-05-31T10:00:00Z">y</time>'
    pages = spark.createDataFrame([("https://s.example/x/1", f"<html><body><article>{times}<p>Texto</p></article></body></html>")], "url string, html string")
    assert str(enrich.enrich(df, pages, None, CFG).first().published) == "2026-05-31 10:00:00"
