import pandas as pd
import pytest

from wirelake.llm import language as lg


@pytest.fixture(scope="module")
def samples(data):
    df = pd.read_parquet(data + "/lang_samples.parquet")
    return list(zip(df["lang"], df["text"]))


def test_held_out_accuracy(samples):
    used = [s for i, s in enumerate(samples) if i % 4]
    held = [s for i, s in enumerate(samples) if not i % 4]
    acc = lg.accuracy(lg.train(used), held)
    assert (acc["mean"] >= 0.97).all() and len(acc) == 7


def test_words():
    assert lg.words_of("A refinaria Petbras de Sul abre") == ["a", "refinaria", "de", "abre"]
    assert lg.words_of("石油2公司") == ["石", "油", "公", "司"]
    assert lg.words_of("") == [] == lg.words_of("12 34")


def test_units():
    assert lg.units_of("T", "<p>Um. Dois!</p>") == ["T", "Um.", "Dois!"]
    assert lg.units_of(None, " ") == [] and lg.units_of("", "x = `select a` y") == ["x = select a y"]
    assert lg.units_of("T", "石油公司。天然气！") == ["T", "石油公司。", "天然气！"]


PT = "A petroleira anunciou a venda de mil barris de óleo cru no porto, conforme o relatório técnico."
EN = "The refinery announced a maintenance shutdown of its coking unit, according to the technical report."
RU = "Нефтяная компания объявила о планах на повышение цен на дизель в порту, согласно отчёту."


def test_cases(spark, data):
    rows = [
        (1, "pt_BR", PT, PT), (2, None, PT, PT), (3, None, EN, EN), (4, "en", PT, ""), (5, "und", PT, PT), (6, "", EN, EN), (7, "pt", PT, PT + " " + EN + " " + PT), (8, "ru", RU, None), (9, "he", "", ""), (10, None, None, None),
        (11, "en", EN, EN + "\nErro 404"), (12, "EN", EN, EN + " " + RU), (None, "ru", EN, EN), (3, None, EN, EN),
    ]
    df = spark.createDataFrame(rows, "article_id long, source_lang string, title string, snippet string").selectExpr("*", "1 as no", "2 as n", "'q' as lang")
    ls = spark.read.parquet(data + "/lang_samples.parquet")
    got = sorted(map(tuple, lg.p5_found(df, ls).collect()), key=str)
    want = [(3, 0, "en"), (3, 0, "en"), (4, 0, "pt"), (5, 0, "pt"), (6, 0, "en"), (7, 1, "pt"), (7, 2, "en"), (7, 3, "pt"), (12, 1, "en"), (12, 2, "ru"), (None, 0, "en")]
    assert got == sorted(want, key=str)
    conf = [r.confidence for r in lg.p5_cases(df, ls).collect()]
    assert all(0 < c <= 1 for c in conf)
    assert lg.p5_found(df.limit(0), ls).count() == 0 and lg.p5_found(df, ls.limit(0)).count() == 0
