"""Translation of kept foreign rows by a function the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.functions.text import is_blank

MAX_CHARS = 4500
# Labels as translators know them; other labels are left to the translator's own guess.
CODES = {"ar": "ar", "fa": "fa", "iw": "iw", "ru": "ru", "zh": "zh-CN", "es": "es"}


def is_foreign(lang: Column) -> Column:
    return F.coalesce(lang.isNotNull() & (F.trim(lang) != "") & ~F.lower(lang).isin("en", "pt"), F.lit(False))


def lookup_translator(table: dict[str, str]) -> Callable[[str, str], str | None]:
    """Offline translator: whole texts by a table."""
    return lambda text, lang: table.get(text)


def translate(articles: DataFrame, translator: Callable[[str, str], str | None], done: DataFrame | None = None, cap: int = 40, seq: str = "seq") -> DataFrame:
    """With ``title_original`` for all foreign rows and ``title_en``, ``snippet_en`` for at most ``cap``.

    Rows whose URL is in ``done`` are skipped. A field whose translation fails stays NULL.
    """
    d = articles
    for c in ("title_original", "title_en", "snippet_en"):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("string"))
    foreign = d.filter(is_foreign(F.col("source_lang")))
    pending = foreign.join(done.select("url").distinct(), "url", "left_anti") if done is not None else foreign
    asked = pending.orderBy(seq).limit(cap).select("url", "title", "snippet", "source_lang")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(text: str | None, lang: str) -> str | None:
            if not text or not text.strip():
                return None
            for code in dict.fromkeys((CODES.get((lang or "").strip().lower(), "auto"), "auto")):
                try:
                    out = translator(text[:MAX_CHARS], code)
                except Exception:  # noqa: BLE001 - any translator's failure leaves the field empty
                    out = None
                if out and out.strip():
                    return out.strip()
            return None

        for b in batches:
            yield pd.DataFrame({"url": b["url"], "_t": [one(t, c) for t, c in zip(b["title"], b["source_lang"])], "_s": [one(t, c) for t, c in zip(b["snippet"], b["source_lang"])]})

    got = asked.mapInPandas(run, "url string, _t string, _s string").groupBy("url").agg(F.max("_t").alias("_t"), F.max("_s").alias("_s"))
    d = d.join(got, "url", "left")
    return (
        d.withColumn("title_original", F.when(is_foreign(F.col("source_lang")), F.col("title")).otherwise(F.col("title_original")))
        .withColumn("title_en", F.coalesce("_t", "title_en"))
        .withColumn("snippet_en", F.coalesce(F.when(~is_blank(F.col("snippet")), F.col("_s")), "snippet_en"))
        .drop("_t", "_s")
    )
