"""Requests of bounded weight for a keyed lookup: order kept, an oversized key alone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.functions import urls


def chunk_urls(df: DataFrame, most: int = 12_000, keys: int = 100, lanes: int = 64) -> DataFrame:
    """``url, lane, chunk``: chunks of a lane are filled one after another, in order of the URLs.

    A lane is chosen by the URL's hash, so the result doesn't depend on how the input
    is divided; ``lanes`` is the parallelism of the requests. NULL URLs are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, at, room, n = None, 0, most, 0
        for b in batches:
            out = []
            for now, w in zip(b["lane"], b["w"]):
                if now != lane:
                    lane, at, room, n = now, 0, most, 0
                elif n and (w > room or n >= keys):
                    at, room, n = at + 1, most, 0
                out.append(at)
                room, n = room - w, n + 1
            yield pd.DataFrame({"url": b["url"], "lane": b["lane"], "chunk": out})

    rows = df.filter("url is not null").select("url", F.pmod(F.xxhash64("url"), F.lit(lanes)).cast("int").alias("lane"), urls.encoded_weight(F.col("url")).alias("w"))
    return rows.repartition(lanes, "lane").sortWithinPartitions("lane", "url").mapInPandas(run, "url string, lane int, chunk int")
