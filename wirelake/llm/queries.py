"""Queries p1, p2, p4 to p9 over the test tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelake.llm import language, markup, neardup, packing, residue, sitelines, splitting, tokenizer
from wirelake.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.p1_found(table(spark, d, "articles"))


@query("p1_groups")
def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.p1_groups(table(spark, d, "articles"))


@query("p7_ids")
def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode(table(spark, d, "documents"), "byte_bpe_50k")


@query("p7_roundtrip")
def p7_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose ids don't decode to their text; no rows if all do."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    back = tokenizer.decode(tokenizer.encode(docs, "byte_bpe_50k"), "byte_bpe_50k").withColumnRenamed("text", "decoded")
    return docs.join(back, "doc_id").filter(F.coalesce("text", F.lit("")) != F.col("decoded")).select("doc_id")


@query("p8_pack")
def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.p8_pack(table(spark, d, "documents"), table(spark, d, "token_limits"), "pack")


@query("p8_pack_long")
def p8_pack_long(spark: SparkSession, d: str) -> DataFrame:
    return packing.p8_pack(table(spark, d, "documents"), table(spark, d, "token_limits"), "pack_long")


@query("p8_fill")
def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    limits = table(spark, d, "token_limits")
    capacity = limits.filter("task = 'pack'").first()["max_tokens"]
    return packing.p8_fill(packing.p8_pack(table(spark, d, "documents"), limits, "pack"), capacity)


@query("p9_pieces")
def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.p9_pieces(table(spark, d, "documents"), table(spark, d, "token_limits"), "split")


@query("p9_pieces_short")
def p9_pieces_short(spark: SparkSession, d: str) -> DataFrame:
    return splitting.p9_pieces(table(spark, d, "documents"), table(spark, d, "token_limits"), "split_short")


@query("p2_found")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.p2_found(table(spark, d, "articles"), table(spark, d, "raw_items"))


@query("p2_clean")
def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.p2_clean(table(spark, d, "articles"), table(spark, d, "raw_items"))


@query("p4_found")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.p4_found(table(spark, d, "articles"), table(spark, d, "raw_items"))


@query("p5_found")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return language.p5_found(table(spark, d, "articles"), table(spark, d, "lang_samples"), table(spark, d, "raw_items"))


@query("p5_cases")
def p5_cases(spark: SparkSession, d: str) -> DataFrame:
    return language.p5_cases(table(spark, d, "articles"), table(spark, d, "lang_samples"), table(spark, d, "raw_items"))


@query("p6_found", sitelines.P6_SQL)
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return sitelines.p6_found(table(spark, d, "articles"))


@query("p6_clean", sitelines.P6_CLEAN_SQL)
def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return sitelines.p6_clean(table(spark, d, "articles"))


@query("p6_sequences")
def p6_sequences(spark: SparkSession, d: str) -> DataFrame:
    return sitelines.sequences(table(spark, d, "articles"))
