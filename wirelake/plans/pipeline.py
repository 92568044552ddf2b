"""One scan: collected items to the merged article table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.config import RunConfig
from wirelake.functions import text
from wirelake.functions.match import compile_matcher, widened
from wirelake.operators import dedupe, enrich, fair, merge, route, translate
from wirelake.session import materialize


@dataclass
class Run:
    """``table``: after the merge; ``kept``: the rows pushed; ``judged``: with ``drop_reason``."""

    table: DataFrame
    kept: DataFrame
    judged: DataFrame
    routed: DataFrame

    def counters(self) -> DataFrame:
        """Counts per reason, NULL for kept rows."""
        return self.judged.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))

    def log(self) -> DataFrame:
        """One row for the run log: routed by way, judged, kept, kept without text, kept in other languages."""
        ways = self.routed.agg(*[F.count_if(F.col("route") == w).alias(w) for w in ("title", "summary", "url", "lede")])
        judged = self.judged.agg(F.count(F.lit(1)).alias("judged"), F.count_if(F.col("drop_reason").isNotNull()).alias("dropped"))
        kept = self.kept.agg(F.count(F.lit(1)).alias("kept"), F.count_if(text.is_blank(F.col("snippet"))).alias("without_text"), F.count_if(translate.is_foreign(F.col("source_lang"))).alias("foreign"))
        return ways.join(judged).join(kept)  # one row each


def run(
    items: DataFrame,
    stored: DataFrame,
    pages: DataFrame,
    registry: DataFrame,
    config: RunConfig,
    as_of: Column,
    extractors: DataFrame | None = None,
    resolved: DataFrame | None = None,
    translator: Callable[[str, str], str | None] | None = None,
) -> Run:
    """Dedupe, route, cap, enrich, rescue, validate, backfill, translate, merge.

    ``items`` need ``seq``, the arrival order. Nothing is written: the caller stores
    ``Run.table`` (``operators.merge.write_table``) or drops it (a dry run).
    """
    concepts = {native: concept for lang in config.languages for native, concept in lang.terms}
    matcher = compile_matcher(widened(config.match, list(concepts)))
    first = dedupe.first_by_url(items)
    routed = materialize(route.route(first, matcher, config, as_of).drop("url_key"), "run-routed")
    near, cands = routed.filter("route = 'lede'"), routed.filter("route <> 'lede'")
    c = config.caps
    wrapped = F.startswith(F.col("url"), F.lit(config.wrapper_prefix))
    direct = cands.filter(~wrapped).withColumn("late", F.lit(0))
    wrappers = fair.per_key_cap(cands.filter(wrapped), c.resolve_per_domain, "source_domain")
    ready = enrich.resolve_wrappers(wrappers, resolved, config.wrapper_prefix).withColumn("late", F.lit(1))
    ready = ready.filter(~F.startswith(F.col("resolved_url"), F.lit(config.wrapper_prefix)))
    both = enrich.resolve_wrappers(direct, None, config.wrapper_prefix).unionByName(ready)
    # direct rows are admitted first; resolved ones continue the same counter, as dated rows
    both = both.withColumn("order", F.struct("late", "seq")).withColumn("counts_as", F.when(F.col("late") == 1, F.lit(0)).otherwise(F.unix_micros("published_at")))
    admitted = fair.mixed_cap(both, c.enrich_dated, c.enrich_undated, "resolved_domain", "order", "counts_as").drop("late", "order", "counts_as")
    enriched = enrich.enrich(admitted, pages, extractors, config, need_snippet=not config.headlines_only)
    rescued = enrich.lede_rescue(enrich.resolve_wrappers(near, None, config.wrapper_prefix), pages, extractors, matcher, config)
    judged = materialize(route.validate(enriched.unionByName(rescued), matcher, config, as_of, concepts, registry), "run-judged")
    kept = judged.filter(F.col("drop_reason").isNull()).drop("drop_reason")
    kept = enrich.backfill(kept, stored.filter("trim(snippet) <> ''").select("url"), pages, extractors, config)
    if translator:
        kept = translate.translate(kept, translator, stored.filter("title_en is not null").select("url"), c.translate)
    for col in ("title_original", "title_en", "snippet_en"):
        if col not in kept.columns:
            kept = kept.withColumn(col, F.lit(None).cast("string"))
    kept = materialize(kept, "run-kept")
    return Run(merge.merge(kept, stored), kept, judged, routed)
