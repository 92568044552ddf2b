"""Keyword matching: accents count, case doesn't, longest terms first, no overlaps.

Terms match anywhere (``substring``) or as whole words (``exact``). Substring hits
come first, then whole words; each is given in its registered spelling, once. The
patterns are literals, compiled once per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirelake.config import FALLBACK_KEYWORDS, MatchConfig


def _pattern(terms: list[str]) -> tuple[str, str]:
    """Alternation of literals behind a look at the first letter, which rejects most places at once."""
    first = "".join(f"\\x{{{ord(c):x}}}" for c in sorted({t[0] for t in terms}))
    return f"(?=[{first}])", "(?:" + "|".join(r"\Q" + t.replace(r"\E", "") + r"\E" for t in terms) + ")"


@dataclass(frozen=True)
class Matcher:
    """Patterns over lower-case text, and the spelling of each term."""

    substring: str | None
    exact: str | None
    spelling: tuple[tuple[str, str], ...]

    def hits(self, text: Column) -> Column:
        """The registered spellings of all hits in order; empty for NULL or blank text."""
        empty = F.array().cast("array<string>")
        low = F.lower(text)
        parts = [F.regexp_extract_all(low, F.lit(p), F.lit(0)) for p in (self.substring, self.exact) if p]
        if not parts:
            return empty
        names = F.create_map(*[F.lit(x) for kv in self.spelling for x in kv])
        found = F.transform(F.concat(*parts), lambda h: F.coalesce(F.try_element_at(names, h), h))
        return F.coalesce(F.array_distinct(found), empty)


def compile_matcher(config: MatchConfig) -> Matcher:
    """Deduplicated by lower case (the first spelling stays), longest first.

    An exact term that isn't among the keywords is matched too, in its own spelling.
    """
    spelling: dict[str, str] = {}
    for k in (*config.keywords, *sorted(config.exact)):
        if k.strip():
            spelling.setdefault(k.lower(), k)
    exact = {e.lower() for e in config.exact if e.strip()}
    order = lambda k: (-len(k), k)
    anywhere, whole = sorted((k for k in spelling if k not in exact), key=order), sorted(exact, key=order)
    return Matcher(
        "".join(_pattern(anywhere)) if anywhere else None,
        r"(?U){}\b{}\b".format(*_pattern(whole)) if whole else None,
        tuple(spelling.items()),
    )


def canonical(matched: Column, to_concept: dict[str, str]) -> Column:
    """Native terms as their concept, order kept, once each; other marks as they are."""
    if not to_concept:
        return F.array_distinct(matched)
    m = F.create_map(*[F.lit(x) for kv in to_concept.items() for x in kv])
    return F.array_distinct(F.transform(matched, lambda k: F.coalesce(F.try_element_at(m, k), k)))


def keyword_union(keywords: DataFrame) -> DataFrame:
    """``keyword, match_type`` of defaults and users together: exact wins, sorted.

    A table without ``match_type`` counts as substring terms throughout.
    """
    kind = F.col("match_type") if "match_type" in keywords.columns else F.lit("substring")
    k = keywords.select(F.col("keyword"), kind.alias("kind")).filter(F.trim(F.coalesce("keyword", F.lit(""))) != "")
    agg = k.groupBy("keyword").agg(F.max((F.col("kind") == "exact").cast("int")).alias("e"))
    return agg.select("keyword", F.when(F.col("e") == 1, "exact").otherwise("substring").alias("match_type")).orderBy("keyword")


def config_from(keywords: DataFrame, window_hours: int = 24, limit: int = 10_000) -> MatchConfig:
    """The settings of a keyword table; the fallback terms where it is empty.

    A keyword table is a configuration: more than ``limit`` rows are refused.
    """
    rows = keyword_union(keywords).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} keywords")
    if not rows:
        return MatchConfig(FALLBACK_KEYWORDS, frozenset(), window_hours)
    return MatchConfig(tuple(r[0] for r in rows), frozenset(r[0] for r in rows if r[1] == "exact"), window_hours)


def widened(config: MatchConfig, terms: list[str]) -> MatchConfig:
    """With further substring terms (the native terms of the search languages)."""
    return MatchConfig(tuple(dict.fromkeys([*config.keywords, *terms])), config.exact, config.window_hours)


def provenance(config: MatchConfig) -> str:
    """Whether a configuration's terms are live ones or the fallback."""
    return "FALLBACK" if set(config.keywords) == set(FALLBACK_KEYWORDS) else "LIVE"
