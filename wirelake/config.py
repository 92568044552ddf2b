"""Settings of the news pipeline as plain values; everything is an explicit argument."""

from __future__ import annotations

from dataclasses import dataclass, field

from wirelake import vocabulary


@dataclass(frozen=True)
class Caps:
    """Budgets of one scan; every cap is a greedy choice along an ordered list."""

    lede_total: int = 40
    lede_per_domain: int = 8
    backfill_total: int = 60
    backfill_per_domain: int = 2
    backfill_lookup: int = 180
    enrich_dated: int = 20
    enrich_undated: int = 40
    resolve_per_domain: int = 20
    translate: int = 40
    repair_total: int = 400
    repair_per_domain: int = 40


@dataclass(frozen=True)
class MatchConfig:
    """Keywords: ``exact`` ones match whole words, all others anywhere."""

    keywords: tuple[str, ...]
    exact: frozenset[str] = frozenset()
    window_hours: int = 24


@dataclass(frozen=True)
class LangConfig:
    """A search language: locale of the query and native terms with their concept."""

    code: str
    hl: str
    gl: str
    ceid: str
    terms: tuple[tuple[str, str], ...] = ()
    cap: int = 12
    domains: tuple[str, ...] = ()


@dataclass(frozen=True)
class RunConfig:
    match: MatchConfig
    caps: Caps = field(default_factory=Caps)
    languages: tuple[LangConfig, ...] = ()
    topical_feeds: frozenset[str] = frozenset()
    recent_only_feeds: frozenset[str] = frozenset()
    wrapper_prefix: str = "https://news.google.com/"
    headlines_only: bool = True
    hint_slack_hours: int = 24


#: keywords used where neither the defaults nor a user names any
FALLBACK_KEYWORDS = vocabulary.DEFAULT_KEYWORDS

#: the search languages: locale of the query, native terms by priority (English takes the live keywords among its own)
LANGUAGES = (
    LangConfig("en", "en-US", "US", "US:en", tuple((t, t) for t in vocabulary.ENGLISH)),
    LangConfig("ar", "ar", "EG", "EG:ar", vocabulary.ARABIC),
    LangConfig("ru", "ru", "RU", "RU:ru", vocabulary.RUSSIAN),
    LangConfig("zh", "zh-CN", "CN", "CN:zh-Hans", vocabulary.CHINESE),
    LangConfig("iw", "iw", "IL", "IL:iw", vocabulary.HEBREW),
    LangConfig("es", "es-419", "US", "US:es-419", vocabulary.SPANISH),
)
