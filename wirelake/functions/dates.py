"""Date functions on columns. "Now" is always the argument ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portuguese month abbreviations.
PT_MONTHS = {"jan": "01", "fev": "02", "mar": "03", "abr": "04", "mai": "05", "jun": "06", "jul": "07", "ago": "08", "set": "09", "out": "10", "nov": "11", "dez": "12"}
EN_MONTHS = {"jan": "01", "feb": "02", "mar": "03", "apr": "04", "may": "05", "jun": "06", "jul": "07", "aug": "08", "sep": "09", "oct": "10", "nov": "11", "dec": "12"}


def hours(n: int | Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n) if isinstance(n, int) else n)


def window_start(as_of: Column, n: int) -> Column:
    return as_of - hours(n)


def within_window(ts: Column, as_of: Column, n: int) -> Column:
    """In a filter: ``ts`` no more than ``n`` hours before ``as_of``; the future is inside, NULL drops."""
    return ts >= window_start(as_of, n)


def in_window_flag(ts: Column, as_of: Column, n: int) -> Column:
    """As a projected flag: never NULL."""
    return F.coalesce(within_window(ts, as_of, n), F.lit(False))


def clamp_future(ts: Column, as_of: Column, minutes: int = 5) -> Column:
    return F.when(ts > as_of + F.make_dt_interval(mins=F.lit(minutes)), as_of).otherwise(ts)


def age_hours(ts: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(ts)) / 3.6e9


def _month_map(names: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])


def parse_rfc822(s: Column) -> Column:
    """``Ter, 26 Mai 2026 09:50:56 -0300`` and its English form; NULL for others."""
    pat = r"(?iu)^\s*(?:\p{L}{3,},?\s+)?(\d{1,2})\s+(\p{L}{3})\p{L}*\s+(\d{4})\s+(\d{2}:\d{2}:\d{2})\s*([+-]\d{4}|GMT|UTC|Z)\s*$"
    mon = F.lower(F.regexp_extract(s, pat, 2))
    month = F.coalesce(F.try_element_at(_month_map(PT_MONTHS | EN_MONTHS), mon), F.lit("00"))
    zone = F.regexp_replace(F.regexp_extract(s, pat, 5), r"^(?i:GMT|UTC|Z)$", "+0000")
    iso = F.concat(F.regexp_extract(s, pat, 3), F.lit("-"), month, F.lit("-"), F.lpad(F.regexp_extract(s, pat, 1), 2, "0"), F.lit("T"), F.regexp_extract(s, pat, 4), zone)
    return F.when(s.rlike(pat), F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ssZ")))


def parse_iso(s: Column) -> Column:
    """ISO date or time, UTC where no zone is written (the session's zone must be UTC)."""
    return F.try_to_timestamp(F.trim(s))


def parse_listing(s: Column) -> Column:
    """The date of a text that holds exactly one ``dd/mm/yyyy``."""
    found = F.regexp_extract_all(s, F.lit(r"\b(\d{2}/\d{2}/\d{4})\b"), F.lit(1))
    return F.when(F.size(found) == 1, F.try_to_timestamp(F.get(found, F.lit(0)), F.lit("dd/MM/yyyy")))


def parse_entry(published: Column, updated: Column) -> Column:
    """A feed entry's date: published, else updated, in any of the forms above."""
    return F.coalesce(parse_rfc822(published), parse_iso(published), parse_rfc822(updated), parse_iso(updated))


def when_clause(n: Column) -> Column:
    """The search operand for a window of ``n`` hours: hours up to 48, then whole days."""
    days = F.greatest(F.lit(1), F.floor(n / 24)).cast("string")
    return F.concat(F.lit("when:"), F.when(n <= 48, F.concat(n.cast("string"), F.lit("h"))).otherwise(F.concat(days, F.lit("d"))))
