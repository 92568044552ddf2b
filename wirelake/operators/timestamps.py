"""Mixed timestamp notations to UTC instants (problem 3).

Each value gets the list of all instants it can denote: both orders of day and month,
wall time of the site and UTC where no zone is written, both passes of an hour that
occurs twice, all known uses of a zone abbreviation. One of them is chosen by Viterbi
decoding along the record order of its source: an interpretation costs what speaks
against it in the source's registry row, a step costs for a change of notation and for
a jump back in time.

The registry is a prior like the others. What it speaks against costs ``AGAINST`` = 4;
one wrong reading can save at most two steps, 3 in all, so where the registry knows
the site its rule holds, and where it doesn't the sequence decides.

Sequences are cut into pieces of about ``CHUNK`` records by their order, whatever the
ids are; each piece also sees about ``HALO`` records before it, so that no task holds
a whole source and the decoder still starts warm.

Defined results: a NULL value gives no row; blank, relative ("2 days ago"),
undated and impossible values give a NULL instant (no row in ``p3_found``); an
unknown or NULL source counts as UTC, both orders of day and month possible,
day first preferred; rows with a NULL id have no place in the order and are decoded
by themselves; repeated rows are all kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from datetime import date, datetime, timedelta
from functools import lru_cache
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 20_000
HALO = 1_000
#: steps of a source's id range whose records are counted to cut it
GRANULES = 4096

# Month names as written in the seven languages of the data.
MONTHS = [
    "jan january janeiro enero ene января январь янв يناير ינואר",
    "feb february fevereiro fev febrero февраля февраль фев فبراير פברואר",
    "mar march março marco marzo марта март مارس מרץ מרס",
    "apr april abril abr апреля апрель апр أبريل ابريل אפריל",
    "may maio mai mayo мая май مايو מאי",
    "jun june junho junio июня июнь июн يونيو יוני",
    "jul july julho julio июля июль июл يوليو יולי",
    "aug august agosto ago августа август авг أغسطس اغسطس אוגוסט",
    "sep sept september setembro set septiembre setiembre сентября сентябрь сен سبتمبر ספטמבר",
    "oct october outubro out octubre октября октябрь окт أكتوبر اكتوبر אוקטובר",
    "nov november novembro noviembre ноября ноябрь ноя نوفمبر נובמבר",
    "dec december dezembro dez diciembre dic декабря декабрь дек ديسمبر דצמבר",
]
MONTH_NO = {w: i + 1 for i, ws in enumerate(MONTHS) for w in ws.split()}
# Abbreviations for sites whose own zone doesn't use them, minutes.
OFFSETS = {
    "BRT": -180, "AMT": -240, "ART": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420, "BST": 60, "WET": 0, "WEST": 60, "CET": 60, "CEST": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "AST": 180, "GST": 240, "IST": 330, "IDT": 180, "HKT": 480, "JST": 540,
}

_DIGITS = {ord(c): str(i) for row in ("٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹", "０１２３４５６７８９") for i, c in enumerate(row)}
_MONTH = "|".join(sorted(MONTH_NO, key=len, reverse=True))
_YMD = re.compile(r"(?<!\d)(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?!\d)")
_COMPACT = re.compile(r"(?<!\d)(\d{4})(\d\d)(\d\d)[T ]?(\d\d)(\d\d)(\d\d)(?:[.,](\d{1,9}))?(?!\d)")
_HAN = re.compile(r"(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日")
_SHORT = re.compile(r"(?<!\d)(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d\d)(?!\d)")
_DAY_NAME = re.compile(rf"(?<!\d)(\d{{1,2}})(?:\s*º|st|nd|rd|th)?[\s-]+(?:de\s+|ב)?({_MONTH})\.?[\s-]+(?:de[l]?\s+)?(\d{{4}})(?!\d)", re.I)
_NAME_DAY = re.compile(rf"(?<!\w)({_MONTH})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?!\d)", re.I)
_EPOCH = re.compile(r"(?:\d{10}|\d{13})\Z")
_TIME = re.compile(r"[^\d+]{0,14}?(\d{1,2})[:h](\d\d)(?!\d)(?::(\d\d)(?!\d))?(?:[.,](\d{1,9}))?\s*([ap])?(?(5)\.?\s?m\b\.?)", re.I)
_ZONE = re.compile(r"\s*\(?\s*(?:(Z|UTC|GMT)\b(?:\s*([+-])(\d{1,2})(?::?(\d\d))?)?|([+-−])(\d\d)(?::?(\d\d))?(?!\d)|([A-Z]{3,5})\b)")
_EPOCH_DAY = date(1970, 1, 1).toordinal()

#: what speaks against an interpretation, and against a step between two records
AGAINST, LESS_USUAL, SWITCH, BACKWARDS = 4.0, 0.5, 1.0, 0.5
JUMP_US = 86_400_000_000


@lru_cache(maxsize=None)
def zone_of(name: str | None) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if name else None
    except (KeyError, ValueError, OSError):
        return None


@lru_cache(maxsize=200_000)
def _wall_offsets(zone: ZoneInfo, y: int, mo: int, d: int, h: int, mi: int) -> tuple[int, ...]:
    """Seconds east of UTC at a wall time: of the first of two, then of the second; the old offset inside a gap."""
    first = int(datetime(y, mo, d, h, mi, tzinfo=zone).utcoffset().total_seconds())
    second = int(datetime(y, mo, d, h, mi, tzinfo=zone, fold=1).utcoffset().total_seconds())
    return (first, second) if second < first else (first,)


@lru_cache(maxsize=50_000)
def _named_offsets(abbr: str, zone: ZoneInfo | None, y: int, mo: int, d: int, h: int, mi: int) -> tuple[int, ...]:
    """Seconds of a zone abbreviation: as the site's zone uses it, then as it is used elsewhere."""
    out = []
    if zone is not None:
        when = datetime(y, mo, d, h, mi)
        for shift in (0, -180, 180, -90, 90):
            try:
                near = when + timedelta(days=shift)
            except OverflowError:
                continue
            for fold in (0, 1):
                t = near.replace(tzinfo=zone, fold=fold)
                if t.tzname() == abbr:
                    out.append(int(t.utcoffset().total_seconds()))
    if abbr in OFFSETS:
        out.append(OFFSETS[abbr] * 60)
    return tuple(dict.fromkeys(out[:1] + out[-1:]))


def interpretations(value: str | None, zone_id: str | None, day_first: bool | None, naive_utc: bool) -> list[tuple[int, str, float]]:
    """All (instant in microseconds, notation, cost) that ``value`` can denote."""
    if value is None:
        return []
    s = value.strip().translate(_DIGITS)
    if not s:
        return []
    if _EPOCH.match(s):
        return [(int(s) * (1_000_000 if len(s) == 10 else 1_000), "epoch", 0.0)]
    hms: tuple[int, int, int, int] | None = None
    dates: list[tuple[int, int, int, str, float]]
    if m := _YMD.search(s):
        dates = [(int(m[1]), int(m[3]), int(m[4]), "ymd" + m[2], 0.0)]
    elif m := _COMPACT.search(s):
        dates = [(int(m[1]), int(m[2]), int(m[3]), "compact", 0.0)]
        hms = int(m[4]), int(m[5]), int(m[6]), int(((m[7] or "") + "000000")[:6])
    elif m := _HAN.search(s):
        dates = [(int(m[1]), int(m[2]), int(m[3]), "han", 0.0)]
    elif m := _DAY_NAME.search(s):
        dates = [(int(m[3]), MONTH_NO[m[2].lower()], int(m[1]), "d-name", 0.0)]
    elif m := _NAME_DAY.search(s):
        dates = [(int(m[3]), MONTH_NO[m[1].lower()], int(m[2]), "name-d", 0.0)]
    elif m := _SHORT.search(s):
        a, b, y = int(m[1]), int(m[3]), int(m[4]) + (2000 if len(m[4]) == 2 else 0)
        if m[2] == ".":
            dates = [(y, b, a, "dmy.", 0.0)]
        else:
            known = day_first is not None
            against = AGAINST if known else LESS_USUAL
            first = day_first if known else True
            dates = [(y, b, a, "dmy" + m[2], 0.0 if first else against), (y, a, b, "mdy" + m[2], against if first else 0.0)]
    else:
        return []
    rest, zoned = s[m.end():], True
    if hms is None:
        t = _TIME.match(rest)
        if t:
            h, mi, sec = int(t[1]), int(t[2]), int(t[3] or 0)
            if t[5]:
                if not 1 <= h <= 12:
                    return []
                h = h % 12 + (12 if t[5] in "pP" else 0)
            hms, rest = (h, mi, sec, int(((t[4] or "") + "000000")[:6])), rest[t.end():]
        else:
            hms, zoned = (0, 0, 0, 0), False
    h, mi, sec, us = hms
    if h > 23 or mi > 59 or sec > 59:
        return []
    z = _ZONE.match(rest) if zoned else None
    zone = zone_of(zone_id)
    out: dict[int, tuple[int, str, float]] = {}
    for y, mo, d, form, cost in dates:
        try:
            day = date(y, mo, d).toordinal()
        except ValueError:
            continue
        offsets: list[tuple[int, str, float]] = []  # offset, zone notation, cost
        if z and (z[1] or z[5]):
            hours, minutes, sign = (z[3], z[4], z[2]) if z[1] else (z[6], z[7], z[5])
            off = int(hours or 0) * 3600 + int(minutes or 0) * 60
            offsets.append((off if sign in ("+", None) else -off, "z", 0.0))
        elif z:
            offsets += [(off, "abbr", AGAINST * i) for i, off in enumerate(_named_offsets(z[8], zone, y, mo, d, h, mi))]
        if not offsets:
            wall = _wall_offsets(zone, y, mo, d, h, mi) if zone is not None else ()
            offsets += [(off, "wall", AGAINST * (i + naive_utc)) for i, off in enumerate(wall)]
            offsets.append((0, "utc", 0.0 if naive_utc or not wall else AGAINST))
        for off, how, more in offsets:
            t = ((day - _EPOCH_DAY) * 86_400 + h * 3600 + mi * 60 + sec - off) * 1_000_000 + us
            if t not in out or cost + more < out[t][2]:
                out[t] = (t, f"{form} {how}", cost + more)
    return list(out.values())


def viterbi(seq: list[list[tuple[int, str, float]]]) -> list[int | None]:
    """The instants of the cheapest path; a record without interpretation is passed over."""
    back: list[list[int] | None] = []
    prev: list[tuple[int, str, float]] | None = None
    costs: list[float] = []
    for cands in seq:
        if not cands:
            back.append(None)
            continue
        if prev is None:
            ptr, new = [0] * len(cands), [c[2] for c in cands]
        elif len(prev) == 1 and len(cands) == 1:
            ptr, new = [0], [0.0]
        else:
            ptr, new = [], []
            for t, form, own in cands:
                step = [c + (SWITCH if form != pf else 0.0) + (BACKWARDS if t < pt - JUMP_US else 0.0) for c, (pt, pf, _) in zip(costs, prev)]
                k = min(range(len(step)), key=step.__getitem__)
                ptr.append(k)
                new.append(step[k] + own)
        back.append(ptr)
        prev, costs = cands, new
    out: list[int | None] = [None] * len(seq)
    if prev is None:
        return out
    k = min(range(len(costs)), key=costs.__getitem__)
    for i in range(len(seq) - 1, -1, -1):
        if back[i] is not None:
            out[i] = seq[i][k][0]
            k = back[i][k]
    return out


def _decode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by sequence and id; one sequence piece at a time is held."""
    key, cands, rows = None, [], []

    def flush() -> pd.DataFrame:
        found = [(*r, t) for (r, own), t in zip(rows, viterbi(cands)) if own]
        return pd.DataFrame(found, columns=["rec_table", "rec_id", "rec_field", "utc_us"]).astype({"rec_id": "Int64", "utc_us": "Int64"})

    for b in batches:
        for tab, rid, field, src, val, zone, first, chunk, own in zip(
            b["rec_table"], b["rec_id"], b["rec_field"], b["src"], b["val"], b["zone_id"], b["day_first"], b["chunk"], b["own"]
        ):
            now = (tab, field, src, chunk)
            if now != key:
                if rows:
                    yield flush()
                key, cands, rows = now, [], []
            first = None if first is None or first != first else bool(first)
            cands.append(interpretations(val, zone, first, field == "found_at"))
            rows.append(((tab, None if pd.isna(rid) else int(rid), field), own))
    if rows:
        yield flush()


_SOURCE = ["rec_table", "rec_field", "src"]


def pieces(placed: DataFrame, chunk: int, halo: int) -> DataFrame:
    """``placed(*_SOURCE, granule)`` to ``*_SOURCE, granule, piece, warm``.

    The records of each granule are counted and the counts summed up in order, at most
    ``GRANULES`` numbers a source. ``warm`` marks the granules that hold the last ``halo``
    records of a piece, which the next one sees too.
    """
    up = Window.partitionBy(*_SOURCE).orderBy("granule")
    inside = Window.partitionBy(*_SOURCE, "piece").orderBy(F.desc("granule"))
    counted = placed.filter("granule is not null").groupBy(*_SOURCE, "granule").agg(F.count(F.lit(1)).alias("n"))
    cut = counted.withColumn("piece", F.floor((F.sum("n").over(up) - F.col("n")) / chunk)).withColumn("last", F.max("piece").over(Window.partitionBy(*_SOURCE)))
    warm = (F.sum("n").over(inside) - F.col("n") < halo) & (F.col("piece") < F.col("last"))
    return cut.select(*_SOURCE, "granule", "piece", warm.alias("warm"))


def resolve(values: DataFrame, registry: DataFrame, chunk: int = CHUNK, halo: int = HALO) -> DataFrame:
    """``values(rec_table, rec_id, rec_field, src, val)`` to one row per non-NULL value.

    Result: ``rec_table, rec_id, rec_field, utc_us`` (NULL where no instant is named).
    ``registry(domain, zone_id, day_first)`` has one row per site, so it is joined
    as a dimension; Spark broadcasts it when its size allows.
    """
    reg = registry.select(F.col("domain").alias("reg_domain"), F.col("zone_id"), F.col("day_first")).dropDuplicates(["reg_domain"])
    known = values.select("rec_table", "rec_id", "rec_field", F.coalesce("src", F.lit("")).alias("src"), "val").filter(F.col("val").isNotNull())
    span = known.groupBy(*_SOURCE).agg(F.min("rec_id").alias("lo"), F.max("rec_id").alias("hi"))
    width = (F.col("hi").cast("double") - F.col("lo").cast("double") + 1) / GRANULES
    placed = known.join(span, _SOURCE).withColumn("granule", F.floor((F.col("rec_id").cast("double") - F.col("lo").cast("double")) / width)).drop("lo", "hi")
    alone = -1 - F.pmod(F.xxhash64("val"), F.lit(1 << 30))
    # a piece and the next differ by one; pieces of the NULL ids are negative
    seq = (
        placed.join(pieces(placed, chunk, halo), [*_SOURCE, "granule"], "left")
        .withColumn("mine", F.coalesce("piece", alone))
        .withColumn("chunk", F.explode(F.when(F.col("warm"), F.array("mine", F.col("mine") + 1)).otherwise(F.array("mine"))))
        .select("rec_table", "rec_id", "rec_field", "src", "val", "chunk", (F.col("chunk") == F.col("mine")).alias("own"))
        .join(reg, F.col("src") == F.col("reg_domain"), "left")
        .drop("reg_domain")
    )
    keys = ["rec_table", "rec_field", "src", "chunk"]
    return (
        seq.repartition(*keys)
        .sortWithinPartitions(*keys, F.col("rec_id").asc_nulls_first())
        .mapInPandas(_decode, "rec_table string, rec_id bigint, rec_field string, utc_us bigint")
    )


def article_and_item_dates(articles: DataFrame, items: DataFrame) -> DataFrame:
    """The three dated fields of the two tables in the form ``resolve`` takes."""
    art = articles.select(
        F.lit("articles").alias("rec_table"),
        F.col("article_id").cast("bigint").alias("rec_id"),
        F.col("domain").alias("src"),
        F.explode(F.array(F.struct(F.lit("published_at").alias("f"), F.col("published_at").alias("v")), F.struct(F.lit("found_at").alias("f"), F.col("found_at").alias("v")))).alias("x"),
    ).select("rec_table", "rec_id", F.col("x.f").alias("rec_field"), "src", F.col("x.v").alias("val"))
    raw = items.select(
        F.lit("raw_items").alias("rec_table"),
        F.col("item_id").cast("bigint").alias("rec_id"),
        F.lit("published_hint").alias("rec_field"),
        F.col("source_domain").alias("src"),
        F.col("published_hint").alias("val"),
    )
    return art.unionByName(raw)


def p3_found(articles: DataFrame, items: DataFrame, registry: DataFrame) -> DataFrame:
    return resolve(article_and_item_dates(articles, items), registry).filter(F.col("utc_us").isNotNull())


def p3_order(articles: DataFrame, items: DataFrame, registry: DataFrame) -> DataFrame:
    """As ``p3_found`` with the registry's order of day and month withheld: the sequences decide."""
    return p3_found(articles, items, registry.withColumn("day_first", F.lit(None).cast("boolean")))
