from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wirelake.operators import timestamps as ts

SP, NY, MAD = "America/Sao_Paulo", "America/New_York", "Europe/Madrid"


def us(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1_000_000)


def best(value, zone=SP, day_first=True, naive_utc=False):
    got = ts.interpretations(value, zone, day_first, naive_utc)
    return min(got, key=lambda x: x[2])[0] if got else None


@pytest.mark.parametrize(
    "value,zone,first,expected",
    [
        ("2026-03-06T09:58:30Z", SP, True, us(2026, 3, 6, 9, 58, 30)),
        ("2026-03-09T19:22:10.426056-03:00", SP, True, us(2026, 3, 9, 22, 22, 10, 426056)),
        ("2026-02-21T19:29:01-06:00[America/Mexico_City]", SP, True, us(2026, 2, 22, 1, 29, 1)),
        ("2026-04-03T17:03:15.485Z", SP, True, us(2026, 4, 3, 17, 3, 15, 485000)),
        ("20251026T072427Z", SP, True, us(2025, 10, 26, 7, 24, 27)),
        ("1764271325", SP, True, 1764271325_000000),
        ("1786753646158", SP, True, 1786753646158_000),
        ("Sáb, 31 Jan 2026 07:07:49 -0300", SP, True, us(2026, 1, 31, 10, 7, 49)),
        ("Sun, 02 Nov 2025 12:52:41 GMT", SP, True, us(2025, 11, 2, 12, 52, 41)),
        ("3 de novembro de 2026 às 03h42", SP, True, us(2026, 11, 3, 6, 42)),
        ("Publicado: 16 de junio de 2026, 02:56 h", MAD, True, us(2026, 6, 16, 0, 56)),
        ("01/12/2026 01:35", NY, False, us(2026, 1, 12, 6, 35)),
        ("01/12/2026 01:35", SP, True, us(2026, 12, 1, 4, 35)),
        ("09/06/26 14:31", SP, True, us(2026, 6, 9, 17, 31)),
        ("Sep 27, 2025 10:35 PM CDT", "America/Chicago", False, us(2025, 9, 28, 3, 35)),
        ("Aug 27, 2026 6:22 a.m.", NY, False, us(2026, 8, 27, 10, 22)),
        ("04/05/2026 03:05 MSK", "Europe/Moscow", True, us(2026, 5, 4, 0, 5)),
        ("14/10/2025 20:00 BST", "Europe/London", True, us(2025, 10, 14, 19)),
        ("20/02/2026 03:39 CST", "Asia/Shanghai", True, us(2026, 2, 19, 19, 39)),
        ("2026年3月31日 08:34", "Asia/Shanghai", True, us(2026, 3, 31, 0, 34)),
        ("نشر في ٢٣ مارس ٢٠٢٦ ٢٣:٤٩", "Asia/Dubai", True, us(2026, 3, 23, 19, 49)),
        ("28 באפריל 2026", "Asia/Jerusalem", True, us(2026, 4, 27, 21)),
        ("26.09.2025 14:16", "Europe/Moscow", True, us(2025, 9, 26, 11, 16)),
        ("10/12/2025 - 01h41", SP, True, us(2025, 12, 10, 4, 41)),
        ("\xa031/07/2026 15:33 (UTC)\n", SP, True, us(2026, 7, 31, 15, 33)),
        ("2026-04-11", SP, True, us(2026, 4, 11, 3)),
        # a wall time that occurs twice, and one that is skipped
        ("2025-11-02 01:30:00", NY, False, us(2025, 11, 2, 5, 30)),
        ("2026-03-08 02:30:00", NY, False, us(2026, 3, 8, 7, 30)),
        ("01/11/2026 01:30 EST", NY, True, us(2026, 11, 1, 6, 30)),
    ],
)
def test_written_forms(value, zone, first, expected):
    assert best(value, zone, first) == expected


@pytest.mark.parametrize("value", ["", "   ", "-", "hoje", "há 3 horas", "1 hour ago", "N/A", "31/02/2026", "2026-02-30", "32/01/2026 10:00", "0000-00-00 00:00:00", "2026-13-45T99:00:00Z", "Invalid Date", "12345", None])
def test_no_instant(value):
    assert ts.interpretations(value, SP, True, False) == []


def test_found_at_without_zone_is_utc():
    assert best("2026-06-03 22:06:26", naive_utc=True) == us(2026, 6, 3, 22, 6, 26)


def brute(seq):
    """The cheapest of all paths."""
    import itertools

    idx = [i for i, c in enumerate(seq) if c]
    cost = lambda path: sum(c[2] for c in path) + sum((ts.SWITCH if a[1] != b[1] else 0) + (ts.BACKWARDS if b[0] < a[0] - ts.JUMP_US else 0) for a, b in zip(path, path[1:]))
    return min((cost(p) for p in itertools.product(*[seq[i] for i in idx])), default=0), cost


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 5).map(lambda d: d * 3 * ts.JUMP_US), st.sampled_from("ab"), st.sampled_from([0.0, 0.5])), max_size=3), max_size=5))
def test_viterbi_is_optimal(seq):
    got = ts.viterbi(seq)
    least, cost = brute(seq)
    import itertools

    idx = [i for i, c in enumerate(seq) if c]
    assert [g is None for g in got] == [not c for c in seq]
    fits = [p for p in itertools.product(*[seq[i] for i in idx]) if [c[0] for c in p] == [got[i] for i in idx]]
    assert min((cost(p) for p in fits), default=0) == pytest.approx(least)


def test_unknown_source_follows_its_sequence(spark):
    rows = [("t", i, "f", "x", v) for i, v in enumerate(["25/03/2026 10:00", "26/03/2026 10:00", "04/05/2026 10:00", "28/05/2026 10:00"])]
    df = spark.createDataFrame(rows, "rec_table string, rec_id long, rec_field string, src string, val string")
    reg = spark.createDataFrame([], "domain string, zone_id string, day_first boolean")
    got = {r.rec_id: r.utc_us for r in ts.resolve(df, reg).collect()}
    assert got[2] == us(2026, 5, 4, 10)


def test_all_readings_are_candidates():
    """Both orders, site and UTC wall time, both passes of a repeated hour, both uses of an abbreviation."""
    read = lambda v, zone, first=True: {t for t, _, _ in ts.interpretations(v, zone, first, False)}
    assert read("2025-11-02 01:30:00", NY) == {us(2025, 11, 2, 5, 30), us(2025, 11, 2, 6, 30), us(2025, 11, 2, 1, 30)}
    assert read("01/12/2026 00:00 UTC", NY) == {us(2026, 12, 1), us(2026, 1, 12)}
    assert read("2026-02-20 03:39 CST", "Asia/Shanghai") == set() or len(read("20 February 2026 03:39 CST", "Asia/Shanghai")) == 2
    assert read("2026-02-20 03:39:00", None) == {us(2026, 2, 20, 3, 39)}


def test_registry_rule_holds_against_any_sequence(spark):
    """Where the registry knows the site no run of records outweighs it."""
    reg = spark.createDataFrame([("s", "UTC", True)], "domain string, zone_id string, day_first boolean")
    rows = [("t", i, "f", "s", f"0{1 + i % 9}/01/2026") for i in range(60)]
    df = spark.createDataFrame(rows, "rec_table string, rec_id long, rec_field string, src string, val string")
    assert {r.rec_id: r.utc_us for r in ts.resolve(df, reg).collect()} == {i: us(2026, 1, 1 + i % 9) for i in range(60)}


def test_pieces_follow_the_order_and_not_the_ids(spark):
    """Ids like hashes: pieces hold about ``chunk`` records all the same."""
    rows = [("t", "f", "s", i * 1_000_003 % 4096) for i in range(3000)]
    got = ts.pieces(spark.createDataFrame(rows, "rec_table string, rec_field string, src string, granule long"), 500, 50)
    per = {}
    n = {g: 0 for *_, g in rows}
    for *_, g in rows:
        n[g] += 1
    for r in got.collect():
        per.setdefault(r.piece, []).append((n[r.granule], r.warm))
    assert sorted(per) == list(range(6)) and all(450 <= sum(k for k, _ in v) <= 550 for v in per.values())
    assert all(50 <= sum(k for k, w in v if w) <= 60 for p, v in per.items() if p < 5) and not any(w for _, w in per[5])


def test_edges_and_chunks(spark):
    reg = spark.createDataFrame([("s", SP, True, "x")], "domain string, zone_id string, day_first boolean, val string")
    rows = [("t", None if i == 5 else i, "published_at", None if i == 7 else "s", None if i == 3 else f"{1 + i % 28:02d}/05/2026 08:00", 9) for i in range(60)]
    df = spark.createDataFrame(rows + rows[:2], "rec_table string, rec_id long, rec_field string, src string, val string, chunk int")
    whole = sorted(map(tuple, ts.resolve(df, reg).collect()), key=str)
    parts = sorted(map(tuple, ts.resolve(df, reg, chunk=10, halo=4).collect()), key=str)
    assert whole == parts and len(whole) == 61
    assert ts.resolve(df.limit(0), reg).count() == 0
