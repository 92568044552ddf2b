import random

from pyspark.sql import functions as F

from wirelake.operators import chunking, fair

SCHEMA = "url string, domain string, published_at timestamp, seq long"


def rows(seed, n=60, nulls=0.2):
    from datetime import datetime, timedelta

    r = random.Random(seed)
    return [(f"u{i}", r.choice("aaaabbcd"), None if r.random() < nulls else datetime(2026, 1, 1) + timedelta(hours=r.randrange(50)), i) for i in range(n)]


def greedy_cap(data, total, per):
    out, n = [], {}
    for x in data:
        if len(out) < total and n.get(x[1], 0) < per:
            n[x[1]] = n.get(x[1], 0) + 1
            out.append(x[0])
    return out


def greedy_mixed(data, dated, undated):
    out, n = [], {}
    for x in data:
        if n.get(x[1], 0) < (undated if x[2] is None else dated):
            n[x[1]] = n.get(x[1], 0) + 1
            out.append(x[0])
    return out


def greedy_round_robin(data, oldest=False):
    from datetime import datetime

    day = lambda x: x[2] or datetime(1, 1, 1)
    by = {}
    for x in data:
        by.setdefault(x[1], []).append(x)
    for v in by.values():
        v.sort(key=day, reverse=not oldest)
    queues = sorted(by.values(), key=lambda q: day(q[0]), reverse=not oldest)
    return [q[i][0] for i in range(max(map(len, queues), default=0)) for q in queues if i < len(q)]


def greedy_interleave(data):
    out = []
    for pair in zip(greedy_round_robin(data), greedy_round_robin(data, True)):
        out += [u for u in pair if u not in out]
    return out


def test_caps_equal_greedy(spark):
    for seed in range(3):
        data = rows(seed)
        df = spark.createDataFrame(data, SCHEMA)
        assert [r.url for r in fair.two_level_cap(df, 12, 4).collect()] == greedy_cap(data, 12, 4)
        assert {r.url for r in fair.mixed_cap(df, 3, 7).collect()} == set(greedy_mixed(data, 3, 7))
        assert [r.url for r in fair.round_robin(df).orderBy(*fair.RR_ORDER).collect()] == greedy_round_robin(data)
        assert [r.url for r in fair.interleave(df, 20).collect()] == greedy_interleave(data)[:20]


def test_interleave_edges(spark):
    df = spark.createDataFrame(rows(1, 3), SCHEMA)
    assert fair.interleave(df, 50).count() == 3
    assert fair.interleave(df.limit(0), 10).count() == 0
    known = df.select("url").limit(1)
    assert fair.backfill_pick(df, known, 180, 60, 2).count() <= 2
    assert fair.backfill_pick(df, None, 180, 60, 2).count() <= 2


def test_per_domain_shares(spark):
    data = [(f"a{i}", "a", None, i) for i in range(200)] + [(f"b{i}", "b", None, 200 + i) for i in range(9)] + [(f"c{i}", "c", None, 300 + i) for i in range(5)]
    got = fair.repair_pick(spark.createDataFrame(data, SCHEMA), 30, 40).groupBy("domain").count()
    assert {r["domain"]: r["count"] for r in got.collect()} == {"a": 16, "b": 9, "c": 5}


def greedy(weights, most, keys):
    out, chunk, room, n = [], 0, most, 0
    for w in weights:
        if n and (w > room or n >= keys):
            chunk, room, n = chunk + 1, most, 0
        out.append(chunk)
        room, n = room - w, n + 1
    return out


def test_chunks(spark):
    assert greedy([5, 5, 20, 1], 10, 100) == [0, 0, 1, 2]
    df = spark.createDataFrame([("https://a.example/" + "é" * n,) for n in (3, 400, 2, 3000)] + [(None,)], "url string").coalesce(1)
    got = chunking.chunk_urls(df, 3000, 100, lanes=1).orderBy("chunk", "url").collect()
    assert len(got) == 4 and [r.chunk for r in got] == [0, 0, 0, 1]


def test_chunks_do_not_depend_on_partitions(spark):
    urls = [f"https://a.example/{'x' * (i % 37)}/{i}" for i in range(400)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    one, many = ({tuple(r) for r in chunking.chunk_urls(df.repartition(n), 600, 9, lanes=5).collect()} for n in (1, 16))
    assert one == many
    for lane in range(5):
        rows = sorted((u, c) for u, at, c in one if at == lane)
        assert [c for _, c in rows] == greedy([len(u.replace(":", "%3A").replace("/", "%2F")) + 3 for u, _ in rows], 600, 9)
