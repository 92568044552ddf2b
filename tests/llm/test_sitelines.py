import re
from collections import defaultdict

import pytest
from sqlcheck import connect, rows

from wirelake.llm import queries, sitelines as sl

SCHEMA = "article_id long, domain string, snippet string, n int, items int, item string"


def form(s):
    return re.sub(r"\d+", "0", re.sub(r"\s+", " ", s.lower())).strip()


def brute(data):
    n, have = defaultdict(int), defaultdict(set)
    for k, (a, d, s, *_) in enumerate(data):
        if d is not None:
            n[d] += 1
            for x in (s or "").split("\n"):
                have[d, form(x)].add(k)
    bad = {k for k, v in have.items() if k[1] and len(v) >= 5 and len(v) * 10 >= n[k[0]]}
    return [(a, i + 1) for a, d, s, *_ in data if s for i, x in enumerate(s.split("\n")) if (d, form(x)) in bad]


def fixture():
    out = []
    for i in range(60):
        d = "a" if i % 3 else "b"
        lines = [f"Texto próprio {'x' * i}", "", f"Atualizado  em {i}/02/2026" if i % 4 == 0 else "z" * (i + 1)]
        if i % 5 == 0:
            lines.insert(1, "  SIGA O CANAL ")
        if i % 5 == 0 and i % 2 == 0:
            lines.append("siga o canal")
        out.append((i, d, None if i == 7 else " " if i == 8 else "\n".join(lines), 1, 2, "q"))
    return out + [(100, None, "Siga o canal", 1, 2, "q")] * 6 + [(None, "a", "Siga\xa0o canal\r", 1, 2, "q")]


def test_found_equals_brute_force(spark):
    data = fixture()
    got = sorted(map(tuple, sl.p6_found(spark.createDataFrame(data, SCHEMA)).collect()), key=str)
    assert got == sorted(brute(data), key=str)


def test_clean(spark):
    data = fixture()
    bad = {(a, i) for a, i in brute(data)}
    got = {r.article_id: r.snippet for r in sl.p6_clean(spark.createDataFrame(data, SCHEMA)).collect()}
    for a, d, s, *_ in data:
        want = None if s is None else "\n".join(x for i, x in enumerate(s.split("\n")) if (a, i + 1) not in bad)
        assert got[a] == want
    empty = spark.createDataFrame([], SCHEMA)
    assert sl.p6_found(empty).count() == 0 and sl.p6_clean(empty).count() == 0 and sl.sequences(empty).count() == 0


def test_sequences(spark):
    data = [(i, "a", f"eu {'x' * i}\nTopo {i}\nmeio {'y' * i}\nFim\nFim" if i % 2 else f"Fim\nTopo {i}", 1, 2, "q") for i in range(20)]
    got = {r.lines: r.n_docs for r in sl.sequences(spark.createDataFrame(data, SCHEMA)).collect()}
    # "topo, fim" always goes on with "fim", so only the longer one is told
    assert got == {"topo 0": 20, "fim": 20, "fim\ntopo 0": 10, "fim\nfim": 10, "topo 0\nfim\nfim": 10}


def test_lines_that_always_stand_together(spark):
    """Sixteen such lines have 65,535 frequent sequences; sixteen are told, and all lines are found."""
    block = [chr(ord("a") + k) * 3 for k in range(16)]
    data = [(i, "s", "\n".join(["x" * (i + 5), *block]), 1, 2, "q") for i in range(12)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {tuple(r.lines.split("\n")): r.n_docs for r in sl.sequences(df).collect()}
    assert got == {tuple(block[k:]): 12 for k in range(16)}
    assert sl.p6_found(df).count() == 12 * 16


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, data, name):
    got, want = queries.QUERIES[name](spark, data).toPandas(), connect(data).execute(queries.SQL[name]).df()
    assert rows(got) == rows(want)
