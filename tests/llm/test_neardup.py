import itertools
import random
import re

import numpy as np
import pytest

from wirelake.llm import neardup as nd
from wirelake.llm.components import components

SCHEMA = "article_id long, title string, snippet string, id int, t string, h string, rep int"


def norm(s):
    return re.sub(r"[\W_]+", " ", (s or "").lower()).strip()


def shingles(s):
    s = norm(s)
    return {s[i : i + 5] for i in range(len(s) - 4)} if len(s) >= 5 else {s} - {""}


def sim(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a and b else 0.0


def brute(rows):
    return {(min(x[0], y[0]), max(x[0], y[0])) for x, y in itertools.combinations(rows, 2) if sim(x[1], y[1]) >= 0.6 and sim(x[2], y[2]) >= 0.6}


def corpus(seed=0, n=40):
    r = random.Random(seed)
    words = ["refinaria", "diesel", "porto", "наблюдатель", "preço", "石油", "gasoduto", "leilão", "terminal", "barril", "export", "tariff"] + [f"w{i}x{i * 7}" for i in range(60)]
    rows, k = [], 0
    for _ in range(n):
        t, s = [r.choice(words) for _ in range(16)], [r.choice(words) for _ in range(40)]
        for _ in range(r.choice([1, 1, 2, 4])):
            k += 1
            t2, s2 = list(t), list(s)
            for x, m in ((t2, 1), (s2, 2)):
                for _ in range(r.randrange(m + 1)):
                    x[r.randrange(len(x))] = r.choice(words)
            rows.append((k, " ".join(t2), " ".join(s2), 7, "x", "y", 3))
    return rows


def test_pairs_equal_brute_force(spark):
    rows = corpus()
    rows += [(900, None, "a b", 1, "", "", 0), (901, "x", None, 1, "", "", 0), (902, "", "  ", 1, "", "", 0), (903, "Ab", "cd", 1, "", "", 0), (904, "ab!", "CD.", 1, "", "", 0), (905, None, None, 1, "", "", 0)]
    rows += [(1000 + i, rows[0][1].upper() + "!", rows[0][2], 1, "", "", 0) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in nd.p1_found(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)
    assert (903, 904) in got


def test_groups(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows + rows[:3] + [(None, "a", "b", 1, "", "", 0)], SCHEMA)
    got = {r.article_id: r.class_id for r in nd.p1_groups(df).collect()}
    assert set(got) == {r[0] for r in rows}
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute(rows):
        parent[find(a)] = find(b)
    assert len(set(got.values())) == len({find(x) for x in parent})
    assert all(got[a] == got[b] for a, b in brute(rows))


def test_hot_copies_and_empty(spark):
    df = spark.createDataFrame([(i, "same headline here", "same text of the story", 1, "", "", 0) for i in range(60)], SCHEMA)
    assert nd.p1_found(df).count() == 60 * 59 // 2
    assert {r.class_id for r in nd.p1_groups(df).collect()} == {0}
    assert nd.p1_found(df.limit(0)).count() == 0 and nd.p1_groups(df.limit(0)).count() == 0


def test_superminhash_estimates_similarity():
    r = np.random.default_rng(1)
    for common in (20, 60, 90):
        a = np.concatenate([np.arange(common), 1000 + np.arange(100 - common)]).astype(np.uint64)
        b = np.concatenate([np.arange(common), 2000 + np.arange(100 - common)]).astype(np.uint64)
        h = nd.mix(np.concatenate([a, b]) + np.uint64(r.integers(1 << 40)))
        sig = nd.superminhash(np.repeat([0, 1], 100), h, 2, 512)
        assert np.isfinite(sig).all()
        assert (sig[0] == sig[1]).mean() == pytest.approx(common / (200 - common), abs=0.07)


def test_similarities_are_exact():
    rows = corpus(9, 60)[: nd.LOT]
    x, y = [r[2] for r in rows] + ["", "ab", "ab", "", "aaaaaaaa"], [r[2] for r in rows[1:] + rows[:1]] + ["", "ab", "abc", "x", "aaaaa"]
    assert np.allclose(nd.similarities(x, y), nd._jaccards(x, y, nd.SHINGLE))


def test_early_stop_is_exact():
    """Each register ends with what the full walk over all steps would give."""
    h = nd.mix(np.arange(1, 31, dtype=np.uint64))
    m = 16
    sig = nd.superminhash(np.zeros(30, dtype=int), h, 1, m)[0]
    want = np.full(m, np.inf)
    for e in h:
        p = np.arange(m)
        for step in range(m):
            with np.errstate(over="ignore"):
                r = nd.mix(np.array([e + np.uint64(2 * step + 1) * nd._STEP]))[0]
            k = step + (int(r) & 0xFFFFFFFF) * (m - step) // (1 << 32)
            p[step], p[k] = p[k], p[step]
            want[p[step]] = min(want[p[step]], step + float(r >> np.uint64(11)) * 2.0**-53)
    assert np.allclose(sig, want)


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges + [(None, 3), (4, None)], "a long, b long")
    got = {x.id: x.class_id for x in components(df).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(df.limit(0)).count() == 0
