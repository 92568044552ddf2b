import random

from wirelake.llm import neardup as nd


def changed(r, t, low, high):
    """A copy of ``t`` with letters changed until its similarity is within the bounds."""
    while True:
        x = list(t)
        for _ in range(200):
            x[r.randrange(len(x))] = r.choice("abcdefghijklmnopqrstuvwxyz")
            s = nd._jaccards([t], ["".join(x)], nd.SHINGLE)[0]
            if low <= s < high:
                return "".join(x)
            if s < low:
                break


def test_pairs_at_the_threshold_are_found(spark):
    r = random.Random(4)
    text = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    t, s = [text(90) for _ in range(1000)], [text(200) for _ in range(1000)]
    t2, s2 = [changed(r, x, 0.6, 0.63) for x in t], [changed(r, x, 0.6, 0.63) for x in s]
    rows = [(i, *x) for i, x in enumerate(zip(t, s))] + [(1000 + i, *x) for i, x in enumerate(zip(t2, s2))]
    df = spark.createDataFrame(rows, "article_id long, title string, snippet string")
    got = {tuple(r) for r in nd.p1_found(df).collect()}
    assert len(got & {(i, 1000 + i) for i in range(1000)}) >= 997
