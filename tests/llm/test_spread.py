import random

import numpy as np

from wirelake.llm import neardup as nd
from wirelake.llm import residue as rs


def edited(seed, n, rng):
    """Texts with one to five letters changed."""
    out = set()
    for _ in range(n):
        x = list(seed)
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            x[rng.randrange(len(x))] = rng.choice("abcdefghijklmnopqrstuvwxyz")
        out.add("".join(x))
    return sorted(out - {seed})


def test_tables_reach_pairs_at_the_threshold():
    """Recall of the SimHash tables against brute force, at 0.80 to 0.86 similarity too."""
    rng = random.Random(7)
    words = "page site server browser script cookie reload moved address please later again contact portal visitor check screen access button notice".split()
    seeds = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(60)]
    pairs = [(i, c) for i, s in enumerate(seeds) for c in edited(s, 60, rng)]
    sim = nd._jaccards([seeds[i] for i, _ in pairs], [c for _, c in pairs], rs.SHINGLE)
    tables = rs.Tables(seeds, ["x"] * len(seeds), np.zeros(0, dtype=np.int64))
    got = {(int(f), int(q)) for qs, fs in tables.near(rs.simhash([c for _, c in pairs])) for q, f in zip(qs, fs)}
    close = [(i, j) for j, (i, _) in enumerate(pairs) if sim[j] >= rs.SIMILARITY]
    edge = [(i, j) for i, j in close if sim[j] < 0.86]
    assert len(edge) > 150
    assert sum(p in got for p in close) >= 0.98 * len(close)
    assert sum(p in got for p in edge) >= 0.97 * len(edge)


def test_record_with_a_changed_message(spark):
    rows = [("raw_items", 1, "Please enable JavaScript to continue."), ("articles", 2, "Plxase enable JavaScript to continue."), ("articles", 3, "O preço do diesel subiu hoje no porto.")]
    df = spark.createDataFrame(rows, "rec_table string, rec_id long, text string")
    assert {tuple(x) for x in rs.residue(df).collect()} == {("raw_items", 1, "seed"), ("articles", 2, "copy")}
