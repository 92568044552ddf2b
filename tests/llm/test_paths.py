from wirelake.llm import markup


def test_records_of_one_path_meet_another_path(spark):
    own = "Texto bem longo e próprio desta página, número "
    rows = [("articles", i, f"https://h.example/a/{p}", f"{own}{p}\nSiga o canal") for i, p in enumerate([1, 1, 1, 2, 2, 3])]
    df = spark.createDataFrame(rows, "rec_table string, rec_id long, url string, text string")
    got = {r.rec_id: (r.shared_lines, r.clean) for r in markup.difference(df.coalesce(1)).collect()}
    assert got == {i: (1, f"{own}{p}") for i, p in enumerate([1, 1, 1, 2, 2, 3])}


def test_same_rows_for_any_number_of_partitions(spark):
    import random

    r = random.Random(3)
    text = lambda: "\n".join(r.choice(["Siga o canal", "Leia mais", "Assine já", *(f"linha própria {r.randrange(400)}" for _ in range(4))]) for _ in range(r.randrange(1, 6)))
    rows = [("articles", i, f"https://{r.choice('abc')}.example/{r.choice('xyz')}/{r.randrange(40)}", text()) for i in range(300)]
    df = spark.createDataFrame(rows, "rec_table string, rec_id long, url string, text string")
    got = [sorted(map(str, markup.difference(df.repartition(n), n).collect())) for n in (1, 4, 64)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 300
    assert any("shared_lines=1" in x for x in got[0])


def test_nearest_of_both_neighbours_and_small_pages(spark):
    rows = [
        ("articles", 1, "https://h.example/sport/9", "um\nAssine\nLeia"),
        ("articles", 2, "https://h.example/world/1", "dois\nRodapé\nVoltar"),
        ("articles", 3, "https://h.example/world/2", "três\nRodapé\nVoltar\nAssine"),
        ("articles", 4, "https://k.example/1", "igual"),
        ("articles", 5, "https://k.example/2", "igual"),
    ]
    df = spark.createDataFrame(rows, "rec_table string, rec_id long, url string, text string")
    got = {r.rec_id: r.clean for r in markup.difference(df).collect()}
    # the template outweighs the text of the page; the neighbour after it is nearer; a copy stays whole
    assert got == {1: "um\nAssine\nLeia", 2: "dois", 3: "três\nAssine", 4: "igual", 5: "igual"}


def test_long_pages_align_in_linear_space():
    a = [f"l{i}" for i in range(6000)]
    b = [x for i, x in enumerate(a) if i % 3] + ["z"] * 500
    assert len(markup.common_lines(a, b)) == 4000
