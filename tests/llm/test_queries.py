import pytest

from wirelake.llm import queries


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() >= 0


def test_found_columns(spark, data):
    want = {
        "p1_found": [("a_id", "bigint"), ("b_id", "bigint")], "p2_found": [("rec_table", "string"), ("rec_id", "bigint")], "p4_found": [("rec_table", "string"), ("rec_id", "bigint")],
        "p5_found": [("article_id", "bigint"), ("seg_no", "int"), ("lang", "string")], "p6_found": [("article_id", "bigint"), ("line_no", "int")], "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    }
    for name, cols in want.items():
        assert queries.QUERIES[name](spark, data).dtypes == cols
