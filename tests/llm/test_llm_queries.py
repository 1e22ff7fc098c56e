import pytest

from loomline.llm import queries as llm
from tests.sqlcheck import connection, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    same(spark, con, llm.queries()[name], llm.oracle_sql()[name], SF)


COLUMNS = {
    "p1_found": "keep_line_id bigint, line_id bigint", "p2_found": "vec_id bigint, neighbor_id bigint", "p3_found": "eval_line_id bigint, train_line_id bigint",
    "p4_found": "doc_id bigint, seg_no int, lang string", "p5_found": "sent_id bigint", "p6_found": "corpus string, line_id bigint", "p7_ids": "doc_id bigint, ids array<int>", "p9_found": "doc_id bigint",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_distinct_rows(spark, name):
    df = llm.queries()[name](spark, SF)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    rows = df.toArrow().to_pylist()
    assert len(rows) == len({str(r) for r in rows})


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(llm.oracle_sql()) - set(COLUMNS)))
def test_query_runs(spark, name):
    assert len(llm.queries()[name](spark, SF).toArrow().column_names) > 0
