"""The queries of the training-data problems on the smallest tables, against their SQL where there is one."""

import pytest

from inkspan.llm import queries
from tests.oracle import connection, differences

COLUMNS = {
    "p1_found": ["seq"], "p2_found": ["qa_id", "defect"], "p3_found": ["seq", "line_no", "noise"], "p4_found": ["seq", "boundary"],
    "p5_found": ["seq", "line_no"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, sf, name):
    assert differences(queries.QUERIES[name](spark, sf), queries.SQL[name], connection(sf)) == ""


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_gives_rows(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert df.columns == COLUMNS.get(name, df.columns)
    assert df.count() > 0
