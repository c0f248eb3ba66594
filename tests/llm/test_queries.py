from pathlib import Path

import pytest

from siltstone.llm.queries import QUERIES
from siltstone.llm.sql import ORACLE

COLUMNS = {"p1_found": ["document_id"], "p2_found": ["document_id"], "p3_found": ["document_id"], "p4_found": ["level", "entity_id", "verdict"], "p5_found": ["item_id", "document_id"], "p6_found": ["document_id", "defect"], "p7_found": ["document_id", "line_no"], "p10_found": ["doc_id", "kind", "start_pos"]}


@pytest.mark.parametrize("name", QUERIES)
def test_query_runs_without_repeats(spark, data, name):
    out = QUERIES[name](spark, data)
    assert out.columns == COLUMNS.get(name, out.columns)
    rows = [str(r) for r in out.collect()]
    assert rows and len(rows) == len(set(rows))


def test_queries_against_sql(spark, data):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, data)
        columns = sorted(got.columns)
        result = con.execute(sql)
        labels = [d[0] for d in result.description]
        want = sorted(str([row[labels.index(c)] for c in columns]) for row in result.fetchall())
        assert sorted(str([r[c] for c in columns]) for r in got.collect()) == want, name
