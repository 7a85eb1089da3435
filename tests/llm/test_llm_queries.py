import os

import duckdb
import pytest

from tamiz.llm import catalog

COLUMNS = {
    "p1_found": ["qa_id"], "p2_found": ["pdf_id"], "p3_found": ["qa_id_a", "qa_id_b"], "p4_found": ["qa_id", "defect"], "p5_found": ["qa_id"],
    "p6_found": ["qa_id_a", "qa_id_b"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, data, name):
    df = catalog.queries()[name](spark, data)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
    if name in catalog.oracle_sql():
        db = duckdb.connect()
        for f in os.listdir(data):
            db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
        found = db.execute(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
        assert sorted(rows, key=str) == sorted(found, key=str)
    assert name == "p7_roundtrip" or rows
