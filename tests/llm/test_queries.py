"""Registered text queries against SQL on the smallest data, and over the whole tables."""

import duckdb
import pytest

from landloom.llm.queries import ORACLES, QUERIES
from tools.compare import TYPES, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got, columns = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLES[name])
    want, names = rows(rel.columns, rel.fetchall())
    assert columns == names
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_a_document(spark, con, name):
    df = QUERIES[name](spark, SF)
    ids = sorted(r[0] for r in df.select("doc_id").collect())
    assert ids == sorted(r[0] for r in con.sql("SELECT doc_id FROM documents").fetchall())
