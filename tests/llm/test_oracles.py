"""The registered SQL gives the rows of its query."""

import duckdb
import pytest

from tabloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_agrees(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    got = [tuple(r) for r in queries.QUERIES[name](spark, sf).select(*columns).collect()]
    assert sorted(got) == sorted(want.fetchall())
