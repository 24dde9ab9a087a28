import duckdb
import pytest

import __spark_entry__ as entry
from tidelog.llm import queries
from tools.compare import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    result = db.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_all_are_registered():
    assert {f"op{n}_" for n in range(1, 14)} <= {q[: q.index("_") + 1] for q in entry.queries() if q.startswith("op")}
    assert "pipeline" in entry.queries()
