"""Some registered queries against their SQL; ``tools/compare.py`` runs all."""

import duckdb
import pytest

import __spark_entry__ as entry
import sample_queries
from tools.compare import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
CHOSEN = [
    "topic_sink", "last_n", "multi_query", "flatten_long", "flatten_array", "flatten_wide",
    "infer_mixed", "coerce_number", "key_collision", "error_rows", "lp_long", "lp_filter_all",
    "lp_tags", "panel_moving_mean", "wire_index", "offset_latest", "last_n_large", "encode_lp", "schema_by_id", "stream_long",
    "manifest_bounds", "sink_offsets", "time_window", "multi_query_shared", "wide_extra", "flatten_deep", "schema_tables", "frame_sink",
]


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = entry.queries()[name](spark, SF_DIR)
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_array_text_takes_floats(spark, tmp_path):
    """Floats whose shortest text is on the other side of a half."""
    db = duckdb.connect()
    values = [(2 * i + 1) / 20000 for i in range(2000)] + [0.25, -0.01905, -1e-5]
    rows = ", ".join(f"({i}, [{v!r}::FLOAT, 1], {i % 3})" for i, v in enumerate(values))
    db.execute(
        f"""COPY (SELECT i::BIGINT AS vec_id, e::FLOAT[] AS embedding, l::INTEGER AS label FROM (VALUES {rows},
        (3000, [], 1)) t(i, e, l)) TO '{tmp_path}/embeddings.parquet'"""
    )
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    df = entry.queries()["array_text"](spark, str(tmp_path))
    result = db.execute(entry.oracle_sql()["array_text"])
    names = [d[0] for d in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "event.user.id" in df.columns


def test_every_query_has_sql():
    assert set(sample_queries.QUERIES) == set(sample_queries.ORACLES)
