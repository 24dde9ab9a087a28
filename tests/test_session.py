import pytest
from pyspark.sql import functions as F

from tidelog.operators.flatten import FlattenOptions
from tidelog.operators.structs import flatten_struct
from tidelog.session import BATCH_BYTES, bounded_batches, stored, temporary_tables
from tidelog.sources.files import file_context


def exists(spark, path):
    hadoop, context = file_context(spark, path)
    return context.util().exists(hadoop.Path(path))


def test_temporary_tables_go_at_the_end(spark):
    kept = stored(spark.range(3), "kept")
    with temporary_tables(spark) as outer:
        table = stored(spark.range(5), "outer")
        with pytest.raises(RuntimeError), temporary_tables(spark) as inner:
            assert stored(spark.range(7), "inner").count() == 7
            raise RuntimeError
        assert len(inner) == 1 and not exists(spark, inner[0])
        assert table.count() == 5
    assert len(outer) == 1 and not exists(spark, outer[0])
    assert kept.count() == 3


def test_batches_are_bounded_by_their_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield batch[["text"]].agg(lambda x: x.str.len().sum()).to_frame("size")

    texts = spark.range(60, numPartitions=1).select(F.repeat(F.lit("x"), 500_000).alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with pytest.raises(RuntimeError), bounded_batches(spark):
        found = [r["size"] for r in texts.mapInPandas(sizes, "size long").collect()]
        raise RuntimeError
    assert sum(found) == 60 * 500_000 and max(found) <= BATCH_BYTES + 500_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_fields_over_the_cap_of_a_schema_are_told(spark):
    df = spark.range(1).select(F.struct(*[F.lit(i).alias(f"f{i}") for i in range(5)]).alias("body"))
    with pytest.warns(UserWarning, match="2 of the schema"):
        assert flatten_struct(df, options=FlattenOptions(5, 3)).columns == ["f0", "f1", "f2"]
