import pytest

from tidelog.operators.infer import schema_groups
from tidelog.operators.schema_tables import read_schema_table, write_schema_tables

VALUES = [
    '{"a":1,"b":"x"}', '{"b":"y","a":2}', '{"a":1.5,"b":"z"}', '{"a":null,"b":"w"}', "bad", None, "{}", '{"topic":"q","c|d:e":true}',
    '{"error":"e"}', '[{"a":7}]', '{"a":{"b":[1,2]}}',
]


def test_each_group_is_a_typed_table(spark, topic, tmp_path):
    df = topic(VALUES, partitions=2)
    groups = write_schema_tables(df, str(tmp_path / "tables")).collect()
    assert sum(g["messages"] for g in groups) == len(VALUES)
    by_fields = {None if g["fields"] is None else tuple(g["fields"]): g for g in groups}
    assert len(by_fields) == len(groups) == 8
    read = lambda *fields: read_schema_table(spark, str(tmp_path / "tables"), by_fields[fields or None]["signature"])
    # the last null takes the type the path had last
    double = read("a:double", "b:string")
    assert dict(double.dtypes)["a"] == "double" and sorted(r["b"] for r in double.collect()) == ["w", "z"]
    whole = read("a:long", "b:string")
    assert dict(whole.dtypes)["a"] == "bigint" and sorted((r["a"], r["b"]) for r in whole.collect()) == [(1, "x"), (2, "y")]
    odd = read("c|d:e:bool", "topic:string")
    assert odd.columns[-2:] == ["c|d:e", "value.topic"] and odd.first()["value.topic"] == "q" and odd.first()["topic"] == "t"
    assert read("error:string").first()["error"] == "e"
    assert read("item_0.a:long").first()["item_0.a"] == 7
    assert read("a.b:json").first()["a.b"] == "[1,2]"
    assert read().count() == 2 and read().columns == ["topic", "partition", "offset", "timestamp"]
    with pytest.raises(LookupError):
        read_schema_table(spark, str(tmp_path / "tables"), "none")
    types = {"a": "double"}
    report = schema_groups(df, types=types).count()
    assert report == len(groups) - 1  # the report calls failed messages error:string


def test_a_file_holds_one_group(spark, topic, tmp_path):
    write_schema_tables(topic(VALUES * 5, partitions=3), str(tmp_path / "tables"))
    files = spark.read.parquet(str(tmp_path / "tables/rows")).select("signature", "_metadata.file_path").distinct()
    assert files.groupBy("file_path").count().filter("count > 1").isEmpty()


def test_messages_are_parsed_once_to_write(topic, tmp_path, monkeypatch):
    from tidelog.operators import schema_tables

    calls = []
    leaves = schema_tables.text_leaves
    monkeypatch.setattr(schema_tables, "text_leaves", lambda *a: calls.append(a) or leaves(*a))
    df = topic(['{"a":1,"n":null}', '{"a":"x","n":null}', '{"a":null}', "bad"])
    groups = {tuple(r["fields"] or ()) for r in write_schema_tables(df, str(tmp_path / "t")).collect()}
    assert groups == {("a:long", "n:double"), ("a:string", "n:double"), ("a:string",), ()}
    assert len(calls) == 1
