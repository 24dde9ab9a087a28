import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidelog.functions import wire
from tidelog.operators import decode, panels
from tidelog.operators.avro import decode_avro
from tidelog.operators.protobuf import decode_protobuf, message_at, message_paths
from tidelog.operators.structs import flatten_struct
from tidelog.operators.wide import FieldSpec
from tidelog.plans.query import TopicQuery
from tidelog.plans.run import run, run_many
from tidelog.sources import offsets, schemas
from tidelog.sources.topic import (
    TopicNotFound,
    TopicSource,
    drop_control_records,
    topic_catalog,
    topic_partitions,
)

GOOD = '{"b":{"c":1},"a":"x","item_10":1,"item_2":2}'


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_query_defaults_and_checks():
    q = TopicQuery("t")
    assert (q.format, q.offset, q.key_format, q.time_mode) == ("json", "latest", "none", "message")
    assert (q.schema_source, q.lp_precision, q.partition, q.last_n) == ("registry", "auto", "all", 100)
    assert TopicQuery("t", last_n=-1).last_n == 100 and TopicQuery("t", last_n=10**9).last_n == 10**9
    assert q.fingerprint() == TopicQuery("t").fingerprint() != TopicQuery("t", alias="x").fingerprint()
    assert not TopicQuery("").is_valid
    with pytest.raises(ValueError, match="format must be one of"):
        TopicQuery("t", format="xml")


def test_wide_layout_and_order(spark, topic):
    df = topic([GOOD, "5"], keys=['{"id":1,"z":{"y":2}}', None], partitions=2)
    out = run(spark, TopicQuery("t", offset="earliest", key_format="json"), df)
    assert out.columns == [
        "time", "partition", "offset", "key.id", "key.z.y", "a", "b.c", "item_10", "item_2", "error",
    ]
    good, bad = sorted(dicts(out), key=lambda r: r["partition"])
    assert (good["key.z.y"], good["b.c"], good["item_10"], good["error"]) == (2, 1, 1, None)
    assert bad["error"].endswith("json.Number") and bad["a"] is None
    single = run(spark, TopicQuery("t", offset="earliest", partition=1), df)
    assert "partition" not in single.columns


def test_reserved_value_names(spark, topic):
    df = topic(['{"time":1,"offset":2,"error":"e"}'])
    out = run(spark, TopicQuery("t", offset="earliest"), df)
    assert out.columns[-4:] == ["value.error", "value.offset", "value.time", "error"]


def test_message_without_leaves_stays_in_wide(spark, topic):
    df = topic(["{}", '{"a":{}}', '{"a":1}'])
    assert run(spark, TopicQuery("t", offset="earliest"), df).count() == 3
    assert run(spark, TopicQuery("t", offset="earliest", shape="long"), df).count() == 1


def test_error_rows_keep_message_time(spark, topic):
    df = topic(['{"a":1}', "nope", None, ""])
    query = TopicQuery("t", offset="earliest", time_mode="now")
    out = run(spark, query, df, fields=[FieldSpec("a", "long")])
    years = {r["offset"]: (r["time"].year, r["error"]) for r in out.collect()}
    assert years[0][0] > 2024 and years[0][1] is None
    assert years[1] == (2024, "json decoding failed: malformed JSON")
    assert years[2] == years[3] == (2024, "message value is nil - possible decoding failure")


def test_split_errors_and_audit(topic):
    decoded = decode.decode_json(topic(['{"a":1}', "x", "[1]", "7"], partitions=2))
    good, bad = decode.split_errors(decoded)
    assert good.count() == 2 and "error" not in good.columns
    assert bad.columns == ["time", "partition", "offset", "error"] and bad.count() == 2
    audit = {r["partition"]: r.asDict() for r in decode.decode_audit(decoded).collect()}
    assert audit[0]["failed"] == 0 and audit[0]["first_error"] is None
    assert (audit[1]["messages"], audit[1]["failed"], audit[1]["first_error_offset"]) == (2, 2, 0)


def test_keys(spark, topic):
    df = topic(["{}"] * 5, keys=["k1", None, b"", b"\xff\x00", "[1]"])
    got = df.select(
        decode.key_text(F.col("key"), "string").alias("s"),
        decode.key_text(F.col("key"), "base64").alias("b"),
    ).collect()
    assert [r["b"] for r in got] == ["azE=", "", "", "/wA=", "WzFd"]
    assert [r["s"] for r in got[:3]] == ["k1", "", ""]
    long_key = topic(["{}"], keys=["x" * 200])
    assert "\n" not in long_key.select(decode.key_text(F.col("key"), "base64")).collect()[0][0]


def test_plaintext(spark, topic):
    out = run(spark, TopicQuery("t", offset="earliest", format="plaintext"), topic(["x\ny", "", None]))
    assert [r["message"] for r in out.orderBy("offset").collect()] == ["x\ny", "", None]


def test_control_records(topic):
    six, commit, abort = bytes(6), b"\0\0\0\1", b"\0\0\0\0"
    keys = [commit, abort, commit, b"\0\1\0\0", b"\0\0\0\2", b"\0\0\1", None, b"\0\0\0\0\0"]
    values = [six, six, bytes(7), six, six, six, six, six]
    kept = drop_control_records(topic(values, keys=keys)).select("offset").collect()
    assert sorted(r["offset"] for r in kept) == [2, 3, 4, 5, 6, 7]
    assert drop_control_records(topic([None], keys=[commit])).count() == 1


def test_partitions(topic):
    df = topic(["{}"] * 6, partitions=3)
    assert offsets.select_partitions(df, "all").count() == 6
    assert offsets.select_partitions(df, 2).count() == 2
    assert offsets.select_partitions(df, 2.0).count() == 2
    for bad, error in ((3, ValueError), (-1, ValueError), (1.5, ValueError), ("x", ValueError)):
        with pytest.raises(error):
            offsets.select_partitions(df, bad)
    with pytest.raises(TypeError):
        offsets.select_partitions(df, None)
    with pytest.raises(TopicNotFound):
        topic_partitions(df, "other")
    assert topic_partitions(df, "t").count() == 3


def test_last_n_counts_offsets(topic):
    df = topic(["{}"] * 20, partitions=2, start=100)
    gaps = df.filter("offset NOT IN (107, 108)")
    kept = sorted(r["offset"] for r in offsets.last_n(gaps, 4).filter("partition = 0").collect())
    assert kept == [106, 109]
    assert offsets.last_n(gaps, 1000).count() == gaps.count()
    many = topic(["{}"] * 900, partitions=300)
    assert offsets.last_n(many, 2).count() == 600
    assert offsets.after_high_water(many, offsets.offset_bounds(many)).count() == 0


def test_taken_names_are_prefixed_until_free(spark, topic):
    df = topic(['{"time":2,"value":{"time":1},"error":"e"}'])
    row = run(spark, TopicQuery("t", offset="earliest"), df).first()
    assert (row["value.value.time"], row["value.time"], row["value.error"]) == (2, 1, "e")


def test_latest_in_batch_needs_bounds(spark, topic):
    old, new = topic(['{"a":1}'] * 2), topic(['{"a":1}', '{"a":1}', '{"a":7}'])
    with pytest.raises(ValueError, match="bounds"):
        run(spark, TopicQuery("t"), new)
    got = run(spark, TopicQuery("t"), new, bounds=offsets.offset_bounds(old)).collect()
    assert [r["a"] for r in got] == [7]


def test_last_value_at_the_largest_offsets(spark):
    at = datetime(2024, 1, 1, tzinfo=UTC)
    rows = [(at, 0, 2**62, 1.0), (at, 0, 2**62 + 1, 2.0), (at, 2_000_000_000, 3, 5.0), (at, 7, 2**63 - 1, 4.0)]
    df = spark.createDataFrame(rows, "time timestamp, partition int, offset long, v double")
    assert panels.reduce_last(df, "v").first()["last"] == 5.0
    assert panels.reduce_last(df.where("partition = 0"), "v").first()["last"] == 2.0


def test_after_high_water(topic):
    old, new = topic(["{}"] * 4, partitions=2), topic(["{}"] * 9, partitions=3)
    kept = offsets.after_high_water(new, offsets.offset_bounds(old)).collect()
    assert sorted((r["partition"], r["offset"]) for r in kept) == [(0, 2), (1, 2), (2, 0), (2, 1), (2, 2)]


def test_starting_offsets_json(topic):
    text = offsets.starting_offsets_json(offsets.offset_bounds(topic(["{}"] * 10, partitions=2)), 2)
    assert json.loads(text) == {"t": {"0": 3, "1": 3}}


def test_catalog(topic):
    df = topic(["{}"] * 4, name="b", partitions=2)
    for name in ("a", "ab", "c"):
        df = df.unionByName(topic(["{}"], name=name))
    assert {r["topic"] for r in topic_catalog(df, limit=2).collect()} == {"a", "ab"}
    assert {r["topic"] for r in topic_catalog(df, "a").collect()} == {"a", "ab"}
    rows = {(r["topic"], r["partition"]): r["messages"] for r in topic_catalog(df, limit=0).collect()}
    assert rows == {("a", 0): 1, ("ab", 0): 1, ("b", 0): 2, ("b", 1): 2, ("c", 0): 1}


def test_alias(spark, topic):
    df = topic(['{"a":1}'])
    query = TopicQuery("t", offset="earliest", ref_id="R", alias="{{topic}}-{{refid}}-{{field}}")
    out = run(spark, query, df)
    names = {f.name: f.metadata.get("display_name") for f in out.schema.fields}
    assert names["a"] == "t-R-a" and names["time"] is None and names["offset"] == "t-R-offset"
    by_partition = TopicQuery("t", offset="earliest", alias="p{{partition}}{{field}}")
    assert run(spark, by_partition, df).collect()[0]["series"] == "p0"
    lp = TopicQuery("t", offset="earliest", format="lineprotocol", shape="long", alias="{{field}}!")
    assert run(spark, lp, topic(["m f=1"])).collect()[0]["series"] == "f!"


def test_multi_query_aligns_types(spark, topic):
    df = topic(['{"v":1,"w":true}'], name="x").unionByName(topic(['{"v":1.5,"w":2}'], name="y"))
    both = [TopicQuery(n, offset="earliest", ref_id=n) for n in ("x", "y", "")]
    got = {r["ref_id"]: (r["v"], r["w"]) for r in run_many(spark, both, df).collect()}
    assert got == {"x": (1.0, "true"), "y": (1.5, "2")}


def test_binary_formats_need_their_packages(spark, topic):
    """Neither package is on this machine; nothing else stands in for it."""
    df = topic([b"\0\0\0\0\1x"])
    with pytest.raises(RuntimeError, match="spark-avro"):
        decode_avro(df, '{"type":"record","name":"R","fields":[]}')
    with pytest.raises(RuntimeError, match="spark-avro"):
        run(spark, TopicQuery("t", offset="earliest", format="avro", schema_source="inline", schema="{}"), df)
    with pytest.raises(RuntimeError, match="spark-protobuf"):
        decode_protobuf(df, b"", "M")


def test_unions_share_their_path(spark):
    df = spark.sql("SELECT struct(1 AS a, struct(struct(5L AS z) AS member0, 7L AS member1) AS u, struct(1L AS member0, 'x' AS member1) AS w) AS body")
    row = flatten_struct(df).first().asDict()
    assert row == {"a": 1, "u": 7, "u.z": 5, "w": "1"}


def test_wire_header_modes(spark):
    values = [b"\0\0\0\0\7abc", b"\0\0\0\0\7", b"abc", None, b"\0\xff\xff\xff\xff!"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value binary")
    for mode in ("auto", "raw"):
        columns = wire.header_columns(F.col("value"), mode)
        rows = df.orderBy("i").select(*[c.alias(n) for n, c in columns.items()]).collect()
        payload = [None if r["payload"] is None else bytes(r["payload"]) for r in rows]
        if mode == "raw":
            assert payload == values and all(r["schema_id"] is None for r in rows)
        else:
            assert [r["schema_id"] for r in rows] == [7, None, None, None, 4294967295]
            assert payload == [b"abc", b"\0\0\0\0\7", b"abc", None, b"!"]


INDEXES = [
    (b"\0rest", [0], 1),
    (b"\1\5", [5], 2),
    (b"\1\xac\2x", [300], 3),
    (b"\2\1\3", [1, 3], 3),
    (b"\x0a" + bytes(range(10)), list(range(10)), 11),
    (b"\x0b\2\0z", [11, 2], 3),
    (b"\3\1\0", [3, 1], 3),
    (b"\5", [5], 1),
    (b"\x81\0\7", [7], 3),
    (b"\xff", None, None),
    (b"\1" + b"\xff" * 9 + b"\1", None, None),
    (b"\5" + b"\xff" * 9 + b"\1\0", None, None),
    (b"\2\1\0" + b"\xff" * 9, [1, 0], 3),
]


def test_message_index_forms(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _, _) in enumerate(INDEXES)], "i int, b binary")
    got = df.orderBy("i").select(wire.message_index(F.col("b")).alias("x")).collect()
    for r, (data, path, skip) in zip(got, INDEXES, strict=True):
        assert (r["x"] and list(r["x"]["path"])) == path, data
        assert (r["x"] and r["x"]["skip"]) == skip, data


def test_schema_table(spark, topic):
    table = spark.createDataFrame(
        [("t-value", 1, 5, "old"), ("t-value", 2, 4, "new"), ("u-value", 9, 6, "u")],
        "subject string, version int, id bigint, schema string",
    )
    assert schemas.latest_schema(table, "t") == "new"
    with pytest.raises(LookupError):
        schemas.latest_schema(table, "missing")
    assert schemas.topic_schemas(table, "t") == {5: "old", 4: "new"}


def test_decode_by_schema_is_one_projection(spark, tmp_path):
    rows = [(5, '{"a":1}'), (6, '{"a":2.5,"b":"x"}'), (7, "{}"), (None, '{"c":true}'), (5, "no"), (5, None)]
    spark.createDataFrame(rows, "schema_id bigint, value string").write.parquet(str(tmp_path / "log"))
    known = {i: "other int" for i in range(100, 167)} | {5: "a bigint", 6: "a double, b string"}
    for df in (spark.read.parquet(str(tmp_path / "log")), spark.readStream.schema("schema_id bigint, value string").parquet(str(tmp_path / "log"))):
        out = schemas.decode_by_schema(df, known, F.from_json, F.col("value"))
        assert out.columns == ["schema_id", "value", "a", "b", "other", "error"]
        if df.isStreaming:
            out.writeStream.format("memory").queryName("by_schema").trigger(availableNow=True).option(
                "checkpointLocation", str(tmp_path / "cp")
            ).start().awaitTermination()
            out = spark.table("by_schema")
        else:
            assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
        got = {(r["schema_id"], r["value"]): (r["a"], r["b"], r["error"]) for r in out.collect()}
        assert got[5, '{"a":1}'] == (1.0, None, None) and got[6, rows[1][1]] == (2.5, "x", None)
        assert got[7, "{}"][2] == "schema not found: id 7" and got[None, rows[3][1]][2] == "schema not found: id none"
        assert got[5, None] == (None, None, None) and len(got) == 6
    bare = schemas.decode_by_schema(spark.createDataFrame(rows[3:4], "schema_id bigint, value string"), {}, F.from_json, F.col("value"), "c boolean")
    assert bare.first()["c"] is True and bare.first()["error"] is None


def test_protobuf_names_and_paths():
    d = pytest.importorskip("google.protobuf.descriptor_pb2")
    file = d.FileDescriptorProto(name="x.proto", package="p", syntax="proto3")
    file.message_type.add(name="First")
    file.message_type.add(name="Outer").nested_type.add(name="Inner")
    descriptor = d.FileDescriptorSet(file=[file]).SerializeToString()
    assert message_at(descriptor) == "p.First" and message_at(descriptor, (1, 0)) == "p.Outer.Inner"
    assert message_paths(descriptor) == [(0,), (1,), (1, 0)]
    with pytest.raises(IndexError):
        message_at(descriptor, (4,))


@pytest.mark.parametrize("piece", [4096, 2])
def test_moving_mean_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(panels, "PIECE_ROWS", piece)
    values = [None, 1.0, 2.5, None, float("nan"), 4.0, float("inf"), 5.0, 6.0, 1e17]
    rows = [
        (s, i, values[(i * k) % 10] if i % 31 else None)
        for s, k in (("a", 1), ("b", 3), (None, 7))
        for i in range(40 if s != "b" else 7)
    ]
    df = spark.createDataFrame(rows, "s string, i int, v double")
    out = panels.moving_mean(df, "v", ["s"], ["i"], fraction=0.1)
    got = {(r["s"], r["i"]): r["moving_mean"] for r in out.collect()}
    assert len(got) == len(rows)
    for s in ("a", "b", None):
        series = [v for t, _, v in sorted((r for r in rows if r[0] == s), key=lambda r: r[1])]
        width = max(1, round(0.1 * len(series)))
        for i in range(len(series)):
            inside = [v for v in series[max(0, i - width + 1) : i + 1] if v is not None]
            want = sum(inside) / len(inside) if inside else None
            assert got[s, i] == pytest.approx(want, nan_ok=True) if want is not None else got[s, i] is None


def test_panels(spark):
    at = datetime(2024, 1, 1, tzinfo=UTC)
    df = spark.createDataFrame(
        [("h1", at, 0, 1, 1.0), ("h1", at, 0, 2, None), ("h1", at, 0, 0, 9.0), ("h2", at, 1, 0, None)],
        "`host.name` string, time timestamp, partition int, offset long, `cpu.load` double",
    )
    last = {r[0]: r["last"] for r in panels.reduce_last(df, "cpu.load", ["host.name"]).collect()}
    assert last == {"h1": 1.0, "h2": None}
    assert panels.reduce_mean(df, "cpu.load").collect()[0]["mean"] == 5.0
    assert panels.footer_sum(df, "cpu.load").collect()[0]["sum"] == 10.0
    assert panels.group_fields(df, ["host.name"]).count() == 2
    assert panels.time_range(df, F.lit(at), F.lit(at)).count() == 4


def test_source_needs_a_path():
    with pytest.raises(ValueError):
        TopicSource()
