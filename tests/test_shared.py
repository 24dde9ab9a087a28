"""Several queries over one scan; the left-over map in batch and as a stream."""

import re
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest

from tidelog.operators.wide import FieldSpec
from tidelog.plans.query import TopicQuery
from tidelog.plans.run import run, run_many, run_shared
from tidelog.sources import manifest
from tidelog.sources.offsets import offset_bounds
from tidelog.sources.sink import write_topic
from tidelog.sources.topic import TopicSource, as_topic
from tidelog.streaming.stream import StreamOptions, start_stream, stream_frame

START = datetime.fromtimestamp(1704067200, UTC)
JSON = [f'{{"a":{i},"b":{{"c":"x{i}"}},"n":null}}' for i in range(40)] + ["{bad", None]
LINES = [f"cpu,host=h{i % 3} load={i},idle={i}i\nmem free={i}" for i in range(20)] + ["free text", "cpu load=1"]


def rows(df):
    names = sorted(df.columns)
    return Counter(tuple(str(r[c]) for c in names) for r in df.select(*[f"`{c}`" for c in names]).collect())


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"LogicalRDD|LocalRelation|Relation \[", plan))


def both(spark, queries, df, **options):
    shared, many = run_shared(spark, queries, df, **options), run_many(spark, queries, df, **options)
    # long tables have a series column only where an alias is asked for
    assert set(shared.columns) == set(many.columns)
    assert rows(shared) == rows(many)
    return shared


def q(**more):
    return TopicQuery("t", **({"offset": "earliest"} | more))


def test_json_queries_share_a_scan(spark, topic):
    df = topic(JSON, partitions=3)
    queries = [
        q(ref_id="A"), q(partition=1, ref_id="B"), q(offset="last_n", last_n=4, ref_id="C"),
        q(start_time=START + timedelta(seconds=5), ref_id="D"),
        q(start_time=START + timedelta(seconds=5), end_time=START + timedelta(seconds=9), partition=2, ref_id="E"), TopicQuery(""),
    ]
    shared = both(spark, queries, df)
    assert scans(shared) == 1 and scans(run_many(spark, queries, df)) == 5
    bounds = offset_bounds(df.filter("offset < 9"))
    both(spark, [q(offset="latest", ref_id="A"), q(ref_id="B")], df, bounds=bounds)


@pytest.mark.parametrize("shape", ["long", "variant"])
def test_other_shapes(spark, topic, shape):
    df = topic(JSON, partitions=2)
    queries = [q(shape=shape, ref_id="A", alias="{{refid}} {{field}} {{partition}}"), q(shape=shape, partition=1, ref_id="B")]
    if shape == "variant":
        queries = [q(shape=shape, ref_id="A"), q(shape=shape, partition=1, ref_id="B")]
    shared = both(spark, queries, df)
    assert scans(shared) == 1


def test_line_protocol_queries_share_a_parse(spark, topic):
    df = topic(LINES, partitions=2)
    lines = {"format": "lineprotocol", "shape": "long"}
    queries = [
        q(**lines, ref_id="A"), q(**lines, lp_measurements="cpu", lp_fields="load", ref_id="B"),
        q(**lines, lp_tags="host=h1", partition=1, ref_id="C"), q(**lines, lp_fields="free", ref_id="D"),
    ]
    shared = both(spark, queries, df)
    assert scans(shared) == 1


def test_different_decoding_is_apart(spark, topic):
    df = topic(JSON, partitions=2).union(topic(LINES, name="u"))
    queries = [
        q(ref_id="A"), q(ref_id="B", partition=0), q(format="plaintext", ref_id="C"), q(key_format="string", ref_id="D"),
        TopicQuery("u", offset="earliest", format="lineprotocol", ref_id="E"),
    ]
    both(spark, queries, df)
    with pytest.raises(ValueError, match="range"):
        run_shared(spark, [q(), q(partition=5)], df)
    with pytest.raises(ValueError, match="no valid"):
        run_shared(spark, [TopicQuery("")], df)


def test_shared_reads_of_a_managed_table(spark, topic, tmp_path):
    source = TopicSource("managed", str(tmp_path / "log"))
    manifest.create_topic(spark, source.path, "t", 3)
    for part in (JSON[:20], JSON[20:]):
        write_topic(as_topic(topic(part, partitions=2)).drop("offset"), source)
    queries = [q(ref_id="A"), q(partition=2, ref_id="B"), q(offset="last_n", last_n=3, ref_id="C")]
    fields = [FieldSpec("a", "long", depths=(1,))]
    shared = both(spark, queries, source, fields=fields)
    assert scans(shared) == 1
    assert Counter(r["ref_id"] for r in shared.collect()) == {"A": 42, "C": 6}


def test_left_over_map(spark, topic):
    values = ['{"a":1,"b":{"c":"x","d":[1,"<"]},"e":2.5,"f":true,"g":null}', '{"a":2}', '{"extra":1,"b.c":"q\\"r"}', "{bad", '[{"a":7}]']
    fields = [FieldSpec("a", "long", depths=(1,)), FieldSpec("extra", "long", depths=(1,))]
    wide = run(spark, q(extra=True), topic(values), fields=fields)
    assert wide.columns == ["time", "partition", "offset", "a", "value.extra", "extra", "error"]
    got = {r["offset"]: r["extra"] for r in wide.collect()}
    assert got == {
        0: {"b.c": "x", "b.d": '[1,"\\u003c"]', "e": "2.5", "f": "true", "g": None},
        1: {}, 2: {"b.c": 'q"r'}, 3: None, 4: {"item_0.a": "7"},
    }
    with pytest.raises(ValueError, match="extra"):
        q(extra=True, shape="long")
    assert q().fingerprint() != q(extra=True).fingerprint()


def test_left_over_map_of_a_stream(spark, topic, tmp_path):
    """A path that comes up while the stream runs is in the map."""
    source = TopicSource(path=str(tmp_path / "log"))
    write_topic(topic(['{"a":1}'] * 3), source)
    query, fields = q(extra=True), [FieldSpec("a", "long", depths=(1,))]
    options = StreamOptions(str(tmp_path / "progress"), available_now=True)
    for new in (None, ['{"a":2,"new":"x"}']):
        if new:
            write_topic(topic(new, start=10), source)
        frame = stream_frame(spark, query, source, fields=fields, options=options)
        start_stream(frame, query, options, path=str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter((r["a"], str(r["extra"])) for r in got) == {(1, "{}"): 3, (2, "{'new': 'x'}"): 1}
