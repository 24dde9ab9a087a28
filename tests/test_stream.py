import pytest

from tidelog.operators.wide import FieldSpec
from tidelog.plans.query import TopicQuery
from tidelog.plans.run import run
from tidelog.sources.sink import write_topic
from tidelog.sources.topic import TopicSource, read_topic
from tidelog.streaming.stream import StreamOptions, start_stream, stream_frame


@pytest.fixture
def stored(topic, tmp_path):
    source = TopicSource(path=str(tmp_path / "topic"))
    write_topic(topic(['{"a":1}', "bad", '{"a":2,"b":"x"}', "[1]"], partitions=2), source)
    return source


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize(
    "query",
    [
        TopicQuery("t", offset="earliest", shape="long"),
        TopicQuery("t", offset="last_n", last_n=1),
        TopicQuery("t", offset="earliest", format="plaintext", partition=1),
    ],
    ids=["long", "wide last one", "plain text"],
)
def test_stream_equals_batch(spark, stored, tmp_path, query):
    fields = [FieldSpec("a", "long"), FieldSpec("b", "string")]
    options = StreamOptions(str(tmp_path / "checkpoints"), available_now=True)
    frame = stream_frame(spark, query, stored, fields=fields, options=options)
    assert frame.isStreaming
    out = str(tmp_path / "out")
    start_stream(frame, query, options, path=out).awaitTermination()
    batch = run(spark, query, read_topic(spark, stored, "t"), fields=fields)
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_latest_sees_only_new_messages(spark, topic, stored, tmp_path):
    query = TopicQuery("t", format="plaintext")
    options = StreamOptions(str(tmp_path / "checkpoints"), available_now=True)
    frame = stream_frame(spark, query, stored, options=options)
    start_stream(frame, query, options, table="first_look").awaitTermination()
    assert spark.table("first_look").count() == 0
    out = str(tmp_path / "out")
    start_stream(frame, query, options, path=out).awaitTermination()
    assert spark.read.schema(frame.schema).parquet(out).count() == 0
    write_topic(topic(["new", "newer"], partitions=2, start=2), stored)
    start_stream(frame, query, options, path=out).awaitTermination()
    got = spark.read.parquet(out).orderBy("partition").collect()
    assert [(r["offset"], r["message"]) for r in got] == [(2, "new"), (2, "newer")]


def test_stream_resumes_from_its_checkpoint(spark, topic, stored, tmp_path):
    query = TopicQuery("t", offset="earliest", format="plaintext")
    options = StreamOptions(str(tmp_path / "checkpoints"), available_now=True, max_files=1)
    out = str(tmp_path / "out")
    for values in (None, ["more"]):
        if values:
            write_topic(topic(values, start=9), stored)
        frame = stream_frame(spark, query, stored, options=options)
        start_stream(frame, query, options, path=out).awaitTermination()
    assert spark.read.parquet(out).count() == 5
    other = TopicQuery("t", offset="earliest", format="plaintext", alias="x")
    assert options.checkpoint(query) != options.checkpoint(other)


def test_errors_get_their_own_sink(spark, stored, tmp_path):
    query = TopicQuery("t", offset="earliest")
    options = StreamOptions(str(tmp_path / "checkpoints"), available_now=True)
    frame = stream_frame(spark, query, stored, fields=[FieldSpec("a", "long")], options=options)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    start_stream(
        frame,
        query,
        options,
        each_batch=lambda batch, n: batch.write.mode("append").parquet(good),
        errors=lambda batch, n: batch.write.mode("append").parquet(bad),
    ).awaitTermination()
    assert spark.read.parquet(good).count() == 3
    assert spark.read.parquet(bad).columns == ["time", "partition", "offset", "error"]
    assert spark.read.parquet(bad).count() == 1


def test_line_protocol_streams(spark, topic, tmp_path):
    source = TopicSource(path=str(tmp_path / "topic"))
    write_topic(topic(["m,h=a f=1\nbroken", "junk", "m,k=b g=2 5"]), source)
    query = TopicQuery("t", offset="earliest", format="lineprotocol", lp_fields="f|g")
    options = StreamOptions(str(tmp_path / "checkpoints"), available_now=True)
    frame = stream_frame(spark, query, source, tag_keys=["h", "k"], options=options)
    start_stream(frame, query, options, path=str(tmp_path / "out")).awaitTermination()
    batch = run(spark, query, read_topic(spark, source, "t"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch)
    assert batch.count() == 3


def test_partition_and_topic_prune_folders(spark, stored):
    df = read_topic(spark, stored, "t").filter("partition = 1 AND offset >= 1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "(partition" in plan
    assert "GreaterThanOrEqual(offset,1)" in plan
