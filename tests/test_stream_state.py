"""Good and error rows under one commit; what a stream remembers of its fields."""

from collections import Counter

import pytest

from tidelog.operators.infer import infer_fields
from tidelog.operators.lineprotocol import lp_tag_keys
from tidelog.operators.wide import FieldSpec
from tidelog.plans.query import TopicQuery
from tidelog.sources.sink import write_topic
from tidelog.sources.topic import TopicSource, read_topic
from tidelog.streaming import journal as journals
from tidelog.streaming.journal import batches, committed, journal, read_journal, total
from tidelog.streaming.registry import FieldRegistry, fields_seen, merged, registering, tags_seen
from tidelog.streaming.stream import StreamOptions, start_stream, stream_frame

QUERY = TopicQuery("t", offset="earliest")
FIELDS = [FieldSpec("a", "long", depths=(1,))]


@pytest.fixture
def source(topic, tmp_path):
    s = TopicSource(path=str(tmp_path / "topic"))
    write_topic(topic([f'{{"a":{i}}}' if i % 3 else "bad" for i in range(12)], partitions=2), s)
    return s


def follow(spark, source, path, tmp_path, max_files=None):
    options = StreamOptions(str(tmp_path / "progress"), available_now=True, max_files=max_files)
    frame = stream_frame(spark, QUERY, source, fields=FIELDS, options=options)
    start_stream(frame, QUERY, options, journal_path=path).awaitTermination()
    return frame.schema


def contents(spark, path, schema):
    good = read_journal(spark, path, QUERY.fingerprint(), schema)
    bad = read_journal(spark, path, QUERY.fingerprint(), schema, "errors")
    return Counter(r["a"] for r in good.collect()), Counter((r["partition"], r["offset"]) for r in bad.collect())


GOOD = Counter(i for i in range(12) if i % 3)
BAD = Counter((i % 2, i // 2) for i in range(12) if i % 3 == 0)


def test_good_and_error_rows(spark, source, tmp_path):
    path = str(tmp_path / "journal")
    schema = follow(spark, source, path, tmp_path, max_files=5)
    assert contents(spark, path, schema) == (GOOD, BAD)
    assert len(committed(spark, path, QUERY.fingerprint())) >= 2
    assert total(spark, path, QUERY.fingerprint()) == (8, 4)
    assert batches(spark, path, "other").count() == 0 and read_journal(spark, path, "other", schema).count() == 0
    with pytest.raises(ValueError, match="table"):
        read_journal(spark, path, "other", schema, "both")


def test_a_batch_that_dies_between_the_sinks(spark, source, tmp_path, monkeypatch):
    """Killed after the good rows, then after the error rows, then after its
    commit but before Spark's own: no row twice, none lost."""
    path = str(tmp_path / "journal")
    plain = journals.split_errors

    def dies_after_good(batch):
        good, bad = plain(batch)
        return good, bad.selectExpr("*", "raise_error('killed') AS x")

    def dies_before_commit(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(journals, "split_errors", dies_after_good)
    with pytest.raises(Exception, match="killed"):
        follow(spark, source, path, tmp_path)
    monkeypatch.setattr(journals, "split_errors", plain)
    schema = stream_frame(spark, QUERY, source, fields=FIELDS).schema
    assert contents(spark, path, schema) == (Counter(), Counter())
    publish = journals.publish
    monkeypatch.setattr(journals, "publish", dies_before_commit)
    with pytest.raises(Exception, match="killed"):
        follow(spark, source, path, tmp_path)
    assert contents(spark, path, schema) == (Counter(), Counter())

    def dies_after_commit(*given):
        publish(*given)
        raise RuntimeError("killed")

    monkeypatch.setattr(journals, "publish", dies_after_commit)
    with pytest.raises(Exception, match="killed"):
        follow(spark, source, path, tmp_path)
    monkeypatch.setattr(journals, "publish", publish)
    follow(spark, source, path, tmp_path)
    assert contents(spark, path, schema) == (GOOD, BAD)


def test_a_repeated_batch_changes_nothing(spark, topic, tmp_path):
    path = str(tmp_path / "journal")
    rows = spark.createDataFrame([(1, 0, 5, None), (2, 0, 6, "bad")], "time int, partition int, offset long, error string")
    write = journal(path, "s")
    write(rows, 0)
    write(rows.limit(0), 0)
    write(rows, 1)
    assert read_journal(spark, path, "s", rows.schema).count() == 2
    assert read_journal(spark, path, "s", rows.schema, "errors").count() == 2


MESSAGES = ['{"a":1,"b":{"c":"x"}}', '{"a":1.5,"d":null}', "bad", '{"b":{"c":true},"e":[1]}', '{"a":7,"d":null}', "[1]"]
LINES = ["cpu,host=a,zone=z load=1", "free text", "cpu,rack=r load=2\nmem,host=b free=1", "mem,area=q,zone=y free=1"]


def test_two_batches_give_the_registry_of_one(spark, topic, tmp_path):
    source = TopicSource(path=str(tmp_path / "topic"))
    registry = FieldRegistry(spark, str(tmp_path / "fields"))
    options = StreamOptions(str(tmp_path / "progress"), available_now=True)
    found = []
    for number, part in enumerate((MESSAGES[:3], MESSAGES[3:])):
        write_topic(topic(part, partitions=2, start=10 * number), source)
        # a new query object each time: what was learned before the restart is still there
        registry = FieldRegistry(spark, registry.path)
        raw = read_topic(spark, source, "t", stream=True)
        write = registering(registry, fields_seen, lambda batch, n: found.append([f.path for f in registry.fields()]))
        start_stream(raw, QUERY, options, each_batch=write).awaitTermination()
    whole = read_topic(spark, source, "t")
    expected = infer_fields(whole).orderBy("path").collect()
    assert [(f.path, f.type, f.mixed, f.depths) for f in registry.fields()] == [
        (r["path"], r["type"], r["mixed"], tuple(r["depths"])) for r in expected
    ]
    assert found == [["a", "b.c", "d"], ["a", "b.c", "d", "e", "item_0"]]
    rows = lambda df: Counter(map(str, df.select(*sorted(df.columns)).collect()))
    assert rows(registry.rows()) == rows(fields_seen(whole))


def test_tag_keys_in_first_seen_order_over_batches(spark, topic, tmp_path):
    registry = FieldRegistry(spark, str(tmp_path / "tags"))
    parts = [topic(LINES[:2]), topic(LINES[2:], start=2)]
    for number, part in enumerate(parts):
        registry.add(tags_seen(part), number)
        registry.add(tags_seen(part), number)  # repeated: nothing is added
    whole = parts[0].union(parts[1])
    assert registry.tag_keys() == lp_tag_keys(whole)
    assert registry.tag_keys(cap=2) == lp_tag_keys(whole)[:2]
    assert registry.rows().count() == tags_seen(whole).count()
    one = merged(tags_seen(parts[1]), tags_seen(parts[0]))
    assert Counter(map(str, one.collect())) == Counter(map(str, registry.rows().select(*one.columns).collect()))


def test_a_batch_that_dies_before_its_registry_is_published(spark, topic, tmp_path, monkeypatch):
    from tidelog.streaming import registry as module

    registry = FieldRegistry(spark, str(tmp_path / "fields"))
    registry.add(fields_seen(topic(MESSAGES[:2])), 0)
    plain = module.publish
    monkeypatch.setattr(module, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        registry.add(fields_seen(topic(MESSAGES[3:4])), 1)
    monkeypatch.setattr(module, "publish", plain)
    assert [f.path for f in registry.fields()] == ["a", "b.c", "d"]
    registry.add(fields_seen(topic(MESSAGES[3:4])), 1)
    assert [f.path for f in registry.fields()] == ["a", "b.c", "d", "e"]
    assert {f.path: f.type for f in registry.fields()}["b.c"] == "string"
